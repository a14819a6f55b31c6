"""Abusive, hateful or sexual content: a factorization machine over hashed terms.

Method: words are normalised (accents, look-alike characters, spacing, stretched letters,
stars), documents are cut into overlapping windows, and the hashed words of a window enter
a factorization machine. No pair of words is a feature: its pairwise factors learn which
words are abusive together, such as an insult with an address or a group, and which are
not, such as an insult with words of report; additive weights alone miss these. A
document's score is that of its highest window. The machine is trained here on at most
``MAX_LABELS`` documents with a reviewer's verdict (majority of repeated verdicts; ties and
nulls left out); every document is scored whole. Linear weights start at half the log odds
of a term and are held small, so that the factors have to carry what they cannot.

Defined results: null and wordless texts score 0.0 and are not found; with no usable
verdicts, or of one kind only, every score is 0.0; repeated rows give repeated scores,
and of rows that repeat a labelled id the least text is learned from; null and blank
sources count as one source named ``unknown``; empty tables give empty results.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictaspark.session import ship, spread

BITS = 17
SIZE = 1 << BITS
FACTORS = 8
WINDOW, STEP = 10, 5
MAX_LABELS = 6000
EPOCHS, PARTS = 40, 4
RATE_W, RATE_V = 0.1, 0.1
DECAY_W, DECAY_V = 1e-2, 3e-2
HARD = 6
CUT = 0.2
BLOCK_CHARS = 400_000
FILLERS = frozenset("um uh er hmm euh bah ben hum".split())
_MARKS = re.compile(r"[̀-ͯ]+")
_EDGE = ".,;:!?…«»\"'()[]"
_SPELT = re.compile(r"^[^\W_](?:[-._·][^\W_])+$")
_NUMERIC = re.compile(r"^[$+]?\d[\d.,:h%-]*(?:am|pm|h|st|nd|rd|th|eme|e|%)?$")
_LOOK = str.maketrans("@$01345", "asoieas")
_STRETCH = re.compile(r"([^\W\d_])\1+")
_ODD = re.compile(r"[@$*\d]")


#: What a token gives: its core ("" for nothing), whether it is a single letter, and its terms.
Token = tuple[str, bool, tuple[str, ...]]


def token_of(raw: str) -> Token:
    """One token in lower case. A word with stars becomes its first letter, ``*``, its length and its last letter."""
    if not raw.isascii():
        raw = _MARKS.sub("", unicodedata.normalize("NFD", raw.replace("’", "'")))
    core = raw.strip(_EDGE)
    if not core or core in FILLERS:
        return "", False, ()
    if len(core) == 1 and core.isalnum() and not core.isdigit():
        return core, True, ()
    if _SPELT.match(core) and not core[0].isdigit():
        return core, False, (_STRETCH.sub(r"\1", re.sub(r"[-._·]", "", core)),)
    if _NUMERIC.match(core):
        return core, False, ("0",)
    if "*" in core:
        return core, False, (f"{core[0]}*{len(core)}{core[-1]}" if core.strip("*") else "*",)
    plain = core.translate(_LOOK) if _ODD.search(core) else core
    return core, False, tuple(_STRETCH.sub(r"\1", part) if not part.isdigit() else "0" for part in re.split(r"[-'/_]", plain) if part)


def terms_of(text: str | None, known: dict[str, Token] | None = None) -> list[str]:
    """Normalised words; letters that stand alone, three or more in a row, are a spelt-out word; a repeated token counts once."""
    if not text:
        return []
    known = {} if known is None else known
    out: list[str] = []
    spelt: list[str] = []
    last = ""

    def close() -> None:
        if len(spelt) >= 3:
            out.append(_STRETCH.sub(r"\1", "".join(spelt)))
        else:
            out.extend(spelt)
        spelt.clear()

    for raw in text.lower().split():
        token = known.get(raw)
        if token is None:
            if len(known) > 500_000:
                known.clear()
            token = known[raw] = token_of(raw)
        core, single, terms = token
        if not core or core == last and len(core) > 1:
            continue
        last = core
        if single:
            spelt.append(core)
        else:
            if spelt:
                close()
            out.extend(terms)
    if spelt:
        close()
    return out


_CODES: dict[str, int] = {}


def code(name: str) -> int:
    value = _CODES.get(name)
    if value is None:
        if len(_CODES) > 800_000:
            _CODES.clear()
        value = _CODES[name] = crc32(name.encode()) & (SIZE - 1)
    return value


def codes_of(terms: list[str], masked: dict[str, str]) -> list[int]:
    """Hashed terms; words with stars stand for their likeliest word."""
    if masked:
        return [code(masked.get(t, t) if "*" in t else t) for t in terms]
    return [code(t) for t in terms]


class Machine:
    """b + sum of w + half (square of sums - sum of squares) of v over the terms of a window."""

    def __init__(self, seed: int = 9, scale: float = 0.1):
        self.b = -1.5
        self.w = np.zeros(SIZE, np.float32)
        self.v = np.random.default_rng(seed).normal(0, scale, (SIZE, FACTORS)).astype(np.float32)

    def scores(self, docs: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, document, first place) of every window; windows are two blocks of ``STEP`` terms, one block apart."""
        many = np.array([-(-len(d) // STEP) for d in docs], np.int64)
        flat = np.fromiter((c for d in docs for c in d), np.int64)
        if not len(flat):
            return np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        length = np.array([len(d) for d in docs], np.int64)
        doc = np.repeat(np.arange(len(docs)), many)
        block = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
        starts = np.repeat(np.cumsum(length) - length, many) + STEP * block
        v = self.v[flat]
        linear = np.add.reduceat(self.w[flat], starts).astype(np.float64)
        sums = np.add.reduceat(v, starts, axis=0).astype(np.float64)
        squares = np.add.reduceat((v * v).sum(1), starts).astype(np.float64)
        joined = np.flatnonzero(doc[:-1] == doc[1:])
        for x in (linear, sums, squares):
            x[joined] = x[joined] + x[joined + 1]
        use = (block + 1 < np.repeat(many, many)) | (np.repeat(many, many) == 1)
        score = self.b + linear + 0.5 * ((sums * sums).sum(1) - squares)
        return score[use], doc[use], STEP * block[use]

    def best(self, docs: list[list[int]]) -> np.ndarray:
        """Highest window of every document; minus infinity without terms."""
        score, doc, _ = self.scores(docs)
        out = np.full(len(docs), -np.inf)
        np.maximum.at(out, doc, score)
        return out


def fit(texts: list[str], labels: list[int]) -> tuple[Machine, dict[str, str]] | None:
    """Machine and the words meant by starred ones, or None when there is nothing to learn; deterministic."""
    # texts that are the same but for layout speak once, by majority
    votes: dict[str, list] = {}
    for text, label in zip(texts, labels):
        words = terms_of(text)
        votes.setdefault(" ".join(words), [words, []])[1].append(label)
    kept = [(words, int(2 * sum(v) > len(v))) for words, v in votes.values() if words and 2 * sum(v) != len(v)]
    terms, y = [w for w, _ in kept], np.array([v for _, v in kept])
    if not len(y) or y.min() == y.max():
        return None
    machine = Machine()
    docs = [codes_of(t, {}) for t in terms]
    pos, neg = _counts(docs, y)
    machine.w = _odds(pos, neg, y)
    masked = _masked(terms, machine)
    if masked:
        docs = [codes_of(t, masked) for t in terms]
        pos, neg = _counts(docs, y)
        machine.w = _odds(pos, neg, y)
    doubtful = _doubtful(docs, y, pos, neg)
    machine.w *= 0.5
    machine.v[pos + neg < 2] = 0.0
    _train(machine, docs, y, doubtful, (pos >= 2) | (neg >= 1), pos + neg >= 2)
    return machine, masked


def _windows(docs: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(terms of each window, filled up with SIZE; document of each window)."""
    rows = [(k, d[at : at + WINDOW]) for k, d in enumerate(docs) for at in range(0, max(1, len(d) - STEP), STEP)]
    out = np.full((len(rows), WINDOW), SIZE, np.int64)
    for row, (_, part) in zip(out, rows):
        row[: len(part)] = part
    return out, np.array([k for k, _ in rows])


def _doubtful(docs: list[list[int]], y: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    """Abusive verdicts on texts that look harmless by the other documents' terms; some verdicts are wrong."""
    machine, first = Machine(scale=0.0), np.zeros(len(docs))
    for k, d in enumerate(docs):
        seen = np.unique(d)
        machine.w[seen] = _odds(pos[seen] - y[k], neg[seen] - (1 - y[k]), y)
        first[k] = machine.best([d])[0]
    doubtful = (y == 1) & (first <= np.quantile(first[y == 0], 0.98))
    # where additive terms cannot tell most of them apart, they say nothing about single verdicts
    return doubtful if 2 * doubtful.sum() <= y.sum() else np.zeros(len(docs), bool)


def _train(machine: Machine, docs: list[list[int]], y: np.ndarray, doubtful: np.ndarray, linear: np.ndarray, paired: np.ndarray) -> None:
    """Adaptive gradient steps on the highest window of abusive documents and the ``HARD`` highest of others."""
    parts, owner = _windows(docs)
    first = np.searchsorted(owner, np.arange(len(docs)))
    w, v, b = np.append(machine.w, 0.0).astype(np.float64), np.vstack([machine.v, np.zeros((1, FACTORS))]).astype(np.float64), machine.b
    gw, gv, gb = np.full(SIZE + 1, 0.05), np.full((SIZE + 1, FACTORS), 0.05), 0.05
    weight = np.where(y == 1, min(4.0, (y == 0).sum() / y.sum()), 1 / HARD**0.5)
    rng, out = np.random.default_rng(4), doubtful.copy()

    def score(x: np.ndarray) -> np.ndarray:
        f = v[x]
        s = f.sum(1)
        return b + w[x].sum(1) + 0.5 * ((s * s).sum(1) - (f * f).sum((1, 2)))

    for epoch in range(EPOCHS):
        now = score(parts)
        order = np.lexsort((-now, owner))
        rank = np.arange(len(owner)) - first[owner[order]]
        use = order[((rank < 1) | ((y[owner[order]] == 0) & (rank < HARD))) & ~out[owner[order]]]
        for part in np.array_split(rng.permutation(use), PARTS):
            if not len(part):
                continue
            x, label = parts[part], y[owner[part]]
            slope = (1 / (1 + np.exp(-np.clip(score(x), -30, 30))) - label) * weight[owner[part]]
            seen, at = np.unique(x, return_inverse=True)
            at = at.reshape(-1)
            real = seen < SIZE
            times = np.bincount(at, minlength=len(seen))
            step = np.bincount(at, np.repeat(slope, WINDOW), len(seen)) + DECAY_W * w[seen] * times
            step *= real & np.append(linear, False)[seen]
            gw[seen] += step * step
            w[seen] -= RATE_W * step / np.sqrt(gw[seen])
            gb += slope.sum() ** 2
            b -= RATE_W * slope.sum() / np.sqrt(gb)
            f = v[x]
            pull = (slope[:, None, None] * (f.sum(1, keepdims=True) - f)).reshape(-1, FACTORS)
            step = np.stack([np.bincount(at, pull[:, k], len(seen)) for k in range(FACTORS)], 1) + DECAY_V * v[seen] * times[:, None]
            step *= (real & np.append(paired, False)[seen])[:, None]
            gv[seen] += step * step
            v[seen] -= RATE_V * step / np.sqrt(gv[seen])
        if epoch in (EPOCHS // 2, EPOCHS * 3 // 4):  # verdicts far off by now are taken for wrong ones
            best = np.maximum.reduceat(score(parts), first)
            out = (doubtful & (best < np.quantile(best[y == 0], 0.98))) | ((y == 0) & (best > 3))
    machine.w, machine.v, machine.b = w[:SIZE].astype(np.float32), v[:SIZE].astype(np.float32), float(b)


def _counts(docs: list[list[int]], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Abusive and other documents of each term."""
    pos, neg = np.zeros(SIZE), np.zeros(SIZE)
    for d, label in zip(docs, y):
        (pos if label else neg)[np.unique(d)] += 1
    return pos, neg


def _odds(pos: np.ndarray, neg: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smoothed log odds of terms; those of a single abusive document say nothing."""
    odds = np.log((pos + 0.3) / max(1, y.sum())) - np.log((neg + 0.3) / max(1, (1 - y).sum()))
    support = np.minimum(1.0, (pos + neg) / 4) * ((pos >= 2) | (neg >= 1))
    return (0.35 * np.clip(np.where(np.abs(odds) > 1.0, odds, 0) * support, -3, 4)).astype(np.float32)


def _masked(terms: list[list[str]], machine: Machine) -> dict[str, str]:
    """For each shape of a starred word, the known word of that shape with the largest weight."""
    best: dict[str, tuple[float, str]] = {}
    for word in sorted({t for ts in terms for t in ts if "*" not in t and len(t) > 2}):
        w = float(machine.w[code(word)])
        if w > 0.2:
            for length in (len(word), len(word) + 1):  # a doubled letter was folded
                shape = f"{word[0]}*{length}{word[-1]}"
                if shape not in best or w > best[shape][0]:
                    best[shape] = (w, word)
    return {shape: word for shape, (_, word) in best.items()}


def _scorer(model: tuple | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, Token] = {}
        for pdf in batches:
            out, texts, at = np.zeros(len(pdf)), pdf["text"].tolist(), 0
            while model is not None and at < len(texts):  # blocks of bounded text
                end, size = at, 0
                while end < len(texts) and (end == at or size < BLOCK_CHARS):
                    size += len(texts[end] or "")
                    end += 1
                best = model[0].best([codes_of(terms_of(t, known), model[1]) for t in texts[at:end]])
                out[at:end] = np.where(np.isfinite(best), 1 / (1 + np.exp(-np.clip(best, -30, 30))), 0.0)
                at = end
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "score": out})

    return run


def verdicts(labels: DataFrame) -> DataFrame:
    """One verdict a document: the majority; ties and nulls are left out."""
    kept = labels.filter("toxic is not null and doc_id is not null")
    return kept.groupBy("doc_id").agg(F.avg(F.when(F.col("toxic") > 0, 1.0).otherwise(0.0)).alias("m")).filter("m <> 0.5").select("doc_id", (F.col("m") > 0.5).cast("int").alias("toxic"))


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, source, score)`` of every document. At most MAX_LABELS labelled texts reach the driver."""
    ship(documents.sparkSession)
    docs = documents.select("doc_id", F.coalesce(F.nullif(F.lower(F.trim("source")), F.lit("")), F.lit("unknown")).alias("source"), "text")
    chosen = verdicts(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELS)
    sample = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")).collect()
    rows = sorted(((r["doc_id"], r["text"] or "", r["toxic"]) for r in sample))
    model = fit([t for _, t, _ in rows], [y for *_, y in rows])
    return spread(docs.select("doc_id", "source", "text")).mapInPandas(_scorer(model), "doc_id bigint, source string, score double")


def rates(scores: DataFrame, cut: float = CUT) -> DataFrame:
    """Documents, flagged documents and rate of every source."""
    flagged = F.sum((F.col("score") >= cut).cast("bigint"))
    return scores.groupBy("source").agg(F.count("*").alias("documents"), flagged.alias("flagged"), (flagged / F.count("*")).alias("rate"))

"""Evaluation texts leaking into training text: latent semantic retrieval with exact checks.

Method: documents are cut into passages of two blocks of ``RUN`` words, one block apart, so
that any run of ``RUN`` words lies wholly in a passage. Terms are hashed and weighted by
their document frequency over all documents. A distributed randomised singular value
decomposition of TF-IDF passages gives the latent space: those of all items and those of
``SAMPLE_DOCS`` documents, the first by hash. Power steps find the range, the small
matrix of the last step gives singular values and vectors, and the ``RANK`` largest stay.
Every passage of every document is projected and searched for item passages of cosine
``COSINE`` or more through an index: all item passages lie in cells around centres, and the
``PROBES`` nearest cells are searched. Candidates are then checked exactly for a run of ``RUN`` words.
For paraphrases, the longest common subsequence of the item with the document around the
best passage, and the item's answers (its numbers and rare words) found there, decide.

Items are searched in blocks of ``ITEM_BLOCK``, each broadcast, whatever their number.

Defined results: case, accents, punctuation, layout and fillers do not count; null and
short texts leak nothing; an item of fewer than ``RUN`` words cannot be found; repeated
documents each report; rows that repeat an item id report each; empty tables give an
empty result.
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

from dictaspark.llm.sampling import hashed_sample
from dictaspark.session import checkpoint, ship, spread

RUN = 12
TERMS = 1 << 14
RANK = 96
OVERSAMPLE = 16
POWER = 2
COSINE = 0.25
ITEM_STRIDE = 3
PROBES = 8
SAMPLE_DOCS = 300
ITEM_BLOCK = 5_000
RARE = 6.0
LCS_SHARE, ANSWER_SHARE = 0.6, 0.5
BLOCK_CHARS = 200_000
FILLERS = frozenset("um uh er hmm euh bah ben hum".split())
_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile(r"[̀-ͯ]+")


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    plain = text.lower()
    if not plain.isascii():
        plain = _MARKS.sub("", unicodedata.normalize("NFD", plain))
    return [w for w in _WORD.findall(plain) if w not in FILLERS]


_CODES: dict[str, int] = {}


def codes_of(words: list[str]) -> list[int]:
    """Hashed terms."""
    if len(_CODES) > 500_000:
        _CODES.clear()
    for w in words:
        if w not in _CODES:
            _CODES[w] = crc32(w.encode()) % TERMS
    return [_CODES[w] for w in words]


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    df, n = np.zeros(TERMS + 1, np.int64), 0
    for pdf in batches:
        for text in pdf["text"]:
            df[list(set(codes_of(words_of(text))))] += 1
            n += 1
    df[TERMS] = n
    yield pd.DataFrame({"term": np.arange(TERMS + 1), "n": df})


def inverse_frequencies(documents: DataFrame) -> np.ndarray:
    """Weight of each hashed term from its document frequency over all documents."""
    rows = documents.select("text").mapInPandas(_frequencies, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(TERMS + 1)
    for r in rows:
        df[r["term"]] = r["n"]
    return np.log((1 + df[TERMS]) / (1 + df[:TERMS])) + 0.05


def item_passages(words: list[str]) -> list[list[str]]:
    """Runs of RUN words of an item, ITEM_STRIDE apart, the last one included."""
    if len(words) < RUN:
        return []
    starts = sorted({*range(0, len(words) - RUN + 1, ITEM_STRIDE), len(words) - RUN})
    return [words[k : k + RUN] for k in starts]


def weighted(codes: list[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terms, TF-IDF weights of length 1) of a passage; a term counts once in each of its blocks of RUN words."""
    blocks = np.array(codes, np.int64) + TERMS * (np.arange(len(codes)) // RUN)
    term, times = np.unique(np.unique(blocks) % TERMS, return_counts=True)
    weight = times * idf[term]
    return term, weight / (np.linalg.norm(weight) or 1.0)


def _sketch(basis: np.ndarray, idf: np.ndarray):
    """Sum over the partition's passages of a (a · basis), by term: one step of the range finder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for text, item in zip(pdf["text"], pdf["item"]):
                words = words_of(text)
                for passage in item_passages(words) if item else document_passages(words):
                    term, weight = weighted(codes_of(passage), idf)
                    image = weight @ basis[term]
                    for c, w in zip(term.tolist(), weight):
                        total[c] = total.get(c, 0.0) + w * image
        yield pd.DataFrame({"term": list(total), "image": pd.Series([v.tolist() for v in total.values()], dtype=object)})

    return run


def document_passages(words: list[str]) -> list[list[str]]:
    """Two blocks of RUN words each, one block apart; what is left over at the end belongs to the last."""
    return [words[k : k + 2 * RUN] for k in range(0, max(1, len(words) - RUN), RUN)] if len(words) >= RUN else []


def decompose(passages: DataFrame, idf: np.ndarray, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """(TERMS x rank right singular vectors, singular values) of ``passages(text, item)`` by randomised subspace iteration.

    Each step is one distributed pass; the reduced TERMS x width matrix, of fixed size, is
    orthogonalised on the driver. With Q the range and Z = A'AQ of the last pass, Q'Z is the
    small matrix whose eigenvectors turn Q into singular vectors of A.
    """
    width = rank + OVERSAMPLE
    basis = np.linalg.qr(np.random.default_rng(13).standard_normal((TERMS, width)))[0]
    for step in range(POWER + 1):
        parts = passages.mapInPandas(_sketch(basis, idf), "term int, image array<double>")
        summed = parts.groupBy("term").agg(F.collect_list("image").alias("images")).select("term", F.aggregate(
            F.slice("images", 2, F.greatest(F.size("images") - 1, F.lit(0))), F.col("images")[0], lambda a, b: F.zip_with(a, b, lambda x, y: x + y)).alias("image"))
        image = np.zeros((TERMS, width))
        for r in summed.toLocalIterator():
            image[r["term"]] = r["image"]
        if step < POWER:
            basis = np.linalg.qr(image)[0]
    small = basis.T @ image
    value, turn = np.linalg.eigh((small + small.T) / 2)
    keep = np.argsort(-value)[:rank]
    keep = keep[value[keep] > 1e-9 * max(1e-30, value.max())]
    return (basis @ turn[:, keep]).astype(np.float32), np.sqrt(value[keep])


def lcs(a: list[str], b: list[str]) -> int:
    at: dict[str, int] = {}
    for k, w in enumerate(a):
        at[w] = at.get(w, 0) | (1 << k)
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        if m := at.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


class Index:
    """Projected item passages of length 1 in cells around centres found by spherical k-means; every passage is in one cell."""

    def __init__(self, items: list[tuple[int, list[str]]], basis: np.ndarray, idf: np.ndarray, probes: int = PROBES):
        owner, rows = [], []
        for k, (_, words) in enumerate(items):
            for passage in item_passages(words):
                term, weight = weighted(codes_of(passage), idf)
                owner.append(k)
                rows.append(weight.astype(np.float32) @ basis[term])
        query = np.array(rows, np.float32).reshape(len(rows), basis.shape[1])
        query /= np.linalg.norm(query, axis=1, keepdims=True) + 1e-9
        count = max(1, int(len(query) ** 0.5))
        centre = query[np.linspace(0, len(query) - 1, count).astype(int)] if len(query) else np.zeros((0, basis.shape[1]), np.float32)
        cell = np.zeros(len(query), np.int64)
        for _ in range(8 if len(query) else 0):
            cell = (query @ centre.T).argmax(1)
            total = np.zeros_like(centre)
            np.add.at(total, cell, query)
            size = np.linalg.norm(total, axis=1, keepdims=True)
            centre = np.where(size > 0, total / (size + 1e-9), centre)
        cell = (query @ centre.T).argmax(1) if len(query) else cell
        order = np.argsort(cell, kind="stable")
        self.query, self.owner, self.centre, self.probes = query[order], np.array(owner, np.int64)[order], centre, min(probes, len(centre))
        self.starts = np.searchsorted(cell[order], np.arange(len(centre) + 1))

    def near(self, passage: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, cosine) of pairs at or above ``least`` in the ``probes`` cells nearest to each passage."""
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))]
        if self.probes:
            value = passage @ self.centre.T
            able = np.linalg.norm(passage, axis=1) >= least  # no cosine exceeds the projected length
            probed = np.argpartition(-value, self.probes - 1, axis=1)[:, : self.probes] if self.probes < len(self.centre) else np.tile(np.arange(len(self.centre)), (len(value), 1))
            row = np.repeat(np.flatnonzero(able), self.probes)
            cell = probed[able].reshape(-1)
            order = np.argsort(cell, kind="stable")
            row, cuts = row[order], np.searchsorted(cell[order], np.arange(len(self.centre) + 1))
            for c in range(len(self.centre)):
                rows, part = row[cuts[c] : cuts[c + 1]], slice(self.starts[c], self.starts[c + 1])
                if len(rows) and part.stop > part.start:
                    cosine = passage[rows] @ self.query[part].T
                    a, b = np.nonzero(cosine >= least)
                    out.append((rows[a], self.owner[part][b], cosine[a, b]))
        return tuple(np.concatenate(x) for x in zip(*out))


def _search(shared, cosine: float, measure: bool):
    """``shared`` is the broadcast (items, index, basis, inverse frequencies)."""

    def batch(ids: list, texts: list, state: tuple) -> list[tuple]:
        items, index, basis, idf, grams = state
        docs = [words_of(t) for t in texts]
        keep = [k for k, w in enumerate(docs) if len(w) >= RUN]
        if not keep or not len(index.owner):
            return []
        code = np.array([c for k in keep for c in codes_of(docs[k])])
        length = np.array([len(docs[k]) for k in keep])
        many = -(-length // RUN)
        number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = np.repeat(np.cumsum(length) - length, many) + RUN * number
        of_block = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(code))))
        # a passage is a block and the next of its document; the last block alone only where it is the only one
        follows = number + 1 < np.repeat(many, many)
        key = np.unique(of_block * TERMS + code)
        weight = idf[key % TERMS]
        first = np.flatnonzero(np.diff(key // TERMS, prepend=-1))
        passage = np.add.reduceat(basis[key % TERMS] * weight[:, None].astype(np.float32), first, axis=0)
        mass = np.add.reduceat(weight**2, first)
        shared = np.intersect1d(key, key - TERMS, assume_unique=True)  # terms of a block that the next one holds too
        both = np.bincount(shared // TERMS, 2 * idf[shared % TERMS] ** 2, len(start))
        joined = np.flatnonzero(follows)
        passage[joined] = passage[joined] + passage[joined + 1]
        mass[joined] = mass[joined] + mass[joined + 1] + both[joined]
        use = follows | (np.repeat(many, many) == 1)
        passage = passage[use] / (np.sqrt(mass[use])[:, None].astype(np.float32) + 1e-9)
        doc, place = np.repeat(np.array(keep), many)[use], (RUN * number)[use]
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for h, item, c in zip(*index.near(passage, cosine)):
            pair = (int(doc[h]), int(item))
            if pair not in best or c > best[pair][0]:
                best[pair] = (float(c), int(place[h]))
        out, cache = [], {}
        for (k, item), (cos, at) in best.items():
            runs = cache.get(k)
            if runs is None:
                w = docs[k]
                runs = cache[k] = {" ".join(w[j : j + RUN]) for j in range(len(w) - RUN + 1)}
            verbatim = not runs.isdisjoint(grams(item))
            if verbatim or measure:
                words = items[item][1]
                around = docs[k][max(0, at - len(words)) : at + 2 * RUN + len(words)]
                share = lcs(words, around) / len(words)
                held, sought = set(around), {w for w, c in zip(words, codes_of(words)) if w.isdigit() or idf[c] > RARE}
                answers = len(sought & held) / len(sought) if sought else share
                out.append((ids[k], items[item][0], cos, verbatim, share, answers, verbatim or share >= LCS_SHARE and answers >= ANSWER_SHARE))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, index, basis, idf = shared.value
        made: dict[int, set[str]] = {}

        def grams(item: int) -> set[str]:
            if item not in made:
                w = items[item][1]
                made[item] = {" ".join(w[k : k + RUN]) for k in range(len(w) - RUN + 1)}
            return made[item]

        for pdf in batches:
            ids, texts = pdf["doc_id"].tolist(), pdf["text"].tolist()
            at = 0
            while at < len(texts):  # blocks of bounded text, so that long documents do not pile up
                end, size = at, 0
                while end < len(texts) and (end == at or size < BLOCK_CHARS):
                    size += len(texts[end] or "")
                    end += 1
                yield pd.DataFrame(batch(ids[at:end], texts[at:end], (items, index, basis, idf, grams)), columns=COLUMNS)
                at = end

    return run


COLUMNS = ["doc_id", "item_id", "cosine", "verbatim", "lcs_share", "answer_share", "leak"]
SCHEMA = "doc_id bigint, item_id bigint, cosine double, verbatim boolean, lcs_share double, answer_share double, leak boolean"


def leaks(documents: DataFrame, items: DataFrame, cosine: float = COSINE, measure: bool = False) -> DataFrame:
    """Verified pairs or, with ``measure``, all candidates: ``leak`` holds for verbatim runs and for paraphrases."""
    spark = documents.sparkSession
    ship(spark)
    docs = documents.select("doc_id", "text")
    idf = inverse_frequencies(docs)
    sample = hashed_sample(docs, ["doc_id", "text"], SAMPLE_DOCS).select("text", F.lit(False).alias("item"))
    basis, _ = decompose(checkpoint(items.select("text", F.lit(True).alias("item")).unionByName(sample)), idf)
    held = items.select("item_id", "text")
    blocks = max(1, -(-held.count() // ITEM_BLOCK))
    out = None
    for block in range(blocks):
        rows = held.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect() if blocks > 1 else held.collect()
        listed = sorted(((r["item_id"], words_of(r["text"])) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        shared = spark.sparkContext.broadcast((listed, Index(listed, basis, idf), basis, idf))
        found = spread(docs).mapInPandas(_search(shared, cosine, measure), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out

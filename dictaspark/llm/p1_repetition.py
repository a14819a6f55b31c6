"""Repetition inside one document: log-likelihood ratio of hashed n-grams.

Method: every run of four words is hashed to one of ``BUCKETS`` buckets, apart for its
first and its later occurrences in a document. Two multinomials over these features are
counted over all rows: the raw corpus, and the trusted target, for which every text that
holds a repeated run is left out. Both are interpolated with a prior, the pooled share of
the bucket times the model's rate of repeats, so that buckets seen seldom say little;
the target's rate of repeats, none by construction, is set to ``TRUST`` of the raw one. A
document's score is the log-likelihood ratio raw against target over its number of runs,
the ratio of first occurrences being held within a range. Every document is thresholded:
the bound is derived, not tuned. A document with a share s of repeated words has at least
s/4 of its runs repeated, and the ratio of repeats has a least value by the interpolation,
so no such document scores below the bound, while texts that do not loop do. Documents at
or above the bound are candidates; the exact share decides among them.

Defined results: null and wordless texts have 0 words, score 0.0 and share 0.0 and are no
candidates; fewer than four words cannot repeat; whole texts of any length are read; the
share is exact for every row, candidate or not; repeated rows give repeated results; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictaspark.session import ship, spread

N = 4
BUCKETS = 1 << 14
SHARE = 0.4
TRUST = 0.01
MIXED = 0.5
_LEAST = math.log(1 / TRUST)
#: First occurrences count within this range, so that the bound stays above 0.
RANGE = _LEAST * SHARE / N / 2
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def runs(words: list[str]) -> list[int]:
    """Places of runs of four words that stood at an earlier place."""
    seen: set[str] = set()
    again = []
    for k, run in enumerate(map(" ".join, zip(words, words[1:], words[2:], words[3:]))):
        if run in seen:
            again.append(k)
        else:
            seen.add(run)
    return again


def repeated_words(places: list[int]) -> int:
    """Words covered by runs that start at these ascending places."""
    covered, end = 0, 0
    for k in places:
        covered += k + N - max(end, k)
        end = k + N
    return covered


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each run, feature of each run), runs in order.

    A run's feature is its bucket, plus BUCKETS when the run stood earlier in its text.
    """
    found = [_WORD.findall(t.lower()) if t else [] for t in texts]
    length = np.array([len(w) for w in found], dtype=np.int64)
    flat = np.array([w for ws in found for w in ws], dtype=object)
    if len(flat) < N:
        return length, np.empty(0, np.int64), np.empty(0, np.int64)
    codes, names = pd.factorize(flat)
    word = pd.util.hash_array(names, categorize=False)[codes]
    doc = np.repeat(np.arange(len(texts)), length)
    key = word[: -N + 1].copy()
    for k in range(1, N):
        key = key * np.uint64(0x9E3779B97F4A7C15) + word[k : len(word) - N + 1 + k]
    whole = doc[: -N + 1] == doc[N - 1 :]
    key, doc = key[whole], doc[: -N + 1][whole]
    bucket = ((key >> np.uint64(33)) % np.uint64(BUCKETS)).astype(np.int64)
    again = pd.Series(key ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))).duplicated().to_numpy()
    return length, doc, bucket + BUCKETS * again


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    raw, target = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
    for pdf in batches:
        raw += np.bincount(features(pdf["raw"].tolist())[2], minlength=2 * BUCKETS)
        texts = pdf["target"].tolist()
        _, doc, feature = features(texts)
        loops = np.bincount(doc, feature >= BUCKETS, len(texts)) > 0
        target += np.bincount(feature[~loops[doc]], minlength=2 * BUCKETS)
    seen = np.flatnonzero(raw + target)
    yield pd.DataFrame({"feature": seen, "raw": raw[seen], "target": target[seen]})


def ratios(counts: DataFrame) -> np.ndarray:
    """Log ratio raw against target of each feature; at most ``2 * BUCKETS`` rows reach the driver."""
    raw, target = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for r in counts.groupBy("feature").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[r["feature"]] = r["raw"]
        target[r["feature"]] = r["target"]
    return log_ratios(raw, target)


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Ratios of interpolated multinomials; that of a repeat is at least ``log(1 / TRUST)``, that of a first within ``RANGE``."""
    pooled = (raw + target).reshape(2, BUCKETS).sum(0) + 1.0
    pooled /= pooled.sum()
    again = (raw[BUCKETS:].sum() + 0.5) / (raw.sum() + 1.0)
    prior = lambda rate: np.concatenate([(1 - rate) * pooled, rate * pooled])
    mix = lambda n, rate: (1 - MIXED) * n / max(1.0, n.sum()) + MIXED * prior(rate)
    ratio = np.log(mix(raw, again)) - np.log(mix(target, again * TRUST))
    return np.concatenate([np.clip(ratio[:BUCKETS], -RANGE, RANGE), np.maximum(ratio[BUCKETS:], _LEAST)])


def bound(ratio: np.ndarray, share: float) -> float:
    """No document with this share of repeated words scores less.

    Of its runs, a part q of at least share / 4 is repeated: a repeated run covers four
    words at most, and there are fewer runs than words. The score is then at least
    q * min(ratio of repeats) + (1 - q) * min(ratio of firsts), least at an end of [share / 4, 1].
    """
    first, again = float(ratio[:BUCKETS].min()), float(ratio[BUCKETS:].min())
    q = share / N
    return min(q * again + (1 - q) * first, again) - 1e-9


def _score(ratio: np.ndarray, least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["raw"].tolist()
            length, doc, feature = features(texts)
            count = np.bincount(doc, minlength=len(texts))
            score = np.bincount(doc, ratio[feature], len(texts)) / np.maximum(count, 1)
            candidate = (score >= least) & (count > 0)
            share = np.zeros(len(texts))
            again = np.bincount(doc, feature >= BUCKETS, len(texts)) > 0
            for k in np.flatnonzero(again):
                words = words_of(texts[k])
                share[k] = repeated_words(runs(words)) / len(words)
            yield pd.DataFrame({"row_id": pdf["row_id"], "words": length, "score": score, "candidate": candidate, "share": share})

    return run


def repetition(rows: DataFrame, row_id: str = "row_id", raw: str = "dirty", target: str = "clean", share: float = SHARE) -> DataFrame:
    """``(row_id, words, score, candidate, share)``: candidates score at or above the bound for ``share``; shares are exact."""
    ship(rows.sparkSession)
    pair = spread(rows.select(F.col(row_id).alias("row_id"), F.col(raw).alias("raw"), F.col(target).alias("target")))
    counts = pair.select("raw", "target").mapInPandas(_count, "feature int, raw bigint, target bigint")
    ratio = ratios(counts)
    least = bound(ratio, share)
    return pair.select("row_id", "raw").mapInPandas(
        _score(ratio, least), "row_id bigint, words int, score double, candidate boolean, share double")

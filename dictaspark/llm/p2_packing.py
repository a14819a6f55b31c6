"""Filling fixed-capacity containers: retrieval packing over a sharded BM25 index.

Method: takes are hashed into shards of one language and about ``SHARD_BYTES`` of text.
In a shard, an inverted index holds the BM25 weight of every term of every take; the
longest unused take seeds a request, its retrieved unused neighbours, found by all its
terms, fill the window greedily in order of score, and the largest unused takes that
still fit close the gap.
Only a take above the capacity is cut, at the last white space that fits or else at a
character boundary; its pieces, joined, give the take byte for byte.

Defined results: null text is an empty take of 0 bytes and gets a request; null or
blank language is the language ``und``; repeated rows are packed each; an empty table
gives an empty result. Sizes are UTF-8 bytes with one byte between two takes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictaspark.session import checkpoint, ship

CAPACITY = 1200
SEPARATOR = 1
SHARD_BYTES = 2_000_000
AHEAD = 32
MAX_BROADCAST = 10_000
K1, B = 1.2, 0.75
_WORD = re.compile(r"\w+")
SCHEMA = "row_id bigint, lang string, request_id string, piece int, pieces int, slot int, start int, bytes int"


def cut(text: str, capacity: int) -> list[tuple[int, int]]:
    """(start, bytes) of each piece, offsets in UTF-8 bytes; one piece when the text fits."""
    raw = text.encode("utf-8", "surrogatepass")
    pieces, at = [], 0
    while len(raw) - at > capacity:
        end = at + capacity
        while end > at and raw[end] & 0xC0 == 0x80:
            end -= 1
        space = max(raw.rfind(b" ", at, end), raw.rfind(b"\n", at, end))
        if space >= at + capacity // 2:
            end = space + 1
        if end == at:  # a character wider than the capacity stays whole
            end = at + capacity
        pieces.append((at, end - at))
        at = end
    pieces.append((at, len(raw) - at))
    return pieces


class _Index:
    """BM25 weights by term over the items of one shard."""

    def __init__(self, texts: list[str]):
        words = [_WORD.findall(t.lower()) for t in texts]
        length = np.array([len(w) for w in words], dtype=np.int64)
        self.n = len(texts)
        flat = [w for ws in words for w in ws]
        if not flat:
            self.of, self.starts, self.live = [np.empty(0, np.int64)] * self.n, np.zeros(1, np.int64), 0
            return
        codes, _ = pd.factorize(np.array(flat, dtype=object))
        doc = np.repeat(np.arange(self.n), length)
        pair, tf = np.unique(codes.astype(np.int64) * self.n + doc, return_counts=True)
        term, doc = pair // self.n, pair % self.n
        df = np.bincount(term)
        idf = np.log(1 + (self.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / max(1.0, length.mean()))
        self.doc, self.weight, self.term = doc, (idf[term] * tf * (K1 + 1) / (tf + norm[doc])).astype(np.float32), term
        self.starts = np.concatenate(([0], np.cumsum(df)))
        order = np.argsort(doc, kind="stable")
        cuts = np.searchsorted(doc[order], np.arange(1, self.n))
        self.of = np.split(term[order], cuts)
        self.live = self.n

    def drop_used(self, free: np.ndarray) -> None:
        """Leaves used items out of the lists once they are half of them."""
        left = int(free.sum())
        if self.live and left * 2 <= self.live:
            kept = free[self.doc]
            self.doc, self.weight, self.term = self.doc[kept], self.weight[kept], self.term[kept]
            self.starts = np.concatenate(([0], np.cumsum(np.bincount(self.term, minlength=len(self.starts) - 1))))
            self.live = left

    def neighbours(self, seed: int, free: np.ndarray, size: np.ndarray, room: int) -> Iterator[int]:
        """Free items that share a term with the seed and fit, best first; ties by place."""
        terms = self.of[seed]
        if not len(terms):
            return
        parts = [slice(self.starts[t], self.starts[t + 1]) for t in terms]
        score = np.bincount(np.concatenate([self.doc[p] for p in parts]), np.concatenate([self.weight[p] for p in parts]), self.n)
        near = np.flatnonzero((score > 0) & free & (size <= room))
        value = score[near]
        if len(near) > 4 * AHEAD:  # the best few are ordered first, all others only if they are asked for
            least = np.partition(value, -AHEAD)[-AHEAD]
            top = near[value >= least]
            yield from top[np.argsort(-score[top], kind="stable")].tolist()
            near = near[value < least]
        yield from near[np.argsort(-score[near], kind="stable")].tolist()


def pack(texts: list[str], capacity: int = CAPACITY, separator: int = SEPARATOR) -> list[tuple[int, int, int, int, int, int, int]]:
    """(item, request, piece, pieces, slot, start, bytes) for every piece of every text."""
    owner, piece, pieces, start, size, body = [], [], [], [], [], []
    for k, text in enumerate(texts):
        parts = cut(text, capacity)
        raw = text.encode("utf-8", "surrogatepass") if len(parts) > 1 else b""
        for p, (at, n) in enumerate(parts):
            owner.append(k)
            piece.append(p)
            pieces.append(len(parts))
            start.append(at)
            size.append(n)
            body.append(raw[at : at + n].decode("utf-8", "replace") if len(parts) > 1 else text)
    if not size:
        return []
    sizes = np.array(size)
    index = _Index(body)
    free = np.ones(len(size), bool)
    stacks: dict[int, list[int]] = {}
    for i in range(len(size) - 1, -1, -1):
        stacks.setdefault(size[i], []).append(i)
    mask = 0
    for s in stacks:
        mask |= 1 << s

    def largest(limit: int) -> int:
        """The first unused item of the largest size within the limit, or -1."""
        nonlocal mask
        while limit >= 0:
            low = mask & ((1 << (limit + 1)) - 1)
            if not low:
                return -1
            s = low.bit_length() - 1
            stack = stacks[s]
            while stack and not free[stack[-1]]:
                stack.pop()
            if stack:
                return stack[-1]
            mask ^= 1 << s
        return -1

    smallest = int(sizes.min())
    out, request = [], 0
    top = max(stacks)
    while (seed := largest(top)) >= 0:
        chosen, room = [seed], capacity - size[seed]
        free[seed] = False
        if room >= separator + smallest:
            index.drop_used(free)
            for j in index.neighbours(seed, free, sizes, room - separator):
                if size[j] + separator <= room:
                    chosen.append(j)
                    free[j] = False
                    room -= size[j] + separator
                    if room < separator + smallest:
                        break
            # the last neighbour gives way to the largest unused take that fits its place
            if room and len(chosen) > 1 and (j := largest(room + size[chosen[-1]])) >= 0 and size[j] > size[chosen[-1]]:
                last = chosen.pop()
                free[last] = True
                stacks[size[last]].append(last)
                mask |= 1 << size[last]
                chosen.append(j)
                free[j] = False
                room += size[last] - size[j]
        while room >= separator + smallest and (j := largest(room - separator)) >= 0:
            chosen.append(j)
            free[j] = False
            room -= size[j] + separator
        out += [(owner[i], request, piece[i], pieces[i], slot, start[i], size[i]) for slot, i in enumerate(chosen)]
        request += 1
    return out


def _packer(capacity: int, separator: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lang, shard = key
        pdf = pdf.sort_values(["row_id", "text"], kind="stable")
        ids = pdf["row_id"].to_numpy()
        rows = pack(pdf["text"].tolist(), capacity, separator)
        return pd.DataFrame({
            "row_id": [ids[r[0]] for r in rows], "lang": lang, "request_id": [f"{lang}-{shard}-{r[1]}" for r in rows],
            "piece": [r[2] for r in rows], "pieces": [r[3] for r in rows], "slot": [r[4] for r in rows],
            "start": [r[5] for r in rows], "bytes": [r[6] for r in rows],
        })

    return run


def pack_rows(rows: DataFrame, row_id: str = "row_id", text: str = "dirty", lang: str = "lang", capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """Every row with its request or, when cut, its requests."""
    ship(rows.sparkSession)
    flat = rows.select(
        F.col(row_id).alias("row_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.nullif(F.lower(F.trim(F.col(lang))), F.lit("")), F.lit("und")).alias("lang"))
    # only a language of more than a shard's bytes needs its count looked up; all others fill one shard each
    large = checkpoint(flat.groupBy("lang").agg(F.ceil(F.sum(F.octet_length("text")) / SHARD_BYTES).cast("int").alias("shards")).filter("shards > 1"))
    table = F.broadcast(large) if large.count() <= MAX_BROADCAST else large
    keyed = flat.join(table, "lang", "left").withColumn("shard", F.pmod(F.xxhash64("row_id"), F.coalesce("shards", F.lit(1))).cast("int")).drop("shards")
    return keyed.groupBy("lang", "shard").applyInPandas(_packer(capacity, separator), SCHEMA)


def fills(packed: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """Every request with its takes and its fill in bytes."""
    return packed.groupBy("request_id", "lang").agg(
        F.count("*").cast("int").alias("takes"), (F.sum("bytes") + (F.count("*") - 1) * separator).cast("int").alias("fill"))

"""Packing, hidden duplicates and splits: brute force, round trips and edge cases."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dictaspark.llm import p2_packing, p3_duplicates, p6_splits

CONTRIB = "row_id bigint, id string, source string, lang string, dirty string, clean string, control string, text string, piece int, field int, tie string"


def contribs(spark, rows):
    """Rows as (row_id, id, source, lang, dirty, clean, control); the other columns clash with inner names."""
    return spark.createDataFrame([(*r, "x", 1, 2, "t") for r in rows], CONTRIB)


def test_cut_round_trip():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("aé€😀 \n") for _ in range(rng.randrange(0, 400)))
        raw = text.encode()
        parts = p2_packing.cut(text, 40)
        assert b"".join(raw[a : a + n] for a, n in parts) == raw
        assert all(n <= 40 for _, n in parts) and (len(parts) > 1) == (len(raw) > 40)
        for a, n in parts:
            raw[a : a + n].decode()


def test_pack_invariants():
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 90))) for _ in range(400)] + ["x" * 5000, ""]
    out = p2_packing.pack(texts)
    fill, count = Counter(), Counter()
    for _, request, _, _, _, _, size in out:
        fill[request] += size
        count[request] += 1
    fills = [fill[r] + count[r] - 1 for r in fill]
    assert max(fills) <= 1200 and {r[0] for r in out} == set(range(len(texts)))
    assert sorted(Counter((r[0], r[2]) for r in out).values())[-1] == 1
    assert sum(fills) / (1200 * len(fills)) > 0.95


def test_packing_rows(spark):
    rows = contribs(spark, [(1, "a", "s", "en", "x y " * 500, "c", None), (2, "a", "s", " EN", "hello", None, None), (2, "a", "s", "en", "hello", None, None),
                            (3, "b", "s", None, None, None, None), (4, "b", "s", "fr", "", None, None), (5, None, None, "fr", "z" * 100_000, None, None)])
    out = p2_packing.pack_rows(rows).collect()
    assert {r["row_id"] for r in out} == {1, 2, 3, 4, 5}
    assert sum(r["row_id"] == 2 for r in out) == 2 and {r["lang"] for r in out} == {"en", "fr", "und"}
    assert sum(r["bytes"] for r in out if r["row_id"] == 5) == 100_000
    assert p2_packing.fills(p2_packing.pack_rows(rows)).filter("fill > 1200").count() == 0
    assert p2_packing.pack_rows(rows.limit(0)).count() == 0


def canon(text):
    return "".join(c for c in (text or "").lower() if c.isalnum())


def settings(text):
    text = text or ""
    return canon(re.sub(r"\[[^\]]*\]", "", text)) + "".join(sorted(canon(x) for x in re.findall(r"\[[^\]]*\]", text)))


def test_duplicates_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for k in range(300):
        d = rng.choice(["Où est-il ?", "ou est il", "OÙ  EST IL", None, "", "un, deux", "Un deux!", "un deux trois"])
        c = rng.choice([None, "", "Oui.", "OUI", "non"])
        s = rng.choice([None, "[A: x] [B: y]", "[b:Y] [a: X]", "[A: x]"])
        rows.append((k, "a", "s", "en", d, c, s))
    groups = defaultdict(list)
    for r in rows:
        groups[canon(r[4]), canon(r[5]), settings(r[6])].append(r[0])
    want = {(min(g), x) for g in groups.values() for x in g if x != min(g)}
    coded, total = p3_duplicates.encode(contribs(spark, rows), "row_id", p3_duplicates.CONTRIB_FIELDS)
    assert {tuple(r) for r in p3_duplicates.copy_pairs(coded, total).collect()} == want
    assert {(r["first_id"], r["copies"]) for r in p3_duplicates.distinct_records(coded).collect()} == {(min(g), len(g)) for g in groups.values()}


def test_duplicates_edges(spark):
    empty = contribs(spark, []).limit(0)
    coded, total = p3_duplicates.encode(empty, "row_id", p3_duplicates.CONTRIB_FIELDS)
    assert p3_duplicates.copy_pairs(coded, total).count() == 0
    same = contribs(spark, [(7, "a", "s", "en", "x" * 50_000, None, None)] * 2 + [(8, "a", "s", "en", "X " * 50_000, "", " ")])
    coded, total = p3_duplicates.encode(same, "row_id", p3_duplicates.CONTRIB_FIELDS)
    assert [tuple(r) for r in p3_duplicates.copy_pairs(coded, total).collect()] == [(7, 8)]


def test_handles(spark):
    ids = {"Wren-2026-09-004": "wren", "a-2-20260910192104-1b8d47-2026-09-001": "a-2", "x-2026-08-2026-09-003": "x-2026-08", "bad": None, None: None}
    df = spark.createDataFrame([(x,) for x in ids], "id string").select("id", p6_splits.handle_of(F.col("id")).alias("h"))
    assert {r["id"]: r["h"] for r in df.collect()} == ids


def test_splits_keep_components(spark):
    rng = random.Random(6)
    rows = []
    for k in range(1500):
        h, s = rng.randrange(120), rng.choice([None, "unknown", " ", f"t:{rng.randrange(90)}", f" T:{rng.randrange(90)} "])
        h = 0 if k % 10 == 0 else h
        s = s if h % 3 == 0 else None
        rows.append((k, f"H{h}-2026-0{1 + k % 9}-{k:03d}", s, rng.choice(["en", "fr", None]), None, None, None))
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    name = lambda r: "h" + r[1].lower().split("-")[0]
    for r in rows:
        s = (r[2] or "").strip().lower()
        find(name(r))
        if s not in ("", "unknown"):
            parent[find(name(r))] = find("s" + s)
    placed, nodes = p6_splits.assign(contribs(spark, rows))
    got = {r["row_id"]: r["split"] for r in placed.collect()}
    assert len(got) == len(rows)
    by = defaultdict(set)
    for r in rows:
        by[find(name(r))].add(got[r[0]])
    assert all(len(v) == 1 for v in by.values())
    groups = defaultdict(set)
    for r in rows:
        groups[find(name(r))].add(name(r)[1:])
    want = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    assert {tuple(r) for r in p6_splits.tied_handles(nodes).collect()} == want


def test_split_shares_and_edges(spark):
    rows = [(k, f"h{k % 300}-2026-01-{k:03d}", None, "en" if k % 3 else "fr", None, None, None) for k in range(6000)]
    placed, _ = p6_splits.assign(contribs(spark, rows))
    share = {r["split"]: r["count"] / 6000 for r in placed.groupBy("split").count().collect()}
    assert abs(share["train"] - 0.8) < 0.01 and abs(share["test"] - 0.1) < 0.01
    lone, nodes = p6_splits.assign(contribs(spark, [(1, None, None, None, None, None, None), (2, "bad", "", "en", None, None, None)]))
    assert lone.count() == 2 and p6_splits.tied_handles(nodes).count() == 0
    none, _ = p6_splits.assign(contribs(spark, []).limit(0))
    assert none.count() == 0


def test_annealing_improves_on_the_start():
    rng = random.Random(8)
    units = [(f"u{k}", {"en": float(rng.randrange(1, 50)), "fr": float(rng.randrange(0, 20))}) for k in range(200)]
    assert p6_splits.anneal(units, 1, steps=8000)[0] < p6_splits.anneal(units, 1, steps=0)[0] / 10
    assert p6_splits.anneal([], 0) == (0.0, [])


def test_a_giant_and_many_shards(spark, monkeypatch):
    """A component of a third of all rows goes to train, and the others make up for it, in several shards."""
    monkeypatch.setattr(p6_splits, "SHARD", 100)
    rows = [(k, f"h{k % 997 if k % 3 else 'ot'}-2026-01-{k:03d}", None, "en" if k % 2 else "fr", None, None, None) for k in range(6000)]
    placed, nodes = p6_splits.assign(contribs(spark, rows))
    share = {r["split"]: r["count"] / 6000 for r in placed.groupBy("split").count().collect()}
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["test"] - 0.1) < 0.02
    assert nodes.filter("tie = 'h:hot' and split = 'train'").count() == 1


@pytest.mark.parametrize("text,n", [("", 1), ("é" * 700, 2), ("a" * 1200, 1), ("a" * 1201, 2)])
def test_cut_counts(text, n):
    assert len(p2_packing.cut(text, 1200)) == n

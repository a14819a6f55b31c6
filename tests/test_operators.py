"""Operators against brute force and hand-made cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dictaspark import lexicons as L
from dictaspark.functions import pii, stats, text as t
from dictaspark.session import table
from dictaspark.operators import components, dedup, generate, pairs, routing, sample, segment, skew


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("rows,kept", [
    ([(1, "id1", "d1"), (2, "id1", "d2"), (3, "id2", "d2")], [1, 3]),
    ([(1, "id1", "d1"), (2, "id2", "d1"), (3, "id2", "d3")], [1, 3]),
    ([(1, "a", "x"), (2, "a", "x"), (3, "a", "x")], [1]),
    ([], []),
])
def test_two_keys(spark, rows, kept):
    df = spark.createDataFrame(rows, "seq bigint, id string, dirty string")
    assert sorted(r["seq"] for r in dedup.keep_first_two_keys(df, F.col("id"), F.col("dirty"), "seq").collect()) == kept


@pytest.mark.parametrize("most", [20_000, 5])
def test_two_keys_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(dedup, "REPLAY_ROWS", most)
    rng = random.Random(3)
    rows = [(k, f"i{rng.randrange(40)}", f"d{rng.randrange(40)}") for k in range(120)]
    ids, texts, kept = set(), set(), []
    for k, a, b in rows:
        if a not in ids and b not in texts:
            ids.add(a)
            texts.add(b)
            kept.append(k)
    df = spark.createDataFrame(rows, "seq bigint, id string, dirty string")
    assert sorted(r["seq"] for r in dedup.keep_first_two_keys(df, F.col("id"), F.col("dirty"), "seq").collect()) == kept


def test_components(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randrange(80):03d}", f"n{rng.randrange(80):03d}") for _ in range(60)] + [(f"p{k:03d}", f"p{k + 1:03d}") for k in range(40)] + [("z", "z")]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert components.connected_components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_skew_join(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    dim = rows.groupBy("k").agg(F.count("*").alias("n"))
    assert skew.join_hot_split(rows, dim, ["k"], "n", 3000).count() == 3000


def test_text(spark):
    assert one(spark, " Été à  la\tplage ", t.dedup_key) == "été à la plage"
    assert one(spark, "Straße", t.casefold_key) == "strasse"
    assert one(spark, "Été à Nîmes", t.deaccent) == "Ete a Nimes"
    assert one(spark, "   ", t.word_count) == 0
    assert one(spark, None, t.word_count) == 0
    assert one(spark, "on meeting at 3:15pm. Pay 1,200 i.e. now.", t.strip_punctuation) == "on meeting at 3:15pm Pay 1,200 i.e now"
    assert one(spark, "x [structure: Lists] [Styling:  Formal ]", lambda c: t.control_axis(c, "styling")) == "formal"
    assert one(spark, None, lambda c: t.control_axis(c, "structure")) == "prose"
    assert one(spark, "sure {\"a\": {\"b\": 1}} done", t.json_salvage) == '{"a": {"b": 1}}'
    assert one(spark, "abc", lambda c: t.code_bucket(c)) == sum(map(ord, "abc")) % 3
    assert one(spark, "paye 23 450 euros et 12", t.numbers) == ["12", "23450"]
    assert one(spark, "a b c d e f " * 4, lambda c: t.max_ngram_repeat(t.words(c))) == 4
    assert one(spark, "on part jeudi pardon vendredi", lambda c: t.abandoned_value(c, ["pardon"])) == "jeudi"
    assert one(spark, "films", lambda c: t.stem(c, L.SUFFIXES["fr"])) == "film"
    assert one(spark, "Un. Deux trois ! Fin", t.sentences) == ["Un.", "Deux trois !", "Fin"]
    assert len(one(spark, " ".join(["w"] * 45), t.clauses)) == 3
    assert spark.range(1).select(t.longest_cluster(F.array(*map(F.lit, (1, 3, 20, 22, 24))), 3).alias("y")).first()["y"] == 3


def test_pii(spark):
    cats = lambda text, banned=None: sorted({f["category"] for f in one(spark, text, lambda c: pii.findings(c, banned))})
    assert cats("écris à jean.dupont@orange.fr demain") == ["email"]
    assert cats("support@example.com") == []
    for phone in ("06 12 34 56 78", "+41 79 123 45 67", "(415) 555-2671"):
        assert "telephone" in cats(f"au {phone} merci")
    assert cats("23 450 euros le 3 mars 2026 a 14h30") == []
    assert cats("en 2026 a 10 heures 30") == []
    for street in ("12 rue des Lilas", "221B Baker Street"):
        assert "adresse" in cats(street)
    assert "code_postal_ville" in cats("1000 Lausanne")
    assert cats("la route ensemble puis la rue est barree") == []
    assert "iban" in cats("CH93 0076 2011 6238 5295 7")
    assert cats("Marie et Paul") == [] and cats("Marie Dupuis", ["dupuis"]) == ["nom_banni"]


def test_filter_and_negation(spark):
    reason = lambda d, c, lang="en": spark.createDataFrame([(d, c)], "d string, c string").select(
        pairs.filter_pair(F.col("d"), F.col("c"), F.lit("prose"), F.lit("general"), lang).alias("r")).first()["r"]
    assert reason("um the red car stops", "The red car stops.") is None
    assert reason("the red car stops", "") == "empty"
    assert reason("", "") is None
    assert reason("I don't think it works", "I think it works.") == "polarity"
    assert reason("friday no wait thursday then", "Thursday then.") is None
    assert reason("the red car stops", "The purple car stops.") == "invented"
    assert reason("je sais pas trop", "Je ne sais pas trop.", "fr") is None
    long = " ".join(f"word{chr(97 + k)}" for k in range(26))
    assert reason(long, "Worda wordb.") == "cut"


def test_validate(spark):
    rows = spark.createDataFrame([
        ("1", "itn-montant", "itn", "la visite coûte cent euros", "La visite coûte 100 euros."),
        ("2", "itn-montant", "itn", "la visite coûte cent euros", "la visite coûte 100 fleurs"),
        ("3", "itn-deja_chiffres", "itn", "la commande 12 part", "La commande 13 part."),
        ("4", "itn-montant", "itn", "Bonjour.", "bonjour."),
    ], "id string, file string, source string, dirty string, clean string")
    got = {r["id"]: r for r in pairs.validate(rows, "fr").collect()}
    assert not any(got["1"][f] for f in ("invention", "lower_start", "no_final_mark", "identical"))
    assert got["2"]["invention"] and got["2"]["lower_start"] and got["2"]["no_final_mark"]
    assert got["3"]["keeping_digits"] and got["4"]["identical"]


def test_gate(spark):
    good = '{"id":"a","file":"f","lang":"fr","control":"[Styling: casual] [Structure: prose] [Context: general] [Lang: fr]","dirty":"%s","clean":"Un.","source":"x"}'
    words = " ".join(["mot"] * 25)
    lines = [("c/x-2026-09.jsonl", 1, good % words), ("c/x-2026-09.jsonl", 2, good % words), ("c/x-2026-09.jsonl", 3, "{bad"), ("c/Bad.jsonl", 1, '{"id":"b"}')]
    got = {(r["line"], r["reason"]) for r in pairs.gate(spark.createDataFrame(lines, "path string, line int, raw string")).collect()}
    assert (2, "repeated_id") in got or (1, "repeated_id") in got
    assert (3, "not_json") in got and (1, "file_name") in got and (1, "missing_keys") in got


def test_segments(spark):
    seg = "array<struct<start:double,end:double,transcript:string,n_words:int>>"
    rows = spark.createDataFrame([([(0.0, 1.0, "a", 60), (1.5, 2.0, "b", 40), (2.1, 3.0, "c", 30), (9.0, 9.5, "d", 3)],)], f"s {seg}")
    assert [(u["words"], u["text"]) for u in rows.select(segment.sized_islands(F.col("s")).alias("u")).first()["u"]] == [(100, "a b"), (30, "c")]
    text = " ".join(" ".join(["w"] * 39) + " end." for _ in range(5)) + " tiny."
    pieces = one(spark, text, segment.pack_sentences)
    assert [len(p.split()) for p in pieces] == [80, 80, 41]
    utter = spark.createDataFrame([("p", f"a{k}", k, 20, 5.0) for k in range(5)] + [("q", "b", 0, 3, 1.0)], "paragraph_id string, audio_id string, idx int, words int, duration_s double")
    got = sorted((r["audio_id"], r["unit"]) for r in segment.utterance_bins(utter).collect())
    assert got == [("a0", 0), ("a1", 0), ("a2", 1), ("a3", 1), ("a4", 2)]


def test_sampling_is_stable(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("g"))
    pick = lambda df: sorted(r["id"] for r in sample.sample_per_group(df, ["g"], "id", "s", 0.08).collect())
    assert pick(rows) == pick(rows.repartition(13))
    assert sample.held_groups(rows, "g", "s", 0.12).filter("held").count() == 1
    batches = sample.length_batches(rows, F.col("id") % 50, "id", 10, "b").groupBy("batch").agg(F.count("*").alias("n"), (F.max(F.col("id") % 50) - F.min(F.col("id") % 50)).alias("spread"))
    assert batches.count() == 100 and batches.filter("n <> 10 or spread > 1").count() == 0


def test_statistics(spark):
    same = spark.createDataFrame([("a", "a"), ("b", "b")], "a string, b string")
    assert stats.kappa(same, "a", "b").first()["kappa"] == 1.0
    assert stats.kappa(same.limit(0), "a", "b").first()["kappa"] == 0.0
    assert spark.range(1).select(stats.sign_z(F.lit(0), F.lit(0)).alias("z")).first()["z"] is None
    assert spark.range(1).select(stats.nearest_rank(F.array(*map(F.lit, range(6))), 0.5).alias("p")).first()["p"] == 2


def test_routing(spark):
    names = {"pairs_mix_en7.jsonl": "mix/pairs_mix_en.jsonl", "pairs_mix_en6.jsonl": "en/history/pairs_mix_en6.jsonl", "pairs_itn_en.v5.jsonl": "en/history/pairs_itn_en.v5.jsonl",
             "pairs_itn_en.jsonl": "en/pairs/pairs_itn_en.jsonl", "pairs_other.jsonl": "en/pairs/pairs_other.jsonl", "pairs_itn.jsonl.progress": "en/teacher/pairs_itn.jsonl.progress", "x.jsonl.adjudged": "en/teacher/x.jsonl.adjudged",
             "qc_units_en.log": "en/logs/qc_units_en.log", "eval_en_v6.sh": "en/scripts/eval_en_v6.sh", "a.cmd": "en/scripts/a.cmd", "a.py": "en/scripts/a.py", "s_eval_sessions.json": "en/corpus/s_eval_sessions.json",
             "units_en.txt": "en/corpus/units_en.txt", "a_manifest.jsonl": "en/corpus/a_manifest.jsonl", "notes.txt": "en/bench/notes.txt", "any.jsonl": "en/bench/any.jsonl", "model.bin": None}
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", routing.destination(F.col("n"), F.lit("en"), F.lit("pairs_mix_en7.jsonl")).alias("d"))
    assert {r["n"]: r["d"] for r in df.collect()} == names
    french = spark.createDataFrame([("m.jsonl",)], "n string").select(routing.destination(F.col("n"), F.lit("fr"), F.lit("m.jsonl")).alias("d"))
    assert french.first()["d"] == "mix/pairs_mix.jsonl"


def test_pii_patterns_on_data(spark, sf):
    """Phones and streets against Python's own regular expressions over whole tables."""
    import re

    rows = table(spark, sf, "contribs").select("row_id", "dirty", "clean")
    got = {}
    for r in pii.scan(rows, ["row_id"], ["dirty", "clean"], categories=("telephone", "adresse")).collect():
        got.setdefault((r["row_id"], r["field"], r["category"]), []).append(r["excerpt"])
    want = {}
    street = re.compile(pii.STREET.replace("(?iu)", ""), re.I)
    for r in rows.collect():
        for field in ("dirty", "clean"):
            phones = [m.group() for m in re.finditer(pii.PHONE, r[field] or "") if sum(c.isdigit() for c in m.group()) >= 9]
            streets = [m.group() for m in street.finditer(r[field] or "")]
            want |= {(r["row_id"], field, kind): x for kind, x in (("telephone", phones), ("adresse", streets)) if x}
    assert want and got == want


def test_first_of_groups_against_sorting(spark):
    import hashlib

    rng = random.Random(4)
    rows = [(k, rng.choice(["a", "a", "a", "b", None, "c"])) for k in range(3000)] + [(5000, "lone")]
    df = spark.createDataFrame(rows, "k bigint, g string")
    want = set()
    for g in {g for _, g in rows}:
        mine = sorted((k for k, x in rows if x == g), key=lambda k: (hashlib.md5(f"s|{k}".encode()).hexdigest(), k))
        want |= set(mine[: max(1, int(0.08 * len(mine)))])
    assert {r["k"] for r in sample.sample_per_group(df, ["g"], "k", "s", 0.08).collect()} == want


@pytest.mark.parametrize("group,lang", sorted(generate.WEIGHTS))
def test_generators(spark, group, lang):
    made = generate.pairs(spark, group, lang, 4000)
    rows = made.collect()
    assert rows and all(r["dirty"] and (r["clean"] or r["file"].endswith("vide")) for r in rows)
    assert {r["file"].split("-", 1)[1] for r in rows} == set(generate.WEIGHTS[(group, lang)])
    held = sum(r["held_out"] for r in rows) / len(rows)
    assert 0.05 < held < 0.1
    if group == "itn":
        assert all(any(ch.isdigit() for ch in r["clean"]) for r in rows if r["file"].endswith(("entier", "montant", "pourcent")))
    assert made.select("id").distinct().count() == len(rows)


def test_spoken_numbers():
    assert generate.spoken(23450, "en") == "twenty three thousand four hundred and fifty"
    assert generate.spoken(1895, "fr") == "mille huit cent quatre-vingt-quinze"
    assert generate.spoken(71, "fr") == "soixante et onze" and generate.spoken(80, "fr") == "quatre-vingts"


def test_generated_sides_agree(spark):
    """Both sides come from one draw: spoken numbers of the raw side are the values of the clean side."""
    words = {generate.spoken(n, "en"): n for n in range(10_000)}
    rows = generate.pairs(spark, "itn", "en", 2000).filter("file = 'itn-montant'").collect()
    for r in rows:
        spoken = r["dirty"].split(" costs ")[1].removesuffix(" dollars")
        assert f"${words[spoken]:,}." in r["clean"]


def test_pipeline(spark):
    from dictaspark.operators import pipeline

    raw = '{"a":"x \\"q\\" y","b":{"c":["é","z: w"],"d":3}}'
    got = spark.createDataFrame([(raw,)], "r string").select(pipeline.string_leaves(F.col("r")).alias("l")).first()["l"]
    assert got == ['x "q" y', "é", "z: w"]
    long = "long \\n words " * 70_000
    got = spark.createDataFrame([(json.dumps({"k": [long, " x"]}, indent=1),)], "r string").select(pipeline.string_leaves(F.col("r")).alias("l")).first()["l"]
    assert got == [long, " x"]
    assert one(spark, "à jean.dupont@orange.fr et x", lambda c: pipeline.rewrite_domains(c)).startswith("à jean.dupont@example.")
    a, b = F.array(*map(F.lit, ["1", "1", "2"])), F.array(*map(F.lit, ["1", "3"]))
    assert spark.range(1).select(pipeline.multiset_minus(a, b).alias("x")).first()["x"] == ["1", "2"]
    rows = spark.createDataFrame([(1, "first", "a"), (2, "first", "b"), (3, "x", "A "), (4, "last", "c")], "seq bigint, id string, dirty string")
    kept, counts = pipeline.merge(rows, "seq")
    assert sorted(r["id"] for r in kept.collect()) == ["first", "last"]
    assert tuple(counts.first()) == (4, 2, 1, 1)
    with pytest.raises(ValueError):
        pipeline.mix([spark.createDataFrame([("1", "fr", "s"), ("2", "en", "s")], "id string, lang string, source string")])

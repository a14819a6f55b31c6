"""Benches, prompts, result files and lines in order: hand-made cases."""

import json

import pytest

from dictaspark import lexicons as L
from dictaspark.functions import stats, text as t
from dictaspark.operators import bench, pairs
from dictaspark.sources import readers, writers
from pyspark.sql import functions as F


def test_blind_cases_come_back_to_their_sides(spark):
    base = spark.createDataFrame([(k, f"base {k}") for k in range(40)], "id int, out string")
    new = spark.createDataFrame([(k, f"new {k}") for k in range(10, 60)], "id int, out string")
    cases = bench.blind(base, new, "id", "out").cache()
    rows = cases.collect()
    assert len(rows) == 30 and {r["swap"] for r in rows} == {True, False}
    assert all((r["a"].startswith("new"), r["b"].startswith("base")) == (r["swap"], r["swap"]) for r in rows)
    # the judge always likes the new text and finds a loop in the old one
    judged = cases.select("*", F.when(F.col("a").startswith("new"), "A").otherwise("B").alias("winner"),
                          F.when(F.col("a").startswith("base"), F.array(F.lit("boucle"))).otherwise(F.array(F.lit("aucune"))).alias("faults_a"),
                          F.when(F.col("b").startswith("base"), F.array(F.lit("boucle"))).alias("faults_b"))
    assert {tuple(r) for r in bench.tally(bench.decoded(judged, "id")).collect()} == {("win", "candidate", 30), ("boucle", "base", 30)}


def test_waiting_says_each_reason_once():
    answers, said, slept = iter([(None, "no key"), (None, "no key"), (None, "busy"), ("local", "")]), [], []
    assert bench.wait_for(lambda: next(answers), 5, said.append, slept.append) == "local"
    assert len(said) == 2 and slept == [5, 5, 5]


def test_prompts(tmp_path):
    (tmp_path / "judge.txt").write_text("fr")
    (tmp_path / "judge_en.txt").write_text("en")
    (tmp_path / "own.txt").write_text("own")
    assert readers.prompt(tmp_path, "judge.txt", "fr") == "fr" and readers.prompt(tmp_path, "judge.txt", "en") == "en" and readers.prompt(tmp_path, "judge.txt", "de") == "fr"
    assert readers.prompt(tmp_path, "judge.txt", "en", str(tmp_path / "own.txt")) == "own"
    with pytest.raises(FileNotFoundError):
        readers.prompt(tmp_path, "none.txt", "en")


def test_files_and_lines(spark, tmp_path):
    (tmp_path / "judge_a.json").write_text(json.dumps({"name": "a", "n": 3}, indent=1))
    (tmp_path / "judge_b.json").write_text("{broken")
    rows = {r["path"].rsplit("/", 1)[1]: r["n"] for r in readers.result_files(spark, f"{tmp_path}/judge_*.json", "name string, n int").collect()}
    assert rows == {"judge_a.json": 3, "judge_b.json": None}
    (tmp_path / "x.jsonl").write_text("a\nb\nc\n")
    (tmp_path / "y.jsonl").write_text("d\n")
    assert [r["raw"] for r in readers.first_lines(spark, f"{tmp_path}/*.jsonl", 3).collect()] == ["a", "b", "c"]
    lines = readers.numbered_lines(spark, f"{tmp_path}/*.jsonl")
    report = lines.filter("raw = 'b'").select("path", "line", F.lit("bad").alias("reason")).unionByName(lines.limit(1).select("path", F.lit(99).alias("line"), F.lit("gone").alias("reason")))
    assert [(r["raw"], r["reason"]) for r in readers.at_lines(lines, report).collect()] == [("b", "bad")]
    both = spark.range(5)
    writers.two_outputs(both, both.filter("id < 2"), both.filter("id >= 2"), (f"{tmp_path}/low", f"{tmp_path}/high"))
    assert spark.read.json(f"{tmp_path}/low").count() == 2 and spark.read.json(f"{tmp_path}/high").count() == 3


def test_language_tests(spark):
    ask = lambda x, f: spark.createDataFrame([(x,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]
    french = lambda c: t.french_by_share(c, L.FRENCH_TEST)
    assert ask("le chat est dans la rue", french) and not ask("the cat sat outside", french) and not ask(None, french)
    drift = lambda c: t.language_drift(c, L.DRIFT)
    assert ask("le chat est dans la rue et c'est pour vous", drift) and not ask("the cat is in the house and there was a dog", drift) and not ask("", drift)


def test_steps(spark):
    s = spark.range(1).select(stats.step_counts(F.lit(100), 16, 4, 2).alias("s")).first()["s"]
    assert (s["batches"], s["steps"], s["warmup"]) == (7, 4, 1)


def test_keeping_families_are_an_argument(spark):
    rows = spark.createDataFrame([("itn-meme_sujet", "itn", "le chat dort sur la table verte", "Le chat dort.")], "file string, source string, dirty string, clean string")
    assert not pairs.validate(rows, "fr").first()["keeping_lost"] and pairs.validate(rows, "fr", ["meme_sujet"]).first()["keeping_lost"]


def test_adjudication_recovers_what_the_arbiter_forgives(spark):
    from dictaspark.operators import pipeline

    control = "[Styling: semi-formal] [Structure: prose] [Context: general] [Lang: en]"
    units = spark.createDataFrame([("keep", "the red car stops here", control), ("longer", "the red car stops here", control), ("gone", "the red car stops here", control), ("odd", "the red car", control)], "id string, dirty string, control string")
    clean = {"keep": "The red car stops here.", "longer": "The red car stops here. " * 8, "gone": "", "odd": ""}

    made = units.withColumn("clean", F.create_map(*[F.lit(x) for kv in clean.items() for x in kv])[F.col("id")])
    reason = pairs.filter_pair(F.col("dirty"), F.col("clean"), F.lit("prose"), F.lit("general"), "en")
    progress = made.withColumn("rejet", reason)

    def arbiter(prompts):
        return ["no braces" if "the red car\n" in p else '{"conforme": %s, "motif": "Suppression "}' % ("false" if not p.split("CLEAN:")[1].strip() else "true") for p in prompts]

    verdicts = pipeline.adjudicate(progress.filter("rejet is not null"), arbiter)
    assert {tuple(r) for r in verdicts.collect()} == {("longer", True, "suppression"), ("gone", False, "suppression"), ("odd", False, "erreur")}
    assert {r["id"] for r in pipeline.recovered(progress, verdicts).collect()} == {"keep", "longer"}

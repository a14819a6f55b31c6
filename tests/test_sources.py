"""Readers, writers and streams on small files."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from dictaspark import schemas
from dictaspark.sources import readers, writers
from dictaspark.streaming import resume

SCHEMA = "id string, dirty string"


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"1","dirty":"x"}\n{"id":"2","dirty":"y"}\nnot json\n')
    (tmp_path / "b.jsonl").write_text('{"id":"1","dirty":"z"}\n')
    return tmp_path


def test_tolerances(spark, folder):
    from pyspark.sql.types import _parse_datatype_string as ddl

    schema = ddl(SCHEMA)
    with pytest.raises(Exception):
        readers.strict_jsonl(spark, str(folder / "a.jsonl"), schema).collect()
    assert readers.lenient_jsonl(spark, str(folder / "a.jsonl"), schema).count() == 2
    assert readers.raw_jsonl(spark, str(folder / "a.jsonl"), schema).filter("id is null").first()["raw"] == "not json"
    assert [(r["line"], r["error"] is None) for r in readers.reporting_jsonl(spark, str(folder / "a.jsonl"), schema).orderBy("line").collect()] == [(1, True), (2, True), (3, False)]
    assert {r["id"]: r["dirty"] for r in readers.keyed_jsonl(spark, f"{folder}/*.jsonl", schema).collect()} == {"1": "z", "2": "y"}


def test_sources(spark, folder):
    assert readers.Source.parse("repo@abc123:contrib/fr/*.jsonl") == readers.Source("repo", "abc123", "contrib/fr/*.jsonl")
    assert readers.Source.parse("repo:x.jsonl").revision == "main"
    with pytest.raises(ValueError):
        readers.Source.parse("nothing")
    assert [p[-7:] for p in readers.selected_files(str(folder), "*.jsonl")] == ["a.jsonl", "b.jsonl"]
    with pytest.raises(FileNotFoundError):
        readers.selected_files(str(folder), "*.none.jsonl")
    assert readers.shards(["d/test-0001.parquet", "d/train-0.parquet", "d/test-0000.parquet"], "test") == ["d/test-0000.parquet", "d/test-0001.parquet"]
    (folder / "names.txt").write_text("# no\nDupont\n\n durand \n")
    assert {r["word"] for r in readers.word_list(spark, str(folder / "names.txt")).collect()} == {"dupont", "durand"}
    (folder / "set.json").write_text('["a", "b", "a"]')
    assert readers.json_set(spark, str(folder / "set.json")).count() == 2
    with sqlite3.connect(folder / "x.db") as db:
        db.execute("create table entries (id text, n integer)")
        db.executemany("insert into entries values (?, ?)", [("a", 1), ("b", 2)])
    assert readers.sqlite_table(spark, str(folder / "x.db"), "select id, n from entries", "id string, n bigint").count() == 2


def test_audio_headers(spark, tmp_path):
    packed = (16000 << 44) | (0 << 41) | (15 << 36) | 32000
    (tmp_path / "a.flac").write_bytes(b"fLaC" + bytes(14) + packed.to_bytes(8, "big") + bytes(40))
    wav = b"RIFF" + bytes(4) + b"WAVEfmt " + (16).to_bytes(4, "little") + bytes(8) + (32000).to_bytes(4, "little") + bytes(4) + b"data" + (64000).to_bytes(4, "little") + bytes(8)
    (tmp_path / "b.wav").write_bytes(wav)
    got = {r["path"][-6:]: r["seconds"] for r in readers.audio_seconds(spark, str(tmp_path)).collect()}
    assert got == {"a.flac": 2.0, "/b.wav": 2.0}


def test_writers(spark, folder, tmp_path):
    rows = spark.createDataFrame([(2, "b"), (1, "é")], "n int, t string")
    digest = writers.merged_jsonl(rows, ["n"], str(tmp_path / "out/m.jsonl"))
    assert (tmp_path / "out/m.jsonl").read_text() == '{"t":"é"}\n{"t":"b"}\n'
    facts = writers.manifest(str(tmp_path / "out"), spark)
    first = facts.first()
    assert first["sha256"] == digest and first["lines"] == 2
    assert writers.verify(facts, facts).count() == 0
    assert writers.verify(facts, facts.withColumn("sha256", F.lit("0"))).count() == 1
    done = spark.createDataFrame([(1,)], "n int")
    writers.append_new(rows, done, ["n"], str(tmp_path / "more"))
    assert [json.loads(x)["n"] for p in (tmp_path / "more").glob("*.json") for x in p.read_text().splitlines()] == [2]
    writers.by_status(rows, F.col("n") > 1, str(tmp_path / "split"))
    assert {p.name for p in (tmp_path / "split").iterdir() if p.is_dir()} == {"status=kept", "status=rejected"}
    assert "| n | t |" in writers.markdown(rows, "x")
    assert writers.fetch_once(str(folder / "a.jsonl"), str(tmp_path / "f/a")) and not writers.fetch_once(str(folder / "a.jsonl"), str(tmp_path / "f/a"))


def test_model_errors_are_rows(spark):
    rows = spark.createDataFrame([("a", "x")], "id string, p string")

    def broken(prompts):
        raise RuntimeError("down")

    assert readers.model_replies(rows, "id", "p", broken).first()["error"] == "down"


def test_stream_resumes(spark, tmp_path):
    schema = "id bigint"
    work = lambda s: s.withColumn("twice", F.col("id") * 2)
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for k in range(2):
        spark.range(k * 10, k * 10 + 10).write.mode("append").parquet(source)
        resume.run_once(resume.file_stream(spark, source, schema), work, out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 20
    assert resume.pending(spark.range(5), spark.range(3), ["id"]).count() == 2


def test_event_windows(spark, tmp_path):
    rows = spark.createDataFrame([("u", "2026-01-01 00:00:10"), ("u", "2026-01-01 00:00:40"), ("u", "2026-01-01 01:00:00")], "user string, t string").select("user", F.to_timestamp("t").alias("ts"))
    assert resume.windowed(rows, "ts", ["user"], "1 minute", "1 minute").count() == 2
    assert resume.sessions(rows, "ts", "user", "5 minutes", "1 minute").count() == 2


def test_schemas():
    assert schemas.REQUIRED_KEYS == ("id", "file", "lang", "control", "dirty", "clean", "source")

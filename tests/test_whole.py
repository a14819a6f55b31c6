"""Queries that do the whole job of one whose SQL leaves part of it out."""

import json
import re

import pytest

from dictaspark.operators import generate, pairs
from dictaspark.plans import catalogue
from tests.helpers import connection, same

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


def written(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def agrees(spark, sf, name):
    df = QUERIES[name](spark, sf)
    same(df, connection(sf), SQL[name])
    return df.collect()


def test_argmax_keeps_ties(spark, tmp_path):
    rows = [(4, "a", 9.0), (3, "a", 9.0), (1, "a", 5.0), (8, "a", 0.5), (7, "a", 0.5), (9, "a", None)]
    sf = written(spark, tmp_path, "events", rows, "event_id long, event_type string, value double")
    assert [tuple(r) for r in agrees(spark, sf, "argmax_all_events")] == [("a", 3, 7)]


def test_gate_reasons(spark):
    control = "[Styling: casual] [Structure: prose] [Context: general] [Lang: %s]"
    number = iter(range(99))

    def line(**new):
        k = next(number)
        row = {"id": f"i{k}", "file": "a-2026-09", "lang": "fr", "control": control % "fr", "dirty": f"bonjour n{k} " + "mot " * 25, "clean": f"Bonjour n{k} " + "mot " * 24 + "mot.", "source": "x"}
        return json.dumps(row | new)

    a, good = "contrib/fr/a-2026-09.jsonl", "contrib/fr/b-2026-09.jsonl"
    rows = [(a, 1, line(clean=" ")), (a, 2, line(clean=None)), (a, 3, line(control=None)), (a, 4, line(lang="en")), (a, 5, line(file="c-2026-09")),
            (a, 6, line(control=control % "en")), (a, 7, line(held_out=True)), (a, 8, line(held_out=False)), (a, 9, line(clean="Bonjour Dupont.")),
            (a, 10, line(source="itn", clean="sans rapport")), (a, 11, line(held_out="false")), ("other/a-2026-09.jsonl", 1, line()),
            (good, 1, line(file="b-2026-09", source="itn", clean="bonjour nuage")), (good, 2, line(file="b-2026-09", source="x", clean="nuage"))]
    lines = spark.createDataFrame(rows, "path string, line int, raw string")
    got = {(r["path"], r["line"], r["reason"]) for r in pairs.gate(lines, ["Dupont"]).collect()}
    assert got == {(a, 1, "empty_side"), (a, 2, "empty_side"), (a, 3, "control"), (a, 4, "lang"), (a, 5, "file"), (a, 6, "control_lang"), (a, 7, "held_out"), (a, 9, "pii_nom_banni"), (a, 11, "held_out"),
                   ("other/a-2026-09.jsonl", 1, "path"), (good, 1, "structure_invention"), (good, 1, "structure_lower_start"), (good, 1, "structure_no_final_mark")}


def test_windows_follow_idx(spark, tmp_path):
    rows = [("s", "p", a, i, w) for a, i, w in (("a9", 0, 100), ("a1", 1, 100), ("a5", 2, 60), ("a2", 4, 5), ("a3", 5, 5), ("a4", 6, 251), ("b1", 8, 1), ("b0", 8, 1), ("b2", 9, 1))]
    sf = written(spark, tmp_path, "utterances", rows, "session_id string, paragraph_id string, audio_id string, idx int, words int")
    got = {(r["audio_id"], r["size"], r["total_words"]) for r in agrees(spark, sf, "windows_by_idx")}
    assert got == {("a9", 2, 200), ("a1", 2, 160), ("a9", 3, 260), ("a2", 2, 10), ("a3", 2, 256), ("b1", 2, 2)}


def test_negation_of_both_languages(spark, tmp_path):
    texts = [("en", "no I do not know, no wait, don't", "I know."), ("fr", "je sais pas", "Je ne sais pas."), ("fr", "je sais", "Je n'ai su."), ("en", None, "No."), (None, "no", "no"), ("en", "no , wait nor No", "nothing")]
    sf = written(spark, tmp_path, "contribs", [(k, *x) for k, x in enumerate(texts)], "row_id long, lang string, dirty string, clean string")

    def brute(text, lang):
        found = [m.lower() for m in re.findall(PATTERNS[lang], text or "", re.I)]
        particles = sum(m in ("ne", "n'", "n’") for m in found)
        return len(found) - particles, particles

    want = {(k, *brute(d, lang or "en"), *brute(c, lang or "en")) for k, (lang, d, c) in enumerate(texts)}
    rows = QUERIES["negation_markers"](spark, sf).collect()
    assert {tuple(r)[:5] for r in rows} == want and (0, 3, 0, 0, 0) in want
    assert {r["row_id"]: r["delta"] for r in rows} == {0: "changed", 1: None, 2: "particle", 3: "changed", 4: None, 5: "changed"}


PATTERNS = {"fr": r"\b(?:ne|n['’]|pas|plus|jamais|rien|aucune?s?|nul[le]*s?|ni|personne)\b",
            "en": r"\b(?:not|never|none|nothing|nobody|neither|nor|cannot)\b|n['’]t\b|\bno\b(?!\s*,?\s*wait\b)"}


def test_bench_counts_shared_causes(spark, tmp_path):
    rows = [("a", "KO", ["boucle", "vide"]), ("a", "ko ", ["boucle"]), ("b", "KO", ["vide"]), ("b", "KO", ["vide"]), ("c", "KO", ["langue"]), ("c", "OK", []), ("d", None, ["boucle"]), ("e", "KO", ["langue"]), ("e", "KO", None)]
    sf = written(spark, tmp_path, "qc_verdicts", rows, "id string, verdict string, causes array<string>")
    assert [r.asDict() for r in agrees(spark, sf, "binary_bench_causes")] == [{"n": 5, "agree": 3, "missed_ko": 0, "false_ko": 1, "cause_agree": 1}]


@pytest.mark.parametrize("group,lang", sorted(generate.WEIGHTS))
def test_generators_fill_quotas(spark, group, lang):
    weights = generate.WEIGHTS[(group, lang)]
    counts = {r["file"].split("-", 1)[1]: r["count"] for r in generate.pairs(spark, group, lang, 5000).groupBy("file").count().collect()}
    assert counts == generate.quotas(weights, 5000) and sum(counts.values()) == 5000
    assert all(abs(counts[f] / 5000 - w / sum(weights.values())) < 0.01 for f, w in weights.items())


def test_every_document_and_unit_counts(spark, sf):
    import hashlib

    ids = [r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()]
    assert agrees(spark, sf, "mirror_consistency_all")[0]["cases"] == sum(int(hashlib.md5(f"m2|{i}".encode()).hexdigest()[:8], 16) % 4 < 3 for i in ids)
    assert {r["id"][-1] for r in agrees(spark, sf, "evaluation_units_held")} - {"3"}

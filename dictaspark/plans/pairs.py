"""Pair queries: lengths, numbers, negation, control lines, filters, guard, gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dictaspark import lexicons as L
from dictaspark.functions import text as t
from dictaspark.operators import guard, pairs
from dictaspark.plans import sqltext as q
from dictaspark.plans.registry import query
from dictaspark.session import spread, table

_COUNTS = f"SELECT row_id, {q.word_count('dirty')} AS d, {q.word_count('clean')} AS c, control, dirty, clean FROM contribs"


@query(f"""SELECT row_id, CASE WHEN c > d * 1.15 + 12 THEN 'longer' WHEN d > 25 AND c < d * 0.45 THEN 'cut' ELSE 'ok' END AS drift FROM ({_COUNTS})""")
def pair_length_drift(spark: SparkSession, sf: str) -> DataFrame:
    d, c = t.word_count(F.col("dirty")), t.word_count(F.col("clean"))
    return table(spark, sf, "contribs").select("row_id", F.when(c > d * 1.15 + 12, "longer").when((d > 25) & (c < d * 0.45), "cut").otherwise("ok").alias("drift"))


@query(f"SELECT floor(c / greatest(d, 1) * 10)::BIGINT AS tenths, count(*) AS n FROM ({_COUNTS}) GROUP BY 1")
def pair_word_ratio_bands(spark: SparkSession, sf: str) -> DataFrame:
    ratio = t.word_count(F.col("clean")) / F.greatest(t.word_count(F.col("dirty")), F.lit(1))
    return table(spark, sf, "contribs").groupBy(F.floor(ratio * 10).alias("tenths")).agg(F.count("*").alias("n"))


@query(f"SELECT row_id FROM contribs WHERE {q.dedup_key('strip_accents(dirty)')} = {q.dedup_key('strip_accents(clean)')}")
def pair_identical(spark: SparkSession, sf: str) -> DataFrame:
    key = lambda c: t.dedup_key(t.deaccent(F.col(c)))
    return table(spark, sf, "contribs").filter(key("dirty") == key("clean")).select("row_id")


_NUM = r"list_sort(list_transform(regexp_extract_all(coalesce({0}, ''), '\d{{1,3}}(?:[ ,]\d{{3}})+|\d+'), lambda n: regexp_replace(n, '[ ,]', '', 'g')))"


@query(f"SELECT row_id, {_NUM.format('dirty')} AS dirty_numbers, {_NUM.format('clean')} AS clean_numbers FROM contribs")
def number_multiset(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", t.numbers(F.col("dirty")).alias("dirty_numbers"), t.numbers(F.col("clean")).alias("clean_numbers"))


@query(r"SELECT row_id FROM contribs WHERE NOT regexp_matches(dirty, '\d') AND regexp_matches(clean, '\d')")
def digit_invention(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").filter(~F.col("dirty").rlike(r"\d") & F.col("clean").rlike(r"\d")).select("row_id")


@query()
def negation_markers(spark: SparkSession, sf: str) -> DataFrame:
    """Full markers and particles of both sides and what became of them, by the full patterns of the row's language."""
    rows = spread(table(spark, sf, "contribs").select("row_id", "lang", "dirty", "clean"))
    count = lambda side, k: pairs.by_language(lambda lang: pairs.negation(F.col(side), lang)[k], F.col("lang"))
    delta = pairs.by_language(lambda lang: pairs.negation_delta(F.col("dirty"), F.col("clean"), lang), F.col("lang"))
    return rows.select("row_id", count("dirty", 0).alias("d"), count("dirty", 1).alias("d_particles"), count("clean", 0).alias("c"), count("clean", 1).alias("c_particles"), delta.alias("delta"))


@query("SELECT row_id, '[Styling: semi-formal] [Structure: prose] [Context: general] [Lang: ' || lang || ']' AS line FROM contribs WHERE lang IS NOT NULL")
def control_line_build(spark: SparkSession, sf: str) -> DataFrame:
    line = t.control_line(F.lit("semi-formal"), F.lit("prose"), F.lit("general"), F.col("lang"))
    return table(spark, sf, "contribs").filter("lang is not null").select("row_id", line.alias("line"))


@query(f"SELECT row_id, {', '.join(f'{q.axis(k, v)} AS {k}' for k, v in t.AXES.items())} FROM contribs")
def control_line_parse(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", *[t.control_axis(F.col("control"), a).alias(a) for a in t.AXES])


@query(f"SELECT count(*) AS n FROM (SELECT DISTINCT {', '.join(f'{q.axis(k, v)} AS {k}' for k, v in list(t.AXES.items())[:3])} FROM contribs)")
def combination_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").agg(F.countDistinct(*[t.control_axis(F.col("control"), a) for a in list(t.AXES)[:3]]).alias("n"))


@query(f"""SELECT row_id, CASE WHEN d > 150 THEN 'refuse long' WHEN d < 5 THEN 'refuse short' WHEN d < 20 THEN 'warn short' ELSE 'ok' END AS size FROM ({_COUNTS})""")
def contrib_size_bounds(spark: SparkSession, sf: str) -> DataFrame:
    d = t.word_count(F.col("dirty"))
    return table(spark, sf, "contribs").select("row_id", F.when(d > 150, "refuse long").when(d < 5, "refuse short").when(d < 20, "warn short").otherwise("ok").alias("size"))


@query(f"SELECT row_id, len({q.content('dirty', 'en')})::INT AS words, len(list_distinct({q.content('dirty', 'en')}))::INT AS different FROM contribs WHERE lang = 'en'")
def content_word_counts(spark: SparkSession, sf: str) -> DataFrame:
    w = t.content_words(F.col("dirty"), L.TOOLS["en"])
    return table(spark, sf, "contribs").filter("lang = 'en'").select("row_id", F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("different"))


_STEMS = f"list_transform({q.content('dirty', 'en')}, lambda x: {q.stem('x', 'en')})"


@query(f"""WITH s AS (SELECT row_id, {q.content('clean', 'en')} AS c, {_STEMS} AS ds FROM contribs WHERE lang = 'en' AND clean IS NOT NULL)
SELECT row_id, len(list_filter(list_distinct(c), lambda w: NOT list_contains(ds, {q.stem('w', 'en')})))::INT AS unsupported FROM s""")
def unsupported_words(spark: SparkSession, sf: str) -> DataFrame:
    """Different content words of the clean side whose stem the raw side lacks."""
    stems = F.transform(t.content_words(F.col("dirty"), L.TOOLS["en"]), lambda w: t.stem(w, L.SUFFIXES["en"]))
    words = F.array_distinct(t.content_words(F.col("clean"), L.TOOLS["en"]))
    fresh = t.let(stems, lambda known: F.filter(words, lambda w: ~F.array_contains(known, t.stem(w, L.SUFFIXES["en"]))))
    return table(spark, sf, "contribs").filter("lang = 'en' and clean is not null").select("row_id", F.size(fresh).alias("unsupported"))


@query()
def filter_pair(spark: SparkSession, sf: str) -> DataFrame:
    """First reason to reject each pair, by its language."""
    reason = pairs.by_language(lambda lang: pairs.filter_pair(
        F.col("dirty"), F.coalesce("clean", F.lit("")), t.control_axis(F.col("control"), "structure"), t.control_axis(F.col("control"), "context"), lang), F.col("lang"))
    rows = spread(table(spark, sf, "contribs").select("row_id", "lang", "control", "dirty", "clean"))
    return rows.select("row_id", reason.alias("reason"))


@query()
def validate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = spread(table(spark, sf, "contribs").filter("dirty is not null").select("lang", "file", "source", "dirty", "clean"))
    flags = ["invention", "rewriting", "lower_start", "no_final_mark", "keeping_lost", "keeping_digits", "identical"]
    parts = [pairs.validate(rows.filter(F.col("lang") == lang), lang) for lang in ("fr", "en")]
    return parts[0].unionByName(parts[1]).groupBy("lang").agg(F.count("*").alias("n"), *[F.count_if(F.col(f)).alias(f) for f in flags])


def _guarded(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    rows = spread(table(spark, sf, "contribs").filter("lang = 'fr'").select("row_id", "dirty", "clean", "control"))
    return guard.guard(rows, "row_id").filter(F.col("type") == kind)


@query()
def guard_invention(spark: SparkSession, sf: str) -> DataFrame:
    return _guarded(spark, sf, "invention")


@query()
def guard_loop(spark: SparkSession, sf: str) -> DataFrame:
    """Loops of the raw side that the clean side does not hold: a decoder that loops is guarded like a model that does."""
    rows = spread(table(spark, sf, "contribs").filter("lang = 'fr'").select("row_id", "clean", "dirty", "control"))
    return guard.guard(rows, "row_id", "clean", "dirty").filter("type = 'boucle'")


@query()
def guard_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _guarded(spark, sf, "suppression")


@query()
def guard_length(spark: SparkSession, sf: str) -> DataFrame:
    return _guarded(spark, sf, "derive_longueur")


@query()
def guard_polarity(spark: SparkSession, sf: str) -> DataFrame:
    return _guarded(spark, sf, "polarite")


@query()
def contribution_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Refusals and warnings of the contributions, taken as lines of their files; the family names of ``name_list`` are banned."""
    rows = spread(table(spark, sf, "contribs").select("row_id", "id", "file", "lang", "control", "dirty", "clean", "source"))
    raw = F.to_json(F.struct("id", "file", "lang", "control", "dirty", "clean", "source"), {"ignoreNullFields": "false"})
    lines = rows.select(F.concat(F.lit("contrib/"), F.coalesce("lang", F.lit("xx")), F.lit("/"), F.lower("file"), F.lit(".jsonl")).alias("path"), F.col("row_id").alias("line"), raw.alias("raw"))
    banned = [r["name"] for r in table(spark, sf, "name_list").filter("lower(trim(kind)) = 'family'").select(F.lower(F.trim("entry")).alias("name")).distinct().collect()]
    return pairs.gate(lines, sorted(banned)).groupBy("severity", "reason").agg(F.count("*").alias("n"))

"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dictaspark.llm import p1_repetition, p2_packing, p3_duplicates, p4_personal, p5_pairs, p6_splits, p7_leaks, p8_mixing, p9_abuse
from dictaspark.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_repetition.repetition(table(spark, sf_dir, "contribs")).filter(F.col("candidate") & (F.col("share") >= p1_repetition.SHARE)).select("row_id")


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = p1_repetition.repetition(table(spark, sf_dir, "contribs"))
    return out.select("row_id", "words", "candidate", F.round("score", 6).alias("score"), F.round("share", 6).alias("share"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_packing.pack_rows(table(spark, sf_dir, "contribs")).filter("pieces > 1 and piece = 0").select("row_id")


def p2_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_packing.pack_rows(table(spark, sf_dir, "contribs"))


def p2_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_packing.fills(p2_packing.pack_rows(table(spark, sf_dir, "contribs")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, total = p3_duplicates.encode(table(spark, sf_dir, "contribs"), "row_id", p3_duplicates.CONTRIB_FIELDS)
    return p3_duplicates.copy_pairs(coded, total)


def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = p3_duplicates.encode(table(spark, sf_dir, "contribs"), "row_id", p3_duplicates.CONTRIB_FIELDS)
    return p3_duplicates.distinct_records(coded).select("first_id", "copies")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_personal.found(table(spark, sf_dir, "contribs"), table(spark, sf_dir, "name_list"))


def p4_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_personal.redacted(table(spark, sf_dir, "contribs"), table(spark, sf_dir, "name_list"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_pairs.tagged(table(spark, sf_dir, "contribs")).filter("defect is not null").select("row_id", "defect")


def p5_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_pairs.tagged(table(spark, sf_dir, "contribs"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_splits.tied_handles(p6_splits.assign(table(spark, sf_dir, "contribs"))[1])


def p6_splits_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_splits.assign(table(spark, sf_dir, "contribs"))[0].select("row_id", "split")


def p6_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and share of every split, over all and by label."""
    rows = table(spark, sf_dir, "contribs")
    labels = rows.select("row_id", F.coalesce(F.lower(F.trim("lang")), F.lit("?")).alias("label"))
    placed = p6_splits.assign(rows)[0].join(labels, "row_id")
    counts = placed.groupBy("label", "split").agg(F.count("*").alias("rows"))
    both = counts.unionByName(counts.groupBy("split").agg(F.sum("rows").alias("rows")).withColumn("label", F.lit("all")))
    return both.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy("label")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).filter("verbatim").select("doc_id", "item_id")


def p7_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), measure=True)


def _sized(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "mix_targets")
    return p8_mixing.sized(table(spark, sf_dir, "documents"), targets), targets


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_mixing.shortfalls(*_sized(spark, sf_dir))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_mixing.mixture(*_sized(spark, sf_dir))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_mixing.shares(*_sized(spark, sf_dir))


def p8_tempered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix at the one exponent that keeps all sources within their limits."""
    return p8_mixing.shares(*_sized(spark, sf_dir), share_out=False)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = p9_abuse.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "review_labels"))
    return scores.filter(F.col("score") >= p9_abuse.CUT).select("doc_id")


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_abuse.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "review_labels"))


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_abuse.rates(p9_abuse.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "review_labels")))


def queries() -> dict:
    return {
        "p1_found": p1_found, "p1_shares": p1_shares,
        "p2_found": p2_found, "p2_requests": p2_requests, "p2_fills": p2_fills,
        "p3_found": p3_found, "p3_records": p3_records,
        "p4_found": p4_found, "p4_redacted": p4_redacted,
        "p5_found": p5_found, "p5_tags": p5_tags,
        "p6_found": p6_found, "p6_splits": p6_splits_by_row, "p6_deviation": p6_deviation,
        "p7_found": p7_found, "p7_candidates": p7_candidates,
        "p8_found": p8_found, "p8_mix": p8_mix, "p8_shares": p8_shares, "p8_tempered": p8_tempered,
        "p9_found": p9_found, "p9_scores": p9_scores, "p9_rates": p9_rates,
    }


_CANON = """
canon AS (
  SELECT row_id,
    regexp_replace(lower(coalesce(dirty, '')), '[^\\p{L}\\p{M}\\p{N}]+', '', 'g') AS d,
    regexp_replace(lower(coalesce(clean, '')), '[^\\p{L}\\p{M}\\p{N}]+', '', 'g') AS c,
    regexp_replace(lower(regexp_replace(coalesce(control, ''), '\\[[^\\]]*\\]', '', 'g')), '[^\\p{L}\\p{M}\\p{N}]+', '', 'g')
      || list_aggregate(list_sort(list_transform(regexp_extract_all(coalesce(control, ''), '\\[[^\\]]*\\]'),
        lambda x: regexp_replace(lower(x), '[^\\p{L}\\p{M}\\p{N}]+', '', 'g'))), 'string_agg', '') AS k
  FROM contribs)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": "SELECT row_id FROM contribs WHERE strlen(dirty) > 1200",
        "p3_found": f"WITH {_CANON}, m AS (SELECT row_id, min(row_id) OVER (PARTITION BY d, c, coalesce(k, '')) AS a FROM canon) "
        "SELECT a AS row_id_a, row_id AS row_id_b FROM m WHERE a <> row_id",
        "p3_records": f"WITH {_CANON} SELECT min(row_id) AS first_id, count(*) AS copies FROM canon GROUP BY d, c, coalesce(k, '')",
        "p6_found": r"""
WITH RECURSIVE r AS (
  SELECT DISTINCT regexp_extract(lower(trim(id)), '^(.+?)(?:-\d{14}-[0-9a-f]{6})?-\d{4}-\d{2}-\d+$', 1) AS h,
    nullif(nullif(lower(trim(source)), ''), 'unknown') AS s FROM contribs),
e AS (SELECT DISTINCT a.h AS a, b.h AS b FROM r a JOIN r b ON a.s = b.s WHERE a.h <> '' AND b.h <> '' AND a.h <> b.h),
t(a, b) AS (SELECT a, b FROM e UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a)
SELECT DISTINCT a AS handle_a, b AS handle_b FROM t WHERE a < b""",
    }

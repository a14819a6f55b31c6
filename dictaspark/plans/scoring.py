"""Scoring queries: judges, blind comparison, significance, mirrors, impact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dictaspark import lexicons as L
from dictaspark.functions import stats, text as t
from dictaspark.plans.registry import query
from dictaspark.session import table

_H = "('0x' || substr(md5('{0}|' || doc_id), 1, 8))::UBIGINT"


def _winner(spark: SparkSession, sf: str) -> DataFrame:
    """Blind verdicts derived from hashes, with the sides swapped for half of the documents."""
    docs = table(spark, sf, "documents").select("doc_id")
    swap, raw = t.hash_draw("swap", F.col("doc_id")) % 2 == 0, t.hash_draw("win", F.col("doc_id")) % 5
    shown = F.when(raw < 2, "A").when(raw < 4, "B").otherwise("egalite")
    real = F.when(shown == "egalite", "tie").when((shown == "A") != swap, "base").otherwise("candidate")
    return docs.select("doc_id", swap.alias("swap"), shown.alias("shown"), real.alias("winner"))


_WINNER = f"""v AS (SELECT doc_id, {_H.format('swap')} % 2 = 0 AS swap, CASE WHEN {_H.format('win')} % 5 < 2 THEN 'A' WHEN {_H.format('win')} % 5 < 4 THEN 'B' ELSE 'egalite' END AS shown FROM documents),
w AS (SELECT *, CASE WHEN shown = 'egalite' THEN 'tie' WHEN (shown = 'A') <> swap THEN 'base' ELSE 'candidate' END AS winner FROM v)"""


@query(f"WITH {_WINNER} SELECT winner, count(*) AS n, count(*) FILTER (swap) AS swapped FROM w GROUP BY winner")
def ab_tally(spark: SparkSession, sf: str) -> DataFrame:
    return _winner(spark, sf).groupBy("winner").agg(F.count("*").alias("n"), F.count_if("swap").alias("swapped"))


@query(f"""WITH {_WINNER}, c AS (SELECT count(*) FILTER (winner = 'candidate') AS a, count(*) FILTER (winner = 'base') AS b FROM w)
SELECT a, b, round((a - b) / sqrt(nullif(a + b, 0)), 9) AS z, coalesce(abs((a - b) / sqrt(nullif(a + b, 0))) >= 1.96, false) AS significant FROM c""")
def sign_z(spark: SparkSession, sf: str) -> DataFrame:
    c = _winner(spark, sf).agg(F.count_if(F.col("winner") == "candidate").alias("a"), F.count_if(F.col("winner") == "base").alias("b"))
    z = stats.sign_z(F.col("a"), F.col("b"))
    return c.select("a", "b", F.round(z, 9).alias("z"), F.coalesce(F.abs(z) >= 1.96, F.lit(False)).alias("significant"))


@query(f"""WITH d AS (SELECT doc_id, {_H.format('m1')} % 3 AS direct, {_H.format('m2')} % 4 AS inverse FROM documents)
SELECT count(*) AS cases, count(*) FILTER (direct = inverse) AS hard, count(*) FILTER (direct = 2 AND inverse = 2) AS ties FROM d WHERE inverse < 3""")
def mirror_consistency_all(spark: SparkSession, sf: str) -> DataFrame:
    """Cases seen in both orders; only a missing side (verdict 3) drops a case."""
    return _mirrored(table(spark, sf, "documents").select("doc_id"))


def _mirrored(docs: DataFrame) -> DataFrame:
    seen = docs.select("doc_id", F.lit("direct").alias("sens"), (t.hash_draw("m1", F.col("doc_id")) % 3).alias("v")).unionByName(
        docs.select("doc_id", F.lit("inverse").alias("sens"), (t.hash_draw("m2", F.col("doc_id")) % 4).alias("v"))).filter("v < 3")
    both = seen.groupBy("doc_id").pivot("sens", ["direct", "inverse"]).agg(F.first("v")).filter("direct is not null and inverse is not null")
    return both.agg(F.count("*").alias("cases"), F.count_if(F.col("direct") == F.col("inverse")).alias("hard"), F.count_if(F.expr("direct = 2 and inverse = 2")).alias("ties"))


_CLASS = "CASE WHEN {0} % 20 < 11 THEN 'sain' WHEN {0} % 20 < 17 THEN 'suspect' ELSE 'verole' END"


@query(f"""WITH d AS (SELECT {_CLASS.format(_H.format('gold'))} AS gold, {_H.format('keep')} % 4 < 3 AS kept FROM documents),
c AS (SELECT gold, count(*) AS n, count(*) FILTER (kept) AS k FROM d GROUP BY gold), w AS (SELECT * FROM (VALUES ('sain', 675), ('suspect', 373), ('verole', 187)) x(gold, weight))
SELECT round(sum(k * 1.0 / n * weight), 6) AS kept, round(sum(k * 1.0 / n * weight) FILTER (gold = 'verole') / sum(k * 1.0 / n * weight), 9) AS contamination,
round(sum(k * 1.0 / n * weight) FILTER (gold = 'sain') / sum(weight) FILTER (gold = 'sain'), 9) AS recall FROM c JOIN w USING (gold)""")
def impact_reweight(spark: SparkSession, sf: str) -> DataFrame:
    """Confusion re-weighted to the corpus class mix."""
    draw = t.hash_draw("gold", F.col("doc_id")) % 20
    rows = table(spark, sf, "documents").select(F.when(draw < 11, "sain").when(draw < 17, "suspect").otherwise("verole").alias("gold"), (t.hash_draw("keep", F.col("doc_id")) % 4 < 3).alias("kept"))
    counts = rows.groupBy("gold").agg(F.count("*").alias("n"), F.count_if("kept").alias("k"))
    weights = spark.createDataFrame([("sain", 675), ("suspect", 373), ("verole", 187)], "gold string, weight int")
    scaled = counts.join(F.broadcast(weights), "gold").select("gold", "weight", (F.col("k") / F.col("n") * F.col("weight")).alias("x"))
    of = lambda c, g: F.sum(F.when(F.col("gold") == g, F.col(c)))
    return scaled.agg(F.round(F.sum("x"), 6).alias("kept"), F.round(of("x", "verole") / F.sum("x"), 9).alias("contamination"), F.round(of("x", "sain") / of("weight", "sain"), 9).alias("recall"))


@query("""WITH x AS (SELECT id, list_sort(list_distinct(list_filter(causes, lambda c: c IN ('boucle', 'effondrement', 'langue', 'incoherence')))) AS c,
list_sort(list_distinct(list_filter(defauts, lambda c: c IN ('boucle', 'effondrement', 'langue', 'incoherence')))) AS d FROM qc_verdicts WHERE causes IS NOT NULL AND defauts IS NOT NULL)
SELECT count(*) AS n, count(*) FILTER (c = d) AS same, count(*) FILTER (list_has_any(c, d)) AS shared FROM x""")
def cause_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Exact and overlapping agreement of the two grids on their shared causes."""
    only = lambda c: F.array_sort(F.array_distinct(F.filter(c, lambda x: x.isin(L.SHARED_CAUSES))))
    rows = table(spark, sf, "qc_verdicts").filter("causes is not null and defauts is not null").select(only("causes").alias("c"), only("defauts").alias("d"))
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col("c") == F.col("d")).alias("same"), F.count_if(F.arrays_overlap("c", "d")).alias("shared"))


@query("""WITH f AS (SELECT coalesce(lang, '?') AS lang, verdict FROM qc_verdicts)
SELECT lang, count(*) AS n, count(*) FILTER (strip_accents(lower(trim(verdict))) IN ('ok', 'ko', 'sain', 'suspect', 'verole')) AS valid,
count(*) FILTER (strip_accents(lower(trim(verdict))) IN ('ok', 'sain')) AS kept FROM f GROUP BY lang""")
def qc_summary(spark: SparkSession, sf: str) -> DataFrame:
    v = t.deaccent(F.lower(F.trim("verdict")))
    return table(spark, sf, "qc_verdicts").groupBy(F.coalesce("lang", F.lit("?")).alias("lang")).agg(
        F.count("*").alias("n"), F.count_if(v.isin("ok", "ko", "sain", "suspect", "verole")).alias("valid"), F.count_if(v.isin("ok", "sain")).alias("kept"))


@query("""SELECT cause, count(*) AS n FROM (SELECT unnest(causes) AS cause FROM qc_verdicts WHERE causes IS NOT NULL)
WHERE cause IS NULL OR cause NOT IN ('vide', 'boucle', 'langue', 'sens', 'invention', 'effondrement', 'incoherence') GROUP BY cause""")
def unknown_causes(spark: SparkSession, sf: str) -> DataFrame:
    causes = table(spark, sf, "qc_verdicts").select(F.explode("causes").alias("cause"))
    return causes.filter(F.col("cause").isNull() | ~F.col("cause").isin(L.CLOSED["qc_cause"])).groupBy("cause").agg(F.count("*").alias("n"))


@query("""WITH m AS (SELECT coalesce(nullif(lower(trim(source)), ''), 'unknown') AS model, count(*) AS n, avg(n_chars) AS cost FROM documents GROUP BY 1)
SELECT model, n, cost, n >= 30 AS enough, n >= 30 AND cost = min(cost) FILTER (n >= 30) OVER () AS smallest FROM m""")
def gates(spark: SparkSession, sf: str) -> DataFrame:
    """A gate on each aggregate, and the smallest that passes."""
    rows = table(spark, sf, "documents").groupBy(F.coalesce(F.nullif(F.lower(F.trim("source")), F.lit("")), F.lit("unknown")).alias("model")).agg(F.count("*").alias("n"), F.avg("n_chars").alias("cost"))
    least = rows.agg(F.min(F.when(F.col("n") >= 30, F.col("cost"))).alias("least"))
    return rows.join(F.broadcast(least), F.lit(True)).select("model", "n", "cost", (F.col("n") >= 30).alias("enough"), ((F.col("n") >= 30) & (F.col("cost") == F.col("least"))).alias("smallest"))

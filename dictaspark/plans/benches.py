"""Queries of the benches, on real joins: redelivered contributions, takes judged twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dictaspark import lexicons as L
from dictaspark.functions import stats, text as t
from dictaspark.operators import bench, pipeline
from dictaspark.plans import sqltext as q
from dictaspark.plans.registry import query
from dictaspark.session import spread, table

_NUM = r"list_sort(list_transform(regexp_extract_all(coalesce({0}, ''), '\d{{1,3}}(?:[ ,]\d{{3}})+|\d+'), lambda n: regexp_replace(n, '[ ,]', '', 'g')))"
_FAULTS = "list_filter([CASE WHEN len({0}) = 0 THEN 'suppression' END, CASE WHEN len(list_filter({1}, lambda n: NOT list_contains({2}, n))) > 0 THEN 'invention' END], lambda f: f IS NOT NULL)"


@query(f"""WITH r AS (SELECT id, arg_min(coalesce(clean, ''), row_id) AS x, arg_max(coalesce(clean, ''), row_id) AS y, arg_min(coalesce(dirty, ''), row_id) AS d FROM contribs WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1),
f AS (SELECT id, {_FAULTS.format("trim(x)", _NUM.format("x"), _NUM.format("d"))} AS fx, {_FAULTS.format("trim(y)", _NUM.format("y"), _NUM.format("d"))} AS fy FROM r),
w AS (SELECT *, CASE WHEN len(fx) < len(fy) THEN 'base' WHEN len(fy) < len(fx) THEN 'candidate' ELSE 'egalite' END AS winner FROM f)
SELECT 'win' AS what, winner AS side, count(*) AS n FROM w GROUP BY 2
UNION ALL SELECT f, 'base', count(*) FROM (SELECT unnest(fx) AS f FROM w) GROUP BY 1 UNION ALL SELECT f, 'candidate', count(*) FROM (SELECT unnest(fy) AS f FROM w) GROUP BY 1""")
def ab_redelivered(spark: SparkSession, sf: str) -> DataFrame:
    """First against last delivery of an id, shown blind: the side with fewer faults (an empty text, a number that the raw side lacks) wins."""
    rows = table(spark, sf, "contribs").filter("id is not null").select("id", "row_id", F.coalesce("dirty", F.lit("")).alias("dirty"), F.coalesce("clean", F.lit("")).alias("clean"))
    both = rows.groupBy("id").agg(F.min_by("clean", "row_id").alias("x"), F.max_by("clean", "row_id").alias("y"), F.min_by("dirty", "row_id").alias("dirty"), F.count("*").alias("n")).filter("n > 1")
    base, candidate = both.select("id", F.col("x").alias("clean")), both.select("id", F.col("y").alias("clean"))
    cases = bench.blind(base, candidate, "id", "clean").join(both.select("id", "dirty"), "id")
    known = t.numbers(F.col("dirty"))
    faults = lambda c: F.array_compact(F.array(F.when(F.trim(c) == "", "suppression"), F.when(F.size(F.array_except(t.numbers(F.col(c)), known)) > 0, "invention")))
    seen = cases.withColumn("faults_a", faults("a")).withColumn("faults_b", faults("b"))
    winner = F.when(F.size("faults_a") < F.size("faults_b"), "A").when(F.size("faults_b") < F.size("faults_a"), "B").otherwise("egalite")
    return bench.tally(bench.decoded(seen.withColumn("winner", winner), "id"))


@query("""WITH v AS (SELECT id, upper(trim(verdict)) AS v FROM qc_verdicts WHERE id IS NOT NULL AND upper(trim(verdict)) IN ('OK', 'KO')),
a AS (SELECT id, max(v) AS a FROM v GROUP BY id), b AS (SELECT id, min(v) AS b FROM v GROUP BY id), j AS (SELECT * FROM a JOIN b USING (id)),
s AS (SELECT count(*) AS n, avg((a = b)::INT) AS po, avg((a = 'OK')::INT) * avg((b = 'OK')::INT) + avg((a = 'KO')::INT) * avg((b = 'KO')::INT) AS pe FROM j)
SELECT n, round(po, 9) AS observed, round(pe, 9) AS chance, round((po - pe) / (1 - pe), 9) AS kappa FROM s""")
def judge_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Two judges joined by id: the kindest and the strictest verdict of every take."""
    rows = table(spark, sf, "qc_verdicts").withColumn("verdict", pipeline.verdict(F.col("verdict"))).filter("id is not null and verdict in ('OK', 'KO')").groupBy("id")
    met = bench.aligned(rows.agg(F.max("verdict").alias("verdict")), rows.agg(F.min("verdict").alias("verdict")))
    out = stats.kappa(met, "a", "b")
    return out.select("n", *[F.round(c, 9).alias(c) for c in ("observed", "chance", "kappa")])


@query(f"""WITH o AS (SELECT id, min(text) AS x FROM asr_takes WHERE id IS NOT NULL AND text IS NOT NULL GROUP BY id),
k AS (SELECT DISTINCT id FROM qc_verdicts WHERE upper(trim(verdict)) = 'OK'),
j AS (SELECT CASE WHEN {q.word_count('x')} > 20 THEN 'OK' ELSE 'KO' END AS v FROM o JOIN k USING (id))
SELECT v AS what, count(*) AS n FROM j GROUP BY 1 UNION ALL SELECT 'vide', count(*) FROM j WHERE v = 'KO' HAVING count(*) > 0""")
def rejudge(spark: SparkSession, sf: str) -> DataFrame:
    """Takes once judged OK, judged again by a stub that calls up to 20 words empty."""
    takes = table(spark, sf, "asr_takes").filter("id is not null and text is not null").groupBy("id").agg(F.min("text").alias("text"))
    known = table(spark, sf, "qc_verdicts").filter(pipeline.verdict(F.col("verdict")) == "OK").select("id").distinct()

    def client(prompts: list[str]) -> list[str]:
        short = [len(p.split("CANDIDATE:")[1].split()) <= 20 for p in prompts]
        return ['{"verdict": "ko", "causes": ["Vide"]}' if s else 'well {"verdict": "OK", "causes": []}' for s in short]

    reference = takes.join(known, "id", "left_semi").select("id", F.col("text").alias("whole"))
    return bench.verdict_summary(bench.rejudge(takes, reference, "id", "text", "whole", client, most=1 << 20))


@query(f"""SELECT doc_id, len(regexp_replace(lower(coalesce(text, '')), '[^àâäéèêëïîôöùûüçœ]', '', 'g')) > len(w) * 0.02 OR len(list_filter(w, lambda x: x IN ({q.quoted(L.FRENCH_TEST)}))) > len(w) * 0.06 AS french
FROM (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[a-zA-ZÀ-ÿ'']+') AS w FROM documents)""")
def french_test(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", t.french_by_share(F.col("text"), L.FRENCH_TEST).alias("french"))


_COUNT = "len(list_filter(w, lambda x: x IN ({0})))"


@query(f"""SELECT doc_id, {" + ".join(_COUNT.format(q.quoted(L.DRIFT[x])) for x in ("fr", "es", "de"))} > {_COUNT.format(q.quoted(L.DRIFT["en"]))} + 2 AS drifts
FROM (SELECT doc_id, regexp_extract_all(replace(lower(coalesce(text, '')), 'c''est', 'c·est'), '[\\p{{L}}\\p{{N}}_·]+') AS v, list_transform(v, lambda x: replace(x, '·', chr(39))) AS w FROM documents)""")
def language_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Texts in which function words of French, Spanish and German outnumber those of English."""
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", t.language_drift(F.col("text"), L.DRIFT).alias("drifts"))


@query("""SELECT n, ceil(n / 16.0)::BIGINT AS batches, floor(ceil(ceil(n / 16.0) / 4.0) * 2)::BIGINT AS steps, greatest(1, floor(0.06 * floor(ceil(ceil(n / 16.0) / 4.0) * 2)))::BIGINT AS warmup
FROM (SELECT count(*) AS n FROM contribs GROUP BY lang)""")
def training_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of 16, optimiser steps of four batches over two epochs, and warm-up, for every language's rows."""
    rows = table(spark, sf, "contribs").groupBy("lang").agg(F.count("*").alias("n"))
    return rows.select("n", stats.step_counts(F.col("n"), 16, 4, 2).alias("s")).select("n", "s.*")


@query(f"""SELECT row_id, CASE WHEN lower(regexp_extract(clean, '^([^ ]+)', 1)) IN ({q.quoted(L.TOOLS["en"])}) THEN lower(left(clean, 1)) || substr(clean, 2) ELSE clean END AS text FROM contribs""")
def lower_first_function_word(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", t.lower_first_function_word(F.col("clean"), L.TOOLS["en"]).alias("text"))


@query("""WITH r AS (SELECT id, verdict, CASE upper(trim(verdict)) WHEN 'OK' THEN 'Plutôt SAIN, je crois' WHEN 'KO' THEN 'VÉROLÉ (suspect)' ELSE 'Suspect' END AS reply FROM qc_verdicts)
SELECT id, CASE WHEN contains(strip_accents(lower(reply)), 'verole') THEN 'verole' WHEN contains(lower(reply), 'suspect') THEN 'suspect' WHEN contains(lower(reply), 'sain') THEN 'sain' END AS word FROM r""")
def verdict_words(spark: SparkSession, sf: str) -> DataFrame:
    """The canonical word in a free reply, written here from every verdict."""
    v = pipeline.verdict(F.col("verdict"))
    reply = F.when(v == "OK", "Plutôt SAIN, je crois").when(v == "KO", "VÉROLÉ (suspect)").otherwise("Suspect")
    return table(spark, sf, "qc_verdicts").select("id", t.verdict_word(reply).alias("word"))

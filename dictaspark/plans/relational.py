"""Relational primitives: joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dictaspark.functions import stats
from dictaspark.operators import dedup, sample
from dictaspark.plans.registry import query
from dictaspark.session import table

@query("SELECT id, max_by(row_id, row_id) AS row_id FROM contribs GROUP BY id")
def keyed_scan_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.keep_last(table(spark, sf, "contribs").select("id", "row_id", F.col("row_id").alias("seq")), "id", ["seq"]).select("id", "row_id")


@query("""WITH a AS (SELECT DISTINCT id, text, words FROM asr_takes WHERE id IS NOT NULL),
q AS (SELECT id, max(upper(trim(verdict))) AS verdict FROM qc_verdicts GROUP BY id)
SELECT coalesce(q.verdict, 'sans verdict') AS verdict, count(*) AS n, sum(a.words) AS words FROM a LEFT JOIN q USING (id) GROUP BY 1""")
def left_join_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    asr = table(spark, sf, "asr_takes").select("id", "text", "words").filter("id is not null").distinct()
    verdicts = table(spark, sf, "qc_verdicts").groupBy("id").agg(F.max(F.upper(F.trim("verdict"))).alias("verdict"))
    return asr.join(verdicts, "id", "left").groupBy(F.coalesce("verdict", F.lit("sans verdict")).alias("verdict")).agg(
        F.count("*").alias("n"), F.sum("words").alias("words"))


@query("SELECT DISTINCT id FROM asr_takes WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM qc_verdicts WHERE id IS NOT NULL AND upper(trim(verdict)) IN ('OK', 'KO'))")
def anti_join_pending(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "qc_verdicts").filter(F.upper(F.trim("verdict")).isin("OK", "KO"))
    return table(spark, sf, "asr_takes").select("id").filter("id is not null").distinct().join(done.select("id"), "id", "left_anti")


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM review_labels WHERE toxic IS NOT NULL)")
def semi_join_labelled(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "review_labels").filter("toxic is not null"), "doc_id", "left_semi")


@query("""SELECT DISTINCT session_id, audio_id FROM utterances u WHERE NOT EXISTS (
SELECT 1 FROM documents d WHERE d.session_id = u.session_id AND d.words = u.words)""")
def anti_join_composite(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "documents").select("session_id", "words")
    return table(spark, sf, "utterances").join(seen, ["session_id", "words"], "left_anti").select("session_id", "audio_id").distinct()


@query("""SELECT u.session_id, count(DISTINCT u.audio_id) AS utterances, count(DISTINCT d.doc_id) AS documents, count(DISTINCT r.reviewer) AS reviewers
FROM utterances u JOIN documents d USING (session_id) LEFT JOIN review_labels r ON r.doc_id = d.doc_id GROUP BY u.session_id""")
def three_way_join(spark: SparkSession, sf: str) -> DataFrame:
    # each side is counted before the join, so that rows of hot sessions are not multiplied
    spoken = table(spark, sf, "utterances").filter("session_id is not null").groupBy("session_id").agg(F.countDistinct("audio_id").alias("utterances"))
    docs = table(spark, sf, "documents").filter("session_id is not null").select("session_id", "doc_id")
    labels = table(spark, sf, "review_labels").select("doc_id", "reviewer").distinct()
    texts = docs.join(labels, "doc_id", "left").groupBy("session_id").agg(F.countDistinct("doc_id").alias("documents"), F.countDistinct("reviewer").alias("reviewers"))
    return spoken.join(texts, "session_id")


@query("""SELECT n_name, r_name, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name""")
def star_join_revenue(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    by_nation = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("r").alias("revenue"))
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return by_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "r_name", "revenue")


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, avg(l_extendedprice) AS avg_price, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def pricing_summary(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp")).groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.avg("l_extendedprice").alias("avg_price"), F.count("*").alias("n"))


@query("""WITH q AS (SELECT DISTINCT id, list_sort(list_distinct(causes)) AS c FROM qc_verdicts WHERE causes IS NOT NULL),
x AS (SELECT id, c, unnest(c) AS a FROM q), y AS (SELECT a, unnest(c) AS b FROM x)
SELECT a, b, count(*) AS n FROM y WHERE a < b GROUP BY 1, 2""")
def cause_confusions(spark: SparkSession, sf: str) -> DataFrame:
    # unordered pairs inside one row's short list of causes
    rows = table(spark, sf, "qc_verdicts").filter("causes is not null").select("id", F.array_sort(F.array_distinct("causes")).alias("c")).distinct()
    return rows.select("c", F.explode("c").alias("a")).select("a", F.explode("c").alias("b")).filter("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))


@query("SELECT cause, count(*) AS n FROM (SELECT unnest(causes) AS cause FROM qc_verdicts WHERE causes IS NOT NULL) GROUP BY cause")
def cause_explode(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "qc_verdicts").select(F.explode(F.coalesce("causes", F.array().cast("array<string>"))).alias("cause")).groupBy("cause").agg(F.count("*").alias("n"))


@query("""WITH k AS (SELECT row_id, id, regexp_replace(lower(regexp_replace(dirty, '[ \\t\\n\\r\\f\\x{A0}]+', ' ', 'g')), '^ | $', '', 'g') AS key FROM contribs)
SELECT row_id, min(row_id) OVER (PARTITION BY key) AS first_row, count(*) OVER (PARTITION BY key) AS copies FROM k
QUALIFY first_row <> row_id""")
def dedup_against_existing(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose folded text stood in an earlier row: key counts first, then a join, so no group is sorted."""
    key = F.regexp_replace(F.lower(F.regexp_replace("dirty", "[ \\t\\n\\r\\f\\u00A0]+", " ")), "^ | $", "")
    rows = table(spark, sf, "contribs").filter("dirty is not null").select("row_id", F.xxhash64(key).alias("h"), F.md5(key).alias("m"))
    heads = rows.groupBy("h", "m").agg(F.min("row_id").alias("first_row"), F.count("*").alias("copies")).filter("copies > 1")
    return rows.join(heads, ["h", "m"]).filter("row_id <> first_row").select("row_id", "first_row", "copies")


@query("SELECT source_key, count(*) AS n, count(*) * 1.0 / sum(count(*)) OVER () AS share FROM (SELECT coalesce(nullif(lower(trim(source)), ''), 'unknown') AS source_key FROM contribs) GROUP BY source_key")
def mix_composition(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "contribs").groupBy(F.coalesce(F.nullif(F.lower(F.trim("source")), F.lit("")), F.lit("unknown")).alias("source_key")).agg(F.count("*").alias("n"))
    total = rows.agg(F.sum("n").alias("total"))
    return rows.join(F.broadcast(total), F.lit(True)).select("source_key", "n", (F.col("n") / F.col("total")).alias("share"))


@query("""SELECT lang, count(*) AS n, count(*) FILTER (clean IS NULL) AS no_clean, count(*) FILTER (control IS NULL) AS no_control,
count(*) FILTER (lower(control) LIKE '%[context: email]%') AS emails FROM contribs GROUP BY lang""")
def conditional_sums(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").groupBy("lang").agg(
        F.count("*").alias("n"), F.count_if(F.col("clean").isNull()).alias("no_clean"), F.count_if(F.col("control").isNull()).alias("no_control"),
        F.count_if(F.lower("control").contains("[context: email]")).alias("emails"))


@query("""SELECT CASE WHEN grouping(lang) = 1 THEN 'all' ELSE coalesce(lang, '?') END AS family, count(*) AS n, sum(words) AS words
FROM asr_takes GROUP BY ROLLUP (lang)""")
def score_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "asr_takes").rollup("lang").agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.grouping("lang").alias("g")).select(
        F.when(F.col("g") == 1, "all").otherwise(F.coalesce("lang", F.lit("?"))).alias("family"), "n", "words")


@query("""SELECT coalesce(o_orderpriority, '?') AS gold, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def confusion_pivot(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "orders").groupBy(F.coalesce("o_orderpriority", F.lit("?")).alias("gold")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    return wide.na.fill(0, ["F", "O", "P"])


@query("SELECT session_id, count(DISTINCT speaker_id) AS speakers, string_agg(DISTINCT speaker_id, '|' ORDER BY speaker_id) AS names FROM utterances WHERE session_id IS NOT NULL GROUP BY session_id")
def collect_distinct_join(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "utterances").filter("session_id is not null").select("session_id", "speaker_id").distinct()
    return people.groupBy("session_id").agg(F.count("speaker_id").alias("speakers"), F.nullif(F.array_join(F.array_sort(F.collect_list("speaker_id")), "|"), F.lit("")).alias("names"))


@query("SELECT paragraph_id, string_agg(raw_text, ' ' ORDER BY idx, audio_id) AS text, sum(words) AS words FROM utterances WHERE paragraph_id IS NOT NULL GROUP BY paragraph_id")
def concat_in_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "utterances").filter("paragraph_id is not null").groupBy("paragraph_id").agg(
        F.array_sort(F.collect_list(F.struct("idx", "audio_id", "raw_text"))).alias("parts"), F.sum("words").alias("words"))
    texts = F.filter(F.transform("parts", lambda p: p["raw_text"]), lambda x: x.isNotNull())
    return rows.select("paragraph_id", F.array_join(texts, " ").alias("text"), "words")


@query("""WITH o AS (SELECT lang, words, row_number() OVER (PARTITION BY lang ORDER BY words) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM asr_takes WHERE words IS NOT NULL AND lang IS NOT NULL)
SELECT lang, max(words) FILTER (r = round_even(0.5 * (n - 1), 0)) AS p50, max(words) FILTER (r = round_even(0.9 * (n - 1), 0)) AS p90 FROM o GROUP BY lang""")
def percentile_nearest_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest rank from a histogram of values, so that no group is collected."""
    cells = table(spark, sf, "asr_takes").filter("words is not null and lang is not null").groupBy("lang", "words").agg(F.count("*").alias("n"))
    part = Window.partitionBy("lang")
    run = cells.withColumn("upto", F.sum("n").over(part.orderBy("words"))).withColumn("total", F.sum("n").over(part))
    at = lambda p: F.min(F.when(F.col("upto") > F.bround(p * (F.col("total") - 1)), F.col("words")))
    return run.groupBy("lang").agg(at(0.5).alias("p50"), at(0.9).alias("p90"))


@query("SELECT source, median(n_chars) AS mid FROM (SELECT coalesce(nullif(lower(trim(source)), ''), 'unknown') AS source, n_chars FROM documents) GROUP BY source")
def median_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy(F.coalesce(F.nullif(F.lower(F.trim("source")), F.lit("")), F.lit("unknown")).alias("source")).agg(F.median("n_chars").alias("mid"))


@query("SELECT session_id, sum(words) / sum(duration_s) AS words_a_second, avg(words) AS mean_words FROM utterances WHERE session_id IS NOT NULL GROUP BY session_id HAVING sum(duration_s) > 0")
def density(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "utterances").filter("session_id is not null").groupBy("session_id").agg(
        (F.sum("words") / F.sum("duration_s")).alias("words_a_second"), F.avg("words").alias("mean_words"), F.sum("duration_s").alias("s")).filter("s > 0").drop("s")


@query("""SELECT event_type, (array_agg(event_id ORDER BY value DESC, event_id))[1] AS best, (array_agg(event_id ORDER BY value, event_id))[1] AS least
FROM events WHERE value IS NOT NULL GROUP BY event_type""")
def argmax_all_events(spark: SparkSession, sf: str) -> DataFrame:
    """Arg-max and arg-min of every type over every event; the smallest event of the extreme value answers."""
    rows = table(spark, sf, "events").filter("value is not null").groupBy("event_type", "value").agg(F.min("event_id").alias("event_id"))
    return rows.groupBy("event_type").agg(F.max_by("event_id", "value").alias("best"), F.min_by("event_id", "value").alias("least"))


@query("SELECT p_type AS family, count(*) AS n FROM part GROUP BY p_type HAVING count(*) < 200")
def sub_floor_families(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy(F.col("p_type").alias("family")).agg(F.count("*").alias("n")).filter("n < 200")


@query("""SELECT source, count(*) AS n FROM (SELECT coalesce(nullif(lower(trim(source)), ''), 'unknown') AS source FROM documents)
GROUP BY source ORDER BY n DESC, source LIMIT 10""")
def top_sources(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").groupBy(F.coalesce(F.nullif(F.lower(F.trim("source")), F.lit("")), F.lit("unknown")).alias("source")).agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "source").limit(10)


@query("""(SELECT doc_id, n_chars, 'top' AS part FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20) UNION ALL
(SELECT doc_id, n_chars, 'bottom' AS part FROM documents ORDER BY n_chars, doc_id LIMIT 20)""")
def top_and_bottom(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    top = docs.orderBy(F.desc("n_chars"), "doc_id").limit(20).withColumn("part", F.lit("top"))
    return top.unionByName(docs.orderBy("n_chars", "doc_id").limit(20).withColumn("part", F.lit("bottom")))


@query("SELECT doc_id AS key, text FROM documents UNION ALL SELECT item_id AS key, text FROM eval_items")
def union_files(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("key"), "text").unionByName(table(spark, sf, "eval_items").select(F.col("item_id").alias("key"), "text"))


@query("SELECT id FROM asr_takes WHERE id IS NOT NULL INTERSECT SELECT id FROM qc_verdicts")
def intersect_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "asr_takes").select("id").filter("id is not null").intersect(table(spark, sf, "qc_verdicts").select("id"))


@query("SELECT session_id FROM documents WHERE session_id IS NOT NULL EXCEPT SELECT session_id FROM utterances WHERE session_id IS NOT NULL")
def except_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("session_id").filter("session_id is not null").subtract(table(spark, sf, "utterances").select("session_id").filter("session_id is not null"))


@query("SELECT lower(file) AS file, count(DISTINCT lang) AS langs, count(DISTINCT lang) > 1 AS mixed FROM contribs GROUP BY 1")
def language_homogeneity(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").groupBy(F.lower("file").alias("file")).agg(F.countDistinct("lang").alias("langs")).withColumn("mixed", F.col("langs") > 1)


@query("""WITH s AS (SELECT row_id, lower(file) AS f, row_number() OVER (PARTITION BY lower(file) ORDER BY row_id) - 1 AS r FROM contribs)
SELECT row_id, f || '#' || CASE WHEN r < 1000 THEN lpad(r::varchar, 3, '0') ELSE r::varchar END AS ordinal_id FROM s""")
def ordinal_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ordinals in a file: offsets of hashed ranges of row ids first, so that a hot file is ranked by many tasks."""
    rows = table(spark, sf, "contribs").select("row_id", F.lower("file").alias("f"))
    width = 2000
    keyed = rows.withColumn("b", F.floor(F.col("row_id") / width))
    cells = keyed.groupBy("f", "b").agg(F.count("*").alias("n"))
    before = cells.withColumn("off", F.coalesce(F.sum("n").over(Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    ranked = keyed.withColumn("r", F.row_number().over(Window.partitionBy("f", "b").orderBy("row_id")) - 1).join(before, ["f", "b"])
    number = (F.col("r") + F.col("off")).cast("string")
    return ranked.select("row_id", F.concat("f", F.lit("#"), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number)).alias("ordinal_id"))


@query("""SELECT audio_id, sum(coalesce(duration_s, 0)) OVER w + 0.25 * (row_number() OVER w - 1) AS ends_at FROM utterances
WHERE paragraph_id IS NOT NULL WINDOW w AS (PARTITION BY paragraph_id ORDER BY idx, audio_id ROWS UNBOUNDED PRECEDING)""")
def cumulative_offsets(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("paragraph_id").orderBy("idx", "audio_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = table(spark, sf, "utterances").filter("paragraph_id is not null")
    return rows.select("audio_id", (F.sum(F.coalesce("duration_s", F.lit(0.0))).over(w) + 0.25 * (F.row_number().over(w) - 1)).alias("ends_at"))


@query("""WITH g AS (SELECT file, row_id, count(*) OVER (PARTITION BY file) AS n, row_number() OVER (PARTITION BY file ORDER BY md5('held|' || row_id), row_id) AS r
FROM (SELECT lower(file) AS file, row_id FROM contribs)) SELECT row_id, file FROM g WHERE r <= greatest(1, floor(0.08 * n))""")
def family_holdout_8pct(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "contribs").select(F.lower("file").alias("file"), "row_id")
    return sample.sample_per_group(rows, ["file"], "row_id", "held", 0.08).select("row_id", "file")


@query("""SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('strata|' || doc_id), doc_id) AS r FROM documents WHERE lang IS NOT NULL) WHERE r <= 50""")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sample.stratified(table(spark, sf, "documents").filter("lang is not null"), "lang", "doc_id", "strata", 50).select("doc_id", "lang")


@query("SELECT item_id FROM eval_items ORDER BY md5('eval|' || item_id), item_id LIMIT 80")
def eval_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sample.first_by_hash(table(spark, sf, "eval_items"), "item_id", "eval", 80).select("item_id")


@query("""WITH s AS (SELECT DISTINCT session_id FROM utterances WHERE session_id IS NOT NULL),
r AS (SELECT session_id, row_number() OVER (ORDER BY md5('hold|' || session_id), session_id) AS r, count(*) OVER () AS n FROM s)
SELECT session_id, r <= greatest(1, round_even(0.12 * n, 0)) AS held FROM r""")
def session_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return sample.held_groups(table(spark, sf, "utterances"), "session_id", "hold", 0.12).select("session_id", "held")


@query("""WITH f AS (SELECT DISTINCT lower(file) AS file FROM contribs WHERE lang IS NOT NULL),
r AS (SELECT file, row_number() OVER (ORDER BY md5('split|' || file), file) AS r, count(*) OVER () AS n FROM f)
SELECT c.row_id, CASE WHEN c.lang IS NULL OR coalesce(r.r <= greatest(1, round_even(0.2 * r.n, 0)), false) THEN 'eval' ELSE 'train' END AS part
FROM contribs c LEFT JOIN r ON lower(c.file) = r.file""")
def train_eval_split(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a set flag (here: no language) go to eval, the rest by held-out files."""
    rows = table(spark, sf, "contribs").select("row_id", F.lower("file").alias("file"), "lang")
    return sample.train_eval(rows, F.when(F.col("lang").isNull(), F.lit(True)), "file", "split", 0.2).select("row_id", "part")


@query("""WITH r AS (SELECT doc_id, len(text)::INT AS n, row_number() OVER (ORDER BY len(text) NULLS FIRST, substr(md5(doc_id::VARCHAR), 1, 2), doc_id) - 1 AS r FROM documents)
SELECT doc_id, n, r // 16 AS batch, ('0x' || substr(md5('batch|' || (r // 16)), 1, 8))::BIGINT AS batch_order FROM r""")
def length_batches(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.length("text").alias("n"))
    return sample.length_batches(rows, F.col("n"), "doc_id", 16, "batch").select("doc_id", "n", "batch", "batch_order")


@query("""WITH d AS (SELECT doc_id, CASE WHEN ('0x' || substr(md5('a|' || doc_id), 1, 8))::UBIGINT % 10 < 7 THEN 'OK' ELSE 'KO' END AS a,
CASE WHEN ('0x' || substr(md5('a|' || doc_id), 1, 8))::UBIGINT % 13 < 9 THEN 'OK' ELSE 'KO' END AS b FROM documents),
t AS (SELECT count(*)::DOUBLE AS n, avg((a = b)::INT) AS po, avg((a = 'OK')::INT) * avg((b = 'OK')::INT) + avg((a = 'KO')::INT) * avg((b = 'KO')::INT) AS pe FROM d)
SELECT n::BIGINT AS n, round(po, 9) AS observed, round(pe, 9) AS chance, round((po - pe) / (1 - pe), 9) AS kappa FROM t""")
def kappa(spark: SparkSession, sf: str) -> DataFrame:
    from dictaspark.functions.text import hash_draw

    d = hash_draw("a", F.col("doc_id"))
    judges = table(spark, sf, "documents").select(F.when(d % 10 < 7, "OK").otherwise("KO").alias("a"), F.when(d % 13 < 9, "OK").otherwise("KO").alias("b"))
    out = stats.kappa(judges, "a", "b")
    return out.select("n", *[F.round(c, 9).alias(c) for c in ("observed", "chance", "kappa")])


@query("""WITH e AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
g AS (SELECT *, sum(CASE WHEN p IS NOT NULL AND epoch_us(ts) - epoch_us(p) > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM e)
SELECT user_id, island, count(*) AS n, min(ts) AS starts, max(ts) AS ends FROM g GROUP BY user_id, island""")
def gap_islands(spark: SparkSession, sf: str) -> DataFrame:
    from dictaspark.operators import segment

    rows = table(spark, sf, "events").select("user_id", "ts", "event_id")
    cut = segment.gap_islands(rows, "user_id", F.col("ts"), 1800)
    return cut.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("ts").alias("starts"), F.max("ts").alias("ends"))


@query("SELECT event_type, count(*) AS n, sum(json_extract_string(props, '$.k')::BIGINT) AS k FROM events GROUP BY event_type")
def json_field(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k"))

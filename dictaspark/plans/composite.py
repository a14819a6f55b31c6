"""Composite and scalar queries that complete the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dictaspark import lexicons as L
from dictaspark.functions import text as t
from dictaspark.operators import pipeline, sample
from dictaspark.plans import sqltext as q
from dictaspark.plans.registry import query
from dictaspark.session import table

_JUDGED = """o AS (SELECT id, min({'text': text, 'lang': lang, 'words': words}) AS t FROM asr_takes WHERE id IS NOT NULL AND text IS NOT NULL GROUP BY id),
m AS (SELECT id, CASE WHEN bool_or(upper(trim(verdict)) = 'KO') THEN 'KO' WHEN bool_or(upper(trim(verdict)) = 'OK') THEN 'OK' END AS verdict FROM qc_verdicts GROUP BY id),
j AS (SELECT o.id, o.t.text AS text, o.t.lang AS lang, coalesce(m.verdict, 'sans verdict') AS verdict FROM o LEFT JOIN m USING (id))"""


@query(f"WITH {_JUDGED} SELECT verdict, count(*) AS n FROM j GROUP BY verdict")
def judged_takes(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.judged(table(spark, sf, "asr_takes"), table(spark, sf, "qc_verdicts")).groupBy("verdict").agg(F.count("*").alias("n"))


_U = "('0x' || substr(md5('units:{0}|' || id), 1, 8))::UBIGINT"
_PICK = "[{1}][({0} % {2} + 1)::INT]"
_CONTROL = ("CASE WHEN " + _U.format("default") + " / 4294967296.0 < 0.4 THEN '[Styling: semi-formal] [Structure: prose] [Context: general] [Lang: ' || lang || ']' ELSE '[Styling: ' || "
            + _PICK.format(_U.format("styling"), "'casual', 'semi-casual', 'semi-formal', 'formal'", 4) + " || '] [Structure: ' || " + _PICK.format(_U.format("structure"), "'prose', 'lists'", 2)
            + " || '] [Context: ' || " + _PICK.format(_U.format("context"), "'general', 'email'", 2) + " || '] [Lang: ' || lang || ']' END")


@query(f"""WITH {_JUDGED}, l AS (SELECT id, text, coalesce(nullif(lower(trim(lang)), ''), 'fr') AS lang FROM j WHERE verdict = 'OK')
SELECT id, text AS dirty, lang, 'asr' AS source, regexp_split_to_array(id, '[_-]')[1] AS file, {_CONTROL} AS control FROM l""")
def unit_preparation(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.prepare_units(table(spark, sf, "asr_takes"), table(spark, sf, "qc_verdicts"))


@query(f"""WITH {_JUDGED}, l AS (SELECT id, coalesce(nullif(lower(trim(lang)), ''), 'fr') AS lang, regexp_split_to_array(id, '[_-]')[1] AS file FROM j WHERE verdict = 'OK'),
h AS (SELECT id, lang, count(*) OVER p AS n, row_number() OVER (PARTITION BY file ORDER BY md5('units|' || id), id) AS r FROM l WINDOW p AS (PARTITION BY file))
SELECT id, '[Styling: semi-formal] [Structure: prose] [Context: general] [Lang: ' || lang || ']' AS control FROM h WHERE r <= greatest(1, floor(0.08 * n)) ORDER BY md5('eval|' || id), id LIMIT 80""")
def evaluation_units_held(spark: SparkSession, sf: str) -> DataFrame:
    """The held-out sample of units under the default control line, from the 8 % of each file that the family hold-out sets aside."""
    units = pipeline.prepare_units(table(spark, sf, "asr_takes"), table(spark, sf, "qc_verdicts"))
    held = sample.sample_per_group(units.select("id", "file", "lang"), ["file"], "id", "units", 0.08)
    return pipeline.evaluation_units(held, F.lit(True)).select("id", "control")


@query()
def qc_pass(spark: SparkSession, sf: str) -> DataFrame:
    """Judgement of pending takes by a stub model, and the causes it names."""
    takes = table(spark, sf, "asr_takes").filter("id is not null and text is not null").groupBy("id").agg(F.min("text").alias("text"))
    reply = lambda prompts: ['so {"verdict": "%s", "causes": [%s]}' % (("OK", "") if len(p.split()) > 20 else ("KO", '"vide"')) for p in prompts]
    return pipeline.judge(takes, table(spark, sf, "qc_verdicts"), "text", reply)


@query()
def teach(spark: SparkSession, sf: str) -> DataFrame:
    """Units cleaned by a stub model, then filtered; the stub drops fillers and sets a capital and a final mark."""
    units = pipeline.prepare_units(table(spark, sf, "asr_takes"), table(spark, sf, "qc_verdicts")).filter("lang = 'en'")

    def client(prompts: list[str]) -> list[str]:
        kept = [" ".join(w for w in p.split() if w.lower() not in ("um", "uh", "er", "hmm")) for p in prompts]
        return [k[:1].upper() + k[1:].rstrip(".") + "." for k in kept]

    return pipeline.teach(units, client, "en").select("id", "clean", "rejet")


@query()
def teach_adjudicated(spark: SparkSession, sf: str) -> DataFrame:
    """Rows kept, recovered and confirmed bad by language; the stub cleaner repeats long takes, and the stub arbiter forgives what is only longer."""
    units = pipeline.prepare_units(table(spark, sf, "asr_takes"), table(spark, sf, "qc_verdicts"))

    def cleaner(prompts: list[str]) -> list[str]:
        return [p if len(p.split()) < 30 else "" if len(p) % 5 == 0 else f"{p} {p}" for p in prompts]

    def arbiter(prompts: list[str]) -> list[str]:
        blank = [not p.split("CLEAN:")[1].strip() for p in prompts]
        return ['{"conforme": %s, "motif": "%s"}' % (("false", "suppression") if b else ("true", "aucun")) for b in blank]

    parts = []
    for lang in ("fr", "en"):
        kept, bad = pipeline.taught(units.filter(F.col("lang") == lang), cleaner, arbiter, lang)
        parts += [kept.select("lang", F.when(F.col("rejet").isNull(), "kept").otherwise("recovered").alias("status")), bad.select("lang", F.concat(F.lit("bad: "), "motif").alias("status"))]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("lang", "status").agg(F.count("*").alias("n"))


@query()
def dataset_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the merged dataset: rows kept by id and folded text in order."""
    return pipeline.merge(table(spark, sf, "contribs").select("row_id", "id", "dirty"), "row_id")[1]


@query("SELECT id, dirty, clean FROM contribs WHERE lang = 'en' AND source IS DISTINCT FROM 'example'")
def mix(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "contribs").filter("lang = 'en'")
    return pipeline.mix([rows.filter("row_id % 2 = 0"), rows.filter("row_id % 2 = 1")]).select("id", "dirty", "clean")


_NUM = r"list_sort(list_transform(regexp_extract_all(coalesce({0}, ''), '\d{{1,3}}(?:[ ,]\d{{3}})+|\d+'), lambda n: regexp_replace(n, '[ ,]', '', 'g')))"


@query(f"""WITH x AS (SELECT lower(file) AS family, {q.collapse('dirty')} IS NOT DISTINCT FROM {q.collapse('clean')} AS e, {_NUM.format('dirty')} AS g, {_NUM.format('clean')} AS w FROM contribs),
y AS (SELECT family, e, g = w AS v, len(list_filter(list_distinct(g), lambda n: len(list_filter(g, lambda m: m = n)) > len(list_filter(w, lambda m: m = n)))) > 0 AS i FROM x)
SELECT CASE WHEN grouping(family) = 1 THEN 'all' ELSE family END AS family, count(*) AS n, count(*) FILTER (e) AS exact, count(*) FILTER (v) AS "values", count(*) FILTER (i) AS invented FROM y GROUP BY ROLLUP (family)""")
def synthetic_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.score(table(spark, sf, "contribs"), "dirty", "clean", F.lower("file"))


@query(f"""WITH x AS (SELECT row_id, {_NUM.format('clean')} AS g, {_NUM.format('dirty')} AS w FROM contribs)
SELECT row_id, list_sort(list_filter(list_distinct(g), lambda n: len(list_filter(g, lambda m: m = n)) > len(list_filter(w, lambda m: m = n)))) AS new FROM x""")
def number_difference(spark: SparkSession, sf: str) -> DataFrame:
    extra = pipeline.multiset_minus(t.numbers(F.col("clean")), t.numbers(F.col("dirty")))
    return table(spark, sf, "contribs").select("row_id", F.array_sort(extra).alias("new"))


@query(f"""WITH r AS (SELECT id, CASE WHEN verdict IS NOT NULL THEN {{'v': upper(trim(verdict)), 'c': coalesce(causes, [])}} END AS x FROM qc_verdicts),
b AS (SELECT id, max(x) AS a, min(x) AS b FROM r GROUP BY id)
SELECT count(*) AS n, count(*) FILTER (a.v = b.v) AS agree, count(*) FILTER (a.v = 'KO' AND b.v = 'OK') AS missed_ko, count(*) FILTER (a.v = 'OK' AND b.v = 'KO') AS false_ko,
count(*) FILTER (a.v = 'KO' AND b.v = 'KO' AND len(list_filter(a.c, lambda x: list_contains(b.c, x) AND x IN ({q.quoted(L.SHARED_CAUSES)}))) > 0) AS cause_agree FROM b WHERE id IS NOT NULL""")
def binary_bench_causes(spark: SparkSession, sf: str) -> DataFrame:
    """Every id's largest against its smallest judgement, by verdict and then causes, and the shared causes of both."""
    judged = F.struct(F.upper(F.trim("verdict")).alias("verdict"), F.coalesce("causes", F.array().cast("array<string>")).alias("causes"))
    rows = table(spark, sf, "qc_verdicts").select("id", F.when(F.col("verdict").isNotNull(), judged).alias("x")).groupBy("id")
    side = lambda f: rows.agg(f("x").alias("x")).select("id", "x.*")
    return pipeline.binary_bench(side(F.max), side(F.min))


_EXPLICIT = ["rent", "price", "budget", "dollars", "euros", "prix"]


@query(f"""WITH s AS (SELECT doc_id, len(regexp_extract_all(lower(text), '\\b(?:{"|".join(_EXPLICIT)})\\b'))::INT AS score FROM documents)
SELECT * FROM (SELECT doc_id, score, 'explicit' AS part FROM s WHERE score >= 2 ORDER BY score DESC, doc_id LIMIT 30) UNION ALL
SELECT * FROM (SELECT doc_id, score, 'control' AS part FROM s WHERE score = 0 ORDER BY doc_id LIMIT 30)""")
def refusal_groups(spark: SparkSession, sf: str) -> DataFrame:
    a, b = pipeline.refusal_rate(table(spark, sf, "documents"), F.col("text"), _EXPLICIT, 30, "doc_id")
    return a.withColumn("part", F.lit("explicit")).unionByName(b.withColumn("part", F.lit("control")))


@query()
def heldout_export(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out rows with reserved mail domains on both sides."""
    rows = table(spark, sf, "contribs").select("row_id", F.lower("file").alias("file"), "dirty", "clean")
    held = sample.held_groups(rows, "file", "export", 0.12).filter("held")
    return rows.join(held, "file", "left_semi").select("row_id", pipeline.rewrite_domains(F.col("dirty")).alias("dirty"), pipeline.rewrite_domains(F.col("clean")).alias("clean"))


@query("SELECT row_id, CASE WHEN len(dirty) <= 200 THEN dirty ELSE left(dirty, 100) || ' […] ' || right(dirty, 100) END AS clipped FROM contribs")
def clip_middle(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", t.clip_middle(F.col("dirty"), 200).alias("clipped"))


@query(f"SELECT row_id, CASE WHEN len(x) <= 80 THEN x ELSE left(x, 79) || '…' END AS quote FROM (SELECT row_id, {q.collapse('dirty')} AS x FROM contribs)")
def short_quote(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", t.short_quote(F.col("dirty"), 80).alias("quote"))


@query("SELECT row_id, upper(left(dirty, 1)) || substr(dirty, 2) AS x FROM contribs")
def capitalise(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", t.capitalise(F.col("dirty")).alias("x"))


@query(f"SELECT row_id, regexp_replace(clean, '[.?!;:,]([{q.SPACE}]|$)', '\\1', 'g') AS x FROM contribs")
def strip_punctuation(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", t.strip_punctuation(F.col("clean")).alias("x"))


@query("SELECT id, list_sum(list_transform(string_split(id, ''), lambda c: unicode(c)))::BIGINT % 3 AS bucket FROM (SELECT DISTINCT id FROM contribs)")
def code_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("id").distinct().select("id", t.code_bucket(F.col("id")).cast("bigint").alias("bucket"))


@query("""SELECT p_partkey, replace(format('{:,}', (p_retailprice * 100)::BIGINT), ',', ' ') AS fr, format('{:,}', (p_retailprice * 100)::BIGINT) AS en FROM part""")
def thousands(spark: SparkSession, sf: str) -> DataFrame:
    n = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return table(spark, sf, "part").select("p_partkey", t.thousands(n, "fr").alias("fr"), t.thousands(n, "en").alias("en"))


@query(f"SELECT row_id, floor(1.3 * {q.word_count('dirty')})::INT + 32 AS cap FROM contribs")
def output_cap(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", t.output_cap(t.word_count(F.col("dirty"))).alias("cap"))


@query("SELECT event_id, json_extract_string(regexp_extract('reply: ' || props || ' end', '(?s)\\{.*\\}'), '$.k') AS k FROM events")
def json_salvage(spark: SparkSession, sf: str) -> DataFrame:
    reply = F.concat(F.lit("reply: "), "props", F.lit(" end"))
    return table(spark, sf, "events").select("event_id", F.get_json_object(t.json_salvage(reply), "$.k").alias("k"))


@query("""SELECT event_id, coalesce(json_extract_string(e, '$.entry.k'), json_extract_string(e, '$.k')) AS k FROM (
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"entry": ' || props || '}' ELSE props END AS e FROM events)""")
def json_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """A value in either of two envelope shapes."""
    e = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"entry": '), "props", F.lit("}"))).otherwise(F.col("props"))
    body = F.coalesce(F.get_json_object(e, "$.entry"), e)
    return table(spark, sf, "events").select("event_id", F.get_json_object(body, "$.k").alias("k"))


_MARKERS = ["no wait", "pardon", "sorry", "plutôt", "non pardon"]


@query(f"""SELECT * FROM (SELECT row_id, list_extract(list_filter(regexp_extract_all(regexp_extract(lower(dirty), '(?s)^(.*?)\\b(?:{"|".join(_MARKERS)})\\b', 1), '[^{q.SPACE}]+'),
lambda w: len(w) > 2), -1) AS value FROM contribs) WHERE value IS NOT NULL""")
def abandoned_value(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", t.abandoned_value(F.col("dirty"), _MARKERS).alias("value")).filter("value is not null")


@query(f"""WITH p AS (SELECT row_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(dirty, '([.!?…;:])[{q.SPACE}]+', '\\1' || chr(1), 'g'), ',[{q.SPACE}]*', chr(1), 'g'), chr(1)),
lambda x: {q.collapse('x')}), lambda x: x <> '') AS p FROM contribs WHERE dirty IS NOT NULL),
w AS (SELECT row_id, flatten(list_transform(p, lambda x: CASE WHEN len(string_split(x, ' ')) <= 30 THEN [x]
ELSE list_transform(range(0, (len(string_split(x, ' ')) + 19) // 20), lambda k: array_to_string(string_split(x, ' ')[k * 20 + 1:k * 20 + 20], ' ')) END)) AS c FROM p)
SELECT row_id, unnest(range(len(c)))::INT AS clause, unnest(c) AS text FROM w""")
def clause_split(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", F.posexplode(t.clauses(F.col("dirty"))).alias("clause", "text"))


@query("SELECT row_id, CASE WHEN u < 0.18 THEN 'entier' WHEN u < 0.38 THEN 'montant' WHEN u < 0.54 THEN 'date' ELSE 'autre' END AS family FROM (SELECT row_id, ('0x' || substr(md5('w|' || row_id), 1, 8))::UBIGINT / 4294967296.0 AS u FROM contribs)")
def weighted_draw(spark: SparkSession, sf: str) -> DataFrame:
    u = t.hash_draw("w", F.col("row_id")) / F.lit(float(1 << 32))
    return table(spark, sf, "contribs").select("row_id", sample.weighted_choice(u, {"entier": 18, "montant": 20, "date": 16, "autre": 46}).alias("family"))


@query("""SELECT doc_id, bucket FROM (SELECT doc_id, CASE WHEN n_chars < 600 THEN 'short' WHEN n_chars < 1200 THEN 'mid' ELSE 'long' END AS bucket FROM documents) d
JOIN (VALUES ('short', 40), ('mid', 30), ('long', 20)) v(b, quota) ON bucket = b QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY md5('q|' || doc_id), doc_id) <= quota""")
def stratified_quota(spark: SparkSession, sf: str) -> DataFrame:
    """Length buckets with a quota each."""
    bucket = F.when(F.col("n_chars") < 600, "short").when(F.col("n_chars") < 1200, "mid").otherwise("long")
    quota = F.when(F.col("bucket") == "short", 40).when(F.col("bucket") == "mid", 30).otherwise(20)
    return sample.first_of_groups(table(spark, sf, "documents").select("doc_id", bucket.alias("bucket")), ["bucket"], "doc_id", "q", lambda _: quota)


@query(f"""SELECT row_id FROM contribs WHERE {q.axis('styling', 'semi-formal')} = 'semi-formal' AND {q.axis('structure', 'prose')} = 'prose' AND {q.axis('context', 'general')} = 'general'
AND {q.word_count('dirty')} > 0 AND {q.word_count('clean')} > 0""")
def axis_selection(spark: SparkSession, sf: str) -> DataFrame:
    axis = lambda a: t.control_axis(F.col("control"), a)
    plain = (axis("styling") == "semi-formal") & (axis("structure") == "prose") & (axis("context") == "general")
    return table(spark, sf, "contribs").filter(plain & (t.word_count(F.col("dirty")) > 0) & (t.word_count(F.col("clean")) > 0)).select("row_id")


_NUMBERS = "one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty ninety hundred thousand".split()


@query(f"SELECT row_id FROM contribs WHERE lang = 'en' AND NOT list_has_any(regexp_extract_all(lower(dirty), '[a-z]+'), [{q.quoted(_NUMBERS)}]) AND NOT regexp_matches(dirty, '[0-9]')")
def number_free(spark: SparkSession, sf: str) -> DataFrame:
    tokens = F.regexp_extract_all(F.lower("dirty"), F.lit("[a-z]+"), F.lit(0))
    return table(spark, sf, "contribs").filter("lang = 'en'").filter(~F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in _NUMBERS])) & ~F.col("dirty").rlike("[0-9]")).select("row_id")


@query("""SELECT s, CASE WHEN s < 100 THEN 0.0002 * s / 100.0 ELSE 0.0002 * 0.5 * (1 + cos(pi() * (s - 100) / 900.0)) END AS rate FROM range(0, 1001, 50) r(s)""")
def cosine_schedule(spark: SparkSession, sf: str) -> DataFrame:
    """Learning rate with warm-up over 1,000 steps."""
    s = F.col("s")
    warm, rest = 0.0002 * s / 100.0, 0.0002 * 0.5 * (1 + F.cos(F.lit(3.141592653589793) * (s - 100) / 900.0))
    return spark.range(0, 1001, 50).withColumnRenamed("id", "s").select("s", F.when(s < 100, warm).otherwise(rest).alias("rate"))


@query("""SELECT row_id, unnest(range(len(v)))::INT AS place, unnest(v) AS leaf FROM (
SELECT row_id, list_filter([id, dirty, clean, control], lambda x: x IS NOT NULL) AS v FROM contribs)""")
def string_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """Every string of a nested JSON record."""
    raw = F.to_json(F.struct("id", F.struct("dirty", F.array("clean", "control").alias("more")).alias("inner")))
    return table(spark, sf, "contribs").select("row_id", F.posexplode(pipeline.string_leaves(raw)).alias("place", "leaf"))

"""Corpus preparation: funnels, triage, units, segments, deduplication, routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dictaspark.functions import pii, text as t
from dictaspark.operators import dedup, generate, routing, segment
from dictaspark.plans import sqltext as q
from dictaspark.plans.registry import query
from dictaspark.session import spread, table
from dictaspark.streaming import resume


@query(f"""WITH k AS (SELECT doc_id, lang, {q.word_count('text')} AS n, min(doc_id) OVER (PARTITION BY {q.dedup_key('text')}) AS first_id FROM documents),
v AS (SELECT doc_id, max(toxic) AS toxic FROM review_labels WHERE toxic IS NOT NULL GROUP BY doc_id),
r AS (SELECT coalesce(lang, '?') AS lang, CASE WHEN k.doc_id <> first_id THEN 'repeated' WHEN v.toxic IS NULL THEN 'no verdict' WHEN v.toxic > 0 THEN 'KO' WHEN n < 8 THEN 'too short' ELSE 'ok' END AS reason FROM k LEFT JOIN v USING (doc_id))
SELECT reason, lang, count(*) AS n, count(*) * 1.0 / sum(count(*)) OVER () AS share FROM r GROUP BY reason, lang""")
def unit_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by first reason of rejection and language, with shares."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", t.word_count(F.col("text")).alias("n"), F.md5(t.dedup_key(F.col("text"))).alias("key"))
    heads = docs.groupBy("key").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.lit(True).alias("head"))
    verdicts = table(spark, sf, "review_labels").filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    joined = docs.join(heads, "doc_id", "left").join(verdicts, "doc_id", "left")
    reason = (F.when(F.col("head").isNull(), "repeated").when(F.col("toxic").isNull(), "no verdict").when(F.col("toxic") > 0, "KO")
              .when(F.col("n") < 8, "too short").otherwise("ok"))
    counts = joined.groupBy(reason.alias("reason"), F.coalesce("lang", F.lit("?")).alias("lang")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), F.lit(True)).select("reason", "lang", "n", (F.col("n") / F.col("total")).alias("share"))


@query(f"""SELECT row_id, {q.word_count('dirty')} AS dirty_words, {q.word_count('clean')} AS clean_words FROM contribs""")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", t.word_count(F.col("dirty")).alias("dirty_words"), t.word_count(F.col("clean")).alias("clean_words"))


@query(f"SELECT row_id, {q.dedup_key('dirty')} AS key FROM contribs")
def dedup_key_collapse(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "contribs").select("row_id", t.dedup_key(F.col("dirty")).alias("key"))


@query(f"SELECT min(row_id) AS row_id, count(*) AS copies FROM contribs GROUP BY {q.dedup_key('dirty')}, control")
def keep_first_dirty(spark: SparkSession, sf: str) -> DataFrame:
    keyed = table(spark, sf, "contribs").select("row_id", F.md5(t.dedup_key(F.col("dirty"))).alias("key"), "control")
    return keyed.groupBy("key", "control").agg(F.min("row_id").alias("row_id"), F.count("*").alias("copies")).select("row_id", "copies")


@query(f"SELECT copies, count(*) AS groups FROM (SELECT count(*) AS copies FROM documents GROUP BY {q.dedup_key('text')}) GROUP BY copies")
def dup_groups(spark: SparkSession, sf: str) -> DataFrame:
    keyed = table(spark, sf, "documents").groupBy(F.md5(t.dedup_key(F.col("text"))).alias("key")).agg(F.count("*").alias("copies"))
    return keyed.groupBy("copies").agg(F.count("*").alias("groups"))


@query(f"""WITH a AS (SELECT *, {q.word_count('text')} AS n FROM asr_takes)
SELECT coalesce(lang, '?') AS lang, CASE WHEN error IS NOT NULL THEN 'error' WHEN text IS NULL OR n = 0 THEN 'blank' WHEN n < 8 THEN 'short'
WHEN audio_seconds IS NULL THEN 'no length' WHEN n / greatest(audio_seconds, 1) NOT BETWEEN 0.45 AND 6 THEN 'out of band' ELSE 'ok' END AS reason, count(*) AS n FROM a GROUP BY 1, 2""")
def rejection_reasons(spark: SparkSession, sf: str) -> DataFrame:
    n = t.word_count(F.col("text"))
    rate = n / F.greatest("audio_seconds", F.lit(1.0))
    reason = (F.when(F.col("error").isNotNull(), "error").when(F.col("text").isNull() | (n == 0), "blank").when(n < 8, "short")
              .when(F.col("audio_seconds").isNull(), "no length").when(~rate.between(0.45, 6), "out of band").otherwise("ok"))
    return table(spark, sf, "asr_takes").groupBy(F.coalesce("lang", F.lit("?")).alias("lang"), reason.alias("reason")).agg(F.count("*").alias("n"))


_GRAMS = "list_transform(range(1, greatest(len(w) - 4, 1)), lambda k: array_to_string(w[k:k+5], ' '))"


@query(f"""WITH a AS (SELECT DISTINCT id, error, text, words, regexp_extract_all(coalesce(text, ''), '[^{q.SPACE}]+') AS w FROM asr_takes WHERE id IS NOT NULL),
g AS (SELECT id, error, text, words, w, CASE WHEN len(w) < 12 THEN 1 ELSE list_max(map_values(list_histogram({_GRAMS}))) END AS rep FROM a)
SELECT id, CASE WHEN words IS NULL OR words < 8 THEN 'reject' WHEN error IS NOT NULL THEN 'error' WHEN len(w) = 0 THEN 'empty' WHEN rep > 3 THEN 'repeats'
WHEN len(w) / words < 0.45 OR len(w) / words > 2.0 THEN 'ratio' WHEN len(w) / words BETWEEN 0.75 AND 1.30 THEN 'clear' ELSE 'doubt' END AS band, rep::INT AS repeats FROM g""")
def triage_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Takes by word ratio and by the most repeated run of six words."""
    takes = table(spark, sf, "asr_takes").select("id", "error", "text", "words").filter("id is not null").distinct()
    w = t.words(F.col("text"))
    rep = t.max_ngram_repeat(w)
    ratio = F.size(w) / F.col("words")
    band = (F.when(F.col("words").isNull() | (F.col("words") < 8), "reject").when(F.col("error").isNotNull(), "error").when(F.size(w) == 0, "empty")
            .when(rep > 3, "repeats").when((ratio < 0.45) | (ratio > 2.0), "ratio").when(ratio.between(0.75, 1.30), "clear").otherwise("doubt"))
    return takes.select("id", band.alias("band"), rep.alias("repeats"))


@query(f"""WITH d AS (SELECT doc_id, regexp_extract_all(text, '[^{q.SPACE}]+') AS w FROM documents)
SELECT doc_id, CASE WHEN len(w) < 12 THEN 1 ELSE list_max(map_values(list_histogram({_GRAMS}))) END::INT AS repeats FROM d""")
def ngram_max_repeat(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", t.max_ngram_repeat(t.words(F.col("text"))).alias("repeats"))


_FR = "le la les des du et est que qui dans pas pour sur avec une un".split()
_EN = "the of to and in is that it for was on are with as at be".split()


@query(f"""WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS x FROM documents), w AS (SELECT doc_id, x, regexp_extract_all(x, '[a-zà-ÿ]+') AS w FROM d),
c AS (SELECT doc_id, len(regexp_replace(x, '[^àâäçéèêëîïôöùûü]', '', 'g')) AS a, greatest(len(w), 1) AS n, len(list_filter(w, lambda v: v IN ({q.quoted(_FR)}))) AS f,
len(list_filter(w, lambda v: v IN ({q.quoted(_EN)}))) AS e FROM w)
SELECT doc_id, CASE WHEN a > 0.02 * n OR f > e THEN 'fr' WHEN e > f THEN 'en' ELSE 'amb' END AS vote FROM c""")
def lang_vote(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", t.language_vote(F.col("text"), _FR, _EN).alias("vote"))


@query("""WITH s AS (SELECT session_id, audio_id, idx, coalesce(words, 0) AS w FROM utterances WHERE session_id IS NOT NULL AND paragraph_id IS NOT NULL),
l AS (SELECT session_id, audio_id, idx, w, lead(idx) OVER p AS i2, lead(idx, 2) OVER p AS i3, lead(w) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM s WINDOW p AS (PARTITION BY session_id ORDER BY idx, audio_id))
SELECT session_id, audio_id, 2 AS size, (w + w2)::BIGINT AS total_words FROM l WHERE i2 = idx + 1 AND w + w2 <= 260 UNION ALL
SELECT session_id, audio_id, 3 AS size, (w + w2 + w3)::BIGINT AS total_words FROM l WHERE i2 = idx + 1 AND i3 = idx + 2 AND w + w2 + w3 <= 260""")
def windows_by_idx(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of 2 and 3 utterances whose idx follow one another, of at most 260 words."""
    rows = table(spark, sf, "utterances").filter("session_id is not null and paragraph_id is not null").select("session_id", "audio_id", "idx", F.coalesce("words", F.lit(0)).alias("w"))
    two, three = (segment.consecutive_windows(rows, "session_id", "idx", "w", n, 260, "audio_id").withColumn("size", F.lit(n)) for n in (2, 3))
    return two.unionByName(three).select("session_id", "audio_id", "size", F.col("total_words").cast("bigint").alias("total_words"))


@query()
def greedy_segments(spark: SparkSession, sf: str) -> DataFrame:
    return segment.utterance_bins(table(spark, sf, "utterances").filter("paragraph_id is not null"))


@query()
def sized_islands(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "utterances").filter("session_id is not null and paragraph_id is not null")
    seg = F.struct(F.col("idx").cast("double").alias("start"), (F.col("idx") + F.coalesce("duration_s", F.lit(0.0))).alias("end"), F.coalesce("raw_text", F.lit("")).alias("transcript"), F.coalesce("words", F.lit(0)).alias("n_words"))
    tracks = rows.groupBy("session_id", "paragraph_id").agg(F.collect_list(seg).alias("segments"))
    return tracks.select("session_id", "paragraph_id", F.posexplode(segment.sized_islands(F.col("segments"))).alias("unit", "u")).select("session_id", "paragraph_id", "unit", "u.words", "u.text")


@query()
def pack_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.posexplode(segment.pack_sentences(F.col("text"))).alias("piece", "text"))


@query()
def two_key_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "contribs").select("row_id", "id", "dirty")
    return dedup.keep_first_two_keys(rows, F.col("id"), F.md5(t.casefold_key(F.col("dirty"))), "row_id").select("row_id")


_WORK = ["pairs_itn6.jsonl", "pairs_forme.jsonl", "pairs_forme.v2.jsonl", "pairs_mix5.jsonl", "pairs_x.jsonl.progress", "pairs_x.jsonl.adjudged", "run.log", "units_a.jsonl", "cohere_units_a.txt",
         "a_unit_ref.jsonl", "a_manifest.jsonl", "b_eval_sessions.json", "eval_set_c.txt", "go.sh", "go.cmd", "go.ps1", "tool.py", "judge.json", "notes.txt", "model.bin", "pairs_mix7.jsonl"]


@query(f"""WITH w AS (SELECT lang, [{", ".join(f"'{w}'" for w in _WORK)}][row_id % {len(_WORK)} + 1] AS f, file FROM contribs WHERE lang IS NOT NULL),
n AS (SELECT lang, f FROM w UNION ALL SELECT lang, lower(file) || '.jsonl' FROM w)
SELECT CASE WHEN f = 'pairs_mix7.jsonl' AND lang = 'fr' THEN 'mix/pairs_mix.jsonl' WHEN f = 'pairs_mix7.jsonl' THEN 'mix/pairs_mix_' || lang || '.jsonl'
WHEN f LIKE '%.jsonl.progress' OR f LIKE '%.jsonl.adjudged' THEN lang || '/teacher/' || f
WHEN starts_with(f, 'pairs_') AND suffix(f, '.jsonl') THEN lang || CASE WHEN starts_with(f, 'pairs_mix') OR regexp_matches(f, '[.]v[0-9]+[.]jsonl$') OR regexp_full_match(f, 'pairs_[a-z_]+[0-9]+[.]jsonl') THEN '/history/' ELSE '/pairs/' END || f
WHEN suffix(f, '.log') THEN lang || '/logs/' || f
WHEN regexp_matches(f, '^(cohere_|qc_)?units_') OR starts_with(f, 'eval_set_') OR regexp_matches(f, '_(unit_ref|unit_jobs|manifest)[.]jsonl$') OR regexp_matches(f, '_eval_(sessions|meetings)[.]json$') THEN lang || '/corpus/' || f
WHEN suffix(f, '.sh') OR suffix(f, '.cmd') OR suffix(f, '.ps1') OR suffix(f, '.py') THEN lang || '/scripts/' || f
WHEN suffix(f, '.jsonl') OR suffix(f, '.json') OR suffix(f, '.txt') THEN lang || '/bench/' || f END AS destination, count(*) AS n FROM n GROUP BY 1""")
def archive_routing(spark: SparkSession, sf: str) -> DataFrame:
    """Work files of every kind, and the contributed files, by destination; what is not archived has none."""
    rows = table(spark, sf, "contribs").filter("lang is not null")
    work = F.element_at(F.array(*[F.lit(w) for w in _WORK]), (F.col("row_id") % len(_WORK) + 1).cast("int"))
    names = rows.select("lang", F.explode(F.array(work, F.concat(F.lower("file"), F.lit(".jsonl")))).alias("file"))
    return names.groupBy(routing.destination(F.col("file"), F.col("lang"), F.lit("pairs_mix7.jsonl")).alias("destination")).agg(F.count("*").alias("n"))


@query(r"""WITH x AS (SELECT row_id, unnest(regexp_extract_all(dirty, '(?i)\b[\w.+-]+@(?:[\w-]+\.)+[a-z]{2,}\b')) AS m FROM contribs)
SELECT row_id, m AS excerpt FROM x WHERE lower(split_part(m, '@', -1)) NOT IN ('example.com', 'example.org', 'example.net')""")
def pii_email(spark: SparkSession, sf: str) -> DataFrame:
    return pii.scan(table(spark, sf, "contribs"), ["row_id"], ["dirty"], categories=("email",)).select("row_id", "excerpt")


@query(r"""SELECT doc_id, unnest(regexp_extract_all(text, '\b(?:\d{4,5}|[A-Z]{1,2}\d[A-Z\d]?\s?\d[A-Z]{2})\s+[A-ZÉ][a-zé-]{2,}\b')) AS excerpt FROM documents""")
def pii_postal_city(spark: SparkSession, sf: str) -> DataFrame:
    return pii.scan(table(spark, sf, "documents"), ["doc_id"], ["text"], categories=("code_postal_ville",)).select("doc_id", "excerpt")


@query()
def pii_by_family(spark: SparkSession, sf: str) -> DataFrame:
    return routing.findings_report(spread(table(spark, sf, "contribs").select("row_id", "file", "dirty", "clean")), "row_id", F.col("file"), ["dirty", "clean"])


@query()
def pii_phone(spark: SparkSession, sf: str) -> DataFrame:
    return pii.scan(table(spark, sf, "contribs"), ["row_id"], ["dirty", "clean"], categories=("telephone",))


@query()
def generator_itn(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "itn", "en", 5000)


@query()
def generator_itn_fr(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "itn", "fr", 5000)


@query()
def generator_correction(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "correction", "fr", 5000)


@query()
def generator_correction_en(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "correction", "en", 5000)


@query()
def generator_forme(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "forme", "fr", 5000)


@query()
def generator_forme_en(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "forme", "en", 5000)


@query()
def generator_compo(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "compo", "en", 5000)


@query()
def generator_compo_fr(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "compo", "fr", 5000)


@query()
def generator_coritn(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "coritn", "fr", 5000)


@query()
def generator_coritn_en(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "coritn", "en", 5000)


@query()
def generator_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return generate.pairs(spark, "paragraphes", "en", 5000)


@query()
def teach_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Takes that a first run left without a valid verdict, answered by a stub model."""
    from dictaspark.sources.readers import model_replies

    takes = table(spark, sf, "asr_takes").filter("id is not null and text is not null").groupBy("id").agg(F.min("text").alias("text"))
    todo = resume.pending(takes, table(spark, sf, "qc_verdicts"), ["id"], F.upper(F.trim("verdict")).isin("OK", "KO"))
    return model_replies(todo, "id", "text", lambda prompts: ["OK" if len(p.split()) >= 8 else "KO" for p in prompts])

"""Composite steps: unit preparation, judging, adjudication, mixing, merging, scoring, export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dictaspark import lexicons as L
from dictaspark.functions import text as t
from dictaspark.operators import dedup, pairs, sample
from dictaspark.session import checkpoint
from dictaspark.sources.readers import model_replies
from dictaspark.streaming.resume import pending


def verdict(column: Column) -> Column:
    return F.upper(F.trim(column))


def judged(takes: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row a take id with its strongest verdict: any KO wins, then OK, then none."""
    one = takes.filter("id is not null and text is not null").groupBy("id").agg(F.min(F.struct("text", "lang", "words")).alias("t")).select("id", "t.*")
    v = verdict(F.col("verdict"))
    marks = verdicts.groupBy("id").agg(F.when(F.bool_or(v == "KO"), "KO").when(F.bool_or(v == "OK"), "OK").alias("verdict"))
    return one.join(marks, "id", "left").withColumn("verdict", F.coalesce("verdict", F.lit("sans verdict")))


def control_draw(seed: str, key: Column, lang: Column, default_share: float = 0.4) -> Column:
    """The default control line for a share of rows, else a uniform draw of the other axes."""
    u = lambda name: t.hash_draw(f"{seed}:{name}", key)
    pick = lambda options, name: F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(u(name), F.lit(len(options))) + 1).cast("int"))
    drawn = t.control_line(pick(L.STYLINGS, "styling"), pick(L.STRUCTURES, "structure"), pick(L.CONTEXTS, "context"), lang)
    plain = t.control_line(F.lit("semi-formal"), F.lit("prose"), F.lit("general"), lang)
    return F.when(u("default") / F.lit(float(1 << 32)) < default_share, plain).otherwise(drawn)


def prepare_units(takes: DataFrame, verdicts: DataFrame, seed: str = "units") -> DataFrame:
    """Units of takes judged OK; the file is the first part of the id."""
    ok = judged(takes, verdicts).filter("verdict = 'OK'")
    lang = F.coalesce(F.nullif(F.lower(F.trim("lang")), F.lit("")), F.lit("fr"))
    return ok.select("id", F.col("text").alias("dirty"), lang.alias("lang"), F.lit("asr").alias("source"), F.element_at(F.split("id", "[_-]"), 1).alias("file"),
                     control_draw(seed, F.col("id"), lang).alias("control"))


def evaluation_units(units: DataFrame, held: Column, n: int = 80, seed: str = "eval") -> DataFrame:
    """n held-out units under the default control line."""
    chosen = sample.first_by_hash(units.filter(held), "id", seed, n)
    return chosen.withColumn("control", t.control_line(F.lit("semi-formal"), F.lit("prose"), F.lit("general"), F.col("lang")))


def judge(rows: DataFrame, done: DataFrame, prompt: str, client: Callable) -> DataFrame:
    """Verdicts for what has none yet, parsed from the replies; a failure stays pending for the next run."""
    todo = pending(rows, done, ["id"], verdict(F.col("verdict")).isin("OK", "KO"))
    replies = model_replies(todo, "id", prompt, client)
    parsed = F.from_json(t.json_salvage(F.col("reply")), "verdict string, causes array<string>, preuve string, explication string")
    out = replies.withColumn("r", parsed)
    return out.select("id", verdict(F.col("r.verdict")).alias("verdict"), F.coalesce("r.causes", F.array().cast("array<string>")).alias("causes"), "r.preuve", "r.explication", "error")


def teach(units: DataFrame, client: Callable, lang: str) -> DataFrame:
    """Clean texts by a model, then the pair filter; ``rejet`` is null for kept rows."""
    cleaned = units.join(model_replies(units, "id", "dirty", client).select("id", F.col("reply").alias("clean")), "id")
    reason = pairs.filter_pair(F.col("dirty"), F.coalesce("clean", F.lit("")), t.control_axis(F.col("control"), "structure"), t.control_axis(F.col("control"), "context"), lang)
    return cleaned.withColumn("rejet", reason)


def adjudicate(rejected: DataFrame, client: Callable) -> DataFrame:
    """``(id, conforme, motif)`` of rejected rows by an arbiter; an answer that fails or does not parse upholds the rejection.

    A motive outside the closed vocabulary counts as ``erreur``.
    """
    prompt = F.format_string("RAW:\n%s\n\nCLEAN:\n%s", F.coalesce("dirty", F.lit("")), F.coalesce("clean", F.lit("")))
    replies = model_replies(rejected.select("id", prompt.alias("prompt")), "id", "prompt", client)
    parsed = replies.withColumn("r", F.from_json(t.json_salvage(F.col("reply")), "conforme boolean, motif string"))
    motive = F.lower(F.trim("r.motif"))
    return parsed.select("id", F.coalesce("r.conforme", F.lit(False)).alias("conforme"), F.when(motive.isin(L.CLOSED["motive"]), motive).otherwise("erreur").alias("motif"))


def taught(units: DataFrame, client: Callable, arbiter: Callable, lang: str) -> tuple[DataFrame, DataFrame]:
    """Kept and recovered rows, and those whose rejection the arbiter upheld with its motive; the phases follow one another, each written before the next."""
    progress = checkpoint(teach(units, client, lang))
    verdicts = checkpoint(adjudicate(progress.filter("rejet is not null"), arbiter))
    confirmed = progress.filter("rejet is not null").join(verdicts.filter("not conforme").select("id", "motif"), "id")
    return recovered(progress, verdicts), confirmed


def recovered(progress: DataFrame, adjudications: DataFrame) -> DataFrame:
    """Kept rows and rejected ones an arbiter found conforming."""
    upheld = adjudications.filter("conforme").select("id")
    return progress.filter("rejet is null").unionByName(progress.filter("rejet is not null").join(upheld, "id", "left_semi"))


def mix(files: list[DataFrame], seed: str = "mix") -> DataFrame:
    """Union of files without templates, one language only, in hashed order."""
    rows = files[0]
    for f in files[1:]:
        rows = rows.unionByName(f, allowMissingColumns=True)
    rows = rows.filter(~F.col("source").eqNullSafe("example"))
    langs = [r["lang"] for r in rows.select("lang").distinct().limit(3).collect()]
    if len(langs) > 1:
        raise ValueError(f"several languages: {sorted(map(str, langs))}")
    return rows.withColumn("order", sample.draw(seed, F.col("id"))).sort("order", "id").drop("order")


def merge(rows: DataFrame, seq: str) -> tuple[DataFrame, DataFrame]:
    """Rows kept by id and folded text in order, and one row of counts: input, kept, skipped by id and by text.

    A row counts as skipped by id when a kept row of the same id stands before it, else by text.
    """
    key = F.md5(t.casefold_key(F.col("dirty")))
    kept = dedup.keep_first_two_keys(rows, F.col("id"), key, seq)
    owners = kept.groupBy("id").agg(F.min(seq).alias("owner"))
    skipped = rows.join(kept.select(seq), seq, "left_anti").join(owners, "id", "left")
    counts = skipped.agg(F.count("*").alias("skipped"), F.count_if(F.col("owner") < F.col(seq)).alias("by_id"))
    totals = rows.agg(F.count("*").alias("input_rows")).join(F.broadcast(kept.agg(F.count("*").alias("rows"))), F.lit(True)).join(F.broadcast(counts), F.lit(True))
    return kept, totals.select("input_rows", "rows", F.col("by_id").alias("duplicate_ids_skipped"), (F.col("skipped") - F.col("by_id")).alias("duplicate_dirty_skipped"))


def score(rows: DataFrame, got: str, want: str, family: Column) -> DataFrame:
    """Exact outputs, equal value multisets and rows with invented values, over all and by family."""
    g, w = t.numbers(F.col(got)), t.numbers(F.col(want))
    marked = rows.select(family.alias("family"), t.collapse(F.col(got)).eqNullSafe(t.collapse(F.col(want))).alias("exact"), (g == w).alias("values"), (F.size(multiset_minus(g, w)) > 0).alias("invented"))
    out = marked.rollup("family").agg(F.count("*").alias("n"), *[F.count_if(F.col(c)).alias(c) for c in ("exact", "values", "invented")], F.grouping("family").alias("g"))
    return out.select(F.when(F.col("g") == 1, "all").otherwise(F.coalesce("family", F.lit("?"))).alias("family"), "n", "exact", "values", "invented")


def multiset_minus(a: Column, b: Column) -> Column:
    """Distinct values that ``a`` holds more often than ``b``."""
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return F.filter(F.array_distinct(a), lambda x: count(a, x) > count(b, x))


def binary_bench(gold: DataFrame, judge_: DataFrame) -> DataFrame:
    """Agreement of two sets of OK/KO verdicts on shared ids: missed and false KO, cause overlap among joint KO."""
    both = gold.select("id", verdict(F.col("verdict")).alias("a"), F.col("causes").alias("ca")).join(judge_.select("id", verdict(F.col("verdict")).alias("b"), F.col("causes").alias("cb")), "id")
    shared = lambda c: F.filter(c, lambda x: x.isin(L.SHARED_CAUSES))
    joint = (F.col("a") == "KO") & (F.col("b") == "KO")
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("a") == F.col("b")).alias("agree"), F.count_if((F.col("a") == "KO") & (F.col("b") == "OK")).alias("missed_ko"),
                    F.count_if((F.col("a") == "OK") & (F.col("b") == "KO")).alias("false_ko"), F.count_if(joint & F.arrays_overlap(shared("ca"), shared("cb"))).alias("cause_agree"))


def refusal_rate(rows: DataFrame, text: Column, explicit: list[str], n: int, key: str) -> tuple[DataFrame, DataFrame]:
    """An explicit group (two or more marked words, most first) and a neutral control group (none), n of each, keys and scores only."""
    hits = F.size(F.regexp_extract_all(F.lower(text), F.lit(rf"\b(?:{'|'.join(explicit)})\b"), F.lit(0)))
    scored = rows.select(key, hits.alias("score"))
    return scored.filter("score >= 2").orderBy(F.desc("score"), key).limit(n), scored.filter("score = 0").orderBy(key).limit(n)


def rewrite_domains(text: Column, domains: tuple[str, ...] = ("example.com", "example.org", "example.net")) -> Column:
    """Mail domains replaced by reserved ones; which one depends on the local part's code points."""
    pattern = r"(?i)\b([\w.+-]+)@(?:[\w-]+\.)+[a-z]{2,}\b"
    mails = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0)))

    def swap(acc: Column, mail: Column) -> Column:
        local = F.substring_index(mail, "@", 1)
        name = F.element_at(F.array(*[F.lit(d) for d in domains]), t.code_bucket(local, len(domains)) + 1)
        return F.replace(acc, mail, F.concat(local, F.lit("@"), name))

    return F.aggregate(mails, text, swap)


def string_leaves(raw: Column) -> Column:
    """Every string value of a JSON text, however deep: quoted strings that are no key. Possessive, so strings of any length take no stack."""
    quoted = F.regexp_extract_all(raw, F.lit(r'"(?:[^"\\]++|\\.)*+"(?:\s*+:)?+'), F.lit(0))
    return F.transform(F.filter(quoted, lambda q: q.endswith('"')), lambda q: F.get_json_object(F.concat(F.lit('{"v":'), q, F.lit("}")), "$.v"))

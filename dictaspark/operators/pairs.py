"""Pair filter, negation balance, structural validation and the contribution gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dictaspark import lexicons as L
from dictaspark.functions import pii, text as t
from dictaspark.operators.skew import join_hot_split
from dictaspark.session import checkpoint


def markers(text: Column, lang: str) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(L.NEGATION[lang]), F.lit(0)), F.lower)


def negation(text: Column, lang: str) -> tuple[Column, Column]:
    """(full markers, particles)."""
    found = markers(text, lang)
    particles = F.size(F.filter(found, lambda m: m.isin(L.PARTICLES[lang]))) if L.PARTICLES[lang] else F.lit(0)
    return F.size(found) - particles, particles


def negation_delta(dirty: Column, clean: Column, lang: str) -> Column:
    """``changed`` when full markers differ, ``particle`` when more particles appear than could be restored, else null."""
    d_full, d_part = negation(dirty, lang)
    c_full, c_part = negation(clean, lang)
    return F.when(c_full != d_full, "changed").when(c_part > d_part + d_full, "particle")


def supported(word: Column, source: Column) -> Column:
    """Equal, or the same first four characters with a source word of at least four. Row-local, so no join."""
    head = F.substring(word, 1, 4)
    return F.array_contains(source, word) | F.exists(source, lambda w: (F.length(w) >= 4) & w.startswith(head))


def filter_pair(dirty: Column, clean: Column, structure: Column, context: Column, lang: str) -> Column:
    """First reason to reject, or null: empty, polarity, invented, longer, cut."""
    stop = L.STOP[lang]
    digits = L.DIGITS_FR if lang == "fr" else {}
    source, target = t.filter_words(dirty, stop, digits), t.filter_words(clean, stop, digits)
    invented = t.let(source, lambda known: F.exists(target, lambda w: ~supported(w, known)))
    d, c = t.word_count(dirty), t.word_count(clean)
    ceiling = F.when((structure == "prose") & (context == "general"), 1.15).otherwise(1.35)
    blank = t.word_count(clean) == 0
    return (F.when(blank & (d == 0), F.lit(None)).when(blank, "empty")
            .when(negation_delta(dirty, clean, lang).isNotNull(), "polarity")
            .when(invented, "invented").when(c > d * ceiling + 12, "longer").when((c < d * 0.45) & (d > 25), "cut"))


def by_language(column, langs: Column) -> Column:
    """``column(lang)`` for French rows and for all others, English."""
    return F.when(langs == "fr", column("fr")).otherwise(column("en"))


def family(file: Column) -> Column:
    """What follows the first dash of the file name; the whole name without one."""
    return F.when(F.instr(file, "-") > 0, F.substring(file, F.instr(file, "-") + 1, F.lit(1 << 30))).otherwise(file)


def validate(rows: DataFrame, lang: str, keeping: list[str] | None = None) -> DataFrame:
    """Structural flags of every pair: invention, rewriting, lower-case start, missing final mark, losses, digits, identical sides.

    ``keeping`` names the families that must keep everything; the usual ones when none are given.
    """
    d, c, fam = F.col("dirty"), F.coalesce(F.col("clean"), F.lit("")), family(F.col("file"))
    tools, noise = L.TOOLS[lang], F.array(*[F.lit(w) for w in L.HESITATIONS[lang] + L.NUMBER_WORDS[lang]])
    source, target = F.array_distinct(t.content_words(d, tools)), F.array_distinct(t.content_words(c, tools))
    stems = lambda words: F.transform(words, lambda w: t.stem(w, L.SUFFIXES[lang]))
    near = lambda w, known: F.array_contains(known["stems"], t.stem(w, L.SUFFIXES[lang]))
    plain = F.create_map(*[F.lit(x) for kv in L.SYNONYMS[lang].items() for x in kv])
    expected = F.create_map(*[x for name, ws in L.EXPECTED[lang].items() for x in (F.lit(name), F.array(*[F.lit(w) for w in ws]))])
    may = F.coalesce(F.try_element_at(expected, fam), F.array().cast("array<string>"))
    standard = F.array_compact(F.transform(source, lambda w: F.try_element_at(plain, w)))
    fresh = F.array_except(F.array_except(F.array_except(target, source), noise), may)
    invented = t.let(F.struct(stems(source).alias("stems"), standard.alias("standard")), lambda known: F.filter(
        fresh, lambda w: ~near(w, known) & ~F.array_contains(known["standard"], w)))
    gone = t.let(F.struct(stems(target).alias("stems"), target.alias("words")), lambda known: F.filter(
        F.array_except(F.array_except(source, target), noise),
        lambda w: ~near(w, known) & ~F.coalesce(F.array_contains(known["words"], F.try_element_at(plain, w)), F.lit(False))))
    made, keeps = F.coalesce(F.col("source").isin(L.SYNTHETIC), F.lit(False)), fam.isin(L.KEEPING if keeping is None else keeping)
    bare = lambda x: F.regexp_replace(t.deaccent(F.lower(x)), r"^[ .]+|[ .]+$", "")
    spoken = F.arrays_overlap(source, F.array(*[F.lit(w) for w in L.NUMBER_WORDS[lang]]))
    return rows.select(
        "*", fam.alias("family"), invented.alias("invented_words"),
        (made & (F.size(invented) > 0)).alias("invention"), (~made & (F.size(invented) > 0)).alias("rewriting"),
        (made & F.substring(c, 1, 1).rlike(r"^\p{Ll}")).alias("lower_start"),
        (made & ~fam.isin(L.LAID_OUT) & (c != "") & ~F.right(c, F.lit(1)).isin(*".!?…")).alias("no_final_mark"),
        (keeps & (F.size(gone) > 0)).alias("keeping_lost"),
        (keeps & ~spoken & (t.digit_runs(d) != t.digit_runs(c))).alias("keeping_digits"),
        (made & ~keeps & (bare(d) == bare(c))).alias("identical"))


FILE_NAME = r"^[a-z0-9]+(?:-[a-z0-9]+)*-\d{4}-\d{2}\.jsonl$"
FILE_PATH = r"^contrib/(fr|en)/[^/]+$"

# Structural flags that refuse a file; rewriting only informs. JSON values that count as absent.
STRUCTURAL = ["invention", "keeping_lost", "keeping_digits", "identical", "lower_start", "no_final_mark"]
ABSENT = ["null", "false", "0", "0.0", '""', "[]", "{}"]


def _parsed(lines: DataFrame) -> DataFrame:
    """The keys of every line beside its path, with the language folder and the name the path gives."""
    schema = "id string, file string, lang string, control string, dirty string, clean string, source string, held_out variant"
    parsed = lines.withColumn("r", F.from_json("raw", schema)).withColumn("present", F.json_object_keys("raw"))
    name = F.element_at(F.split("path", "/"), -1)
    return parsed.select("*", "r.*", F.nullif(F.regexp_extract("path", FILE_PATH, 1), F.lit("")).alias("folder"), name.alias("name")).drop("r")


def gate(lines: DataFrame, banned: list[str] | None = None) -> DataFrame:
    """Refusals and warnings of contributed lines ``(path, line, raw)``, one row per reason.

    A line that does not parse, lacks keys, has an empty side, is too long or short, is held
    out, repeats an id or text, has a control line out of form, a language or file other
    than its path's, or blocking personal data is refused; a short text, and numbers or
    streets that may be personal, are warned of. Every repeated key after its first line
    counts, whatever became of the first. Files without a refusal are then validated, and
    every structural flag of a line is a refusal.
    """
    keys = F.array(*[F.lit(k) for k in ("id", "file", "lang", "control", "dirty", "clean", "source")])
    parsed = _parsed(lines).withColumn("broken", F.col("present").isNull())
    parsed = parsed.withColumn("complete", ~F.col("broken") & (F.size(F.array_except(keys, F.coalesce("present", F.array().cast("array<string>")))) == 0))
    seq = F.struct("path", "line")
    first = lambda key: F.min(seq).over(Window.partitionBy(key))
    text_key = t.dedup_key(F.col("dirty"))
    n = t.word_count(F.col("dirty"))
    checked = parsed.withColumn("text_key", text_key).withColumn("id_first", first(F.col("id"))).withColumn("text_first", first(F.col("text_key")))
    hits = F.array_distinct(F.transform(F.concat(pii.findings(F.col("dirty"), banned), pii.findings(F.col("clean"), banned)), lambda h: h["category"]))
    placed = F.col("complete") & F.col("folder").isNotNull()
    said = F.regexp_extract("control", t.CONTROL, 4)
    refuse = lambda when, reason: F.when(when, F.struct(F.lit("refusal").alias("severity"), F.lit(reason).alias("reason")))
    reasons = F.array_compact(F.concat(F.array(
        refuse(F.col("folder").isNull(), "path"),
        refuse(~F.col("name").rlike(FILE_NAME), "file_name"),
        refuse(F.col("broken"), "not_json"),
        refuse(~F.col("broken") & ~F.col("complete"), "missing_keys"),
        refuse(F.col("complete") & ~F.coalesce(F.to_json("held_out"), F.lit("null")).isin(ABSENT), "held_out"),
        refuse(placed & ~F.col("lang").eqNullSafe(F.col("folder")), "lang"),
        refuse(F.col("complete") & ~F.concat("file", F.lit(".jsonl")).eqNullSafe(F.col("name")), "file"),
        refuse(F.col("complete") & ((n == 0) | (t.word_count(F.col("clean")) == 0)), "empty_side"),
        refuse(n > 150, "too_long"),
        refuse(~F.col("broken") & (n < 5), "too_short"),
        F.when((n >= 5) & (n < 20), F.struct(F.lit("warning").alias("severity"), F.lit("short").alias("reason"))),
        refuse(~F.coalesce(F.col("control").rlike(t.CONTROL), ~F.col("complete")), "control"),
        refuse(placed & F.col("control").rlike(t.CONTROL) & (said != F.col("folder")), "control_lang"),
        refuse(F.col("id").isNotNull() & (F.col("id_first") != seq), "repeated_id"),
        refuse(F.col("dirty").isNotNull() & (F.col("text_first") != seq), "repeated_text"),
    ), F.transform(hits, lambda h: F.struct(F.when(h.isin(pii.BLOCKING), "refusal").otherwise("warning").alias("severity"), F.concat(F.lit("pii_"), h).alias("reason")))))
    found = checkpoint(checked.select("path", "line", F.explode(reasons).alias("x")).select("path", "line", "x.severity", "x.reason"))
    return found.unionByName(_structure(lines, found.filter("severity = 'refusal'").select("path").distinct()))


def _structure(lines: DataFrame, refused: DataFrame) -> DataFrame:
    """Structural refusals of the files that have no other."""
    files = lines.groupBy("path").agg(F.count("*").alias("n")).join(refused.withColumn("refused", F.lit(True)), "path", "left")
    files = checkpoint(files)
    total = files.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = join_hot_split(_parsed(lines), files, ["path"], "n", total).filter("refused is null")
    flags = F.array_compact(F.array(*[F.when(F.col(f), F.lit(f"structure_{f}")) for f in STRUCTURAL]))
    parts = [validate(rows.filter(F.col("folder") == lang), lang) for lang in ("fr", "en")]
    return parts[0].unionByName(parts[1]).select("path", "line", F.lit("refusal").alias("severity"), F.explode(flags).alias("reason"))

"""Text functions as column expressions; everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, written out because regex dialects differ.
WS = r" \t\n\x0B\f\r\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
ACCENTED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿÀÂÄÁÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝŸ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUYY"
CONTROL = r"^\[Styling: (casual|semi-casual|semi-formal|formal)\] \[Structure: (prose|lists)\] \[Context: (general|email)\] \[Lang: (fr|en)\]$"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, where a lambda would compute it for every element."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Runs of anything but white space; empty for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[^{WS}]+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text))


def collapse(text: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, f"[{WS}]+", " "), "^ | $", "")


def dedup_key(text: Column) -> Column:
    return F.lower(collapse(text))


def casefold_key(text: Column) -> Column:
    """Dedup key with sharp s opened, as full case folding does."""
    return F.replace(dedup_key(text), F.lit("ß"), F.lit("ss"))


def deaccent(text: Column) -> Column:
    """Precomposed Latin letters without their marks; combining marks dropped; ligatures stay."""
    return F.translate(F.regexp_replace(text, r"\p{Mn}", ""), ACCENTED, PLAIN)


def apostrophes(text: Column) -> Column:
    return F.translate(text, "’ʼ‘´`", "'''''")


def content_words(text: Column, tools: list[str]) -> Column:
    """Deaccented words without function words and single letters, apostrophes trimmed."""
    raw = F.regexp_extract_all(deaccent(F.lower(F.translate(text, "’ʼ", "''"))), F.lit("[a-z']+"), F.lit(0))
    bare = F.transform(raw, lambda w: F.regexp_replace(w, "^'+|'+$", ""))
    return F.filter(bare, lambda w: (F.length(w) > 1) & ~w.isin(tools))


def filter_words(text: Column, stop: list[str], digits: dict[str, str]) -> Column:
    """Words of three letters or more with digits and number words bridged both ways."""
    pieces = F.flatten(F.transform(
        F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[0-9]+|[a-zA-ZÀ-ÿ]+(?:['’][a-zA-ZÀ-ÿ]+)*"), F.lit(0)),
        lambda w: F.split(deaccent(F.lower(w)), "['’]")))
    kept = F.filter(pieces, lambda p: (F.length(p) >= 3) & ~p.isin(stop))
    if not digits:
        digits = {"": ""}
    to_digit = F.create_map(*[F.lit(x) for kv in digits.items() for x in kv])
    back: dict[str, str] = {}
    for word, digit in digits.items():
        back.setdefault(digit, word)
    to_word = F.create_map(*[F.lit(x) for kv in back.items() for x in kv])

    def bridged(p: Column) -> Column:
        value = F.regexp_replace(p, "^0+(?=.)", "")
        number = F.array(value, F.coalesce(F.try_element_at(to_word, value), value))
        word = F.array_compact(F.array(p, F.try_element_at(to_digit, p)))
        return F.when(p.rlike("^[0-9]+$"), number).otherwise(word)

    return F.array_distinct(F.flatten(F.transform(kept, bridged)))


def stem(word: Column, suffixes: list[str]) -> Column:
    out = word
    for suffix in reversed(suffixes):
        cut = F.substring(word, F.lit(1), F.length(word) - len(suffix))
        out = F.when(word.endswith(suffix) & (F.length(word) - len(suffix) >= 3), cut).otherwise(out)
    return out


def clip_middle(text: Column, limit: int, marker: str = " […] ") -> Column:
    half = limit // 2
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, half), F.lit(marker), F.right(text, F.lit(half))))


def short_quote(text: Column, limit: int = 180) -> Column:
    flat = collapse(text)
    return F.when(F.length(flat) <= limit, flat).otherwise(F.concat(F.substring(flat, 1, limit - 1), F.lit("…")))


def sentences(text: Column) -> Column:
    parts = F.split(F.regexp_replace(text, f"^[{WS}]+|[{WS}]+$", ""), f"(?<=[.!?…])[{WS}]+")
    return F.filter(F.transform(parts, collapse), lambda s: s != "")


def capitalise(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30))


def strip_punctuation(text: Column) -> Column:
    """Sentence marks before white space or the end; marks inside numbers and abbreviations stay."""
    return F.regexp_replace(text, f"[.?!;:,](?=[{WS}]|$)", "")


def lower_first_function_word(text: Column, tools: list[str]) -> Column:
    first = F.lower(F.regexp_extract(text, r"^([^ ]+)", 1))
    return F.when(first.isin(tools), F.concat(F.lower(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30))).otherwise(text)


def cite_first(text: Column, targets: list[str], limit: int = 180) -> Column:
    """The first sentence that holds one of the folded targets, else the text, shortened."""
    wanted = F.array(*[F.lit(t) for t in targets])
    tokens = lambda s: F.regexp_extract_all(deaccent(F.lower(apostrophes(s))), F.lit("[0-9]+|[a-z]+"), F.lit(0))
    hit = F.try_element_at(F.filter(sentences(text), lambda s: F.arrays_overlap(tokens(s), wanted)), F.lit(1))
    return short_quote(F.coalesce(hit, text), limit)


def code_bucket(text: Column, n: int = 3) -> Column:
    """Sum of code points modulo n."""
    points = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), F.ascii)
    return F.aggregate(points, F.lit(0), lambda a, x: a + x) % n


def thousands(number: Column, lang: str) -> Column:
    return F.replace(F.format_number(number, 0), F.lit(","), F.lit(" " if lang == "fr" else ","))


def control_line(styling: Column, structure: Column, context: Column, lang: Column) -> Column:
    return F.format_string("[Styling: %s] [Structure: %s] [Context: %s] [Lang: %s]", styling, structure, context, lang)


AXES = {"styling": "semi-formal", "structure": "prose", "context": "general", "lang": "fr"}


def control_axis(control: Column, axis: str) -> Column:
    """Value of one bracketed setting in any order and case; the default where it is missing or blank."""
    value = F.lower(collapse(F.regexp_extract(F.coalesce(control, F.lit("")), rf"(?i)\[\s*{axis}\s*:\s*([^\]]*?)\s*\]", 1)))
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(AXES[axis]))


def output_cap(n: Column) -> Column:
    return F.floor(1.3 * n).cast("int") + 32


def json_salvage(reply: Column) -> Column:
    """From the first to the last brace; null when there is none."""
    return F.nullif(F.regexp_extract(reply, r"(?s)\{.*\}", 0), F.lit(""))


def verdict_word(reply: Column) -> Column:
    """Canonical verdict by what the reply contains, accents or not."""
    low = deaccent(F.lower(reply))
    return F.when(low.contains("verole"), "verole").when(low.contains("suspect"), "suspect").when(low.contains("sain"), "sain")


def numbers(text: Column) -> Column:
    """Numbers as values, sorted: thousands blanks and commas removed."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\d{1,3}(?:[ ,]\d{3})+|\d+"), F.lit(0))
    return F.array_sort(F.transform(found, lambda n: F.regexp_replace(n, "[ ,]", "")))


def digit_runs(text: Column) -> Column:
    return F.array_sort(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\d+"), F.lit(0)))


def ngrams(tokens: Column, n: int) -> Column:
    return let(tokens, lambda w: _ngrams(w, n))


def _ngrams(tokens: Column, n: int) -> Column:
    count = F.greatest(F.size(tokens) - n + 1, F.lit(0))
    places = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda k: F.array_join(F.slice(tokens, k, n), " "))


def max_ngram_repeat(tokens: Column, n: int = 6, least: int = 12) -> Column:
    """Most occurrences of one run of n words; 1 for fewer than ``least`` words. Sorts once, then counts runs."""
    return let(tokens, lambda w: _max_repeat(w, n, least))


def _max_repeat(tokens: Column, n: int, least: int) -> Column:
    ordered = F.array_sort(_ngrams(tokens, n))
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(1).alias("best"))

    def step(a: Column, g: Column) -> Column:
        run = F.when(g == a["last"], a["run"] + 1).otherwise(F.lit(1))
        return F.struct(g.alias("last"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    return F.when(F.size(tokens) < least, F.lit(1)).otherwise(F.aggregate(ordered, start, step, lambda a: a["best"]))


def clauses(text: Column, most: int = 30, window: int = 20) -> Column:
    """Cut at strong marks, then commas, then into windows where a piece is still long."""
    pieces = F.flatten(F.transform(F.split(text, f"(?<=[.!?…;:])[{WS}]+"), lambda s: F.split(s, f",[{WS}]*")))
    tidy = F.filter(F.transform(pieces, collapse), lambda s: s != "")

    def windows(piece: Column) -> Column:
        return let(F.struct(piece.alias("piece"), F.split(piece, " ").alias("w")), lambda x: parts(x["piece"], x["w"]))

    def parts(piece: Column, w: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / window).cast("int")), lambda k: F.array_join(F.slice(w, k * window + 1, window), " "))
        return F.when(F.size(w) <= most, F.array(piece)).otherwise(cut)

    return F.flatten(F.transform(tidy, windows))


def longest_cluster(places: Column, gap: int) -> Column:
    """Longest train of ascending places at most ``gap`` apart."""
    start = F.struct(F.lit(None).cast("int").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(a: Column, p: Column) -> Column:
        run = F.when(a["last"].isNotNull() & (p - a["last"] <= gap), a["run"] + 1).otherwise(F.lit(1))
        return F.struct(p.alias("last"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    return F.aggregate(places, start, step, lambda a: a["best"])


def abandoned_value(text: Column, markers: list[str]) -> Column:
    """Last word of more than two characters before the first correction marker."""
    before = F.regexp_extract(F.lower(text), rf"(?s)^(.*?)\b(?:{'|'.join(markers)})\b", 1)
    long = F.filter(words(before), lambda w: F.length(w) > 2)
    return F.try_element_at(long, F.lit(-1))


def language_vote(text: Column, fr: list[str], en: list[str]) -> Column:
    """fr on accents above 2 % of words or more French words, en on more English ones, else amb."""
    low = F.lower(F.coalesce(text, F.lit("")))
    tokens = F.regexp_extract_all(low, F.lit("[a-zà-ÿ]+"), F.lit(0))
    hits = lambda names: F.size(F.filter(tokens, lambda w: w.isin(names)))
    accents = F.length(F.regexp_replace(low, "[^àâäçéèêëîïôöùûü]", ""))
    return (F.when((accents > 0.02 * F.greatest(F.size(tokens), F.lit(1))) | (hits(fr) > hits(en)), "fr")
            .when(hits(en) > hits(fr), "en").otherwise("amb"))


def hash_draw(seed: str, *keys: Column) -> Column:
    """Reproducible uniform integer below 2**32 from the md5 of seed and keys."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys])), 1, 8), 16, 10).cast("bigint")


def french_by_share(text: Column, known: list[str], accents: float = 0.02, share: float = 0.06) -> Column:
    """Accented letters above a share of the words, or listed words above another."""
    low = F.coalesce(text, F.lit(""))
    tokens = F.regexp_extract_all(low, F.lit("[a-zA-ZÀ-ÿ']+"), F.lit(0))
    marks = F.length(F.regexp_replace(F.lower(low), "[^àâäéèêëïîôöùûüçœ]", ""))
    return let(tokens, lambda w: (marks > F.size(w) * accents) | (F.size(F.filter(w, lambda x: x.isin(known))) > F.size(w) * share))


def language_drift(text: Column, words_by_lang: dict[str, list[str]], own: str = "en", slack: int = 2) -> Column:
    """Whether function words of the other languages, each language counted, outnumber the own ones by more than ``slack``."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]+(?:'est(?![\p{L}\p{N}_]))?"), F.lit(0))

    def count(words: Column, lang: str) -> Column:
        return F.size(F.filter(words, lambda x: x.isin(words_by_lang[lang])))

    def drifts(words: Column) -> Column:
        foreign = F.lit(0)
        for lang in words_by_lang:
            if lang != own:
                foreign = foreign + count(words, lang)
        return foreign > count(words, own) + slack

    return let(tokens, drifts)

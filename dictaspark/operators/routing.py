"""Archive routing by file name, and the archive's report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dictaspark.functions import pii

# File prefixes of generated families, names of corpus and superseded files, and the session id form.
SYNTHETIC = ("itn-", "frm-", "cor-", "ter-", "cmp-", "cri-", "par-")
CORPUS = r"^(units_|cohere_units_|qc_units_|eval_set_)|_(unit_ref|unit_jobs|manifest)\.jsonl$|_eval_(sessions|meetings)\.json$"
HISTORY = r"^pairs_mix|\.v\d+\.jsonl$|^pairs_[a-z_]+\d+\.jsonl$"
SESSION_ID = r"^\d{8}-\d{2,4}$"


def destination(name: Column, lang: Column, mix: Column) -> Column:
    """Where a work file belongs, or null for what is not archived; ``mix`` names the present mix, and the first rule that fits wins."""
    def under(folder: str | Column) -> Column:
        return F.concat_ws("/", lang, F.lit(folder) if isinstance(folder, str) else folder, name)

    ends = lambda *names: F.coalesce(*[F.when(name.endswith(n), True) for n in names], F.lit(False))
    rules = [
        (name == mix, F.concat(F.lit("mix/pairs_mix"), F.when(lang == "fr", "").otherwise(F.concat(F.lit("_"), lang)), F.lit(".jsonl"))),
        (ends(".jsonl.progress", ".jsonl.adjudged"), under("teacher")),
        (name.startswith("pairs_") & ends(".jsonl"), under(F.when(name.rlike(HISTORY), "history").otherwise("pairs"))),
        (ends(".log"), under("logs")),
        (name.rlike(CORPUS), under("corpus")),
        (ends(".sh", ".cmd", ".ps1", ".py"), under("scripts")),
        (ends(".jsonl", ".json", ".txt"), under("bench")),
    ]
    return F.coalesce(*[F.when(test, place) for test, place in rules])


def findings_report(rows: DataFrame, key: str, file: Column, texts: list[str]) -> DataFrame:
    """Findings by kind and family, and whether the family is generated; a phone-like run that is a session id is its own kind."""
    named = F.lower(file)
    family = F.regexp_extract(named, "^([a-z0-9]+)", 1)
    made = F.coalesce(*[F.when(named.startswith(p), True) for p in SYNTHETIC], F.lit(False))
    hits = pii.scan(rows.select(key, *texts, family.alias("family"), made.alias("synthetic")), [key, "family", "synthetic"], texts)
    kind = F.when((F.col("category") == "telephone") & F.trim("excerpt").rlike(SESSION_ID), "id_session").otherwise(F.col("category"))
    return hits.withColumn("kind", kind).groupBy("kind", "family", "synthetic").agg(F.count("*").alias("n"))

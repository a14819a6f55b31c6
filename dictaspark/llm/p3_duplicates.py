"""Duplicates hidden by formatting: dictionary-encoded records grouped as integer tuples.

Method: every field value is canonicalised (letters, digits and their marks, lower
case; bracketed settings in sorted order), each distinct canonical value gets an
integer in a dictionary, records become sorted (field, integer) tuples, and the
compact tuples are grouped. Text is read once and never shuffled: a value is known by
the 128 bits of its MD5 digest and its length, and only these and integers travel. For
that, values are canonicalised where they are read, before equal ones meet.

Defined results: null and blank fields equal each other and are left out of the
tuple; records with only such fields form one class; repeated row ids count as rows;
an empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dictaspark.operators.skew import join_hot_split
from dictaspark.session import checkpoint

DROPPED = r"[^\p{L}\p{M}\p{N}]+"
SETTING = r"\[[^\]]*\]"


def canonical_text(value: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(value.cast("string"), F.lit(""))), DROPPED, "")


def canonical_settings(value: Column) -> Column:
    """Bracketed settings in sorted order, after what stands outside brackets."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    inside = F.transform(F.regexp_extract_all(text, F.lit(SETTING), F.lit(0)), canonical_text)
    return F.concat(canonical_text(F.regexp_replace(text, SETTING, "")), F.array_join(F.array_sort(inside), ""))


def encode(rows: DataFrame, row_id: str, fields: dict) -> tuple[DataFrame, int]:
    """``(row_id, tuple)``: each record as its sorted (field number, value integer) pairs, and the number of rows.

    ``fields`` maps a column to the function that makes its canonical form. The row's
    own number ``seq`` keeps rows apart whose ids repeat.
    """
    wide = rows.select(
        F.col(row_id).alias("row_id"),
        *[canon(F.col(name)).alias(f"v{k}") for k, (name, canon) in enumerate(fields.items())],
    )
    prints = checkpoint(wide.select(
        "row_id", F.monotonically_increasing_id().alias("seq"),
        *[F.when(F.col(f"v{k}") != "", F.struct(F.unhex(F.md5(f"v{k}")).alias("a"), F.length(f"v{k}").alias("b"))).alias(f"f{k}") for k in range(len(fields))],
    ))
    total = prints.count()
    long = prints.select("row_id", "seq", F.explode(F.array(
        *[F.struct(F.lit(k).alias("field"), F.col(f"f{k}.a").alias("a"), F.col(f"f{k}.b").alias("b")) for k in range(len(fields))],
    )).alias("x")).select("row_id", "seq", "x.*").filter(F.col("a").isNotNull())
    dictionary = long.groupBy("field", "a", "b").agg(F.count("*").alias("n"))
    dictionary = checkpoint(dictionary.withColumn("value", F.monotonically_increasing_id()))
    coded = join_hot_split(long, dictionary, ["field", "a", "b"], "n", total)
    filled = coded.groupBy("seq", "row_id").agg(F.array_sort(F.collect_list(F.struct("field", "value"))).alias("tuple"))
    blank = prints.filter(F.coalesce(*[F.col(f"f{k}.a") for k in range(len(fields))]).isNull()).select(
        "seq", "row_id", F.array().cast("array<struct<field:int,value:bigint>>").alias("tuple"))
    return checkpoint(filled.unionByName(blank)), total


def distinct_records(coded: DataFrame) -> DataFrame:
    """One row per class: its tuple, least row id and number of copies."""
    return coded.groupBy("tuple").agg(F.min("row_id").alias("first_id"), F.count("*").alias("copies"))


def copy_pairs(coded: DataFrame, total: int) -> DataFrame:
    """``row_id_a`` the least row of a class, ``row_id_b`` every other one."""
    classes = checkpoint(distinct_records(coded).filter("copies > 1"))
    met = join_hot_split(coded, classes, ["tuple"], "copies", total)
    return met.filter("row_id <> first_id").select(F.col("first_id").alias("row_id_a"), F.col("row_id").alias("row_id_b")).distinct()


CONTRIB_FIELDS = {"dirty": canonical_text, "clean": canonical_text, "control": canonical_settings}

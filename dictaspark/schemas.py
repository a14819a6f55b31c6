"""Explicit schemas of the record kinds; readers never infer."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
          "array<string>": T.ArrayType(T.StringType())}


def struct(fields: str) -> T.StructType:
    """``name type, name type`` without a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (f.split() for f in fields.split(","))])


PAIR = struct(
    "id string, file string, source string, lang string, held_out boolean, styling string, structure string, "
    "context string, control string, dirty string, clean string")
CONTRIBUTION = struct("id string, file string, lang string, control string, dirty string, clean string, source string")
UNIT = struct("id string, dirty string, lang string, source string, file string, styling string, structure string, context string, held_out boolean")
ASR = struct("id string, text string, lang string, words int, audio_seconds double, error string")
UTTERANCE = struct(
    "session_id string, paragraph_id string, audio_id string, split string, raw_text string, norm_text string, "
    "speaker_id string, gender string, idx int, words int, duration_s double")
SEGMENT = struct("start double, end double, transcript string, n_words int")
QC_VERDICT = struct(
    "id string, verdict string, causes array<string>, defauts array<string>, preuve string, explication string, "
    "lang string, audio_seconds double, words int")
PROGRESS = struct(
    "id string, dirty string, lang string, source string, file string, styling string, structure string, context string, "
    "held_out boolean, control string, clean string, rejet string")
ADJUDICATION = T.StructType([*PROGRESS.fields, T.StructField("arbitrage", struct("conforme boolean, motif string, explication string"))])
GENERATION = struct("id string, control string, dirty string, out string")
AB_VERDICT = struct("id string, gagnant string, a_fautes array<string>, b_fautes array<string>, preuve string, explication string")
FINDING = struct("line bigint, category string, excerpt string")
FAULT = struct("type string, gravite string, message string, preuve string")
REQUIRED_KEYS = tuple(CONTRIBUTION.fieldNames())

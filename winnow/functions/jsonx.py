"""Column functions on the JSON that models answer with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, strip

PAIRS = "array<struct<question: string, answer: string, question_type: string>>"
VERDICT = "struct<content_type: string, confidence: double, secondary_types: array<string>>"


def unfenced(c: Column | str) -> Column:
    """What stands between the first line that begins with ``` and the next such line, if the text begins with one."""
    t = strip(c)
    inner = F.regexp_extract(t, r"(?s)\A```[^\n]*\n?(.*?)(?:\n```|\A```|\z)", 1)
    return F.when(t.startswith("```"), F.regexp_replace(inner, r"(?s)^```.*", "")).otherwise(t)


def parse_list(c: Column | str, schema: str = PAIRS) -> Column:
    """The JSON array in an answer: fenced, or from the first [ to the last ]; an empty one if there is none."""
    t = strip(unfenced(c))
    first, last = F.instr(t, "["), F.length(t) - F.instr(F.reverse(t), "]") + 1
    text = F.when(t.startswith("["), t).when((first > 0) & (F.instr(t, "]") > 0), F.substr(t, first, F.greatest(last - first + 1, F.lit(0)))).otherwise(t)
    empty = F.array().cast(schema)
    return F.when(text.startswith("["), F.coalesce(F.from_json(text, schema), empty)).otherwise(empty)


def parse_object(c: Column | str, schema: str = VERDICT) -> Column:
    """The JSON object in an answer, fenced or not; null if it is none."""
    return F.from_json(unfenced(c), schema, {"mode": "PERMISSIVE"})


def parse_first_object(c: Column | str) -> Column:
    """The verdict in the first {...} of an answer; unknown with confidence 0 if it can't be read."""
    found = F.from_json(F.regexp_extract(as_col(c), r"(\{[^}]+\})", 1), VERDICT)
    return F.when(found["content_type"].isNotNull(), found).otherwise(F.struct(F.lit("unknown").alias("content_type"), F.lit(0.0).alias("confidence"), F.array().cast("array<string>").alias("secondary_types")))


def list_json(c: Column | str) -> Column:
    """An array as JSON text; an empty array for null."""
    return F.to_json(F.coalesce(as_col(c), F.array().cast("array<string>")))

"""Validation of training records: schema, conversations, images, required fields, distribution."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    require_image: bool = True
    require_conversations: bool = True
    require_metadata: bool = True
    check_images: bool = True
    min_width: int = 100
    min_height: int = 100
    min_question: int = 10
    min_answer: int = 5
    max_answer: int = 1000
    min_section: int = 5
    max_section: int = 2000


TURNS = "array<struct<role: string, content: string>>"


def schema_errors(raw: Column, limits: Limits | None = None) -> Column:
    """Errors of a record given as JSON text: missing keys (a null value is present), conversations no list, bad roles."""
    v, keys = limits or Limits(), F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    missing = lambda key, on: F.when(F.lit(on) & ~F.array_contains(keys, key), f"Missing '{key}' field")
    body = F.get_json_object(raw, "$.conversations")
    is_list = F.coalesce(F.ltrim(body).startswith("["), F.lit(False))
    items = F.when(is_list, F.from_json(body, "array<string>"))

    def turn_error(item: Column, i: Column) -> Column:
        role = F.get_json_object(item, "$.role")
        bad = F.format_string("Invalid role '%s' at conversation %d", F.coalesce(role, F.lit("None")), i)
        return F.when(~F.coalesce(F.ltrim(item).startswith("{"), F.lit(False)), F.format_string("Conversation %d is not a dict", i)).when(role.isNull() | ~role.isin("user", "assistant"), bad)

    no_list = F.when(F.lit(v.require_conversations) & F.array_contains(keys, "conversations") & ~is_list, "'conversations' must be a list")
    turns = F.when(F.lit(v.require_conversations) & items.isNotNull(), F.transform(items, turn_error)).otherwise(F.array().cast("array<string>"))
    head = F.array(missing("image", v.require_image), missing("conversations", v.require_conversations), no_list)
    return F.array_compact(F.concat(head, turns, F.array(missing("metadata", v.require_metadata))))


def order_errors(turns: Column) -> Column:
    """One error for each turn out of the order user, assistant, user, ...; one alone for no turns."""
    expected = lambda i: F.when(i % 2 == 0, "user").otherwise("assistant")
    wrong = F.transform(turns, lambda t, i: F.when(~t["role"].eqNullSafe(expected(i)), F.format_string("Wrong role order at position %d: expected '%s', got '%s'", i, expected(i), F.coalesce(t["role"], F.lit("None")))))
    return F.when(F.coalesce(F.size(turns), F.lit(0)) <= 0, F.array(F.lit("Empty conversations list"))).otherwise(F.array_compact(wrong))


def length_warnings(turns: Column, limits: Limits | None = None) -> Column:
    """Warnings about too short questions and too short or long answers, by unstripped length."""
    v = limits or Limits()

    def of(t: Column) -> Column:
        n = F.length(F.coalesce(t["content"], F.lit("")))
        user, assistant = t["role"] == "user", t["role"] == "assistant"
        return F.array(
            F.when(user & (n < v.min_question), F.format_string("Question too short (%d chars)", n)),
            F.when(assistant & (n < v.min_answer), F.format_string("Answer too short (%d chars)", n)),
            F.when(assistant & (n > v.max_answer), F.format_string("Answer too long (%d chars)", n)),
        )

    return F.array_compact(F.flatten(F.transform(F.coalesce(turns, F.array().cast(TURNS)), of)))


def image_size(data: bytes | None) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, GIF or JPEG; None for anything else."""
    d = data or b""
    if d[:8] == b"\x89PNG\r\n\x1a\n" and len(d) >= 24:
        return struct.unpack(">II", d[16:24])
    if d[:6] in (b"GIF87a", b"GIF89a") and len(d) >= 10:
        return struct.unpack("<HH", d[6:10])
    if d[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(d):
            if d[at] != 0xFF:
                at += 1
                continue
            kind = d[at + 1]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", d[at + 5 : at + 9])
                return w, h
            at += 2 if kind == 0xFF or 0xD0 <= kind <= 0xD8 or kind == 1 else 2 + struct.unpack(">H", d[at + 2 : at + 4])[0]
    return None


def with_image_size(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, n_bytes, width, height) of image files; sizes are null where the header can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [image_size(x) or (None, None) for x in b.column("c").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("p"), b.column("n"), pa.array([s[0] for s in sizes], pa.int32()), pa.array([s[1] for s in sizes], pa.int32())], names=["path", "n_bytes", "width", "height"])

    return files.select(F.col(path).alias("p"), F.col(content).alias("c"), F.length(content).cast("long").alias("n")).mapInArrow(run, "path string, n_bytes bigint, width int, height int")


def image_findings(records: DataFrame, sizes: DataFrame, limits: Limits | None = None) -> DataFrame:
    """records with image_error and image_warning, by a join with the sizes of the image files. A null image has neither."""
    v = limits or Limits()
    if not v.check_images:
        return records.withColumns({"image_error": F.lit(None).cast("string"), "image_warning": F.lit(None).cast("string")})
    met = records.join(sizes.select(F.col("path").alias("image"), F.lit(True).alias("__there"), "width", "height"), "image", "left")
    has = F.col("image").isNotNull()
    error = F.when(has & F.col("__there").isNull(), F.concat(F.lit("Image not found: "), "image")).when(has & F.col("width").isNull(), F.concat(F.lit("Image not readable: "), "image"))
    small = has & ((F.col("width") < v.min_width) | (F.col("height") < v.min_height))
    return met.withColumn("image_error", error).withColumn("image_warning", F.when(small, F.format_string("Image too small: %dx%d", "width", "height"))).drop("__there", "width", "height")


def section_warnings(counts: DataFrame, limits: Limits | None = None) -> DataFrame:
    """(section_id, n, warning) of the sections with too few or too many rows."""
    v = limits or Limits()
    w = F.when(F.col("n") < v.min_section, F.format_string("Section '%s' has only %d examples", "section_id", "n")).when(F.col("n") > v.max_section, F.format_string("Section '%s' has %d examples", "section_id", "n"))
    return counts.withColumn("warning", w).filter("warning is not null")


def field_findings(rows: DataFrame, required: list[str]) -> DataFrame:
    """rows with errors (required fields missing or null) and warnings (empty ones)."""
    e = [F.when(F.col(c).isNull() if c in rows.columns else F.lit(True), f"Missing required field: {c}") for c in required]
    w = [F.when(F.col(c).cast("string") == "", f"Empty required field: {c}") for c in required if c in rows.columns]
    none = F.array().cast("array<string>")
    return rows.withColumn("errors", F.array_compact(F.array(*e)) if e else none).withColumn("warnings", F.array_compact(F.array(*w)) if w else none)


def labelled(findings: DataFrame, split: Column | str, column: str, ordinal: str = "ordinal") -> DataFrame:
    """One row per message, as split[i]: message with the record's number from 0."""
    s = F.col(split) if isinstance(split, str) else split
    return findings.select(s.alias("split"), ordinal, F.explode(column).alias("m")).select("split", ordinal, F.format_string("%s[%d]: %s", "split", ordinal, "m").alias("message"))


def verdict(findings: DataFrame, strict: bool = False, errors: str = "errors", warnings: str = "warnings") -> DataFrame:
    """One row: n_errors, n_warnings, passed (no errors; strict: no warnings either)."""
    e, w = F.coalesce(F.sum(F.size(errors)), F.lit(0)), F.coalesce(F.sum(F.size(warnings)), F.lit(0))
    return findings.agg(e.alias("n_errors"), w.alias("n_warnings"), ((e == 0) & (w == 0) if strict else e == 0).alias("passed"))

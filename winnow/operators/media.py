"""Preparing sources: validating images, fanning PDF files out to pages, resizing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import basename, media_type, stem
from .validate import image_size, with_image_size

#: Makes a list of JPEG pages of a PDF's bytes; raises where it can't. No library for it is bundled.
Rasteriser = Callable[[bytes], list[bytes]]
LOG = "timestamp string, source_file string, operation string, status string, output_path string, error_message string"


def encoded_images(files: DataFrame) -> DataFrame:
    """(path, media_type, data): image bytes in base 64."""
    return files.select("path", media_type("path").alias("media_type"), F.base64("content").alias("data"))


def validate_images(files: DataFrame) -> DataFrame:
    """(path, ok, error_message): empty files and those without a readable image header fail."""
    met = with_image_size(files)
    error = F.when(F.coalesce("n_bytes", F.lit(0)) == 0, "File is empty").when(F.col("width").isNull(), "Invalid image")
    return met.select("path", error.isNull().alias("ok"), F.coalesce(error, F.lit("")).alias("error_message"))


def fan_out_pdfs(files: DataFrame, rasterise: Rasteriser | None) -> DataFrame:
    """(path, page, image, error): a row for each page of each PDF, or one with an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                try:
                    if rasterise is None:
                        raise RuntimeError("no rasteriser")
                    rows = [(path, n, image, None) for n, image in enumerate(rasterise(content), 1)]
                except Exception as e:  # a broken file is logged, the others go on
                    rows = [(path, None, None, str(e))]
                if rows:
                    p, n, i, e = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(p, pa.string()), pa.array(n, pa.int32()), pa.array(i, pa.binary()), pa.array(e, pa.string())], names=["path", "page", "image", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, page int, image binary, error string")


def prepared_inventory(inventory: DataFrame, pages: DataFrame, checked: DataFrame, timestamp: str) -> tuple[DataFrame, DataFrame]:
    """(prepared inventory, log) from an inventory, fan_out_pdfs rows and validate_images rows, paths as in the inventory.

    A PDF becomes its pages, NNN.jpg beside it, with original_source set; one that fails is only
    logged, and so is an image that fails. HTML files are taken over as they are.
    """
    inv = inventory.select("file_path", "file_type", "section_dir", "filename")
    cols = ["file_path", "file_type", "section_dir", "filename", "original_source"]
    page = inv.join(pages.filter("error is null").select(F.col("path").alias("file_path"), "page"), "file_path")
    name = F.format_string("%03d.jpg", "page")
    folder = F.concat(F.regexp_replace("file_path", r"[^/]*$", ""), stem(basename("file_path")), F.lit("/"))
    made = page.select(F.concat(folder, name).alias("file_path"), F.lit("jpg").alias("file_type"), stem(basename("file_path")).alias("section_dir"), name.alias("filename"), F.col("file_path").alias("original_source"))
    kept = inv.join(checked.filter("ok").select(F.col("path").alias("file_path")), "file_path", "left_semi").filter("file_type in ('jpg', 'png')")
    whole = kept.unionByName(inv.filter("file_type = 'html'")).withColumn("original_source", F.lit("")).select(cols).unionByName(made.select(cols))
    row = lambda src, op, status, out, err: [F.lit(timestamp).alias("timestamp"), src.alias("source_file"), F.lit(op).alias("operation"), status.alias("status"), out.alias("output_path"), F.coalesce(err, F.lit("")).alias("error_message")]
    log = pages.groupBy("path").agg(F.first("error", ignorenulls=True).alias("e")).select(*row(F.col("path"), "pdf_convert", F.when(F.col("e").isNull(), "success").otherwise("failure"), F.when(F.col("e").isNull(), F.col("path")).otherwise(""), F.col("e")))
    log = log.unionByName(checked.select(*row(F.col("path"), "image_validate", F.when(F.col("ok"), "success").otherwise("failure"), F.when(F.col("ok"), F.col("path")).otherwise(""), F.col("error_message"))))
    log = log.unionByName(inv.filter("file_type = 'html'").select(*row(F.col("file_path"), "skip", F.lit("skipped"), F.col("file_path"), F.lit(""))))
    return whole, log


def fit_image(data: bytes, resize: Callable[[bytes, int, int], bytes], most_pixels: int = 4096, most_bytes: int = 5_000_000, quality: int = 85, least: int = 25) -> bytes:
    """An image within the limits: resized to most_pixels a side, then encoded at falling quality, in steps of 10, until small enough.

    resize(data, longest side, quality) does the work; no image library is bundled. The last try is
    returned even if it is too large.
    """
    size = image_size(data)
    if size and max(size) <= most_pixels and len(data) <= most_bytes:
        return data
    out = data
    for q in range(quality, least - 1, -10):
        out = resize(data, most_pixels, q)
        if len(out) <= most_bytes:
            break
    return out

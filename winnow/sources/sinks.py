"""Writing tables, documents, records, logs and image files."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_filename
from .readers import exists


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None, order: list[str] | None = None, append: bool = False) -> None:
    """A CSV folder with headers and fixed columns, in order if one is given; append adds files to it."""
    out = rows.select(columns) if columns else rows
    out = out.orderBy(order) if order else out
    out.write.mode("append" if append else "overwrite").option("header", True).option("escape", '"').csv(path)


def write_jsonl(rows: DataFrame, path: str, append: bool = False) -> int:
    """JSON lines with nulls kept; returns how many."""
    rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)
    return rows.sparkSession.read.text(path).count()


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system that a folder lies on, and its path there; workers open it themselves."""
    local = folder.removeprefix("file://").removeprefix("file:")
    return fs.FileSystem.from_uri(folder) if "://" in local else (fs.LocalFileSystem(), os.path.abspath(local))


def write_named(rows: DataFrame, folder: str) -> int:
    """Write each (name, value) row to a file of that name below the folder, and return how many rows there were.

    Tasks write the files, under another name first, so that one that is lost leaves no half of a
    file; nothing goes through the driver. value is text or bytes, null for nothing; a name may
    have folders, but none that lead up. Files of other names stay. Rows of one name overwrite
    each other: see name_clashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        for batch in batches:
            for name, value in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if not name or name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"no name of a file below a folder: {name!r}")
                place, _, last = f"{base}/{name}".rpartition("/")
                store.create_dir(place, recursive=True)
                half = f"{place}/.{last}.{uuid.uuid4().hex}"
                with store.open_output_stream(half) as out:
                    out.write(value.encode() if isinstance(value, str) else value or b"")
                store.move(half, f"{place}/{last}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    written = rows.select("name", "value").mapInArrow(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    file_system(folder)[0].create_dir(file_system(folder)[1], recursive=True)
    return written


def name_clashes(rows: DataFrame) -> DataFrame:
    """(name, n): names that several rows would be written under."""
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def named_documents(docs: DataFrame, key: str | Column = "page_id", sanitise: bool = False) -> DataFrame:
    """(name, value): each document as JSON, nulls kept, under its key with .json."""
    name = F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit("null"))
    body = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    return docs.select(F.concat(safe_filename(name) if sanitise else name, F.lit(".json")).alias("name"), body.alias("value"))


def write_documents(docs: DataFrame, folder: str, key: str | Column = "page_id", sanitise: bool = False) -> int:
    """One JSON file for each document, named by its key; returns how many. See write_named."""
    return write_named(named_documents(docs, key, sanitise), folder)


def write_raw(rows: DataFrame, folder: str, key: str, text: str, suffix: str = ".html") -> int:
    """Raw texts such as HTML, one file each, named by the key; returns how many. See write_named."""
    return write_named(rows.select(F.concat(F.coalesce(F.col(key), F.lit("null")), F.lit(suffix)).alias("name"), F.col(text).alias("value")), folder)


def review_queue(pages: DataFrame) -> DataFrame:
    """Pages that need review, the least certain first."""
    return pages.filter("needs_review").orderBy("confidence", "page_id").select("page_id", "image_path", "content_type", "confidence", "secondary_types")


def write_review_queue(pages: DataFrame, path: str) -> bool:
    """Writes the review queue unless it is empty."""
    queue = review_queue(pages)
    if queue.isEmpty():
        return False
    write_csv(queue.withColumn("secondary_types", F.to_json("secondary_types") if dict(queue.dtypes)["secondary_types"].startswith("array") else F.col("secondary_types")), path)
    return True


def materialise_images(images: DataFrame, folder: str, mode: str = "symlink") -> DataFrame:
    """(source, image, status) after putting each image file into a folder that all tasks share.

    mode is copy, symlink or relative. A target that exists is left alone, a source that doesn't is
    reported missing. For file systems that the workers mount; images has (source, image).
    """
    if mode not in ("copy", "symlink", "relative"):
        raise ValueError(f"no such mode: {mode}")

    def one(source: str | None, image: str) -> str:
        target = os.path.join(folder, os.path.basename(image))
        if os.path.lexists(target):
            return "there"
        if not source or not os.path.exists(source):
            return "missing"
        os.makedirs(folder, exist_ok=True)
        if mode == "copy":
            shutil.copy2(source, target)
        else:
            os.symlink(os.path.abspath(source) if mode == "symlink" else os.path.relpath(source, folder), target)
        return "made"

    def run(batches: Iterable) -> Iterable:
        for pdf in batches:
            pdf["status"] = [one(s, i) for s, i in zip(pdf["source"], pdf["image"], strict=True)]
            yield pdf

    return images.select("source", "image").mapInPandas(run, "source string, image string, status string")


def upload_map(folder_files: DataFrame, root: str) -> DataFrame:
    """(remote, local): files to upload by their path below the root. Uploading itself is left to the caller."""
    bare = root.rstrip("/") + "/"
    return folder_files.filter(F.col("path").startswith(bare)).select(F.substring("path", len(bare) + 1, 1 << 20).alias("remote"), F.col("path").alias("local"))


def token_of(argument: str | None, environment: dict[str, str] | None = None, names: tuple[str, ...] = ("HF_TOKEN", "HUGGINGFACE_TOKEN")) -> str | None:
    """An access token: the argument before the environment's variables, in their order."""
    env = os.environ if environment is None else environment
    return argument or next((env[n] for n in names if env.get(n)), None)


def append_log(rows: DataFrame, path: str) -> None:
    write_csv(rows, path, append=exists(rows.sparkSession, path))

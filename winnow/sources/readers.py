"""Reading inventories, documents, records, pages and images."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import basename, file_type, needs_conversion, parent_name, stem
from ..operators.index import last_per_key
from ..operators.order import with_rank
from ..operators.validate import field_findings

INVENTORY = "file_path string, file_type string, section_dir string, filename string, needs_conversion string"
PREPARED = "file_path string, file_type string, section_dir string, filename string, original_source string"
CLASSIFIED = "page_id string, image_path string, section_id string, section_name string, source_type string, content_type string, is_index string, confidence string, secondary_types string, needs_review string"
GENERATION = "struct<model: string, timestamp: string, prompt_template: string, tokens_input: bigint, tokens_output: bigint, method: string, source_file: string, model_detected: string, specs_parsed: bigint>"
QA_DOCUMENT = (
    "page_id string, image_path string, section_id string, section_name string, source_type string, content_type string, procedures_covered array<string>, procedures_names array<string>, "
    f"generation {GENERATION}, qa_pairs array<struct<id: string, question: string, answer: string, question_type: string, _warnings: array<string>>>"
)
RECORD = "image string, conversations array<struct<role: string, content: string>>, metadata struct<page_id: string, section_id: string, section_name: string, source_type: string, content_type: string, question_type: string, qa_id: string>"
INDEX = "section_id string, section_name string, index_pages array<string>, procedures array<struct<code: string, name: string, pages: array<string>>>, page_to_procedures map<string, array<string>>, merge_warnings array<string>"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system that Spark reads."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern matches, sorted."""
    fs, p = _fs(spark, pattern)
    return sorted(str(s.getPath()) for s in (fs.globStatus(p) or []))


def need(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return path


def plain_path(path: Column) -> Column:
    """A file's path without its scheme."""
    return F.regexp_replace(path, r"^[a-z0-9]+:(//[^/]*)?", "")


def bare_root(root: str) -> str:
    """A folder's path without its scheme and without a slash at its end."""
    return re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", root).rstrip("/")


def files_below(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, length, content) of the files under root whose names match a pattern, empty ones too; paths are without a scheme.

    Spark's readers pass over empty files. These are the names in the listing that a reader keeps
    anyway, without those that it reads.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(need(spark, root))
    some = files.select(plain_path(F.col("path")).alias("path"), "length", "content")
    names = spark.createDataFrame([(unquote(name),) for name in files.inputFiles()], "path string").select(plain_path(F.col("path")).alias("path"))
    empty = names.join(some.select("path"), "path", "left_anti")
    return some.unionByName(empty.select("path", F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content")))


def scan_inventory(spark: SparkSession, root: str, section: str | None = None) -> DataFrame:
    """Files of known types under root, in order of path, with their section (the folder; empty at the root). Contents aren't read."""
    files = files_below(spark, root).select(F.col("path").alias("p"))
    bare = bare_root(root)
    rows = files.withColumn("file_type", file_type("p")).filter("file_type is not null")
    rows = rows.select(F.substring(F.col("p"), len(bare) + 2, 1 << 20).alias("file_path"), "file_type")
    out = rows.select("file_path", "file_type", parent_name("file_path").alias("section_dir"), basename("file_path").alias("filename"), needs_conversion("file_type").alias("needs_conversion"))
    return (out if section is None else out.filter(F.col("section_dir") == section)).orderBy("file_path")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header, all columns as text."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(need(spark, path))


def read_image_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PREPARED).filter(F.lower("file_type").isin("jpg", "jpeg", "png"))


def typed_classification(rows: DataFrame) -> DataFrame:
    """Booleans and confidence of classified pages from their text; a confidence that is no number is 0."""
    true = lambda c: F.coalesce(F.lower(c) == "true", F.lit(False))
    out = rows.withColumns({"is_index": true("is_index"), "confidence": F.coalesce(F.col("confidence").try_cast("double"), F.lit(0.0))})
    return out.withColumn("needs_review", true("needs_review")) if "needs_review" in rows.columns else out


def read_classified(spark: SparkSession, path: str) -> DataFrame:
    return typed_classification(read_csv(spark, path, CLASSIFIED))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """Classified pages kept from before, the last row of each page; none if there is no such file.

    Of several files the one written last counts as the later one, ties by name; within a file
    rows count in their order.
    """
    if not exists(spark, path):
        return typed_classification(spark.createDataFrame([], CLASSIFIED))
    rows = typed_classification(spark.read.schema(CLASSIFIED).option("header", True).option("escape", '"').csv(path))
    place = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return last_per_key(rows.withColumn("__o", place).filter("page_id is not null"), "page_id", "__o").drop("__o")


def read_documents(spark: SparkSession, folder: str, schema: str = QA_DOCUMENT, strict: bool = False) -> DataFrame:
    """JSON documents of a folder (not below it) with file_name and doc_ord, their place in order of name.

    A missing folder is an error, files that are no JSON are skipped (skipped_documents names
    them); strict=True makes an empty
    folder an error too. doc_ord orders by name; it is a rank of names, not a scan order.
    """
    files = [p for p in matching(spark, need(spark, folder).rstrip("/") + "/*.json")]
    if not files:
        if strict:
            raise ValueError(f"no JSON documents in {folder}")
        return spark.createDataFrame([], f"{schema}, file_name string, doc_ord bigint")
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(folder.rstrip("/") + "/*.json").withColumn("file_name", F.col("_metadata.file_name"))
    names = with_rank(rows.select("file_name").distinct(), ["file_name"], "__r")
    return rows.join(names, "file_name").withColumn("doc_ord", F.col("__r") - 1).select(*[f.name for f in rows.schema if f.name != "file_name"], "file_name", "doc_ord")


def skipped_documents(spark: SparkSession, folder: str, schema: str = QA_DOCUMENT) -> DataFrame:
    """(file_name): the files of a folder that read_documents skips because they are no JSON documents."""
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(need(spark, folder)).select(basename("path").alias("file_name"))
    return there.join(read_documents(spark, folder, schema).select("file_name").distinct(), "file_name", "left_anti")


def read_keyed_documents(spark: SparkSession, folder: str, schema: str = INDEX) -> DataFrame:
    """JSON documents with key, the file's name without its extension."""
    return read_documents(spark, folder, schema).withColumn("key", stem("file_name"))


def first_with_json(spark: SparkSession, candidates: list[str]) -> str | None:
    """The first of some folders that holds JSON documents."""
    return next((c for c in candidates if exists(spark, c) and matching(spark, c.rstrip("/") + "/*.json")), None)


def read_jsonl(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """JSON lines; blank lines are skipped, any other bad line is an error. ordinal is the row's number from 0, raw its text."""
    lines = numbered_lines(spark, need(spark, path))
    bad = F.raise_error(F.format_string("line %d is not JSON: %s", F.col("line"), F.substring("raw", 1, 80)))
    ok = F.coalesce(F.json_object_keys("raw").isNotNull(), F.lit(False))
    parsed = lines.withColumn("raw", F.when(ok, F.col("raw")).otherwise(bad)).withColumn("r", F.from_json("raw", schema))
    return parsed.select("ordinal", "raw", "r.*")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines with line (from 1 within their file, blank ones counted) and ordinal (from 0, without them).

    Files of any size: lines are read in splits and ranked by file, split and place in it.
    """
    each = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("m"), F.col("value").alias("raw"))
    ranked = with_rank(each, ["file", "b", "m"], "r")
    first = ranked.groupBy("file").agg(F.min("r").alias("f"))
    full = ranked.join(first, "file").withColumn("line", F.col("r") - F.col("f") + 1).filter(F.trim(F.regexp_replace("raw", r"(?U)\s+", " ")) != "")
    return with_rank(full, ["r"], "n").select("file", "line", (F.col("n") - 1).alias("ordinal"), "raw")


def read_jsonl_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, none if there is no such file."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def count_jsonl(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).filter(F.trim("value") != "").count()


def read_html(spark: SparkSession, root: str) -> DataFrame:
    """(path, html) of the pages under root with specifications: by name, or with a table in the first 10,000 characters."""
    pages = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").text(need(spark, root), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    return pages.filter(has_specs("path", "html")).dropDuplicates(["path"])


def has_specs(path: str, html: str) -> Column:
    name = basename(path)
    return name.rlike(r"(-techspec|-specs)\.html$") | name.rlike(r"techspec.*\.html$") | F.lower(F.substring(html, 1, 10000)).contains("<table")


def read_images(spark: SparkSession, root: str, pattern: str = "*.{jpg,jpeg,png,gif,webp}") -> DataFrame:
    """(path, content) of the images under root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(need(spark, root))
    return files.select(plain_path(F.col("path")).alias("path"), "content")


def read_validated(spark: SparkSession, path: str, schema: str, required: list[str]) -> DataFrame:
    """JSON lines, none if there is no such file, with the errors and warnings of their required fields."""
    return field_findings(read_jsonl_if_there(spark, path, schema), required)

"""Queries that write files from the driver's tables, read them back, and compare what the readers say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators import crawl, emit, media, rules, stats
from ..operators.order import with_rank
from ..session import durable, scratch
from ..sources import config, readers, sinks
from ..streaming import ingest
from . import reports, stages
from .registry import query, table

EXTENSIONS = ("jpg", "JPEG", "png", "pdf", "html", "txt", "gif")
#: A supplier's file: its folder is that of its nation, the extension follows its key.
_EXT = "['jpg', 'JPEG', 'png', 'pdf', 'html', 'txt', 'gif'][s_suppkey % 7 + 1]"
_FILES = f"f AS (SELECT s_suppkey, 'nation' || s_nationkey AS section_dir, s_suppkey || '.' || {_EXT} AS filename, 'nation' || s_nationkey || '/' || s_suppkey || '.' || {_EXT} AS file_path, CASE lower({_EXT}) WHEN 'jpeg' THEN 'jpg' WHEN 'txt' THEN NULL WHEN 'gif' THEN NULL ELSE lower({_EXT}) END AS file_type FROM supplier)"


def _name() -> Column:
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]), (F.col("s_suppkey") % len(EXTENSIONS) + 1).cast("int"))
    return F.concat(F.lit("nation"), F.col("s_nationkey").cast("string"), F.lit("/"), F.col("s_suppkey").cast("string"), F.lit("."), ext)


def _files(spark: SparkSession, sf_dir: str, value: Column | None = None) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(_name().alias("name"), (F.col("s_name") if value is None else value).alias("value"), "s_suppkey")


@query(f"WITH {_FILES} SELECT file_path, file_type, section_dir, filename, CASE WHEN file_type = 'pdf' THEN 'true' ELSE 'false' END AS needs_conversion FROM f WHERE file_type IS NOT NULL")
def inventory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        sinks.write_named(_files(spark, sf_dir), folder)
        return durable(readers.scan_inventory(spark, folder))


@query(f"WITH {_FILES} SELECT file_path, file_type, section_dir, filename, CAST(NULL AS VARCHAR) AS original_source FROM f WHERE file_type IN ('jpg', 'png')")
def inventory_csv_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        f = _files(spark, sf_dir).select(F.col("name").alias("file_path"))
        rows = f.select("file_path", paths.file_type("file_path").alias("file_type"), paths.parent_name("file_path").alias("section_dir"), paths.basename("file_path").alias("filename"), F.lit(None).cast("string").alias("original_source")).filter("file_type is not null")
        sinks.write_csv(rows, folder, ["file_path", "file_type", "section_dir", "filename", "original_source"], order=["file_path"])
        return durable(readers.read_image_rows(spark, folder))


@query(f"WITH {_FILES} SELECT file_type, count(*) AS n, count(*) FILTER (file_type = 'pdf') AS to_convert FROM f WHERE file_type IS NOT NULL GROUP BY 1")
def inventory_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        sinks.write_named(_files(spark, sf_dir), folder)
        return durable(stats.inventory_summary(readers.scan_inventory(spark, folder)))


@query(f"WITH {_FILES}, r AS (SELECT file_path, row_number() OVER (ORDER BY file_path) AS place FROM f WHERE file_type IS NOT NULL) SELECT file_path, place FROM r")
def csv_keeps_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        rows = _files(spark, sf_dir).select(F.col("name").alias("file_path")).filter(paths.file_type("file_path").isNotNull())
        sinks.write_csv(rows, folder, order=["file_path"])
        back = readers.read_csv(spark, folder, "file_path string").select("file_path", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"))
        return durable(with_rank(back, ["at"], "place").select("file_path", F.col("place").cast("long").alias("place")))


_CLASSIFIED = "SELECT c_name AS page_id, c_mktsegment AS section_id, c_custkey % 3 = 0 AS is_index, CASE WHEN c_custkey % 5 = 0 THEN 0.0 ELSE c_custkey % 100 / 100.0::DOUBLE END AS confidence, c_custkey % 4 = 1 AS needs_review FROM customer"


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    said = lambda yes: F.when(yes, F.when(k % 2 == 0, "True").otherwise("true")).otherwise(F.when(k % 2 == 0, "False").otherwise(""))
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("page_id"), F.lit("x.jpg").alias("image_path"), F.col("c_mktsegment").alias("section_id"), F.lit('a "quoted", name').alias("section_name"), F.lit("service_manual").alias("source_type"), F.lit("text").alias("content_type"),
        said(k % 3 == 0).alias("is_index"), F.when(k % 5 == 0, "n/a").otherwise((k % 100 / 100.0).cast("string")).alias("confidence"), F.lit("[]").alias("secondary_types"), said(k % 4 == 1).alias("needs_review"),
    )


@query(_CLASSIFIED)
def classified_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        sinks.write_csv(_classified(spark, sf_dir), folder, order=["page_id"])
        return durable(readers.read_classified(spark, folder).select("page_id", "section_id", "is_index", "confidence", "needs_review"))


@query("SELECT c_name AS page_id, CASE WHEN c_custkey % 3 = 0 THEN 'third' WHEN c_custkey % 2 = 0 THEN 'second' ELSE 'first' END AS content_type FROM customer")
def result_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _classified(spark, sf_dir)
    k = F.substring("page_id", 10, 20).cast("long")
    with scratch(spark) as folder:
        for name, part in (("first", rows), ("second", rows.filter(k % 2 == 0)), ("third", rows.filter(k % 3 == 0))):
            sinks.append_log(part.withColumn("content_type", F.lit(name)), folder)
        return durable(readers.read_cache(spark, folder).select("page_id", "content_type"))


def _supplier_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.struct(F.concat("s_name", F.lit("-q01")).alias("id"), F.concat(F.lit("Balance of "), "s_name", F.lit("?")).alias("question"), F.format_string("%.2f", "s_acctbal").alias("answer"), F.lit("factual").alias("question_type"))
    return table(spark, sf_dir, "supplier").select(F.col("s_name").alias("page_id"), F.col("s_nationkey").cast("string").alias("section_id"), F.array(pair).alias("qa_pairs"), "s_suppkey")


_DOCUMENTS = "SELECT s_name AS page_id, CAST(s_nationkey AS VARCHAR) AS section_id, 'Balance of ' || s_name || '?' AS question, replace(s_name, '#', '_') || '.json' AS file_name, row_number() OVER (ORDER BY replace(s_name, '#', '_')) - 1 AS doc_ord FROM supplier"


@query(_DOCUMENTS)
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        sinks.write_documents(_supplier_documents(spark, sf_dir).drop("s_suppkey"), f"{folder}/there", sanitise=True)
        found = readers.first_with_json(spark, [f"{folder}/not there", folder, f"{folder}/there"])
        docs = readers.read_documents(spark, found, strict=True)
        return durable(docs.select("page_id", "section_id", F.col("qa_pairs")[0]["question"].alias("question"), "file_name", "doc_ord"))


@query("SELECT replace(s_name, '#', '_') AS key, s_name AS page_id FROM supplier WHERE s_suppkey % 10 <> 0")
def keyed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        _broken_documents(spark, sf_dir, folder)
        return durable(readers.read_keyed_documents(spark, folder, readers.QA_DOCUMENT).select("key", "page_id").filter("page_id is not null"))


@query("SELECT replace(s_name, '#', '_') || '.json' AS file_name FROM supplier WHERE s_suppkey % 10 = 0")
def skipped_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        _broken_documents(spark, sf_dir, folder)
        return durable(readers.skipped_documents(spark, folder))


def _broken_documents(spark: SparkSession, sf_dir: str, folder: str) -> None:
    docs = _supplier_documents(spark, sf_dir)
    sinks.write_documents(docs.filter("s_suppkey % 10 <> 0").drop("s_suppkey"), folder, sanitise=True)
    sinks.write_raw(docs.filter("s_suppkey % 10 = 0").select(F.replace("page_id", F.lit("#"), F.lit("_")).alias("key"), F.lit('{"page_id": ').alias("text")), folder, "key", "text", ".json")


_LINES = "l AS (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS ordinal FROM customer)"


@query(f"WITH {_LINES} SELECT ordinal, c_name AS page_id, 'What is ' || c_name || '?' AS question, c_mktsegment AS answer FROM l")
def jsonl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    rows = table(spark, sf_dir, "customer").orderBy("c_custkey").select(F.lit(None).cast("string").alias("image"), F.array(turn("user", F.concat(F.lit("What is "), "c_name", F.lit("?"))), turn("assistant", F.col("c_mktsegment"))).alias("conversations"), F.struct(F.col("c_name").alias("page_id")).alias("metadata"))
    with scratch(spark) as folder:
        sinks.write_jsonl(rows, folder)
        back = readers.read_jsonl(spark, folder)
        return durable(back.select("ordinal", "metadata.page_id", F.col("conversations")[0]["content"].alias("question"), F.col("conversations")[1]["content"].alias("answer")))


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'Missing required field: author' END AS error, CASE WHEN doc_id % 5 <> 0 AND doc_id % 3 = 0 THEN 'Empty required field: author' END AS warning, (SELECT count(*) FROM labels) AS n_lines FROM labels")
def jsonl_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    author = F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 3 == 0, "").otherwise("ann")
    with scratch(spark) as folder:
        sinks.write_jsonl(table(spark, sf_dir, "labels").select("doc_id", author.alias("author")), folder)
        found = readers.read_validated(spark, folder, "doc_id bigint, author string", ["doc_id", "author"])
        none = readers.read_validated(spark, f"{folder}/not there", "doc_id bigint, author string", ["doc_id", "author"])
        n = readers.count_jsonl(spark, folder)
        return durable(found.unionByName(none).select("doc_id", F.get("errors", F.lit(0)).alias("error"), F.get("warnings", F.lit(0)).alias("warning"), F.lit(n).cast("long").alias("n_lines")))


@query("SELECT CASE WHEN page_id % 3 = 0 THEN page_id || '-techspec.html' ELSE page_id || '.html' END AS name, page_id % 5 = 0 AS has_table FROM pages WHERE page_id % 3 = 0 OR page_id % 5 = 0 OR contains(lower(substr(html, 1, 10000)), '<table')")
def html_with_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages count by their names, or by a table that begins within the first 10,000 characters."""
    k = F.col("page_id")
    named = table(spark, sf_dir, "pages").select(F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit("-techspec"))).otherwise(k.cast("string")).alias("key"), F.when(k % 5 == 0, F.concat(F.repeat(F.lit("<p>"), F.lit(3000)), F.lit("<TABLE>"), "html")).when(k % 5 == 1, F.concat(F.repeat(F.lit("<p>"), F.lit(4000)), F.lit("<table>"))).otherwise(F.col("html")).alias("html"))
    with scratch(spark) as folder:
        sinks.write_raw(named, folder, "key", "html")
        return durable(readers.read_html(spark, folder).select(paths.basename("path").alias("name"), F.col("html").contains("<TABLE>").alias("has_table")))


@query(f"WITH {_FILES} SELECT file_path, CASE {_EXT} WHEN 'png' THEN 'image/png' WHEN 'gif' THEN 'image/gif' ELSE 'image/jpeg' END AS media_type, to_base64(encode(s_name)) AS data FROM f JOIN supplier USING (s_suppkey) WHERE {_EXT} IN ('jpg', 'png', 'gif')".replace("s_nationkey || '/'", "s_nationkey || '/'"))
def images_in_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        sinks.write_named(_files(spark, sf_dir), folder)
        found = media.encoded_images(readers.read_images(spark, folder))
        return durable(found.select(F.substring_index("path", "/", -2).alias("file_path"), "media_type", "data"))


def form_feeds(content: bytes) -> list[bytes]:
    """A stand-in for a rasteriser: pages of a text parted by form feeds; broken ones raise."""
    if content.startswith(b"broken"):
        raise ValueError("broken file")
    return content.split(b"\f")


_SOURCES = _FILES.replace("FROM supplier", "FROM supplier") + ", p AS (SELECT *, s_suppkey % 3 + 1 AS n_pages, s_suppkey % 4 = 0 AS broken, CASE WHEN s_suppkey % 2 = 0 THEN 'ok' ELSE '' END AS state FROM f)"


def _source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    png = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), F.lpad(F.hex(k + 10), 8, "0"), F.lit("00000020")))
    pdf = F.when(k % 4 == 0, F.encode(F.lit("broken"), "UTF-8")).otherwise(F.encode(F.concat_ws("\f", F.transform(F.sequence(F.lit(1), (k % 3 + 1).cast("int")), lambda n: n.cast("string"))), "UTF-8"))
    return _files(spark, sf_dir, F.when(_name().endswith("pdf"), pdf).when(k % 2 == 0, png).otherwise(F.lit(b"")))


def _prepared(spark: SparkSession, sf_dir: str, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sinks.write_named(_source_files(spark, sf_dir), folder)
    return stages.prepare(spark, durable(readers.scan_inventory(spark, folder)), folder, form_feeds, "now")


@query(f"""WITH {_SOURCES} SELECT file_path, file_type, section_dir, filename, '' AS original_source FROM p WHERE file_type = 'html' OR (file_type IN ('jpg', 'png') AND state = 'ok')
UNION ALL SELECT section_dir || '/' || s_suppkey || '/' || printf('%03d', i) || '.jpg', 'jpg', CAST(s_suppkey AS VARCHAR), printf('%03d', i) || '.jpg', file_path FROM (SELECT *, unnest(range(1, n_pages + 1)) AS i FROM p WHERE file_type = 'pdf' AND NOT broken)""")
def prepared_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        return durable(_prepared(spark, sf_dir, folder)[0])


@query(f"""WITH {_SOURCES}, l AS (SELECT 'pdf_convert' AS operation, CASE WHEN broken THEN 'failure' ELSE 'success' END AS status FROM p WHERE file_type = 'pdf'
UNION ALL SELECT 'image_validate', CASE WHEN state = 'ok' THEN 'success' ELSE 'failure' END FROM p WHERE file_type IN ('jpg', 'png') UNION ALL SELECT 'skip', 'skipped' FROM p WHERE file_type = 'html') SELECT operation, status, count(*) AS n FROM l GROUP BY ALL""")
def prepared_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        log = _prepared(spark, sf_dir, f"{folder}/sources")[1]
        sinks.write_csv(log, f"{folder}/log")
        return durable(stats.operation_summary(readers.read_csv(spark, f"{folder}/log", media.LOG)))


@query(f"WITH {_SOURCES} SELECT section_dir || '/' || s_suppkey || '/' || printf('%03d', i) || '.jpg' AS file_path, CAST(i AS VARCHAR) AS content FROM (SELECT *, unnest(range(1, n_pages + 1)) AS i FROM p WHERE file_type = 'pdf' AND NOT broken)")
def prepared_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        sinks.write_named(_prepared(spark, sf_dir, folder)[2], f"{folder}-pages")
        found = readers.read_images(spark, f"{folder}-pages")
        return durable(found.select(F.substring_index("path", "/", -3).alias("file_path"), F.decode("content", "UTF-8").alias("content")))


@query(f"WITH {_SOURCES} SELECT file_path, state = 'ok' AS ok, CASE WHEN state = 'ok' THEN '' ELSE 'File is empty' END AS error_message FROM p WHERE file_type IN ('jpg', 'png')")
def checked_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        sinks.write_named(_source_files(spark, sf_dir), folder)
        found = media.validate_images(readers.files_below(spark, folder, "*.{jpg,JPEG,png}"))
        return durable(found.select(F.substring_index("path", "/", -2).alias("file_path"), "ok", "error_message"))


@query("SELECT c_name AS page_id, CAST(confidence AS VARCHAR) AS confidence FROM (" + _CLASSIFIED.replace("SELECT c_name AS page_id", "SELECT c_name, c_custkey") + ") WHERE needs_review")
def review_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        pages = readers.typed_classification(_classified(spark, sf_dir))
        if not sinks.write_review_queue(pages.limit(0), f"{folder}/none") and not readers.exists(spark, f"{folder}/none"):
            sinks.write_review_queue(pages, f"{folder}/some")
        return durable(readers.read_csv(spark, f"{folder}/some", "page_id string, image_path string, content_type string, confidence string, secondary_types string").select("page_id", "confidence"))


@query("SELECT replace(c_name, '#', '-') AS remote, length(c_mktsegment) AS n FROM customer WHERE c_custkey % 10 = 0")
def upload_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").filter("c_custkey % 10 = 0").select(F.replace("c_name", F.lit("#"), F.lit("-")).alias("name"), F.col("c_mktsegment").alias("value"))
    with scratch(spark) as folder:
        sinks.write_named(rows, folder)
        files = spark.read.format("binaryFile").load(folder).select(readers.plain_path(F.col("path")).alias("path"), "length")
        return durable(sinks.upload_map(files.select("path"), readers.bare_root(folder)).join(files, F.col("local") == F.col("path")).select("remote", F.col("length").alias("n")))


@query("SELECT o_orderkey AS post_id, 'https://img.example.org/' || o_orderkey || '.jpg' AS url, CASE WHEN o_orderstatus = 'F' THEN 'images/' || o_orderkey ELSE '' END AS local_path, o_orderstatus = 'F' AS downloaded FROM orders")
def image_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("url", F.concat(F.lit("https://img.example.org/"), F.col("o_orderkey").cast("string"), F.lit(".jpg")))
    got = o.filter("o_orderstatus = 'F'").select("url", F.concat(F.lit("images/"), F.col("o_orderkey").cast("string")).alias("local_path"))
    return crawl.image_manifest(o.select("url", F.col("o_orderkey").alias("post_id"), F.col("o_custkey").alias("thread_id"), F.lit(1).alias("forum_id")), got).select("post_id", "url", "local_path", "downloaded")


@query("SELECT count(*) AS total_images, count(*) FILTER (o_orderstatus = 'F') AS downloaded, count(*) FILTER (o_orderstatus <> 'F') AS failed FROM orders")
def image_manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as folder:
        sinks.write_jsonl(image_manifest(spark, sf_dir), folder)
        return durable(crawl.manifest_totals(readers.read_jsonl_if_there(spark, folder, "url string, downloaded boolean")))


@query(f"WITH {_FILES} SELECT 'images/' || filename AS image, CASE WHEN s_suppkey % 3 = 0 THEN 'missing' ELSE 'made' END AS status FROM f")
def materialised_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For file systems that the workers mount, as local ones are."""
    with scratch(spark) as folder:
        sinks.write_named(_files(spark, sf_dir).filter("s_suppkey % 3 <> 0"), f"{folder}/from")
        own = readers.bare_root(folder)
        rows = _files(spark, sf_dir).select(F.concat(F.lit(f"{own}/from/"), "name").alias("source"), F.concat(F.lit("images/"), paths.basename("name")).alias("image"))
        return durable(sinks.materialise_images(rows, f"{own}/to", "copy").select("image", "status"))


@query("SELECT '| value | n | percent |' AS line UNION ALL SELECT '|---|---|---|' UNION ALL SELECT '| ' || o_orderpriority || ' | ' || count(*) || ' | ' || printf('%.2f', count(*) * 100.0 / (SELECT count(*) FROM orders)) || ' |' FROM orders GROUP BY o_orderpriority")
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = reports.md_table(stats.counts(table(spark, sf_dir, "orders"), "o_orderpriority"))
    return spark.createDataFrame([(line,) for line in text.split("\n")], "line string")


@query("SELECT unnest(['---', 'language: en', 'license: cc-by-nc-4.0', 'tags:', '- forum', '---', '', '# orders', '', '- train: ' || (SELECT count(*) FROM orders WHERE o_orderkey % 10 <> 0), '- val: ' || (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0), '', '| section_id | train | val |', '|---|---|---|']) AS line UNION ALL SELECT '| ' || o_orderstatus || ' | ' || count(*) FILTER (o_orderkey % 10 <> 0) || ' | ' || count(*) FILTER (o_orderkey % 10 = 0) || ' |' FROM orders GROUP BY o_orderstatus")
def dataset_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("section_id"), F.when(F.col("o_orderkey") % 10 == 0, "val").otherwise("train").alias("split"))
    return spark.createDataFrame([(line,) for line in reports.dataset_card("orders", rows, tags=("forum",)).rstrip("\n").split("\n")], "line string")


@query("SELECT * FROM (VALUES ('filters', 'min_answer', '3'), ('filters', 'max_answer', '500'), ('filters', 'question_mark', 'False'), ('output', 'ratio', '0.8'), ('output', 'seed', '42'), ('output', 'stratify_by', 'None'), ('deduplication', 'threshold', '0.95'), ('deduplication', 'strategy', 'first_seen'), ('vlm_validation', 'check_images', 'False'), ('vlm_validation', 'min_answer', '5'), ('upload', 'message', 'Second version')) t(stage, name, value)")
def settings_of_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = {"filters": {"min_answer_length": 3}, "output": {"train_split": 0.7, "stratify_by": "none"}, "deduplication": {"similarity_threshold": 0.95}, "upload": {"commit_message": "First version"}}
    more = {"filters": {"require_question_mark": False}, "output": {"train_split": 0.8}, "deduplication": {"prefer_strategy": "first_seen"}, "vlm_validation": {"check_image_exists": False}, "upload": {"commit_message": "Second version"}}
    raw = config.layered(base, more)
    shown = {"filters": ("min_answer", "max_answer", "question_mark"), "output": ("ratio", "seed", "stratify_by"), "deduplication": ("threshold", "strategy"), "vlm_validation": ("check_images", "min_answer"), "upload": ("message",)}
    return spark.createDataFrame([(stage, name, str(getattr(config.stage_settings(raw, stage), name))) for stage, names in shown.items() for name in names], "stage string, name string, value string")


@query("SELECT event_id AS qa_id, 'answer_too_short' AS rejection_reason, 'answer_length' AS filter_name FROM events WHERE event_type = 'click'")
def rejection_log_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("qa_id"), F.col("user_id").cast("string").alias("page_id"), F.lit('What is a "torque", in detail?').alias("question"), F.when(F.col("event_type") == "click", "short").otherwise("It is a moment of force.").alias("answer"), F.lit("factual").alias("question_type"))
    v = rules.first_failure()
    marked = rows.withColumns({"v": v}).withColumns({"filter_name": F.col("v.filter_name"), "reason": F.col("v.reason"), "similar_to": F.lit(None).cast("string"), "similarity": F.lit(None).cast("double")})
    with scratch(spark) as folder:
        sinks.append_log(rules.rejection_log(marked, "now"), folder)
        back = readers.read_csv(spark, folder, "timestamp string, page_id string, qa_id bigint, question string, answer string, rejection_reason string, filter_name string")
        return durable(back.select("qa_id", "rejection_reason", "filter_name"))


@query("SELECT user_id AS post_id, count(*) > 0 AS there FROM events GROUP BY 1")
def ingested_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of several files, many of them repeated, streamed into a table in batches, then streamed again without the checkpoint."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("post_id"), F.col("event_type").alias("text"))
    with scratch(spark) as folder:
        rows.repartition(6).write.json(f"{folder}/in")
        for checkpoint in ("first", "first", "lost"):
            ingest.append_new(ingest.new_files(spark, f"{folder}/in", "post_id bigint, text string", 2), "post_id", f"{folder}/out", f"{folder}/{checkpoint}").awaitTermination()
        return durable(spark.read.parquet(f"{folder}/out").select("post_id", F.col("text").isNotNull().alias("there")))


@query("SELECT s_suppkey AS item_id FROM supplier WHERE s_suppkey % 3 <> 0 OR s_suppkey % 2 = 1")
def work_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items not completed: every third was, but of those the odd ones failed later."""
    items = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("item_id"))
    with scratch(spark) as folder:
        ingest.record_progress(items.filter("item_id % 3 = 0"), "posts", folder)
        ingest.record_progress(items.filter("item_id % 3 = 0 and item_id % 2 = 1"), "posts", folder, "failed")
        ingest.record_progress(items, "threads", folder)
        return durable(ingest.remaining(items, ingest.read_progress(spark, folder, "posts")))


@query("SELECT 'posts' AS stage, count(*) FILTER (s_suppkey % 3 = 0 AND s_suppkey % 2 = 0) AS completed, count(*) FILTER (s_suppkey % 3 = 0 AND s_suppkey % 2 = 1) AS failed FROM supplier UNION ALL SELECT 'threads', count(*), 0 FROM supplier")
def progress_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("item_id"))
    with scratch(spark) as folder:
        ingest.record_progress(items.filter("item_id % 3 = 0"), "posts", folder)
        ingest.record_progress(items.filter("item_id % 3 = 0 and item_id % 2 = 1"), "posts", folder, "failed")
        ingest.record_progress(items, "threads", folder)
        return durable(ingest.progress_summary(spark, folder).select("stage", "completed", "failed"))


@query("SELECT flat AS image, count(*) AS n FROM (SELECT DISTINCT 'sec_' || ((p_partkey // 2) % 50) || '_x.jpg' AS flat, CASE WHEN p_partkey % 2 = 0 THEN 'sec/' || ((p_partkey // 2) % 50) || '/x.jpg' ELSE 'sec_' || ((p_partkey // 2) % 50) || '/x.jpg' END AS path FROM part) GROUP BY 1 HAVING count(*) > 1")
def image_name_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = (F.floor(F.col("p_partkey") / 2) % 50).cast("string")
    path = F.concat(F.lit("sec"), F.when(F.col("p_partkey") % 2 == 0, "/").otherwise("_"), k, F.lit("/x.jpg"))
    return emit.name_collisions(table(spark, sf_dir, "part").select(path.alias("image_path")))

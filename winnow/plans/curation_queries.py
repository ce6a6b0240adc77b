"""Queries over rules, records, indices, model answers and paths, on pairs that are made from the driver's tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonx, paths, text
from ..operators import dedup, emit, generate, index, rules, similarity, split, stats, validate
from . import stages
from .registry import query, table


def _text(*parts: Column | str) -> Column:
    """Columns and plain pieces of text, joined."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _case(k: Column, n: int, values: dict[int, Column | str | None], default: Column | str) -> Column:
    out = F.lit(default) if isinstance(default, str) else default
    for i, v in values.items():
        out = F.when(k % n == i, F.lit(v) if v is None or isinstance(v, str) else v).otherwise(out)
    return out


# --- rules -------------------------------------------------------------------------------------

#: Every rule is broken by some pairs, some of them by pairs that break a later rule too; the others meet in their page.
_PAIRS = """p AS (SELECT event_id, 'u' || user_id AS page_id, 'e' || event_id AS qa_id, event_id % 97 AS part, CASE event_id % 12
  WHEN 0 THEN 'answer_too_short' WHEN 1 THEN 'answer_too_long' WHEN 2 THEN 'question_too_short' WHEN 3 THEN 'missing_question_mark' WHEN 4 THEN 'generic_answer: typically'
  WHEN 5 THEN 'self_referential: in this image' WHEN 6 THEN 'invalid_question_type: weird' WHEN 7 THEN 'answer_too_short' WHEN 8 THEN 'missing_question_mark' END AS broken FROM events),
s AS (SELECT *, CASE WHEN broken IS NULL THEN first_value(qa_id) OVER (PARTITION BY page_id, part, broken IS NULL ORDER BY event_id) END AS kept FROM p),
m AS (SELECT *, CASE WHEN broken IS NOT NULL THEN CASE event_id % 12 WHEN 0 THEN 'answer_length' WHEN 1 THEN 'answer_length' WHEN 2 THEN 'question_length' WHEN 3 THEN 'question_format' WHEN 4 THEN 'generic_answer' WHEN 5 THEN 'self_referential' WHEN 6 THEN 'question_type' WHEN 7 THEN 'answer_length' ELSE 'question_format' END
  WHEN kept <> qa_id THEN 'question_similarity' END AS filter_name FROM s)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    n = k % 97
    plain = _text("Which torque does part n", n, " need m", n, " o", n, " p", n)
    question = _case(k, 12, {2: "Why so?", 3: plain, 5: "What is shown in this image of the part?", 7: "Why", 8: plain}, F.concat(plain, F.lit("?")))
    answer = _case(k, 12, {0: "  Short.   ", 1: F.repeat(F.lit("long "), F.lit(120)), 4: "It is TYPICALLY 25 Nm, usually.", 7: "No", 8: "I cannot see it, not visible."}, "It takes 25 Nm in all.")
    return table(spark, sf_dir, "events").select(_text("u", F.col("user_id")).alias("page_id"), k.alias("pair_ord"), _text("e", k).alias("qa_id"), question.alias("question"), answer.alias("answer"), _case(k, 12, {6: "weird", 9: None}, "factual").alias("question_type"))


@query(f"WITH {_PAIRS} SELECT qa_id, filter_name, CASE WHEN broken IS NOT NULL THEN broken WHEN kept <> qa_id THEN 'question_similarity' END AS reason, CASE WHEN kept <> qa_id THEN kept END AS similar_to, CASE WHEN kept <> qa_id THEN 1.0::DOUBLE END AS similarity FROM m")
def rules_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(_pairs(spark, sf_dir)).select("qa_id", "filter_name", "reason", "similar_to", "similarity")


@query(f"WITH {_PAIRS} SELECT filter_name, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM m WHERE filter_name IS NOT NULL GROUP BY 1")
def rejections_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rejection_counts(rules.apply_rules(_pairs(spark, sf_dir))).withColumn("percent", F.round("percent", 6))


@query(f"WITH {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY filter_name ORDER BY page_id, event_id) AS sample FROM m WHERE filter_name IS NOT NULL) SELECT filter_name, sample, qa_id FROM r WHERE sample <= 5")
def samples_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rejection_samples(rules.apply_rules(_pairs(spark, sf_dir))).select("filter_name", F.col("sample").cast("long").alias("sample"), "qa_id")


@query(f"WITH {_PAIRS} SELECT qa_id, CASE WHEN kept <> qa_id THEN 'question_similarity: 1.00 with ' || kept ELSE broken END AS rejection_reason, filter_name FROM m WHERE filter_name IS NOT NULL")
def rejections_for_the_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rejection_log(rules.apply_rules(_pairs(spark, sf_dir)), "now").select("qa_id", "rejection_reason", "filter_name")


@query("""SELECT event_id, event_id % 6 NOT IN (0, 1, 5) AS ok, CASE event_id % 6 WHEN 0 THEN 'Question too short or missing' WHEN 1 THEN 'Answer too short or missing' WHEN 2 THEN 'Question doesn''t end with ''?''' WHEN 3 THEN 'Answer ends with ''?'' (may be a question)'
WHEN 4 THEN 'Potential hedge/hallucination: ''typically''|Self-referential question: ''on this page''' ELSE 'Invalid question_type: missing link' END AS warnings FROM events""")
def findings_at_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    question = _case(k, 6, {0: "Too short", 2: "What is the torque here", 4: "What is on this page?"}, "What is the torque here?")
    answer = _case(k, 6, {1: "No.", 3: "Is it 25 Nm?", 4: "Typically 25 Nm. I CANNOT SEE more."}, "It is 25 Nm.")
    rows = table(spark, sf_dir, "events").select("event_id", question.alias("question"), answer.alias("answer"), _case(k, 6, {5: "missing link"}, "factual").alias("question_type"))
    return rules.route_generated(rows).select("event_id", F.col("valid").alias("ok"), F.array_join("_warnings", "|").alias("warnings"))


@query("SELECT event_id, event_id % 3 = 0 AS valid FROM events")
def strict_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").select("event_id", _case(k, 3, {1: "What is the torque here"}, "What is the torque here?").alias("question"), _case(k, 3, {2: "It is usually 25 Nm."}, "It is 25 Nm.").alias("answer"), F.lit("factual").alias("question_type"))
    return rules.route_generated(rows, strict=True).select("event_id", "valid")


# --- documents, records, images ----------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document for each nation with its customers as pairs; every fifth answer is missing, every fourth image too."""
    k = F.col("c_custkey")
    pair = F.struct(k.alias("o"), F.struct(F.col("c_name").alias("id"), F.concat(F.lit("Segment of "), "c_name", F.lit("?")).alias("question"), F.when(k % 5 != 0, F.col("c_mktsegment")).alias("answer"), F.lit("factual").alias("question_type")).alias("p"))
    docs = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["p"]).alias("qa_pairs"))
    image = F.when(F.col("c_nationkey") % 4 != 0, _text("img/", F.col("c_nationkey"), ".jpg"))
    return docs.select(_text("n", F.col("c_nationkey")).alias("page_id"), image.alias("image_path"), F.when(F.col("c_nationkey") % 3 != 0, F.col("c_nationkey").cast("string")).alias("section_id"), F.lit("service_manual").alias("source_type"), F.col("c_nationkey").alias("doc_ord"), "qa_pairs")


_ROWS = "SELECT *, 'n' || c_nationkey AS page_id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pair_ord, CASE WHEN c_nationkey % 4 <> 0 THEN 'img/' || c_nationkey || '.jpg' END AS image_path FROM customer"


@query(f"SELECT page_id, c_name AS qa_id, CAST(pair_ord AS INTEGER) AS pair_ord, 'Segment of ' || c_name || '?' AS question, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS answer, image_path, CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS section_id, '' AS content_type FROM ({_ROWS})")
def flat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emit.flatten_pairs(_documents(spark, sf_dir)).select("page_id", "qa_id", "pair_ord", "question", "answer", "image_path", "section_id", "content_type")


@query(f"SELECT c_name AS qa_id, CASE WHEN c_nationkey % 4 <> 0 AND c_nationkey % 2 = 1 THEN 'images/img_' || c_nationkey || '.jpg' END AS image FROM ({_ROWS})")
def records_with_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose image path has no image are emitted without one."""
    rows = emit.flatten_pairs(_documents(spark, sf_dir))
    files = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 1").select(_text("img/", F.col("n_nationkey"), ".jpg").alias("path"))
    images, _ = stages.with_images(rows, files, "images")
    return emit.emit_records(rows, images).select("metadata.qa_id", "image")


@query(f"SELECT count(image_path) AS with_image, count(DISTINCT image_path) AS distinct_images, count(*) FILTER (image_path IS NULL) AS text_only FROM ({_ROWS})")
def image_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.image_counts(emit.flatten_pairs(_documents(spark, sf_dir)))


@query(f"SELECT DISTINCT image_path FROM ({_ROWS}) WHERE image_path IS NOT NULL")
def images_of_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.distinct_images(emit.flatten_pairs(_documents(spark, sf_dir)))


@query("SELECT image_path, source FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'a/' || p_partkey || '.jpg' WHEN 1 THEN 'data_src/b/' || p_partkey || '.jpg' WHEN 2 THEN 'gone/' || p_partkey || '.jpg' ELSE 'none/' || p_partkey || '.gif' END AS image_path, CASE p_partkey % 4 WHEN 0 THEN 'a/' || p_partkey || '.jpg' WHEN 1 THEN 'b/' || p_partkey || '.jpg' WHEN 2 THEN 'y/' || p_partkey || '.jpg' END AS source FROM part)")
def resolved_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    part = table(spark, sf_dir, "part")
    wanted = part.select(_case(k, 4, {0: _text("a/", k, ".jpg"), 1: _text("data_src/b/", k, ".jpg"), 2: _text("gone/", k, ".jpg")}, _text("none/", k, ".gif")).alias("image_path"))
    there = part.select(F.explode(F.when(k % 4 == 0, F.array(_text("a/", k, ".jpg"))).when(k % 4 == 1, F.array(_text("b/", k, ".jpg"))).when(k % 4 == 2, F.array(_text("z/", k, ".jpg"), _text("y/", k, ".jpg"))).otherwise(F.array(_text("c/", k, ".jpg")))).alias("path"))
    return emit.resolve_images(wanted, there)


@query("""SELECT s_suppkey AS ordinal, CASE WHEN s_suppkey % 5 = 0 THEN 'Image not found: images/' || s_suppkey || '.png' WHEN s_suppkey % 7 = 0 THEN 'Image not readable: images/' || s_suppkey || '.png' END AS image_error,
CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0 AND s_suppkey + 10 < 100 THEN 'Image too small: ' || (s_suppkey + 10) || 'x120' END AS image_warning FROM supplier WHERE s_suppkey % 11 <> 0 UNION ALL SELECT s_suppkey, NULL, NULL FROM supplier WHERE s_suppkey % 11 = 0""")
def findings_on_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier")
    png = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), F.lpad(F.hex(k + 10), 8, "0"), F.lit("00000078")))
    files = rows.filter(k % 5 != 0).select(_text("images/", k, ".png").alias("path"), F.when(k % 7 == 0, F.encode(F.lit("junk"), "UTF-8")).otherwise(png).alias("content"))
    records = rows.select(k.alias("ordinal"), F.when(k % 11 != 0, _text("images/", k, ".png")).alias("image"))
    return validate.image_findings(records, validate.with_image_size(files)).select("ordinal", "image_error", "image_warning")


@query("WITH m AS (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'error' WHEN s_suppkey % 7 = 0 THEN 'error' WHEN s_suppkey + 10 < 100 THEN 'warning' END AS level FROM supplier) SELECT level, count(*) AS n FROM m WHERE level IS NOT NULL GROUP BY 1")
def image_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier")
    png = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), F.lpad(F.hex(k + 10), 8, "0"), F.lit("00000078")))
    files = rows.filter(k % 5 != 0).select(_text("images/", k, ".png").alias("path"), F.when(k % 7 == 0, F.encode(F.lit("junk"), "UTF-8")).otherwise(png).alias("content"))
    found = stages.check_images(rows.select(F.lit("train").alias("split"), k.alias("ordinal"), _text("images/", k, ".png").alias("image")), files)
    return found.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("WITH r AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS ordinal FROM (SELECT DISTINCT conv_id FROM conversations)) SELECT CASE WHEN conv_id % 2 = 0 THEN 'train' ELSE 'val' END || '[' || conv_id || ']: Empty conversations list' AS message FROM r WHERE conv_id % 3 = 0")
def empty_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("conv_id")
    none = F.array().cast(validate.TURNS)
    rows = table(spark, sf_dir, "conversations").select("conv_id").distinct().filter(k % 3 == 0).select(F.when(k % 2 == 0, "train").otherwise("val").alias("split"), k.alias("ordinal"), F.when(k % 2 == 0, none).alias("turns"))
    return validate.labelled(rows.withColumn("errors", validate.order_errors(F.col("turns"))), "split", "errors").select("message")


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Missing required field: author' WHEN doc_id % 4 = 1 THEN 'Empty required field: author' END AS author_finding, CASE WHEN doc_id % 6 = 0 THEN 'Missing required field: title' END AS title_finding, 'Missing required field: absent' AS absent_finding FROM documents")
def fields_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, "").otherwise("ann").alias("author"), F.when(k % 6 != 0, F.col("lang")).alias("title"))
    f = validate.field_findings(rows, ["author", "title", "absent"])
    every = F.concat("errors", "warnings")
    about = lambda c: F.get(F.filter(every, lambda m: m.endswith(f": {c}")), F.lit(0))
    return f.select("doc_id", about("author").alias("author_finding"), about("title").alias("title_finding"), about("absent").alias("absent_finding"))


# --- indices -----------------------------------------------------------------------------------


@query("""WITH p AS (SELECT c_name AS code, c_mktsegment AS name, c_custkey % 100 AS s FROM customer), g AS (SELECT s, list(code ORDER BY code) AS codes, list(name ORDER BY code) AS names FROM p GROUP BY 1)
SELECT s_suppkey, coalesce(array_to_string(codes, ','), '') AS codes, coalesce(array_to_string(names, ','), '') AS names FROM supplier LEFT JOIN g ON s = s_suppkey AND s_suppkey % 7 <> 0""")
def index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are found by their id without leading zeros, every third by its id as it is, every seventh not at all."""
    c = table(spark, sf_dir, "customer")
    s = F.col("c_custkey") % 100
    listed = c.select(_text("2", s % 5, "-part-group").alias("section"), F.col("c_name").alias("code"), F.col("c_mktsegment").alias("name"), F.array(_text("2", s % 5, "-", s), _text("raw_", s)).alias("pages"))
    k = F.col("s_suppkey")
    page = F.when(k % 7 == 0, _text("other-", k)).when(k % 3 == 0, _text("raw_", k)).otherwise(_text("2", k % 5, "-00", k))
    pages = table(spark, sf_dir, "supplier").select("s_suppkey", page.alias("page_id"), _text("2", k % 5).alias("section_id"), F.lit("Part Group").alias("section_name"))
    return index.with_procedures(pages, listed).select("s_suppkey", F.array_join("procedures_covered", ",").alias("codes"), F.array_join("procedures_names", ",").alias("names"))


def index_answers(asked: list[dict]) -> list[str | None]:
    """A stand-in for a model that reads index pages: their file names tell it all."""
    out: list[str | None] = []
    for a in asked:
        k = int(a["filename"].split(".")[0])
        said = json.dumps({"section_id": "2", "section_name": "Group", "procedures": [{"code": f"c{k % 20}", "name": f"n{k % 3}", "page": str(k)}, {"code": "", "name": "none", "page": "0"}]})
        out.append(None if k % 11 == 0 else "no JSON" if k % 7 == 0 else f"```json\n{said}\n```")
    return out


_ENTRIES = "e AS (SELECT s_nationkey % 3 AS section, s_suppkey || '.jpg' AS f, 'c' || (s_suppkey % 20) AS code, 'n' || (s_suppkey % 3) AS name, CAST(s_suppkey AS VARCHAR) AS page FROM supplier WHERE s_suppkey % 7 <> 0 AND s_suppkey % 11 <> 0)"


@query(f"WITH {_ENTRIES}, n AS (SELECT *, first_value(name) OVER (PARTITION BY section, code ORDER BY f) AS first_name FROM e) SELECT 's' || section AS section, '2' AS section_id, 'Group' AS section_name, code, first_name AS name, array_to_string(list_sort(list_distinct(list(page))), ',') AS pages FROM n GROUP BY section, code, first_name")
def section_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "supplier").select(_text("s", F.col("s_nationkey") % 3).alias("section_dir"), _text(F.col("s_suppkey"), ".jpg").alias("filename"))
    merged = stages.section_indices(pages, index_answers)
    return merged.select("section", "section_id", "section_name", F.inline("procedures")).withColumn("pages", F.array_join("pages", ","))


@query(f"WITH {_ENTRIES}, n AS (SELECT *, first_value(name) OVER (PARTITION BY section, code ORDER BY f) AS first_name FROM e) SELECT 's' || section AS section, count(DISTINCT f) AS n_pages, count(*) FILTER (name <> first_name) AS n_warnings, array_to_string(list_sort(list_distinct(list(page))), ',') AS pages FROM n GROUP BY section")
def section_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "supplier").select(_text("s", F.col("s_nationkey") % 3).alias("section_dir"), _text(F.col("s_suppkey"), ".jpg").alias("filename"))
    merged = stages.section_indices(pages, index_answers)
    return merged.select("section", F.size("index_pages").cast("long").alias("n_pages"), F.size("merge_warnings").cast("long").alias("n_warnings"), F.array_join(F.array_sort(F.map_keys("page_to_procedures")), ",").alias("pages"))


# --- paths and names ---------------------------------------------------------------------------


@query("""WITH n AS (SELECT p_partkey, p_partkey % 4 AS k, CASE p_partkey % 4 WHEN 0 THEN '21 - Clutch  Parts!' WHEN 1 THEN 'Getrag265' WHEN 2 THEN 'Electrical Troubleshooting' ELSE 'Bosch Motronic - ECU' END AS section FROM part)
SELECT p_partkey, section AS parent, CASE k WHEN 0 THEN '21-' || p_partkey WHEN 1 THEN CAST(p_partkey AS VARCHAR) WHEN 2 THEN 'a-INDEX-' || p_partkey ELSE 'toc.' || p_partkey END AS stem,
CASE k WHEN 0 THEN 'service_manual' WHEN 1 THEN 'service_manual' WHEN 2 THEN 'electrical_manual' ELSE 'ecu_technical' END AS source_type, k = 2 AS is_index,
CASE k WHEN 0 THEN '21-clutch-parts' WHEN 1 THEN 'getrag265' WHEN 2 THEN 'electrical-troubleshooting' ELSE 'bosch-motronic-ecu' END AS slug,
CASE k WHEN 0 THEN '21-' || p_partkey || '_clutch-p' WHEN 1 THEN 'getrag-' || p_partkey WHEN 2 THEN 'electrical-troubleshooting-a-INDEX-' || p_partkey ELSE 'bosch-motronic-ecu-toc.' || p_partkey END AS page_id,
CASE k WHEN 0 THEN '21' WHEN 1 THEN 'getrag265' WHEN 2 THEN 'electrical' ELSE 'bosch' END AS section_id, CASE k WHEN 0 THEN 'Clutch  Parts!' ELSE section END AS section_name FROM n""")
def names_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    section = _case(k, 4, {0: "21 - Clutch  Parts!", 1: "Getrag265", 2: "Electrical Troubleshooting"}, "Bosch Motronic - ECU")
    path = F.concat(F.lit("data/"), section, F.lit("/"), _case(k, 4, {0: _text("21-", k), 1: k.cast("string"), 2: _text("a-INDEX-", k)}, _text("toc.", k)), F.lit(".jpg"))
    p = table(spark, sf_dir, "part").select("p_partkey", paths.parent_name(path, "data").alias("parent"), paths.basename(path).alias("f"))
    return p.select("p_partkey", "parent", paths.stem("f").alias("stem"), paths.source_type("parent", "f").alias("source_type"), paths.is_index_page("f").alias("is_index"), paths.section_slug("parent").alias("slug"), paths.page_id("f", "parent").alias("page_id"), paths.section_id("parent").alias("section_id"), paths.section_name("parent").alias("section_name"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '21-' || p_partkey WHEN 1 THEN '21-00' || p_partkey || '-x' ELSE 'plain' || p_partkey END AS normal, '2' || p_partkey || '-' || replace(lower(p_name), ' ', '-') AS slug,
'a_b_' || p_partkey || '_c.jpg' AS flat, 'a_é-' || p_partkey || '__' AS safe, CASE p_partkey % 6 WHEN 0 THEN 'M3' WHEN 1 THEN '320is' WHEN 2 THEN '325is' WHEN 3 THEN '325i' WHEN 4 THEN '318i' ELSE 'E30' END AS model FROM part""")
def names_made_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    page = _case(k, 3, {0: _text("21-00", k), 1: _text("21-00", k, "-x")}, _text("plain", k))
    file = _case(k, 6, {0: "M3-318i-specs.html", 1: "x320IS.html", 2: "325is.html", 3: "my-325i-car.html", 4: "318i.html"}, "e30.html")
    return table(spark, sf_dir, "part").select(
        "p_partkey", paths.normal_page_id(page).alias("normal"), paths.derived_slug(_text("2", k), F.concat("p_name", F.lit("!"))).alias("slug"),
        text.flat_image_name(_text("/a//b:", k, " \t?c.jpg")).alias("flat"), text.safe_filename(_text("a é-", k, "/.")).alias("safe"), paths.model_of(file).alias("model"),
    )


# --- answers of models -------------------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 0 ELSE 2 END AS n, CASE WHEN o_orderkey % 4 <> 3 THEN 'What is ' || o_orderkey || '?' END AS question, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderstatus END AS answer FROM orders")
def pairs_in_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    listed = _text('[{"question": "What is ', k, '?", "answer": "', F.col("o_orderstatus"), '", "question_type": "factual"}, {"question": "b [x]?", "answer": "c"}]')
    said = _case(k, 4, {0: listed, 1: F.concat(F.lit("```json\n"), listed, F.lit("\n```")), 2: F.concat(F.lit("Here they are: "), listed, F.lit(" I hope this helps."))}, "[ no list")
    found = table(spark, sf_dir, "orders").select("o_orderkey", jsonx.parse_list(said).alias("p"))
    return found.select("o_orderkey", F.size("p").alias("n"), F.get("p", F.lit(0))["question"].alias("question"), F.get("p", F.lit(0))["answer"].alias("answer"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderpriority END AS strict_type, CASE o_orderkey % 3 WHEN 0 THEN o_orderpriority WHEN 2 THEN o_orderpriority ELSE 'unknown' END AS first_type, CASE o_orderkey % 3 WHEN 0 THEN 0.75::DOUBLE WHEN 2 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS first_confidence,
CASE WHEN o_orderkey % 3 = 0 THEN '["a","b"]' ELSE '[]' END AS secondary FROM orders""")
def verdicts_in_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole objects, fenced or not; and the first braces of any answer. An object in an object ends at the first brace, and is unknown."""
    k = F.col("o_orderkey")
    kind = F.col("o_orderpriority")
    whole = _text('{"content_type": "', kind, '", "confidence": 0.75, "secondary_types": ["a", "b"]}')
    nested = _text('```\n{"x": {"y": 1}, "content_type": "', kind, '", "confidence": 0.5}\n```')
    said = _case(k, 3, {0: whole, 1: nested}, _text('I say {"content_type": "', kind, '", "confidence": 0.5} and no more'))
    found = table(spark, sf_dir, "orders").select("o_orderkey", jsonx.parse_object(said).alias("v"), jsonx.parse_first_object(said).alias("w"))
    return found.select("o_orderkey", F.col("v.content_type").alias("strict_type"), F.col("w.content_type").alias("first_type"), F.col("w.confidence").alias("first_confidence"), jsonx.list_json(F.when(F.col("o_orderkey") % 3 == 0, F.col("v.secondary_types"))).alias("secondary"))


@query("""WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'procedure' WHEN 1 THEN 'specification' WHEN 2 THEN 'index' ELSE 'photo' END AS t, CASE p_partkey % 4 WHEN 0 THEN 12 WHEN 1 THEN 10 WHEN 2 THEN 6 ELSE 8 END AS n, CASE WHEN p_partkey % 8 = 0 THEN 'Procedures that the index lists for this page:' || chr(10) || '- c1: Remove' || chr(10) || '- c2: Fit' WHEN p_partkey % 4 = 1 THEN 'Read the values off the tables, and name the unit of each.' ELSE '' END AS c FROM part)
SELECT p_partkey, n, 'Write ' || n || ' question and answer pairs about ' || CASE t WHEN 'procedure' THEN 'the work steps, tools and cautions on this page of Clutch.' WHEN 'specification' THEN 'the values on this page of Clutch; give each with its unit.' WHEN 'index' THEN 'where in Clutch its procedures are found.' ELSE 'this page of Clutch.' END || chr(10) || c AS prompt FROM p""")
def prompts_for_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    kind = _case(k, 4, {0: "procedure", 1: "specification", 2: "index"}, "photo")
    codes = F.when(k % 8 == 0, F.array(F.lit("c1"), F.lit("c2"))).otherwise(F.array().cast("array<string>"))
    names = F.when(k % 8 == 0, F.array(F.lit("Remove"), F.lit("Fit"), F.lit("Check"))).otherwise(F.array().cast("array<string>"))
    n = generate.questions_for(kind)
    return table(spark, sf_dir, "part").select("p_partkey", n.alias("n"), generate.prompt(F.lit("service_manual"), kind, F.lit("Clutch"), n, generate.context_block(kind, codes, names)).alias("prompt"))


def page_answers(asked: list[dict]) -> list[str | None]:
    """A stand-in for a model that classifies pages."""
    return [None if int(a["filename"][1:-4]) % 5 == 0 else "what?" if int(a["filename"][1:-4]) % 5 == 1 else json.dumps({"content_type": "text", "confidence": int(a["filename"][1:-4]) % 100 / 100}) for a in asked]


@query("""WITH f AS (SELECT s_suppkey, s_suppkey % 4 = 0 AS is_index FROM supplier) SELECT s_suppkey, is_index, CASE WHEN is_index THEN 'index' WHEN s_suppkey % 5 < 2 THEN 'unknown' ELSE 'text' END AS content_type, CASE WHEN is_index THEN 0.95::DOUBLE WHEN s_suppkey % 5 < 2 THEN 0.3::DOUBLE ELSE s_suppkey % 100 / 100.0::DOUBLE END AS confidence,
CASE WHEN is_index THEN false WHEN s_suppkey % 5 < 2 THEN true ELSE s_suppkey % 100 / 100.0::DOUBLE < 0.7 END AS needs_review FROM f""")
def pages_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    pages = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 4 == 0, _text("a-index-", k, ".jpg")).otherwise(_text("p", k, ".jpg")).alias("filename"))
    return generate.classify(pages, page_answers).select("s_suppkey", "is_index", "content_type", "confidence", "needs_review")


def pair_answers(asked: list[dict]) -> list[str | None]:
    """A stand-in for a model that writes pairs: three, of which one has no answer to speak of; none at all for some pages."""
    out: list[str | None] = []
    for a in asked:
        k = int(a["page_id"][1:])
        pairs = [{"question": f"What is part {i} of page {k}?", "answer": "No." if i == 2 else f"It is part {i}.", "question_type": "factual"} for i in (1, 2, 3)]
        out.append(None if k % 7 == 0 else json.dumps(pairs))
    return out


_ASKED = "a AS (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0 AND s_suppkey % 10 <> 9)"


@query(f"WITH {_ASKED} SELECT 'p' || s_suppkey AS page_id, 'p' || s_suppkey || '-q0' || i AS id, 'What is part ' || i || ' of page ' || s_suppkey || '?' AS question FROM a, (VALUES (1), (3)) v(i) WHERE s_suppkey % 7 <> 0")
def pairs_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generated(spark, sf_dir).docs.select("page_id", F.inline("qa_pairs")).select("page_id", "id", "question")


@query(f"WITH {_ASKED} SELECT 'p' || s_suppkey AS page_id, 'failed' AS what, 'no answer' AS why FROM a WHERE s_suppkey % 7 = 0 UNION ALL SELECT 'p' || s_suppkey, 'rejected', 'Answer too short or missing' FROM a WHERE s_suppkey % 7 <> 0 UNION ALL SELECT 'p' || s_suppkey, 'skipped', CASE WHEN s_suppkey % 3 = 0 THEN 'Output file already exists' ELSE 'Content type ''blank'' is in skip list' END FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey % 10 = 9")
def pages_without_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _generated(spark, sf_dir)
    out = made.failed.select("page_id", F.lit("failed").alias("what"), F.col("error").alias("why"))
    out = out.unionByName(made.rejected.select("page_id", F.lit("rejected").alias("what"), F.array_join("_warnings", "|").alias("why")))
    return out.unionByName(made.skipped.select("page_id", F.lit("skipped").alias("what"), F.col("reason").alias("why")))


def _generated(spark: SparkSession, sf_dir: str) -> stages.Generated:
    """Every third page is done already, some are blank."""
    k = F.col("s_suppkey")
    pages = table(spark, sf_dir, "supplier").select(_text("p", k).alias("page_id"), _text("img/", k, ".jpg").alias("image_path"), F.lit("21").alias("section_id"), F.lit("Clutch").alias("section_name"), F.lit("service_manual").alias("source_type"), F.when(k % 10 == 9, "blank").otherwise("procedure").alias("content_type"))
    none = spark.createDataFrame([], "section string, code string, name string, pages array<string>")
    return stages.generate_pairs(pages, none, pages.filter(F.substring("page_id", 2, 20).cast("long") % 3 == 0), pair_answers, "now")


@query("SELECT CASE WHEN place <= 5 THEN 'asked' ELSE 'Budget is spent' END AS state, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY s_name) AS place FROM supplier) GROUP BY 1")
def pages_within_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is reckoned at 1.8 cents: the fifth uses up nine cents."""
    pages = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("page_id"), F.lit("x").alias("image_path"), F.lit("21").alias("section_id"), F.lit("Clutch").alias("section_name"), F.lit("service_manual").alias("source_type"), F.lit("procedure").alias("content_type"))
    none = spark.createDataFrame([], "section string, code string, name string, pages array<string>")
    made = stages.generate_pairs(pages, none, pages.limit(0), None, "now", budget=0.089)
    states = made.failed.select(F.lit("asked").alias("state")).unionByName(made.skipped.select(F.col("reason").alias("state")))
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, value / 1000 AS cost_usd FROM events WHERE value / 1000 > 0.01")
def costly_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.cost_warnings(table(spark, sf_dir, "events").select("event_id", (F.col("value") / 1000).alias("cost_usd")), 0.01)


@query("SELECT CAST(sum(user_id) AS BIGINT) AS tokens_input, CAST(sum(event_id) AS BIGINT) AS tokens_output, round(sum(value), 4) AS cost_usd, count(*) AS qa_count FROM events")
def usage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("tokens_input"), F.col("event_id").alias("tokens_output"), F.col("value").alias("cost_usd"), F.lit(1).cast("long").alias("qa_count"))
    return stats.usage_totals(e).withColumn("cost_usd", F.round("cost_usd", 4))


# --- slices and choices ------------------------------------------------------------------------


@query("SELECT c_custkey FROM customer WHERE c_custkey >= 20 ORDER BY c_custkey LIMIT 80")
def slice_from_a_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("page_id"), F.col("c_custkey").alias("ord"))
    return split.page_slice(rows, 100, "20").select("c_custkey")


@query("SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 100")
def slice_from_an_unknown_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("page_id"), F.col("c_custkey").alias("ord"))
    return split.page_slice(rows, 100, "no such page").select("c_custkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def dearest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.top_n(table(spark, sf_dir, "orders"), 20, [F.col("o_totalprice").desc(), "o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("WITH g AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY length(CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR)) DESC, o_orderkey) AS rn FROM orders) SELECT o_orderkey, rn = 1 AS kept FROM g WHERE n > 1")
def kept_by_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Higher confidence means the longer answer. Groups are the orders of a customer."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("p").alias("page_id"), F.col("o_orderkey").alias("qa_id"), F.concat(F.lit("Order of "), F.col("o_custkey").cast("string"), F.lit("?")).alias("question"), F.round("o_totalprice").cast("long").cast("string").alias("answer"), F.col("o_orderkey").alias("doc_ord"), F.lit(0).alias("pair_ord"))
    return dedup.pick_survivors(dedup.exact_groups(rows), "higher_confidence").select("o_orderkey", "kept")


# --- similar texts -----------------------------------------------------------------------------

#: Rows with a vector. The first two of each twenty have one question: an exact group, unless groups are confined to pages.
_VECTORS = "u AS (SELECT vec_id, vec_id % 4 AS page, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings{which}), near AS (SELECT x.vec_id AS a, y.vec_id AS b, list_cosine_similarity(x.v, y.v) AS s FROM u x JOIN u y ON x.vec_id < y.vec_id{scope} WHERE list_cosine_similarity(x.v, y.v) >= 0.3), nl AS (SELECT b AS id, list(a) AS es FROM near GROUP BY b), ids AS (SELECT vec_id AS id, row_number() OVER (ORDER BY vec_id) AS i FROM u)"
_WALK = """walk AS (SELECT i, id, [id] AS kept, id AS leader FROM ids WHERE i = 1
  UNION ALL SELECT x.i, x.id, CASE WHEN n.es IS NOT NULL AND list_has_any(n.es, w.kept) THEN w.kept ELSE list_append(w.kept, x.id) END, CASE WHEN n.es IS NOT NULL AND list_has_any(n.es, w.kept) THEN list_min(list_intersect(n.es, w.kept)) ELSE x.id END
  FROM walk w JOIN ids x ON x.i = w.i + 1 LEFT JOIN nl n ON n.id = x.id),
g AS (SELECT w.id, w.leader, s, count(*) OVER (PARTITION BY w.leader) AS n FROM walk w LEFT JOIN near ON a = w.leader AND b = w.id),
many AS (SELECT leader, avg(s) AS score FROM g WHERE n > 1 GROUP BY leader)"""


def _vector_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "embeddings")
    k = F.col("vec_id")
    rows = e.select(F.format_string("v%06d", k).alias("qa_id"), _text("p", k % 4).alias("page_id"), F.when(k % 20 <= 1, _text("Same as ", F.floor(k / 20), "?")).otherwise(_text("Own question ", k, "?")).alias("question"), F.repeat(F.lit("x"), (k % 50).cast("int")).alias("answer"), k.alias("doc_ord"), F.lit(0).alias("pair_ord"))
    return rows, e.select(F.format_string("v%06d", k).alias("qa_id"), "embedding")


@query("WITH RECURSIVE " + _VECTORS.format(scope="", which=" WHERE vec_id % 20 > 1") + ", " + _WALK + " SELECT printf('v%06d', g.id) AS qa_id, printf('semantic-%03d', dense_rank() OVER (ORDER BY g.leader)) AS group_id, round(score, 6) AS similarity_score FROM g JOIN many USING (leader)")
def dedup_semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, vectors = _vector_rows(spark, sf_dir)
    _, marked = dedup.deduplicate(rows, vectors, threshold=0.3)
    return marked.filter("match_type = 'semantic'").select("qa_id", "group_id", F.round("similarity_score", 6).alias("similarity_score"))


@query("WITH RECURSIVE " + _VECTORS.format(scope=" AND x.page = y.page", which="") + ", " + _WALK + " SELECT printf('v%06d', g.id) AS qa_id, 'p' || (g.leader % 4) || '/' || printf('semantic-%03d', dense_rank() OVER (PARTITION BY g.leader % 4 ORDER BY g.leader)) AS group_id, round(score, 6) AS similarity_score FROM g JOIN many USING (leader)")
def dedup_semantic_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, vectors = _vector_rows(spark, sf_dir)
    _, marked = dedup.deduplicate(rows, vectors, threshold=0.3, cross_page=False)
    return marked.filter("match_type = 'semantic'").select("qa_id", "group_id", F.round("similarity_score", 6).alias("similarity_score"))


@query("WITH RECURSIVE " + _VECTORS.format(scope="", which=" WHERE vec_id % 20 > 1") + ", " + _WALK + ", r AS (SELECT id, row_number() OVER (PARTITION BY leader ORDER BY id % 50 DESC, id) AS rn FROM g JOIN many USING (leader) UNION ALL SELECT vec_id, row_number() OVER (PARTITION BY vec_id // 20 ORDER BY vec_id % 50 DESC, vec_id) FROM embeddings WHERE vec_id % 20 <= 1) SELECT printf('v%06d', vec_id) AS qa_id FROM embeddings WHERE vec_id NOT IN (SELECT id FROM r WHERE rn > 1)")
def dedup_semantic_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, vectors = _vector_rows(spark, sf_dir)
    return dedup.deduplicate(rows, vectors, threshold=0.3)[0].select("qa_id")


@query("SELECT printf('v%06d', vec_id) AS qa_id FROM embeddings WHERE vec_id % 20 > 1")
def outside_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, vectors = _vector_rows(spark, sf_dir)
    none = dedup.semantic_groups(rows, vectors, dedup.exact_groups(rows), 1.1)
    exact = dedup.exact_groups(rows).select("qa_id").distinct()
    return rows.join(exact, "qa_id", "left_anti").join(none.select("qa_id"), "qa_id", "left_anti").select("qa_id")


def letter_counts(texts: list[str]) -> list[list[float]]:
    """A stand-in for a model of vectors."""
    return [[float(t.count(c)) for c in "aeiou"] for t in texts]


def no_model(texts: list[str]) -> list[list[float]]:
    raise OSError("no model")


@query("SELECT c_custkey AS qa_id, " + ", ".join(f"CAST(length(c_mktsegment) - length(replace(c_mktsegment, '{c}', '')) AS DOUBLE) AS {c.lower()}" for c in "AEIOU") + " FROM customer")
def vectors_of_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("qa_id"), F.lower("c_mktsegment").alias("question"))
    none = generate.embed(rows, "question", None)
    made = generate.embed(rows, "question", letter_counts).unionByName(none)
    return made.select("qa_id", *[F.col("embedding")[i].alias(c) for i, c in enumerate("aeiou")])


@query("SELECT c_mktsegment AS a, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 1")
def classes_of_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of a segment have one set of words, by the name of the first of them."""
    c = table(spark, sf_dir, "customer")
    member = similarity.class_of(c.select("c_custkey", F.split("c_mktsegment", "").alias("words")), (), "c_custkey")
    return member.join(c, member["rep"] == c["c_custkey"]).groupBy(F.col("c_mktsegment").alias("a")).agg(F.count(F.lit(1)).alias("n"))

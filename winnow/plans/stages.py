"""The stages end to end, as lazy tables: what is written, and whether, is up to the caller."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.paths import basename, section_slug, stem
from ..operators import dedup, emit, forum, generate, index, media, rules, split, stats, validate
from ..session import durable
from ..sources import readers
from ..sources.config import Dedup, Output
from ..streaming import ingest


@dataclass(frozen=True)
class Curated:
    docs: DataFrame  #: documents with the pairs that stay, those left with none among them
    rows: DataFrame  #: the pairs that stay
    marked: DataFrame  #: all pairs with their first failure
    groups: DataFrame  #: rows of duplicate groups
    warnings: DataFrame


def quality_control(docs: DataFrame, filters: rules.Rules | None = None, settings: Dedup | None = None, vectors: DataFrame | None = None) -> Curated:
    """Filter, then deduplicate the pairs of documents with a doc_ord."""
    r, d = filters or rules.Rules(), settings or Dedup()
    flat = emit.flatten_pairs(docs)
    marked = rules.apply_rules(flat, r)
    passed = marked.filter("filter_name is null").select(flat.columns)
    warnings = rules.page_warnings(docs.select("page_id"), passed, r.min_types)
    kept, groups = dedup.deduplicate(passed, vectors if d.semantic else None, d.strategy, d.threshold, d.cross_page, exact=d.exact)
    return Curated(emit.nest_pairs(docs, kept), kept, marked, groups, warnings)


def finalize(rows: DataFrame, settings: Output | None = None) -> DataFrame:
    """Pairs as training records with their split."""
    o = settings or Output()
    return emit.emit_records(split.stratified_split(rows, o.ratio, o.seed, o.stratify_by))


def check_records(raw: DataFrame, limits: validate.Limits | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(verdict, messages) for (split, ordinal, raw) rows of JSON text."""
    v = limits or validate.Limits()
    turns = F.from_json(F.get_json_object("raw", "$.conversations"), validate.TURNS)
    found = raw.withColumn("errors", F.concat(validate.schema_errors(F.col("raw"), v), validate.order_errors(turns))).withColumn("warnings", validate.length_warnings(turns, v))
    messages = validate.labelled(found, "split", "errors").withColumn("level", F.lit("error")).unionByName(validate.labelled(found, "split", "warnings").withColumn("level", F.lit("warning")))
    return validate.verdict(found, strict), messages


def describe(rows: DataFrame) -> dict[str, DataFrame]:
    """Distributions of pairs: histograms, answer lengths, images."""
    return {"histograms": stats.histograms(rows, ["section_id", "source_type", "content_type", "question_type"]), "lengths": stats.length_stats(rows), "images": stats.image_counts(rows)}


def prepare(spark: SparkSession, inventory: DataFrame, root: str, rasterise: media.Rasteriser | None, timestamp: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(prepared inventory, log, page images as (name, value) for sinks.write_named) of the files of an inventory below a root.

    PDF pages are made once and written to the shared folder, as the three tables read them.
    """
    bare = len(readers.bare_root(root)) + 2
    below = lambda pattern: readers.files_below(spark, root, pattern).select(F.substring("path", bare, 1 << 20).alias("path"), "content")
    listed = lambda files: files.join(inventory.select(F.col("file_path").alias("path")), "path", "left_semi")
    pages = durable(media.fan_out_pdfs(listed(below("*.{pdf,PDF}")), rasterise))
    checked = media.validate_images(listed(below("*.{jpg,jpeg,png,JPG,JPEG,PNG}")))
    whole, log = media.prepared_inventory(inventory, pages, checked, timestamp)
    folder = F.concat(F.regexp_replace("path", r"[^/]*$", ""), stem(basename("path")), F.lit("/"))
    images = pages.filter("error is null").select(F.concat(folder, F.format_string("%03d.jpg", "page")).alias("name"), F.col("image").alias("value"))
    return whole, log, images


def section_indices(pages: DataFrame, provider: generate.Provider | None) -> DataFrame:
    """One row per section with index pages (see index.merge_sections), with slug, the name of its file. Answers are written to the shared folder."""
    return index.merge_sections(durable(generate.index_entries(pages, provider))).withColumn("slug", section_slug("section"))


@dataclass(frozen=True)
class Generated:
    docs: DataFrame  #: question-answer documents of the pages that were asked, those with no pair among them
    rejected: DataFrame  #: pairs that the check at generation rejects, with _warnings
    failed: DataFrame  #: (page_id, error): pages without an answer
    skipped: DataFrame  #: (page_id, reason): pages that were not to be asked, or are beyond the budget


def generate_pairs(pages: DataFrame, procedures: DataFrame, done: DataFrame, provider: generate.Provider | None, timestamp: str, budget: float | None = None, strict: bool = False, model: str = "provider") -> Generated:
    """Ask the provider for pairs about classified pages: skip, look procedures up, ask, parse, check, nest.

    procedures has (section, code, name, pages); done (page_id) names pages whose output exists.
    The budget is spent by what a page is reckoned to cost. Answers are written to the shared
    folder, so that no page is asked twice.
    """
    there = pages.join(done.select("page_id", F.lit(True).alias("__done")).distinct(), "page_id", "left")
    marked = there.withColumn("reason", rules.skip_reason(F.coalesce("__done", F.lit(False)), "page_id", "content_type")).drop("__done")
    cost = generate.cost(F.lit(generate.PAGE_INPUT), F.lit(generate.PAGE_OUTPUT))
    paid = split.within_budget(marked.filter("reason is null").withColumn("cost", cost), budget, "page_id")
    skipped = marked.filter("reason is not null").select("page_id", "reason").unionByName(paid.filter("status = 'not_run'").select("page_id", F.lit("Budget is spent").alias("reason")))
    met = index.with_procedures(paid.filter("status <> 'not_run'").drop("spent", "cost", "status", "reason"), procedures)
    context = generate.context_block("content_type", "procedures_covered", "procedures_names")
    asking = met.withColumn("prompt", generate.prompt("source_type", "content_type", "section_name", generate.questions_for("content_type"), context))
    answered = durable(generate.call(asking, ["page_id", "image_path", "prompt"], provider))
    routed = rules.route_generated(generate.parse_answers(answered), strict)
    item = F.struct("pair_ord", F.struct(F.col("qa_id").alias("id"), "question", "answer", "question_type", F.when(F.size("_warnings") > 0, F.col("_warnings")).alias("_warnings")).alias("p"))
    pairs = routed.filter("valid").groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["p"]).alias("qa_pairs"))
    told = F.struct(F.lit(model).alias("model"), F.lit(timestamp).alias("timestamp"), F.concat_ws("_", "source_type", "content_type").alias("prompt_template"), F.lit(generate.PAGE_INPUT).alias("tokens_input"), F.lit(generate.PAGE_OUTPUT).alias("tokens_output"))
    docs = answered.filter("error is null").join(pairs, "page_id", "left")
    kind = "array<struct<id: string, question: string, answer: string, question_type: string, _warnings: array<string>>>"
    docs = docs.select("page_id", "image_path", "section_id", "section_name", "source_type", "content_type", "procedures_covered", "procedures_names", told.alias("generation"), F.coalesce("qa_pairs", F.array().cast(kind)).alias("qa_pairs"))
    return Generated(docs, routed.filter("not valid"), answered.filter("error is not null").select("page_id", "error"), skipped)


def with_images(records: DataFrame, files: DataFrame, image_dir: str) -> tuple[DataFrame, DataFrame]:
    """(rows with image, (source, image) to put in place): image paths of pairs resolved among the files (path); what isn't there has a null image."""
    found = emit.resolve_images(records.filter("image_path is not null"), files)
    named = found.withColumn("image", F.when(F.col("source").isNotNull(), F.concat(F.lit(image_dir.rstrip("/") + "/"), emit.flat_image_name("image_path"))))
    return named.select("image_path", "image"), named.filter("image is not null").select("source", "image").distinct()


def check_images(records: DataFrame, files: DataFrame, limits: validate.Limits | None = None) -> DataFrame:
    """(split, ordinal, level, message) of records (split, ordinal, image) whose image is missing, unreadable or small; files has (path, content)."""
    found = validate.image_findings(records, validate.with_image_size(files), limits)
    each = F.explode(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(level).alias("level"), F.col(c).alias("m"))) for level, c in (("error", "image_error"), ("warning", "image_warning"))])))
    return found.select("split", "ordinal", each.alias("x")).select("split", "ordinal", "x.level", F.format_string("%s[%d]: %s", "split", "ordinal", "x.m").alias("message"))


#: What crawled pages come as: one JSON row a page.
PAGE = "url string, html string, forum_id string, thread_id string"


def crawl(spark: SparkSession, folder: str, what: str, base_url: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append the threads, posts or forums of pages that appear in a folder to a table, each page once, whatever is restarted."""
    made = {"forums": forum.forums_of, "subforums": forum.subforums_of, "threads": forum.threads_of, "posts": forum.posts_of}[what]
    pages = ingest.new_files(spark, folder, PAGE).withColumnRenamed("url", "page_url")
    return ingest.append_new(pages, "page_url", target, checkpoint, lambda p: made(p, base_url, keep=["page_url"]))

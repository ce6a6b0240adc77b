"""Stages from the command line: python -m winnow STAGE --help."""

from __future__ import annotations

import argparse
import datetime
import importlib
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import paths
from .operators import dedup, emit, generate, html, rules, split, stats, validate
from .plans import reports, stages
from .session import durable
from .sources import config, readers, sinks
from .workers import reach


def _provider(name: str | None):
    """module:function, or none."""
    if not name:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _report(path: str | None, text: str) -> None:
    if path:
        Path(path).write_text(text, encoding="utf-8")
    else:
        print(text)


def _now() -> str:
    return datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")


def inventory(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = readers.scan_inventory(spark, a.input, a.section_filter)
    if not a.dry_run:
        sinks.write_csv(rows, a.output)
    print(reports.md_table(stats.inventory_summary(rows)))
    return 0


def prepare(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = readers.read_csv(spark, a.input, readers.INVENTORY)
    whole, log, images = stages.prepare(spark, rows, a.root, _provider(a.provider), _now())
    if not a.dry_run:
        if not a.force:  # pages that are there stay as they are
            there = readers.scan_inventory(spark, a.root).select(F.col("file_path").alias("name"))
            images = images.join(there, "name", "left_anti")
        print(f"pages written: {sinks.write_named(images, a.root)}")
        sinks.write_csv(whole, a.output, order=["file_path"])
        if a.log:
            sinks.write_csv(log, a.log)
    _report(a.report, reports.document("Prepared sources", [("Operations", reports.md_table(stats.operation_summary(log))), ("Files", reports.md_table(stats.counts(whole, "file_type")))]))
    return 0


def indices(spark: SparkSession, a: argparse.Namespace) -> int:
    pages = readers.read_image_rows(spark, a.input).withColumn("image_path", F.col("file_path")).filter(paths.is_index_page("filename"))
    if a.section_filter:
        pages = pages.filter(F.col("section_dir") == a.section_filter)
    made = stages.section_indices(pages, _provider(a.provider)).drop("section")
    if not a.dry_run:
        body = F.to_json(F.struct(*[c for c in made.columns if c != "slug"]), {"ignoreNullFields": "false"})
        print(f"sections written: {sinks.write_named(made.select(F.concat('slug', F.lit('.json')).alias('name'), body.alias('value')), a.output)}")
    _report(a.report, reports.document("Section indices", [("Sections", reports.md_table(made.select("slug", F.size("procedures").alias("procedures"), F.size("merge_warnings").alias("warnings")).orderBy("slug")))]))
    return 0


def spot_check(spark: SparkSession, a: argparse.Namespace) -> int:
    """Labelled pages (filename, image_path, expected) against what the provider says; with --limit, a diverse sample of the input."""
    rows = spark.read.option("header", True).csv(readers.need(spark, a.input))
    if a.limit:
        rows = split.diverse_sample(rows.withColumn("ord", F.col("filename")), a.limit, ["torque|spec", "diagram|fig", "wiring|circuit", "trouble|fault"], paths.is_index_page("filename"))
    found = durable(generate.classify(rows, _provider(a.provider)))
    _report(a.report, reports.document("Classifier", [("Accuracy", reports.md_table(stats.accuracy(found, "expected", "content_type"))), ("Pages", reports.md_table(found.select("filename", "expected", "content_type", "confidence").orderBy("filename")))]))
    return 0


def generate_images(spark: SparkSession, a: argparse.Namespace) -> int:
    pages = split.page_slice(readers.read_classified(spark, a.input).withColumn("ord", F.col("page_id")), a.limit, a.start_from).drop("ord")
    listed = readers.read_keyed_documents(spark, a.indices) if a.indices else None
    none = spark.createDataFrame([], "section string, code string, name string, pages array<string>")
    procedures = listed.select(F.col("key").alias("section"), F.inline("procedures")) if listed is not None else none
    there = readers.exists(spark, a.output) and not a.force and readers.matching(spark, a.output.rstrip("/") + "/*.json")
    done = readers.read_documents(spark, a.output).select("page_id") if there else spark.createDataFrame([], "page_id string")
    made = stages.generate_pairs(pages, procedures, done, _provider(a.provider) if not a.dry_run else None, _now(), a.budget, a.strict)
    if not a.dry_run:
        print(f"documents written: {sinks.write_documents(made.docs, a.output, sanitise=True)}")
        if a.log:
            sinks.write_csv(made.failed.withColumn("timestamp", F.lit(_now())), a.log)
    asked = made.failed.count() if a.dry_run else made.docs.count()
    _report(a.report, reports.document("Generation", [("Skipped", reports.md_table(stats.counts(made.skipped, "reason")))]) + (f"\npages to ask: {asked}\n" if a.dry_run else f"\npages asked: {asked}\n"))
    return 0


def crawl(spark: SparkSession, a: argparse.Namespace) -> int:
    if not a.base_url:
        raise SystemExit("crawl: --base-url is what relative addresses start from")
    stages.crawl(spark, a.input, a.what, a.base_url, a.output, a.checkpoint or a.output.rstrip("/") + ".checkpoint").awaitTermination()
    print(f"rows: {spark.read.parquet(a.output).count() if readers.exists(spark, a.output) else 0}")
    return 0


def upload(spark: SparkSession, a: argparse.Namespace) -> int:
    """What would be uploaded, and under which names. Uploading itself is left to other tools."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(readers.need(spark, a.input)).select(readers.plain_path(F.col("path")).alias("path"))
    listed = sinks.upload_map(files, a.input).orderBy("remote")
    if not a.dry_run:
        sinks.write_csv(listed, a.output)
    print(reports.md_table(listed, reports.ERRORS))
    return 0


def classify(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = readers.read_image_rows(spark, a.input).withColumn("image_path", F.col("file_path")).withColumn("ord", F.col("file_path"))
    rows = split.page_slice(rows.withColumn("page_id", paths.page_id("filename", "section_dir")), a.limit, a.start_from)
    cache = readers.read_cache(spark, a.output) if not a.force else None
    new = rows if cache is None else rows.join(cache.select("page_id"), "page_id", "left_anti")
    out = durable(generate.classify(new, _provider(a.provider)))  # no page is asked about twice
    out = out.select("page_id", "image_path", paths.section_id("section_dir").alias("section_id"), paths.section_name("section_dir").alias("section_name"), paths.source_type("section_dir", "filename").alias("source_type"), "content_type", "is_index", "confidence", F.to_json("secondary_types").alias("secondary_types"), "needs_review")
    whole = out if cache is None else out.unionByName(cache.select(out.columns))
    if not a.dry_run:
        target = a.output.rstrip("/") + ".new" if cache is not None and readers.exists(spark, a.output) else a.output
        sinks.write_csv(whole, target, order=["page_id"])
        print(f"written: {target}")
    _report(a.report, reports.classification_report(whole))
    return 0


def specs(spark: SparkSession, a: argparse.Namespace) -> int:
    if not a.vehicle:
        raise SystemExit("specs: --vehicle names what the specifications are of")
    docs = html.html_documents(readers.read_html(spark, a.input), a.vehicle)
    if not a.dry_run:
        sinks.write_documents(docs, a.output, sanitise=True)
    print(f"documents: {docs.count()}")
    return 0


def _documents(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    skipped = readers.skipped_documents(spark, a.input)
    if names := [r["file_name"] for r in skipped.orderBy("file_name").limit(reports.WARNINGS).collect()]:
        print(f"skipped, no JSON documents: {skipped.count()} files ({', '.join(names)})", file=sys.stderr)
    return readers.read_documents(spark, a.input)


def filter_pairs(spark: SparkSession, a: argparse.Namespace) -> int:
    r = config.stage_settings(config.read_yaml(a.config), "filters")
    docs = _documents(spark, a)
    marked = rules.apply_rules(emit.flatten_pairs(docs), r)
    passed = marked.filter("filter_name is null")
    warnings = rules.page_warnings(docs.select("page_id"), passed, r.min_types)
    if not a.dry_run:
        sinks.write_documents(emit.nest_pairs(docs, passed).drop("doc_ord", "file_name"), a.output)
        if a.log:
            sinks.write_csv(rules.rejection_log(marked, _now()), a.log)
    _report(a.report, reports.filter_report(marked, warnings))
    return 0


def deduplicate(spark: SparkSession, a: argparse.Namespace) -> int:
    d = config.stage_settings(config.read_yaml(a.config), "deduplication")
    docs = _documents(spark, a)
    rows = emit.flatten_pairs(docs)
    vectors = generate.embed(rows, "question", _provider(a.provider), batch=d.batch) if d.semantic and not a.no_semantic and a.provider else None
    kept, marked = dedup.deduplicate(rows, vectors, d.strategy, d.threshold, d.cross_page, a.compatible, d.exact)
    if not a.dry_run:
        sinks.write_documents(emit.nest_pairs(docs, kept).drop("doc_ord", "file_name"), a.output)
        if a.log:
            sinks.write_csv(dedup.duplicate_log(marked), a.log)
    _report(a.report, reports.dedup_report(dedup.dedup_totals(rows, marked), marked))
    return 0


def emit_data(spark: SparkSession, a: argparse.Namespace) -> int:
    o = config.stage_settings(config.read_yaml(a.config), "output")
    docs = readers.read_documents(spark, a.input, strict=True)
    ratio, seed = a.train_split if a.train_split is not None else o.ratio, a.seed if a.seed is not None else o.seed
    rows = split.stratified_split(emit.flatten_pairs(docs), ratio, seed, o.stratify_by)
    images = None
    if a.root:
        files = readers.read_images(spark, a.root).select("path")
        below = files.union(files.select(F.substring("path", len(a.root.rstrip("/")) + 2, 1 << 20)))
        images, sources = stages.with_images(rows, below, o.image_dir)
        if not a.dry_run:
            full = F.when(F.col("source").startswith("/"), F.col("source")).otherwise(F.concat(F.lit(a.root.rstrip("/") + "/"), "source"))
            put = sinks.materialise_images(sources.withColumn("source", full), f"{a.output.rstrip('/')}/{o.image_dir}", "copy" if a.copy_images else o.image_mode)
            print(reports.md_table(stats.counts(put, "status")))
    records = emit.emit_records(rows, images)
    if not a.dry_run:
        for part in ("train", "val"):
            sinks.write_jsonl(records.filter(F.col("split") == part).drop("split"), f"{a.output.rstrip('/')}/{part}")
    _report(a.report, reports.emit_report(rows))
    return 0


def validate_data(spark: SparkSession, a: argparse.Namespace) -> int:
    v = config.stage_settings(config.read_yaml(a.config), "vlm_validation")
    parts = [readers.read_jsonl(spark, f"{a.input.rstrip('/')}/{p}").withColumn("split", F.lit(p)) for p in ("train", "val") if readers.exists(spark, f"{a.input.rstrip('/')}/{p}")]
    if not parts:
        raise FileNotFoundError(f"neither train nor val in {a.input}")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    result, messages = stages.check_records(rows.select("split", "ordinal", "raw"), v, a.strict)
    flat = rows.select("split", "metadata.*", F.try_element_at("conversations", F.lit(2))["content"].alias("answer"))
    if v.check_images and not a.skip_image_check and readers.exists(spark, f"{a.input.rstrip('/')}/images"):
        files = readers.read_images(spark, f"{a.input.rstrip('/')}/images").withColumn("path", F.concat(F.lit("images/"), paths.basename("path")))
        found = stages.check_images(rows.select("split", "ordinal", "image"), files, v)
        messages = messages.unionByName(found.select(messages.columns))
        n = {r["level"]: r["n"] for r in found.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
        result = result.withColumns({"n_errors": F.col("n_errors") + n.get("error", 0), "n_warnings": F.col("n_warnings") + n.get("warning", 0), "passed": F.col("passed") & F.lit(not n.get("error") and not (a.strict and n.get("warning")))})
    _report(a.report, reports.validation_report(result, messages, flat))
    sections = flat.groupBy("split", F.coalesce("section_id", F.lit("unknown")).alias("section_id")).agg(F.count(F.lit(1)).alias("n"))
    for r in validate.section_warnings(sections, v).limit(reports.WARNINGS).collect():
        print(f"{r['split']}: {r['warning']}")
    return 0 if result.first()["passed"] else 1


STAGES = {"inventory": inventory, "prepare": prepare, "indices": indices, "classify": classify, "spot-check": spot_check, "generate": generate_images, "crawl": crawl, "upload": upload, "specs": specs, "filter": filter_pairs, "dedup": deduplicate, "emit": emit_data, "validate": validate_data}


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="winnow", description=__doc__)
    sub = top.add_subparsers(dest="stage", required=True)
    for name in STAGES:
        p = sub.add_parser(name)
        p.add_argument("--input", required=True)
        p.add_argument("--output", default=f"{name}-output")
        p.add_argument("--config")
        p.add_argument("--report")
        p.add_argument("--log")
        p.add_argument("--dry-run", action="store_true", help="compute, but write no data")
        p.add_argument("--section-filter")
        p.add_argument("--vehicle", help="what specifications are of, before the model")
        p.add_argument("--limit", type=int)
        p.add_argument("--start-from")
        p.add_argument("--force", action="store_true", help="ignore what was kept from before")
        p.add_argument("--provider", help="module:function that answers requests")
        p.add_argument("--no-semantic", action="store_true")
        p.add_argument("--compatible", action="store_true", help="drop duplicates by id on whatever page")
        p.add_argument("--train-split", type=float)
        p.add_argument("--seed", type=int)
        p.add_argument("--strict", action="store_true")
        p.add_argument("--root", help="folder that images and other sources lie below")
        p.add_argument("--indices", help="folder of section indices")
        p.add_argument("--budget", type=float, help="dollars that generation may spend")
        p.add_argument("--copy-images", action="store_true", help="copies instead of links")
        p.add_argument("--skip-image-check", action="store_true")
        p.add_argument("--what", choices=("forums", "subforums", "threads", "posts"), default="posts", help="what is read from crawled pages")
        p.add_argument("--base-url")
        p.add_argument("--checkpoint", help="where a crawl keeps its progress")
    a = top.parse_args(argv)
    return STAGES[a.stage](reach(SparkSession.builder.appName(f"winnow-{a.stage}").getOrCreate()), a)


if __name__ == "__main__":
    sys.exit(main())

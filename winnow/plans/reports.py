"""Markdown reports from small aggregate tables, and the dataset card."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import rules, split, stats

#: Rows that a report shows of a long list.
ERRORS, WARNINGS, GROUPS, DROPPED = 20, 20, 10, 3


def md_table(rows: DataFrame, limit: int = 200) -> str:
    """A Markdown table of a small aggregate; longer tables are cut and say so."""
    found = rows.limit(limit + 1).collect()
    cell = lambda v: f"{v:.2f}" if isinstance(v, float) else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    lines += ["| " + " | ".join(cell(v) for v in r) + " |" for r in found[:limit]]
    return "\n".join(lines + ["", f"(the first {limit})"] * (len(found) > limit))


def document(title: str, sections: Iterable[tuple[str, str]]) -> str:
    return "\n\n".join([f"# {title}", *(f"## {name}\n\n{body}" for name, body in sections)]) + "\n"


def filter_report(marked: DataFrame, warnings: DataFrame) -> str:
    samples = rules.rejection_samples(marked, 3).select("filter_name", "qa_id", F.substring("question", 1, 60).alias("question"), F.substring("answer", 1, 60).alias("answer"))
    return document("Quality filter", [
        ("Totals", md_table(rules.totals(marked))), ("Rejections", md_table(rules.rejection_counts(marked).orderBy(F.col("n").desc()))),
        ("Samples", md_table(samples)), ("Warnings", md_table(warnings.orderBy("page_id", "warning"), WARNINGS)),
    ])


def dedup_report(totals: DataFrame, marked: DataFrame) -> str:
    first = marked.select("group_id").distinct().orderBy("group_id").limit(GROUPS)
    shown = split.top_per_group(marked.join(first, "group_id").filter("not kept"), "group_id", DROPPED, ["qa_id"])
    return document("Deduplication", [("Totals", md_table(totals)), ("Groups", md_table(shown.select("group_id", "match_type", "kept_qa_id", "qa_id", F.substring("question", 1, 50).alias("question")).orderBy("group_id", "qa_id")))])


def classification_report(pages: DataFrame, errors: DataFrame | None = None) -> str:
    parts = [("Source types", md_table(stats.counts(pages, "source_type"))), ("Content types", md_table(stats.counts(pages, "content_type"))), ("Confidence", md_table(stats.confidence_histogram(pages)))]
    return document("Classification", parts + ([("Errors", md_table(errors, ERRORS))] if errors is not None else []))


def emit_report(rows: DataFrame) -> str:
    return document("Training data", [("By section", md_table(stats.split_counts(rows, "section_id").orderBy("section_id"))), ("By source", md_table(stats.split_counts(rows, "source_type").orderBy("source_type"))), ("Images", md_table(stats.image_counts(rows)))])


def validation_report(verdict: DataFrame, messages: DataFrame, rows: DataFrame) -> str:
    lengths = stats.length_stats(rows)
    return document("Validation", [("Result", md_table(verdict)), ("Errors and warnings", md_table(messages.orderBy("split", "ordinal"), ERRORS)), ("Answer lengths", md_table(lengths)), ("Sections", md_table(stats.split_counts(rows, "section_id").orderBy("section_id")))])


def dataset_card(name: str, rows: DataFrame, licence: str = "cc-by-nc-4.0", language: str = "en", tasks: tuple[str, ...] = (), tags: tuple[str, ...] = ()) -> str:
    """Front matter and counts of a dataset."""
    n = {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    listed = lambda key, values: [f"{key}:"] + [f"- {v}" for v in values] if values else []
    head = ["---", f"language: {language}", f"license: {licence}", *listed("task_categories", tasks), *listed("tags", tags), "---"]
    return "\n".join([*head, "", f"# {name}", "", f"- train: {n.get('train', 0)}", f"- val: {n.get('val', 0)}", "", md_table(stats.split_counts(rows, "section_id").orderBy("section_id"))]) + "\n"

"""Model calls behind a narrow interface, and what surrounds them: routing, prompts, parsing, cost.

A provider is any picklable callable from a list of requests (dicts) to a list of answers (texts,
or None for a failed call). It runs inside mapInArrow, once per batch, so a model or a client is
made once per task; calls that fail are retried with growing pauses.
"""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsonx import parse_list, parse_object
from ..functions.paths import is_index_page, needs_review, numbered_id
from ..functions.text import as_col
from ..session import durable

Provider = Callable[[list[dict]], list[str | None]]

#: Questions asked of a page by its type, and prices per thousand tokens.
QUESTIONS = {"index": 6, "procedure": 12, "specification": 10, "diagram": 8, "troubleshooting": 10, "text": 6, "wiring": 10, "pinout": 8, "fuse_chart": 8, "flowchart": 8, "signal": 8, "oscilloscope": 8}
DEFAULT_QUESTIONS = 8
INPUT_PRICE, OUTPUT_PRICE = 0.003, 0.015
#: Tokens that a page is reckoned to take and to give.
PAGE_INPUT, PAGE_OUTPUT = 2000, 800
#: Confidence of an index page, which no model sees; of an answer that can't be read; without a provider.
INDEX_CONFIDENCE, UNREAD_CONFIDENCE, ABSENT_CONFIDENCE = 0.95, 0.3, 0.0

#: Prompt templates by (source_type, content_type); the default is used where there is none.
DEFAULT_PROMPT = "Write {n} question and answer pairs about this page of {section}.\n{context}"
PROMPTS = {
    ("service_manual", "procedure"): "Write {n} question and answer pairs about the work steps, tools and cautions on this page of {section}.\n{context}",
    ("service_manual", "specification"): "Write {n} question and answer pairs about the values on this page of {section}; give each with its unit.\n{context}",
    ("service_manual", "diagram"): "Write {n} question and answer pairs about the parts that this drawing of {section} shows.\n{context}",
    ("service_manual", "troubleshooting"): "Write {n} question and answer pairs about the faults, causes and remedies on this page of {section}.\n{context}",
    ("service_manual", "index"): "Write {n} question and answer pairs about where in {section} its procedures are found.\n{context}",
    ("electrical_manual", "wiring"): "Write {n} question and answer pairs about the wires, connectors and components on this page of {section}.\n{context}",
    ("ecu_technical", "oscilloscope"): "Write {n} question and answer pairs about the signals that this page of {section} shows.\n{context}",
}


def _as_many(given: list, asked: list) -> list:
    if len(given) != len(asked):
        raise ValueError(f"{len(given)} answers to {len(asked)} requests")
    return given


def call(rows: DataFrame, request: list[str], provider: Provider | None, retries: int = 3, pause: float = 2.0, batch: int = 32) -> DataFrame:
    """rows with answer, what the provider says to each row's request columns, and error, why there is none; one of them is null.

    A failed batch is tried again after pause, 2 * pause and so on; then its rows carry the last
    failure. Without a provider every row says so.
    """
    none = F.lit(None).cast("string")
    if provider is None:
        return rows.withColumns({"answer": none, "error": F.lit("no provider")})
    columns = rows.columns
    schema = rows.withColumns({"answer": none, "error": none}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                asked = part.select(request).to_pylist()
                said, why = [None] * len(asked), "no answer"
                for k in range(retries + 1):
                    try:
                        said = _as_many(provider(asked), asked)
                        break
                    except Exception as failure:  # any failure of a remote model is one to try again
                        said, why = [None] * len(asked), f"{type(failure).__name__}: {failure}"
                        if k < retries:
                            time.sleep(pause * 2**k)
                errors = [why if x is None else None for x in said]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(said, pa.string()), pa.array(errors, pa.string())], names=[*columns, "answer", "error"])

    return rows.mapInArrow(run, schema)


def classify(pages: DataFrame, provider: Provider | None) -> DataFrame:
    """pages (filename, image_path, ...) with is_index, content_type, confidence, secondary_types, needs_review.

    Index pages, known by their names, are not sent to the provider.
    """
    marked = pages.withColumn("is_index", is_index_page("filename"))
    none = F.array().cast("array<string>")
    sure = marked.filter("is_index").withColumns({"content_type": F.lit("index"), "confidence": F.lit(INDEX_CONFIDENCE), "secondary_types": none})
    asked = call(marked.filter("not is_index"), ["filename"] + ["image_path"] * ("image_path" in pages.columns), provider).withColumn("__v", parse_object("answer"))
    read = F.col("__v.content_type").isNotNull()
    unread = ABSENT_CONFIDENCE if provider is None else UNREAD_CONFIDENCE
    rest = asked.withColumns({
        "content_type": F.coalesce("__v.content_type", F.lit("unknown")),
        "confidence": F.when(read, F.coalesce("__v.confidence", F.lit(0.0))).otherwise(unread),
        "secondary_types": F.coalesce("__v.secondary_types", none),
    }).drop("__v", "answer", "error")
    return sure.unionByName(rest).withColumn("needs_review", needs_review("confidence", "content_type"))


#: What is asked of an index page, and the shape of the answer.
INDEX_PROMPT = "List the procedures of this index page of {section} as JSON: section_id, section_name, and procedures with code, name and page."
INDEX_ANSWER = "struct<section_id: string, section_name: string, procedures: array<struct<code: string, name: string, page: string>>>"


def index_entries(pages: DataFrame, provider: Provider | None, section: str = "section_dir", order: str = "filename") -> DataFrame:
    """Entries for index.merge_sections of index pages (section, file name, image): a row for each procedure that an answer lists.

    A page without a readable answer gives one row with error and no code, a page that lists
    nothing one without either. ord is the page's place in its section, then that in the answer.
    """
    asked = call(pages.withColumn("prompt", F.replace(F.lit(INDEX_PROMPT), F.lit("{section}"), F.col(section))), ["prompt", "filename"] + ["image_path"] * ("image_path" in pages.columns), provider)
    read = asked.withColumn("v", parse_object("answer", INDEX_ANSWER))
    said = F.col("v.procedures").isNotNull() | F.col("v.section_id").isNotNull()
    each = read.select(F.col(section).alias("section"), F.col(order).alias("__page"), F.col("filename").alias("source_filename"), F.col("v.section_id").alias("section_id"), F.col("v.section_name").alias("section_name"), F.coalesce("error", F.when(~F.coalesce(said, F.lit(False)), "the answer is no index")).alias("error"), F.posexplode_outer("v.procedures").alias("__n", "p"))
    return each.select("section", F.struct(F.col("__page").alias("page"), F.coalesce("__n", F.lit(0)).alias("n")).alias("ord"), "source_filename", "section_id", "section_name", "error", "p.code", "p.name", "p.page")


def context_block(content_type: Column | str, codes: Column | str, names: Column | str) -> Column:
    """What the index says about a page: a header and a line for each procedure; a hint for specifications; or nothing."""
    c, n = as_col(codes), as_col(names)
    k = F.least(F.size(c), F.size(n))
    lines = F.array_join(F.transform(F.arrays_zip(F.slice(c, F.lit(1), k).alias("c"), F.slice(n, F.lit(1), k).alias("n")), lambda x: F.concat(F.lit("- "), x["c"], F.lit(": "), x["n"])), "\n")
    head = F.concat(F.lit("Procedures that the index lists for this page:\n"), lines)
    hint = F.when(as_col(content_type) == "specification", "Read the values off the tables, and name the unit of each.").otherwise("")
    return F.when(F.coalesce(k, F.lit(0)) > 0, head).otherwise(hint)


def questions_for(content_type: Column | str) -> Column:
    """How many questions to ask of a page of this type."""
    c = as_col(content_type)
    return F.coalesce(*[F.when(c == k, F.lit(n)) for k, n in QUESTIONS.items()], F.lit(DEFAULT_QUESTIONS))


def prompt(source_type: Column | str, content_type: Column | str, section: Column | str, n: Column | str, context: Column | str, templates: dict[tuple[str, str], str] | None = None, default: str = DEFAULT_PROMPT) -> Column:
    """The template of the page's types, filled in."""
    s, c = as_col(source_type), as_col(content_type)
    chosen = F.coalesce(*[F.when((s == a) & (c == b), F.lit(t)) for (a, b), t in (PROMPTS if templates is None else templates).items()], F.lit(default))
    for key, value in (("{n}", as_col(n).cast("string")), ("{section}", as_col(section)), ("{context}", as_col(context))):
        chosen = F.replace(chosen, F.lit(key), F.coalesce(value, F.lit("")))
    return chosen


def cost(tokens_in: Column | str, tokens_out: Column | str) -> Column:
    """Dollars for a call."""
    return as_col(tokens_in) * (INPUT_PRICE / 1000) + as_col(tokens_out) * (OUTPUT_PRICE / 1000)


def cost_text(c: Column | str) -> Column:
    return F.format_string("%.4f", as_col(c))


def cost_warnings(progress: DataFrame, most: float = 0.10, cost_col: str = "cost_usd") -> DataFrame:
    """Pages whose call cost more than the given dollars."""
    return progress.filter(F.col(cost_col) > most)


def parse_answers(rows: DataFrame, answer: str = "answer", page: str = "page_id") -> DataFrame:
    """One row per pair that an answer holds, with pair_ord from 1 and qa_id; answers that can't be read give none."""
    pairs = rows.select(page, F.posexplode(parse_list(answer)).alias("__i", "p"))
    return pairs.select(page, (F.col("__i") + 1).alias("pair_ord"), numbered_id(page, F.col("__i") + 1).alias("qa_id"), "p.question", "p.answer", "p.question_type")


def number_pairs(rows: DataFrame, page: str = "page_id", order: str = "ord") -> DataFrame:
    """rows with qa_id: their number within the page."""
    return rows.withColumn("qa_id", numbered_id(page, F.row_number().over(Window.partitionBy(page).orderBy(order))))


def embed(rows: DataFrame, text: str, provider: Callable[[list[str]], list[list[float]]] | None, id_col: str = "qa_id", batch: int = 64) -> DataFrame:
    """(id, embedding) of texts by a provider of vectors. Without one there are no rows: then nothing is similar.

    If the provider fails for any text there are no rows either, and a warning says why: a dedup
    by some of the vectors would be half done. The vectors are made when this is called, and
    written to the shared folder. A null text is read as an empty one.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    if provider is None:
        return rows.select(F.col(id_col), F.lit(None).cast("array<double>").alias("embedding")).limit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                made, why = [None] * part.num_rows, None
                try:
                    made = _as_many(provider(texts := [x or "" for x in part.column("t").to_pylist()]), texts)
                except Exception as failure:  # whatever keeps a model from running
                    why = f"{type(failure).__name__}: {failure}"
                yield pa.RecordBatch.from_arrays([part.column("i"), pa.array(made, pa.list_(pa.float64())), pa.array([why] * part.num_rows, pa.string())], names=[id_col, "embedding", "error"])

    found = durable(rows.select(F.col(id_col).alias("i"), F.col(text).alias("t")).mapInArrow(run, f"`{id_col}` {kind}, embedding array<double>, error string"))
    failed = found.filter("error is not null")
    if first := failed.first():
        warnings.warn(f"no similar texts are looked for: {failed.count()} of {found.count()} texts have no vector ({first['error']})", stacklevel=2)
        found = found.limit(0)
    return found.drop("error")

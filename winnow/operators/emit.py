"""Flattening documents to rows, nesting rows again, and building training records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import basename, numbered_id
from ..functions.text import flat_image_name

PARENTS = ("page_id", "section_id", "section_name", "source_type", "content_type")
METADATA = ("page_id", "section_id", "section_name", "source_type", "content_type", "question_type", "qa_id")


def flatten_pairs(docs: DataFrame, doc_ord: str = "doc_ord") -> DataFrame:
    """One row per pair of the documents, with the page's columns; missing texts are empty, a null image stays null.

    Documents without pairs give no rows. pair_ord is a pair's place in its document.
    """
    blank = lambda c: F.coalesce(c, F.lit(""))
    pairs = docs.select(doc_ord, *[blank(F.col(c)).alias(c) if c in docs.columns else F.lit("").alias(c) for c in PARENTS], (F.col("image_path") if "image_path" in docs.columns else F.lit(None).cast("string")).alias("image_path"), F.posexplode("qa_pairs").alias("pair_ord", "p"))
    fields = {f.name for f in docs.schema["qa_pairs"].dataType.elementType.fields}
    of = lambda n: blank(F.col(f"p.{n}")) if n in fields else F.lit("")
    return pairs.select(of("question").alias("question"), of("answer").alias("answer"), "image_path", *PARENTS, of("question_type").alias("question_type"), of("id").alias("qa_id"), F.col(doc_ord).alias("doc_ord"), "pair_ord")


def nest_pairs(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """docs with qa_pairs cut down to the kept (page_id, qa_id); documents left with none stay, with an empty list."""
    ids = kept.groupBy("page_id").agg(F.collect_set("qa_id").alias("__ids"))
    none = F.array().cast("array<string>")
    return docs.join(ids, "page_id", "left").withColumn("qa_pairs", F.filter("qa_pairs", lambda p: F.array_contains(F.coalesce(F.col("__ids"), none), p["id"]))).select(*docs.columns)


def pair_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Question-answer rows of conversations: each user turn that an assistant turn follows."""
    w = Window.partitionBy(conv).orderBy(turn)
    nxt = turns.withColumn("__role", F.lead("role").over(w)).withColumn("answer", F.lead("text").over(w))
    pairs = nxt.filter("role = 'user' and __role = 'assistant'").withColumn("pair_ord", F.row_number().over(w))
    page = F.col(conv).cast("string")
    return pairs.select(page.alias("page_id"), F.col(conv).alias("doc_ord"), "pair_ord", numbered_id(page, "pair_ord").alias("qa_id"), F.col("text").alias("question"), "answer", F.lit("factual").alias("question_type"))


def record(image: Column) -> Column:
    """A training record: image, the two turns, and the metadata fields."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return F.struct(image.alias("image"), F.array(turn("user", "question"), turn("assistant", "answer")).alias("conversations"), F.struct(*METADATA).alias("metadata"))


def emit_records(rows: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """rows as records (columns image, conversations, metadata) and their split.

    images maps image_path to image; a path that it lacks gives a record without an image.
    """
    if images is None:
        images = rows.filter("image_path is not null").select("image_path", F.concat(F.lit("images/"), flat_image_name("image_path")).alias("image")).distinct()
    met = rows.join(images.select("image_path", "image"), "image_path", "left")
    return met.select(record(F.col("image")).alias("r"), *(["split"] if "split" in rows.columns else [])).select("r.*", *(["split"] if "split" in rows.columns else []))


def resolve_images(paths: DataFrame, files: DataFrame, root: str = "data_src") -> DataFrame:
    """(image_path, source): the file that an image path means, or null.

    A path is looked up as it is, without a leading root folder, and under the root; otherwise the
    first file in order of path that has its name is taken.
    """
    f = files.select(F.col("path").alias("source")).distinct()
    first = f.withColumn("__n", basename("source")).groupBy("__n").agg(F.min("source").alias("__by_name"))
    p = paths.select("image_path").distinct()
    tries = F.array_distinct(F.array(F.col("image_path"), F.regexp_replace("image_path", f"^{root}/", ""), F.concat(F.lit(f"{root}/"), "image_path")))
    hit = p.select("image_path", F.posexplode(tries).alias("at", "source")).join(f, "source").groupBy("image_path").agg(F.min_by("source", "at").alias("__direct"))
    out = p.join(hit, "image_path", "left").withColumn("__n", basename("image_path")).join(first, "__n", "left")
    return out.select("image_path", F.coalesce("__direct", "__by_name").alias("source"))


def name_collisions(paths: DataFrame) -> DataFrame:
    """(image, n): target names that several image paths share."""
    return paths.select("image_path").distinct().groupBy(flat_image_name("image_path").alias("image")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")

"""Exact dedup: rows are grouped by a 128-bit content hash, and bytes are compared inside groups.

Only hashes travel for texts that occur once. Groups of several rows are found from the hashes;
a bitmap of their hashes (of fixed size, so safe to broadcast) lets the second scan pass on the
texts of those groups alone, and these are grouped by hash and text together, which compares
their bytes. Both groupings combine before the shuffle, so a text that fills a third of the
table costs one row a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, maybe_among, text_of


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per document: id, keep_id, group_size (long), kept, text_sha256, by the bytes of the text.

    keep names the row of a group that stays: "min" for the smallest id, "max" for the largest.
    A null text is empty, and all empty texts form one group. Rows that repeat both id and text
    count in group_size and are returned once. A null id is never kept beside another id. An
    empty table gives an empty result. Further columns of docs are ignored, whatever their names.
    Texts that share the content hash but differ stay apart; if they shared SHA-256 as well, the
    run would fail rather than merge them.
    """
    t = text_of(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("__id"), t.alias("__t"), content_hash(t).alias("__h"), F.sha2(t, 256).alias("__sha"))
    slim = keyed.select("__id", "__h", "__sha")
    best = F.min if keep == "min" else F.max
    repeated = slim.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__h")
    same = maybe_among(keyed, "__h", repeated, docs.count() // 2).groupBy("__h", "__sha", "__t").agg(best("__id").alias("__keep"), F.count(F.lit(1)).alias("__size"))
    classes = same.select("__h", "__sha", "__keep", "__size").groupBy("__h", "__sha").agg(best("__keep").alias("__keep"), F.sum("__size").alias("__size"), F.count(F.lit(1)).alias("__texts"))
    classes = classes.filter("__size > 1").withColumn("__size", F.when(F.col("__texts") == 1, F.col("__size")).otherwise(F.raise_error(F.lit("two texts share both digests")).cast("long"))).drop("__texts")
    rows = slim.distinct().join(classes, ["__h", "__sha"], "left")
    keep_id = F.coalesce("__keep", "__id")
    return rows.select(
        F.col("__id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        F.col("__id").eqNullSafe(keep_id).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", **options) -> DataFrame:
    """docs, all columns, without the rows that exact_groups drops and without rows that repeat id and text."""
    groups = exact_groups(docs, id_col, text_col, keep, **options)
    lost = groups.filter(~F.col("kept")).select(F.col(id_col).alias("__lost_id"), F.col("text_sha256").alias("__lost_sha"))
    sha = free_name(docs, "__sha")
    marked = docs.withColumn(sha, F.sha2(text_of(F.col(text_col)), 256))
    stay = marked.join(lost, F.col(id_col).eqNullSafe(F.col("__lost_id")) & (F.col(sha) == F.col("__lost_sha")), "left_anti")
    return stay.dropDuplicates([id_col, sha]).drop(sha)


ORACLE_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

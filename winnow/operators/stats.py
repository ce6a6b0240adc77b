"""Counts and distributions for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import confidence_bucket


def counts(rows: DataFrame, by: str | Column, name: str = "value") -> DataFrame:
    """value, n and percentage of all rows, from the most frequent."""
    n = rows.groupBy((F.col(by) if isinstance(by, str) else by).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.crossJoin(F.broadcast(total)).select(name, "n", (F.col("n") * 100.0 / F.col("total")).alias("percent")).orderBy(F.col("n").desc(), name)


def histograms(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value, n) for several columns in one pass; null and empty count as unknown."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("unknown")).alias("value")) for c in columns]))
    return rows.select(pairs.alias("p")).groupBy("p.field", "p.value").agg(F.count(F.lit(1)).alias("n"))


def length_stats(rows: DataFrame, text: str = "answer") -> DataFrame:
    """One row: n_min, n_max, n_mean, n_median of text lengths; zeros for no rows.

    The median is the upper one: element n // 2 of the sorted lengths. Lengths are counted by value
    first, so what is ordered is as small as the number of different lengths.
    """
    by = rows.select(F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("len")).groupBy("len").agg(F.count(F.lit(1)).alias("n"))
    run = by.withColumn("upto", F.sum("n").over(Window.orderBy("len")))
    total = by.agg(F.sum("n").alias("total"), F.min("len").alias("n_min"), F.max("len").alias("n_max"), (F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("n_mean"))
    mid = run.crossJoin(F.broadcast(total)).filter(F.col("upto") > F.floor(F.col("total") / 2)).agg(F.min("len").alias("n_median"))
    zero = lambda c, t="bigint": F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c)
    return total.crossJoin(mid).select(zero("n_min"), zero("n_max"), zero("n_mean", "double"), zero("n_median"))


def inventory_summary(inventory: DataFrame) -> DataFrame:
    """Files by type, and how many of them need conversion."""
    return inventory.groupBy("file_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("needs_conversion") == "true").alias("to_convert"))


def operation_summary(log: DataFrame) -> DataFrame:
    """Preparation steps by operation and status."""
    return log.groupBy("operation", "status").agg(F.count(F.lit(1)).alias("n"))


def confidence_histogram(pages: DataFrame) -> DataFrame:
    return pages.groupBy(confidence_bucket("confidence").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def split_counts(rows: DataFrame, by: str, splits: tuple[str, ...] = ("train", "val")) -> DataFrame:
    """Rows of each value by split, 0 where there are none."""
    return rows.groupBy(F.coalesce(F.col(by).cast("string"), F.lit("unknown")).alias(by)).pivot("split", list(splits)).count().na.fill(0, list(splits))


def image_counts(rows: DataFrame, image: str = "image_path") -> DataFrame:
    """One row: records with an image, distinct images, records with text alone."""
    return rows.agg(F.count(image).alias("with_image"), F.count_distinct(image).alias("distinct_images"), F.count_if(F.col(image).isNull()).alias("text_only"))


def distinct_images(rows: DataFrame, image: str = "image_path") -> DataFrame:
    return rows.filter(F.col(image).isNotNull()).select(image).distinct()


def usage_totals(progress: DataFrame) -> DataFrame:
    """Sums of tokens, cost and pairs over a progress log."""
    return progress.agg(*[F.sum(c).alias(c) for c in ("tokens_input", "tokens_output", "cost_usd", "qa_count")])


def accuracy(rows: DataFrame, expected: str = "expected", actual: str = "actual") -> DataFrame:
    """One row: tested, correct, accuracy."""
    hit = F.col(expected).eqNullSafe(F.col(actual))
    return rows.agg(F.count(F.lit(1)).alias("tested"), F.count_if(hit).alias("correct"), F.avg(hit.cast("double")).alias("accuracy"))

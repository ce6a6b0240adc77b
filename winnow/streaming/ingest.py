"""Incremental ingest: files become table rows once each, whatever is restarted.

Progress is kept in the stream's own checkpoint folder together with a table of completed
items; both lie on the file system that the cluster shares.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.readers import exists

CHECKPOINT = "stage string, item_id string, status string, at timestamp"


def new_files(spark: SparkSession, folder: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the JSON rows in files that appear in a folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).json(folder)


def append_new(stream: DataFrame, key: str, target: str, checkpoint: str, process: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Append each key's first row to a Parquet table, in micro-batches, and stop when the input is used up.

    Which keys came before is the stream's state, so the work of a batch grows with the batch and
    not with the table. A batch that is run again after a failure overwrites what it wrote: each
    has a folder of its own, by the stream's id and the batch's number (columns stream and batch of
    the table). A stream that starts without its checkpoint beside a table that has rows looks its
    keys up there, until it ends. Within a batch any row of a key may be the one that stays.
    """
    spark = stream.sparkSession
    known = spark.read.parquet(target).select(key).distinct() if exists(spark, target) and not exists(spark, checkpoint) else None

    def write(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = batch if known is None else batch.join(known, key, "left_anti")
        (process(rows) if process else rows).write.mode("overwrite").parquet(f"{target}/stream={own}/batch={number}")

    return stream.dropDuplicates([key]).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_stream(stream: DataFrame, key: str, time: str | None = None, late: str = "1 day") -> DataFrame:
    """A stream without rows whose key came before; with a time column, state older than `late` is let go."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key]) if time else stream.dropDuplicates([key])


def record_progress(items: DataFrame, stage: str, path: str, status: str = "completed", id_col: str = "item_id") -> None:
    """Append items to the table of progress."""
    items.select(F.lit(stage).alias("stage"), F.col(id_col).cast("string").alias("item_id"), F.lit(status).alias("status"), F.current_timestamp().alias("at")).write.mode("append").parquet(path)


def read_progress(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """(item_id, status) of a stage, the latest status of each item; none if there is no table yet."""
    rows = spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], CHECKPOINT)
    return rows.filter(F.col("stage") == stage).groupBy("item_id").agg(F.max_by("status", F.struct("at", "status")).alias("status"))


def remaining(items: DataFrame, progress: DataFrame, id_col: str = "item_id") -> DataFrame:
    """Items that are not completed; failed ones are among them."""
    done = progress.filter("status = 'completed'").select(F.col("item_id").alias("__done"))
    return items.join(done, F.col(id_col).cast("string") == F.col("__done"), "left_anti")


def progress_summary(spark: SparkSession, path: str) -> DataFrame:
    """By stage: items completed and failed, first and last time."""
    rows = spark.read.parquet(path)
    last = rows.groupBy("stage", "item_id").agg(F.max_by("status", F.struct("at", "status")).alias("status"), F.min("at").alias("a"), F.max("at").alias("b"))
    return last.groupBy("stage").agg(F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"), F.min("a").alias("started_at"), F.max("b").alias("updated_at"))

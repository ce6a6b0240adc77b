"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import tempfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import reach


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reach(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Without one a local session, as in tests, gets a temporary folder; any other is refused."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="winnow-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder, so that lost executors cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder, on whatever file system it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints that nothing refers to any more; it learns of them by collecting garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores before it until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(col: str | Column = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fold_of(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % folds


def fold_of_id(doc_id: object, folds: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def small_batches(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a batch holds about max_bytes of the text column, one row at least."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, int(n * max_bytes / max(1, batch.column(column).nbytes)))
        for at in range(0, n, step):
            yield batch.slice(at, step)


#: Bits of a bitmap for each key that may be in it, and its buckets of 32,768 bits (4 KB): at most 256 MB.
BITS, LEAST_BUCKETS, MOST_BUCKETS = 16, 16, 1 << 16


def _bit(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets * 32768)) + 1


def maybe_among(rows: DataFrame, key: str, keys: DataFrame, most: int) -> DataFrame:
    """The rows whose key is among the keys (a table of one column), and a few others.

    A bitmap of the keys' hashes is probed while the rows are scanned, so that an exact join
    afterwards shuffles few other rows. most is an upper bound of the number of keys, by which the
    bitmap is sized; its size has a bound of its own, so it is safe to broadcast. Beyond some
    hundred million keys it fills up and spares less; the result of that join stays the same.
    """
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-most * BITS // 32768)))
    bits = keys.toDF("__k").select(_bit(F.col("__k"), buckets).alias("__b")).groupBy(F.expr("bitmap_bucket_number(__b)").alias("__bucket"))
    bitmap = bits.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(__b))").alias("__bitmap"))
    probe = rows.withColumn("__b", _bit(F.col(key), buckets)).withColumn("__bucket", F.expr("bitmap_bucket_number(__b)")).withColumn("__at", F.expr("bitmap_bit_position(__b)"))
    byte = F.conv(F.hex(F.substring("__bitmap", (F.col("__at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(__byte, cast(__at % 8 as int))").bitwiseAND(F.lit(1)) == 1
    return probe.join(F.broadcast(bitmap), "__bucket").withColumn("__byte", byte).filter(hit).select(*rows.columns)

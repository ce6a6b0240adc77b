"""Sessions, and tables that outlive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which all executors share.

    A local session without one, as in tests, gets a temporary folder; a cluster must name its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="winnow-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder below the shared one, deleted in the end: what is read from it must be made durable before."""
    folder = f"{shared_folder(spark)}/winnow-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

"""Lets Python workers import this package where the session was started from another folder."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def reach(spark: SparkSession) -> SparkSession:
    """Add the package's folder to the workers' import path; on a cluster the same files come by --py-files."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (ROOT, env.get("PYTHONPATH")) if x)
    return spark

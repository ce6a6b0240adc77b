"""Ranks and running sums over a whole table in order, without gathering it in one task.

Rows are dealt to ranges of the order and sorted there; each range's count or sum comes from a
small table of one row a range. The dealt rows are written to the shared folder, so that both steps
see the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

#: monotonically_increasing_id holds the partition above this bit and the row's place in it below.
_BIT = 33


def _dealt(rows: DataFrame, order: list[str | Column]) -> DataFrame:
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id())
    return durable(placed.withColumn("__p", F.shiftright("__m", _BIT)).withColumn("__i", F.col("__m").bitwiseAND(F.lit((1 << _BIT) - 1))).drop("__m"))


def _before(per_range: DataFrame, value: str) -> DataFrame:
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select("__p", F.sum(value).over(w).alias("__b"))


def with_rank(rows: DataFrame, order: list[str | Column], name: str = "rank") -> DataFrame:
    """rows with their place in the order, from 1. Ties are told apart arbitrarily: give a total order."""
    dealt = _dealt(rows, order)
    before = _before(dealt.groupBy("__p").agg(F.count(F.lit(1)).alias("__n")), "__n")
    return dealt.join(F.broadcast(before), "__p").select(*rows.columns, (F.coalesce("__b", F.lit(0)) + F.col("__i") + 1).alias(name))


def with_sum_before(rows: DataFrame, order: list[str | Column], value: str, name: str = "spent") -> DataFrame:
    """rows with the sum of value over all rows before them in the order."""
    dealt = _dealt(rows, order)
    before = _before(dealt.groupBy("__p").agg(F.sum(value).alias("__n")), "__n")
    own = F.sum(value).over(Window.partitionBy("__p").orderBy("__i").rowsBetween(Window.unboundedPreceding, -1))
    met = dealt.withColumn("__own", own).join(F.broadcast(before), "__p")
    return met.select(*rows.columns, (F.coalesce("__b", F.lit(0)) + F.coalesce("__own", F.lit(0))).alias(name))

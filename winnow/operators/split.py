"""Splits, samples and running budgets: deterministic whatever the partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import with_sum_before


def shuffle_key(seed: int, id_col: str) -> Column:
    """Orders rows as if shuffled: MD5 of seed and id."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string")))


def stratified_split(rows: DataFrame, ratio: float = 0.9, seed: int = 42, by: str | None = "section_id", id_col: str = "qa_id") -> DataFrame:
    """rows with split: of each stratum the first floor(n * ratio) shuffled rows are train, the rest val.

    A null or missing stratum is unknown; a stratum of one row goes to val whole. by=None splits
    all rows as one stratum, whose lone row is dealt by a coin. Strata are ranked in two steps, by
    a prefix of the shuffle key and within it, so that a stratum with a third of all rows is sorted
    in many tasks.
    """
    if not 0 < ratio < 1:
        raise ValueError("ratio must lie between 0 and 1")
    stratum = F.lit("all") if by is None else F.coalesce(F.col(by).cast("string"), F.lit("unknown")) if by in rows.columns else F.lit("unknown")
    keyed = rows.withColumn("__s", stratum).withColumn("__k", shuffle_key(seed, id_col)).withColumn("__p", F.substring("__k", 1, 2))
    sizes = keyed.groupBy("__s", "__p").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__s").orderBy("__p")
    base = sizes.withColumn("__before", F.sum("__n").over(w) - F.col("__n")).withColumn("__all", F.sum("__n").over(Window.partitionBy("__s"))).drop("__n")
    ranked = keyed.withColumn("__r", F.row_number().over(Window.partitionBy("__s", "__p").orderBy("__k", id_col))).join(base, ["__s", "__p"])
    take = F.floor(F.col("__all") * F.lit(float(ratio)))
    train = F.col("__before") + F.col("__r") <= take
    if by is None:
        train = F.when(F.col("__all") == 1, F.conv(F.substring("__k", 1, 4), 16, 10).cast("double") / 65536 < ratio).otherwise(train)
    return ranked.withColumn("split", F.when(train, "train").otherwise("val")).select(*rows.columns, "split")


def sample(rows: DataFrame, k: int, seed: int = 42, id_col: str = "qa_id") -> DataFrame:
    """k shuffled rows, all if there are no more."""
    return rows.orderBy(shuffle_key(seed, id_col), id_col).limit(k)


def diverse_sample(rows: DataFrame, n: int, patterns: list[str], is_last: Column, section: str = "section_dir", name: str = "filename", order: str = "ord") -> DataFrame:
    """At most one row of each section, n in all, by the first pattern its name matches; is_last rows fill up only if no pattern does.

    Rows that match no pattern are taken last, and only where is_last is false.
    """
    rank = F.coalesce(*[F.when(F.col(name).rlike(p), F.lit(i)) for i, p in enumerate(patterns)], F.when(~is_last, F.lit(len(patterns))))
    ranked = rows.withColumn("priority", rank).filter("priority is not null")
    first = ranked.withColumn("__rn", F.row_number().over(Window.partitionBy(section).orderBy("priority", order))).filter("__rn = 1").drop("__rn")
    return first.orderBy("priority", order).limit(n)


def within_budget(rows: DataFrame, budget: float | None, order: str = "ord", cost: str = "cost", scope: str | None = None) -> DataFrame:
    """rows with spent (before the row) and status: done while spent < budget, then crossing, then not_run.

    Sums run over the whole table in ranges of the order, or within a scope column's values.
    The row that uses the budget up still runs: it is crossing if its cost takes the sum to the
    budget or past it. No budget: all are done.
    """
    if scope:
        w = Window.partitionBy(scope).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        out = rows.withColumn("spent", F.coalesce(F.sum(cost).over(w), F.lit(0.0)))
    else:
        out = with_sum_before(rows, [order], cost)
    if budget is None:
        return out.withColumn("status", F.lit("done"))
    return out.withColumn("status", F.when(F.col("spent") >= budget, "not_run").when(F.col("spent") + F.col(cost) >= budget, "crossing").otherwise("done"))


def page_slice(rows: DataFrame, limit: int | None = None, start_from: str | None = None, id_col: str = "page_id", order: str = "ord") -> DataFrame:
    """The first `limit` rows in order, of these the ones from start_from on; an unknown start means the first."""
    out = rows.orderBy(order).limit(limit) if limit is not None else rows
    if start_from is None:
        return out
    at = out.filter(F.col(id_col) == start_from).agg(F.min(order).alias("__at"))
    return out.crossJoin(F.broadcast(at)).filter(F.col("__at").isNull() | (F.col(order) >= F.col("__at"))).drop("__at")


def top_n(rows: DataFrame, n: int, order: list[str | Column]) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def top_per_group(rows: DataFrame, by: str | list[str], n: int, order: list[str | Column]) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("rank") <= n)

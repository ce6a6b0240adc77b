"""Connected components of a graph given by edges, by alternating large-star and small-star steps."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, sweep

#: Edges that a task writes.
EDGES_PER_TASK = 250_000
#: Parts that a node's neighbours are dealt to, so that those of a hot node are spread over tasks.
PARTS = 64


def with_least(edges: DataFrame, node: str, other: str) -> DataFrame:
    """edges with m, the least `other` of all edges of their node.

    A node's edges are dealt to PARTS parts. The least of each part is found where the part lies,
    the least of these is one more aggregate, and it goes back to the parts: no task gets all edges
    of a node, only one row for each of its parts.
    """
    dealt = edges.withColumn("__part", F.pmod(F.xxhash64(other), F.lit(PARTS)))
    parts = dealt.groupBy(node, "__part").agg(F.min(other).alias("__least"))
    whole = parts.groupBy(node).agg(F.min("__least").alias("m"))
    return dealt.join(parts.select(node, "__part").join(whole, node), [node, "__part"]).drop("__part")


#: Edges that one task joins by itself; more are joined in rounds.
IN_TASK = 500_000


def _joined(edges: pa.Table) -> pa.Table:
    """(a, b): each node b of the edges but the least of its component, a, beside it."""
    names, flat = np.unique(np.concatenate([edges.column("a").to_numpy(), edges.column("b").to_numpy()]), return_inverse=True)
    x, y = flat[: edges.num_rows], flat[edges.num_rows :]
    least = np.arange(len(names))
    while True:  # each end takes the other's least node, then that node's, until none changes
        before = least.copy()
        np.minimum.at(least, x, least[y])
        np.minimum.at(least, y, least[x])
        np.minimum.at(least, before, least)
        least = least[least]
        if (least == before).all():
            break
    b = np.flatnonzero(least != np.arange(len(names)))
    return pa.table([names[least[b]], names[b]], names=["a", "b"])


def components(edges: DataFrame, rounds: int = 40, in_task: int = IN_TASK) -> DataFrame:
    """(node, component) for every node of the edges' columns a and b; component is the least node.

    Few edges, by a count of them, are joined in one task; the following holds for more.
    Each step joins a node's neighbours to the least of them, so stars form in few rounds whatever
    the diameter. A hot node's neighbours are aggregated and joined in parts. The edges are written
    to the shared folder each round.
    """

    def state(df: DataFrame) -> tuple[int, int]:
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    now = durable(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    known, before = now, state(now)
    tasks = max(8, math.ceil(before[0] / EDGES_PER_TASK))
    if before[0] <= in_task:
        now, rounds = now.withColumn("__all", F.lit("all")).groupBy("__all").applyInArrow(_joined, "a bigint, b bigint"), 0
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours of a node are joined to the least of the node and its neighbours
        large = with_least(both, "a", "b").filter("b > a").select(F.least("a", "m").alias("a"), "b").filter("a < b")
        # small star: smaller neighbours of a node, and the node, are joined to the least of them
        small = with_least(large, "b", "a")
        small = small.select("m", F.explode(F.array("a", "b")).alias("b")).select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        now = durable(small.coalesce(tasks))
        sweep(now.sparkSession)
        after = state(now)
        if after == before:
            break
        before = after
    else:
        if rounds:
            raise RuntimeError("the components did not settle")
    nodes = known.select(F.col("a").alias("node")).unionByName(known.select(F.col("b").alias("node"))).distinct()
    return nodes.join(now.select(F.col("b").alias("node"), F.col("a").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))

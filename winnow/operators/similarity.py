"""Similarity joins and leader clustering as DataFrame plans."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .order import with_rank

#: Rows of a block of the blocked vector join; rows of one block that meet another at once.
BLOCK, STRIP = 2048, 512


def unit(vector: Column | str) -> Column:
    """A vector of doubles divided by its length; a zero vector stays."""
    v = F.transform(F.col(vector) if isinstance(vector, str) else vector, lambda x: x.cast("double"))
    n = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(v, lambda x: x / F.when(n == 0, F.lit(1.0)).otherwise(n))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def cosine_pairs(vectors: DataFrame, threshold: float, id_col: str = "id", vector: str = "embedding", block: int = BLOCK, scope: tuple[str, ...] = ()) -> DataFrame:
    """(scope, a, b, similarity) of all pairs a < b within a scope whose cosine reaches the threshold.

    Exact. The vectors of a scope are dealt to blocks; a task gets two blocks and multiplies them as
    matrices, so work is even, no task holds more than two blocks, and only pairs at the threshold
    leave it. The number of blocks follows from the number of vectors. Rows with a null id or a null
    vector have no pairs; vectors of one scope must be of one length, others raise. A zero vector is
    at right angles to all. Work grows with the square of a scope: see candidate_pairs.
    """
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull()).select(*scope, F.col(id_col).alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    if scope:
        sizes = rows.groupBy(*scope).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n"))
        rows = rows.join(sizes, [*scope])
    else:
        rows = rows.withColumn("n", F.lit(max(1, -(-vectors.count() // block))))
    own = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(*scope, "id", "v", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in scope]
    kind = rows.schema["id"].dataType.simpleString()

    def meet(t: pa.Table) -> pa.Table:
        t = t.sort_by("id").combine_chunks()
        v, own = t.column("v").combine_chunks(), t.column("own").to_numpy()
        if len(pc.unique(pc.list_value_length(v))) > 1:
            raise ValueError("vectors of one scope must be of one length")
        flat = v.flatten().to_numpy(zero_copy_only=False)
        m = flat.reshape(t.num_rows, len(flat) // t.num_rows)
        size = np.sqrt((m * m).sum(axis=1, keepdims=True))
        m = m / np.where(size == 0, 1.0, size)
        x, y = t.column("x")[0].as_py(), t.column("y")[0].as_py()
        left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
        found_a, found_b, found_s = [], [], []
        # in strips: of two blocks each row of one meets each of the other, of one block with itself the later ones
        for at in range(0, len(left), STRIP):
            rows = left[at : at + STRIP]
            others = right[at:] if x == y else right
            s = m[rows] @ m[others].T
            i, j = np.nonzero(s >= threshold)
            a, b, s = rows[i], others[j], s[i, j]
            keep = a < b if x == y else slice(None)
            found_a.append(np.minimum(a, b)[keep])
            found_b.append(np.maximum(a, b)[keep])
            found_s.append(s[keep])
        i, j, s = (pa.array(np.concatenate([*part, empty])) for part, empty in ((found_a, np.empty(0, np.int64)), (found_b, np.empty(0, np.int64)), (found_s, np.empty(0))))
        ids = t.column("id")
        return pa.table([*(t.column(c).take(i) for c in scope), ids.take(i), ids.take(j), s], names=[*scope, "a", "b", "similarity"])

    return dealt.groupBy(*scope, "x", "y").applyInArrow(meet, ", ".join([*kinds, f"a {kind}, b {kind}, similarity double"]))


#: Planes whose sides make one key of candidate_pairs.
PLANES = 16


def tables_for(threshold: float, recall: float, planes: int = PLANES) -> int:
    """The fewest tables of keys by which a pair at the threshold shares a key with the target probability."""
    same = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** planes
    return 1 if same >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - same))


def candidate_pairs(vectors: DataFrame, threshold: float, id_col: str = "id", vector: str = "embedding", recall: float = 0.99, planes: int = PLANES, scope: tuple[str, ...] = ()) -> DataFrame:
    """What cosine_pairs returns, for tables too large to compare all with all: a pair at the threshold is found with a probability of `recall` at least, more similar ones with more.

    Random planes give each vector a key in each of several tables; vectors that share a key are
    compared exactly, so no pair below the threshold is returned. Vectors travel once for each pair
    that they are a candidate of. Equal vectors are one until the end. Meant for thresholds of
    about 0.8 and more: the number of tables grows fast below. Null ids and vectors have no pairs.
    """
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull()).select(*scope, F.col(id_col).alias("id"), unit(F.col(vector)).alias("v"))
    keyed = rows.withColumns({"__h": F.xxhash64("v"), "__k": F.xxhash64("v", F.lit(1))})
    least = keyed.groupBy(*scope, "__h", "__k").agg(F.min("id").alias("rep"), F.first("v").alias("v"))
    member = durable(keyed.drop("v").join(least.drop("v"), [*scope, "__h", "__k"]).select(*scope, "id", "rep"))
    own = durable(least.select(*scope, F.col("rep").alias("id"), "v"))
    tables = tables_for(threshold, recall, planes)
    kinds = ", ".join([*[f"`{c}` {own.schema[c].dataType.simpleString()}" for c in scope], f"id {own.schema['id'].dataType.simpleString()}", "keys array<bigint>"])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: np.ndarray | None = None
        for b in batches:
            v = np.array(b.column("v").to_pylist(), dtype=np.float64).reshape(b.num_rows, -1)
            if sides is None or sides.shape[0] != v.shape[1]:
                sides = np.random.default_rng(17).normal(size=(v.shape[1], tables * planes))
            bits = (v @ sides >= 0).reshape(b.num_rows, tables, planes)
            found = (bits * (1 << np.arange(planes))).sum(axis=2) + (np.arange(tables) << planes)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * tables, pa.int32()), pa.array(found.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in scope), b.column("id"), lists], names=[*scope, "id", "keys"])

    each = own.mapInArrow(keys, kinds).select(*scope, "id", F.explode("keys").alias("key"))
    met = each.toDF(*scope, "a", "key").join(each.toDF(*scope, "b", "key"), [*scope, "key"]).filter("a < b").select(*scope, "a", "b").distinct()
    pairs = met.join(own.toDF(*scope, "a", "__x"), [*scope, "a"]).join(own.toDF(*scope, "b", "__y"), [*scope, "b"])
    near = pairs.select(*scope, "a", "b", dot(F.col("__x"), F.col("__y")).alias("similarity")).filter(F.col("similarity") >= threshold)
    apart = near.join(member.toDF(*scope, "__a", "a"), [*scope, "a"]).join(member.toDF(*scope, "__b", "b"), [*scope, "b"])
    zero = own.filter(dot(F.col("v"), F.col("v")) == 0).select(*scope, F.col("id").alias("rep"))  # at right angles to themselves
    alike = member.join(zero, [*scope, "rep"], "left_anti")
    alike = alike.select(*scope, "rep", F.col("id").alias("__a")).join(alike.select(*scope, "rep", F.col("id").alias("__b")), [*scope, "rep"]).filter("__a < __b")
    both = apart.select(*scope, F.least("__a", "__b").alias("a"), F.greatest("__a", "__b").alias("b"), "similarity")
    return both.unionByName(alike.select(*scope, F.col("__a").alias("a"), F.col("__b").alias("b"), F.lit(1.0).alias("similarity")))


def jaccard_pairs(sets: DataFrame, threshold: float, scope: tuple[str, ...] = (), id_col: str = "id", items: str = "words", expand: bool = True) -> DataFrame:
    """(scope, a, b, similarity) of the pairs a < b within a scope whose item sets' Jaccard similarity reaches the threshold.

    Equal sets are one, by the name of their least id; expand=False returns the pairs between those
    alone, and class_of says which rows they stand for. expand=True names every pair of rows.

    Exact, by prefixes: items are ordered from the rarest; two sets that reach the threshold share
    one of the first size - ceil(threshold * size) + 1 items of each. Those alone are joined, as
    hashes, between sets of like sizes, and counted: what two prefixes share and all that may follow
    them must reach the overlap that the threshold asks for. What passes, little more than the
    result, is verified on the whole sets. Rows with a null id, a null or an empty set have no pairs.
    """
    rows = _keyed(sets, scope, id_col, items).groupBy(*scope, "__h", "__k", "__n").agg(F.min("id").alias("id"), F.first("items").alias("items")).drop("__h", "__k", "__n")
    tokens = _prefixes(rows.select(*scope, "id", F.transform("items", lambda x: F.xxhash64(x)).alias("h")), _rarity(sets.select(items), items), threshold, scope)
    like = F.floor(F.log(F.col("n").cast("double")) / F.lit(1e-6 - math.log(max(threshold, 1e-9)))).cast("int")  # of two sets that reach the threshold the larger is in the smaller one's class or the next
    left = tokens.select(*scope, "item", like.alias("__class"), *[F.col(c).alias(f"{c}a") for c in ("id", "n", "__p", "__last")])
    right = tokens.select(*scope, "item", F.explode(F.array(like, like - 1)).alias("__class"), *[F.col(c).alias(f"{c}b") for c in ("id", "n", "__p", "__last")])
    ordered = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ida") < F.col("idb")))
    met = left.join(right, [*scope, "item", "__class"]).filter(ordered & (F.col("na") >= F.col("nb") * threshold - 1e-9))
    shared = met.groupBy(*scope, "ida", "idb").agg(F.count(F.lit(1)).alias("__c"), F.first(F.when(F.col("__lasta") <= F.col("__lastb"), F.col("na") - F.col("__pa")).otherwise(F.col("nb") - F.col("__pb"))).alias("__rest"), F.first(F.col("na") + F.col("nb")).alias("__n"))
    able = shared.filter(F.col("__c") + F.col("__rest") >= F.col("__n") * F.lit(threshold / (1 + threshold)) - 1e-6).select(*scope, F.least("ida", "idb").alias("a"), F.greatest("ida", "idb").alias("b"))
    whole = able.join(rows.toDF(*scope, "a", "__x"), [*scope, "a"]).join(rows.toDF(*scope, "b", "__y"), [*scope, "b"])
    both = F.size(F.array_intersect("__x", "__y"))
    s = both / (F.size("__x") + F.size("__y") - both)
    near = whole.select(*scope, "a", "b", s.alias("similarity")).filter(F.col("similarity") >= threshold)
    if not expand:
        return near
    own = class_of(sets, scope, id_col, items).select(*scope, "rep", "id")
    apart = near.join(own.toDF(*scope, "a", "__a"), [*scope, "a"]).join(own.toDF(*scope, "b", "__b"), [*scope, "b"])
    alike = own.toDF(*scope, "rep", "__a").join(own.toDF(*scope, "rep", "__b"), [*scope, "rep"]).filter("__a < __b").withColumn("similarity", F.lit(1.0))
    return apart.select(*scope, F.least("__a", "__b").alias("a"), F.greatest("__a", "__b").alias("b"), "similarity").unionByName(alike.select(*scope, F.col("__a").alias("a"), F.col("__b").alias("b"), "similarity"))


#: Counters of items by their hashes; _prefixes needs any fixed order that has rare items first.
COUNTERS = 1 << 18


def _rarity(sets: DataFrame, items: str) -> np.ndarray:
    """For each counter how often its items occur, as powers of 2 ** 0.25, up to 127."""
    n = sets.select(F.explode(F.transform(items, lambda x: F.xxhash64(x).bitwiseAND(F.lit(COUNTERS - 1)).cast("int"))).alias("i")).groupBy("i").count().toArrow()
    out = np.zeros(COUNTERS, dtype=np.int64)
    out[n.column("i").to_numpy()] = np.minimum(127, np.floor(4 * np.log2(n.column("count").to_numpy())))
    return out


def _prefixes(hashed: DataFrame, rarity: np.ndarray, threshold: float, scope: tuple[str, ...]) -> DataFrame:
    """(scope, id, n, __p, __last, item): the first __p of a set's n items, and the last of them in the order. hashed has (scope, id, h)."""
    order = hashed.sparkSession.sparkContext.broadcast(rarity)
    kinds = [*[f"`{c}` {hashed.schema[c].dataType.simpleString()}" for c in scope], f"id {hashed.schema['id'].dataType.simpleString()}"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = order.value
        for b in batches:
            lists = b.column("h")
            h = lists.flatten().to_numpy()
            n = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(n)), n)
            key = (level[h & (COUNTERS - 1)] << 56) | (h & ((1 << 56) - 1))
            key = key[np.lexsort((key, row))]
            p = n - np.ceil(n * threshold - 1e-9).astype(n.dtype) + 1
            p = np.minimum(p, n)
            start = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n
            kept = np.arange(len(key)) - start[row] < p[row]
            at = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in (*scope, "id")), pa.array(n[row[kept]], pa.int32()), pa.array(p[row[kept]], pa.int32()), pa.array(key[start + p - 1][row[kept]], pa.int64()), pa.array(key[kept], pa.int64())], names=[*scope, "id", "n", "__p", "__last", "item"])

    return hashed.mapInArrow(cut, ", ".join([*kinds, "n int, __p int, __last bigint, item bigint"]))


def _keyed(sets: DataFrame, scope: tuple[str, ...], id_col: str, items: str) -> DataFrame:
    """(scope, id, items) of the rows with an id and items, with 128 bits of two hashes that the items' order doesn't change, and their number."""
    rows = sets.select(*scope, F.col(id_col).alias("id"), F.array_distinct(items).alias("items")).filter((F.size("items") > 0) & F.col("id").isNotNull())
    ordered = F.array_sort("items")
    return rows.withColumns({"__h": F.xxhash64(ordered), "__k": F.xxhash64(ordered, F.lit(1)), "__n": F.size("items")})


def class_of(sets: DataFrame, scope: tuple[str, ...] = (), id_col: str = "id", items: str = "words") -> DataFrame:
    """(scope, id, rep): for each row with items the least id of the rows of its scope with an equal set of them. Only hashes are shuffled."""
    keyed = _keyed(sets, scope, id_col, items).drop("items")
    least = keyed.groupBy(*scope, "__h", "__k", "__n").agg(F.min("id").alias("rep"))
    return keyed.join(least, [*scope, "__h", "__k", "__n"]).select(*scope, "id", "rep")


def leaders(vectors: DataFrame, threshold: float, scope: tuple[str, ...] = (), recall: float | None = None) -> DataFrame:
    """(id, ord, leader, similarity): greedy leader clustering of (id, ord, embedding) by cosine, in the order of ord.

    A row becomes a leader unless an earlier leader of its scope is near it; the earliest such
    leader claims it. A leader's own similarity is 1. Rows of equal ord are taken by id; rows with a
    null id, vector or scope are near no other. With a recall the near pairs are those of
    candidate_pairs, see lead. Without one rows are compared with leaders alone, and pairs are never
    listed: the first open rows of each scope are walked through in turn, then all open rows are
    held against the leaders found there, in blocks; what none of them claims goes on to the next
    round. A task holds at most TURN rows and leaders, or a little more.
    """
    if recall is not None:
        near = candidate_pairs(vectors.select(*scope, "id", "embedding"), threshold, recall=recall, scope=scope)
        return lead(vectors.select("id", "ord"), near.select("a", "b", "similarity"))
    alone = lambda rows: rows.select("id", "ord", F.col("id").alias("leader"), F.lit(1.0).alias("similarity"))
    if threshold > 1 + 1e-9:  # no cosine reaches it
        return alone(vectors)
    able = F.lit(True)
    for c in (*scope, "id", "embedding"):
        able &= F.col(c).isNotNull()
    named = [f"__s{i}" for i in range(len(scope))] or ["__s"]
    rows = vectors.filter(able).select(*([F.col(c).alias(n) for c, n in zip(scope, named, strict=False)] or [F.lit(0).alias("__s")]), "id", "ord", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    ranked = with_rank(rows, ["ord", "id"], "pos")
    open_ = ranked.select(*named, "v", "pos")
    kinds = {c.name: c.dataType.simpleString() for c in open_.schema}
    of_rows = ", ".join(f"{c} {kinds[c]}" for c in open_.columns)
    claims = []
    while True:
        sizes = durable(_first_rows(open_, named))
        sized = open_.join(sizes, named)
        new = durable(sized.filter("pos <= cut").select(*open_.columns).groupBy(*named).applyInArrow(lambda t: _walked(t, threshold), of_rows))
        dealt = sized.withColumn("x", F.pmod(F.xxhash64("pos"), F.col("blocks")).cast("int")).select(*open_.columns, "x")
        sent = new.join(sizes, named).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*named, F.col("v").alias("w"), F.col("pos").alias("lpos"), "x")
        met = durable(dealt.groupBy(*named, "x").cogroup(sent.groupBy(*named, "x")).applyInArrow(lambda r, l: _claimed(r, l, threshold, named), f"{of_rows}, lpos bigint, similarity double"))
        claims.append(met.filter("similarity is not null").select("pos", "lpos", "similarity"))
        open_ = met.filter("similarity is null").select(*open_.columns)
        if open_.isEmpty():
            break
    told = reduce(DataFrame.unionByName, claims).join(ranked.select("pos", "id", "ord"), "pos").join(ranked.select(F.col("pos").alias("lpos"), F.col("id").alias("leader")), "lpos")
    return alone(vectors.filter(~able)).unionByName(told.select("id", "ord", "leader", "similarity"))


#: Rows of a scope that one task walks through in turn, and of a block that is held against leaders.
TURN, HELD = 8192, 4096
#: Rows that are multiplied at a time.
STEP = 512


def _first_rows(open_: DataFrame, named: list[str]) -> DataFrame:
    """For each scope the position up to which about TURN rows are open, and how many blocks its open rows make."""
    n = open_.groupBy(*named).agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("least"), F.max("pos").alias("most"), F.percentile_approx("pos", [k / 1000 for k in range(1, 1001)], 10000).alias("p"))
    share = F.floor(F.lit(1000.0 * TURN) / F.col("n")).cast("int")
    cut = F.when(F.col("n") <= TURN, F.col("most")).when(share >= 1, F.element_at("p", F.greatest(F.lit(1), F.least(F.lit(1000), share)))).otherwise(F.least(F.element_at("p", F.lit(1)), F.col("least") + TURN - 1))
    return n.select(*named, cut.alias("cut"), F.ceil(F.col("n") / HELD).cast("int").alias("blocks"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, divided by their lengths; a zero vector stays."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    n = np.diff(lists.offsets.to_numpy())
    if len(n) and (n != n[0]).any():
        raise ValueError("vectors of one scope must be of one length")
    m = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(n), -1)
    size = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(size == 0, 1.0, size)


def _walked(t: pa.Table, threshold: float) -> pa.Table:
    """The leaders among rows, one row after the other."""
    t = t.sort_by("pos")
    m = _matrix(t.column("v"))
    chosen: list[int] = []
    for at in range(0, len(m), STEP):
        some = m[at : at + STEP]
        free = ~((some @ m[chosen].T >= threshold).any(axis=1)) if chosen else np.ones(len(some), dtype=bool)
        near = some @ some.T >= threshold
        own: list[int] = []
        for i in np.flatnonzero(free).tolist():
            if not near[i, own].any():
                own.append(i)
        chosen += [at + i for i in own]
    return t.take(pa.array(chosen, pa.int64()))


def _claimed(rows: pa.Table, leaders: pa.Table, threshold: float, named: list[str]) -> pa.Table:
    """rows with the earliest leader before them that is near, and its cosine: nulls for a row that has none. A leader claims itself."""
    leaders = leaders.sort_by("lpos")
    pos, lpos = rows.column("pos").to_numpy(), leaders.column("lpos").to_numpy()
    who, how = np.full(len(pos), -1), np.zeros(len(pos))
    if len(pos) and len(lpos):
        m, w = _matrix(rows.column("v")), _matrix(leaders.column("w"))
        at = np.minimum(np.searchsorted(lpos, pos), len(lpos) - 1)
        own = lpos[at] == pos
        who[own], how[own] = at[own], 1.0
        for k in range(0, len(lpos), STEP):
            left = np.flatnonzero(who < 0)
            s = m[left] @ w[k : k + STEP].T
            good = (s >= threshold) & (lpos[None, k : k + STEP] < pos[left, None])
            first = good.argmax(axis=1)
            hit = good[np.arange(len(left)), first]
            who[left[hit]], how[left[hit]] = k + first[hit], s[hit, first[hit]]
    none = who < 0
    claimed = leaders.column("lpos").take(pa.array(who, pa.int64(), mask=none))
    kept = rows.column("v").take(pa.array(np.arange(len(pos)), pa.int64(), mask=~none))  # a claimed row needs its vector no more
    return rows.select(named).append_column("v", kept).append_column("pos", rows.column("pos")).append_column("lpos", claimed).append_column("similarity", pa.array(how, pa.float64(), mask=none))


def _in_turn(edges: pa.Table) -> pa.Table:
    """The leaders among the nodes of a graph of (src, dst) edges from earlier to later rows, one row after the other."""
    src, dst = edges.column("src").to_numpy(), edges.column("dst").to_numpy()
    names, flat = np.unique(np.concatenate([src, dst]), return_inverse=True)
    src, dst = flat[: len(src)], flat[len(src) :]
    order = np.argsort(src, kind="stable")
    after, ends = dst[order], np.searchsorted(src[order], np.arange(len(names) + 1))
    waits = np.bincount(dst, minlength=len(names))
    covered = np.zeros(len(names), dtype=bool)
    ready = np.flatnonzero(waits == 0).tolist()
    for k in ready:  # grows: a row is ready when all its earlier neighbours are decided
        for j in after[ends[k] : ends[k + 1]].tolist():
            covered[j] |= not covered[k]
            waits[j] -= 1
            if not waits[j]:
                ready.append(j)
    return pa.table([names[~covered]], names=["id"])


#: Edges between undecided rows that one task walks through in turn; more are decided in rounds.
IN_TURN = 500_000


def lead(rows: DataFrame, near: DataFrame, in_turn: int = IN_TURN) -> DataFrame:
    """(id, ord, leader, similarity): greedy leaders of (id, ord) rows, given their near pairs (a, b, similarity).

    In each round the undecided rows without an undecided earlier neighbour become leaders and
    cover their later neighbours; this reproduces the sequential result in few rounds. When few
    edges between undecided rows are left, as in a long chain, one task walks through them in
    turn. Only rows with neighbours take part. ord must order the rows: of two near rows with equal
    ord neither is the earlier one, and both may lead.
    """
    o = rows.select(F.col("id").alias("a"), F.col("ord").alias("oa")), rows.select(F.col("id").alias("b"), F.col("ord").alias("ob"))
    both = near.join(o[0], "a").join(o[1], "b").filter("oa <> ob")
    early = F.col("oa") < F.col("ob")
    named = durable(both.select(F.when(early, F.col("a")).otherwise(F.col("b")).alias("__src"), F.when(early, F.col("b")).otherwise(F.col("a")).alias("__dst"), "similarity"))
    number = durable(named.select(F.col("__src").alias("__id")).union(named.select(F.col("__dst").alias("__id"))).distinct().withColumn("n", F.monotonically_increasing_id()))
    edges = durable(named.join(number.toDF("__src", "src"), "__src").join(number.toDF("__dst", "dst"), "__dst").select("src", "dst", "similarity"))
    open_, chosen = number.select(F.col("n").alias("id")), number.select(F.col("n").alias("id")).limit(0)
    live = edges.select("src", "dst")
    while True:
        left = live.count()
        if left <= in_turn:
            alone = open_.join(live.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), "id", "left_anti")
            chosen = chosen.union(alone).union(live.withColumn("__all", F.lit("all")).groupBy("__all").applyInArrow(_in_turn, "id bigint"))
            break
        new = durable(open_.join(live.select(F.col("dst").alias("id")).distinct(), "id", "left_anti"))
        covered = live.join(new.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id")).distinct()
        chosen = durable(chosen.union(new))
        open_ = durable(open_.join(new, "id", "left_anti").join(covered, "id", "left_anti"))
        live = durable(live.join(open_.select(F.col("id").alias("src")), "src", "left_semi").join(open_.select(F.col("id").alias("dst")), "dst", "left_semi"))
    chosen = durable(chosen)
    claims = edges.join(chosen.select(F.col("id").alias("src")), "src", "left_semi").join(chosen.select(F.col("id").alias("dst")), "dst", "left_anti")
    told = claims.join(number.toDF("__src", "src"), "src").join(rows.select(F.col("id").alias("__src"), F.col("ord").alias("__o")), "__src")
    first = told.groupBy("dst").agg(F.min_by(F.struct("__src", "similarity"), "__o").alias("c")).join(number.toDF("__dst", "dst"), "dst")
    first = first.select(F.col("__dst").alias("id"), F.col("c.__src").alias("leader"), F.col("c.similarity").alias("similarity"))
    return rows.join(first, "id", "left").select("id", "ord", F.coalesce("leader", "id").alias("leader"), F.coalesce("similarity", F.lit(1.0)).alias("similarity"))

"""N-gram Jaccard join by MinHash banding, verified on the full n-gram sets.

A text's n-grams of words are hashed to a set. Equal sets are one node of what follows, whatever
number of documents has them. Band and row counts are chosen for a target recall at the threshold.
Nodes are shuffled on their band hashes; those that share one are joined to the least of them, and
the components of that graph are the units of verification. A unit that fits a task is verified in
one: pairs that share a band are compared on their sets. A larger unit is verified bucket by bucket,
large buckets in blocks, each pair in the first band that it shares. Tasks return counts and
spanning links of what they verified, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, free_name, maybe_among, small_batches, sweep, text_of
from .components import components

N, THRESHOLD, RECALL = 5, "0.8", 0.99999
#: Rows of a band.
ROWS = 5
#: Nodes, and hashed n-grams, of a unit that one task verifies; nodes of a block of a larger unit's bucket.
UNIT_NODES, UNIT_GRAMS, BLOCK = 400, 1_000_000, 200
#: Distinct words whose hashes a worker remembers.
MEMO = 400_000


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """The fewest bands of so many rows by which a pair at the threshold is found with the target probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


class Shingler:
    """Hashed sets of word n-grams, and their MinHash bands. Words are what white space parts, in lower case."""

    def __init__(self, n: int, bands: int, rows: int):
        self.n, self.bands, self.rows = n, bands, rows
        r = np.random.default_rng(11)
        self.flip, self.mul = r.integers(0, 1 << 63, bands * rows, dtype=np.uint64), r.integers(0, 1 << 62, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.memo: dict[str, int] = {}
        self.hashes = np.zeros(1024, dtype=np.uint64)

    def _words(self, text: str) -> np.ndarray:
        words = text.lower().split()
        codes = np.fromiter(map(self.memo.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        lack = np.flatnonzero(codes < 0)
        if lack.size:
            if len(self.memo) > MEMO:
                self.memo = {}
                lack = np.arange(len(words))
            new = list(dict.fromkeys([words[i] for i in lack.tolist()]))
            used = len(self.memo)
            while used + len(new) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, self.hashes])
            self.hashes[used : used + len(new)] = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in new), dtype=np.uint64, count=len(new))
            self.memo.update(zip(new, range(used, used + len(new)), strict=True))
            codes[lack] = [self.memo[words[i]] for i in lack.tolist()]
        return self.hashes[codes]

    def grams(self, text: str) -> np.ndarray:
        """The sorted set of hashes of a text's n-grams; a text of fewer words has one gram, an empty text none."""
        w = self._words(text)
        if not len(w):
            return w
        n = min(self.n, len(w))
        with np.errstate(over="ignore"):
            h = np.zeros(len(w) - n + 1, dtype=np.uint64)
            for k in range(n):
                h = (h ^ w[k : len(w) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
        return np.unique(h)

    def band_hashes(self, grams: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each band's least values; that of no grams is the same everywhere."""
        least = np.full(self.bands * self.rows, np.iinfo(np.uint64).max, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for at in range(0, len(grams), 1024):
                np.minimum(least, ((grams[at : at + 1024, None] ^ self.flip) * self.mul).min(axis=0), out=least)
            out = np.arange(1, self.bands + 1, dtype=np.uint64)
            for column in least.reshape(self.bands, self.rows).T:
                out = (out ^ column) * np.uint64(0xD6E8FEB86659FD93)
                out ^= out >> np.uint64(32)
        return out


def similar(sets: list[np.ndarray], share: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Of the pairs that share marks (upper triangle), those whose sets reach the threshold."""
    sizes = np.array([len(x) for x in sets])
    low, high = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    share = np.triu(share, 1) & (low * threshold.denominator >= high * threshold.numerator)
    i, j = np.nonzero(share)
    good = np.zeros_like(share)
    if not len(i):
        return good
    if len(i) <= 4 * len(sets):
        both = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist(), strict=True)])
    else:  # by products of the sets' membership in stretches of the grams that several have
        used = np.unique(np.concatenate([i, j]))
        owner = np.repeat(np.arange(len(used)), sizes[used])
        flat = np.concatenate([sets[k] for k in used.tolist()])
        values, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
        keep = count > 1
        number = np.cumsum(keep) - 1
        owner, column = owner[keep[inverse]], number[inverse[keep[inverse]]]
        total = np.zeros((len(used), len(used)), dtype=np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for at in range(0, int(keep.sum()), 4096):
            a, b = np.searchsorted(column, [at, at + 4096])
            member = np.zeros((len(used), 4096), dtype=np.float32)
            member[owner[a:b], column[a:b] - at] = 1
            total += member @ member.T
        place = np.zeros(len(sets), dtype=np.int64)
        place[used] = np.arange(len(used))
        both = total[place[i], place[j]].astype(np.int64)
    either = sizes[i] + sizes[j] - both
    hit = both * threshold.denominator >= either * threshold.numerator
    good[i[hit], j[hit]] = True
    return good


def spanning(links: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph, each from a node to one of lower number's tree."""
    root = list(range(len(links)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(*(x.tolist() for x in np.nonzero(links)), strict=True):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def shared_bands(bands: np.ndarray, mine: int | None = None) -> np.ndarray:
    """Which nodes share a band; with `mine`, which share that band as the first one."""
    out = np.zeros((len(bands), len(bands)), dtype=bool)
    for k in range(bands.shape[1] if mine is None else mine):
        out |= bands[:, k, None] == bands[None, :, k]
    return out if mine is None else ~out & (bands[:, mine, None] == bands[None, :, mine])


def jaccard_classes(docs: DataFrame, n: int = N, threshold: str = THRESHOLD, recall: float = RECALL, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text", unit_nodes: int = UNIT_NODES, block: int = BLOCK, with_kept: bool = False) -> DataFrame:
    """One row per document: id, class_id, class_size, n_links, n_grams.

    Two documents are linked if the Jaccard similarity of their sets of word n-grams reaches the
    threshold (a decimal, compared exactly); n_links counts a document's links, those to copies
    among them. Classes are the components of the links; class_id is the least id of a class, and
    class_size counts its documents. A pair at the threshold is found with a probability of at
    least `recall`, more similar ones with more; pairs below the threshold are never linked. Every
    link is counted, so the verification of a class grows with its square, in even blocks.

    A text of fewer than n words has one gram of all its words. Texts without words, null ones
    among them, have no grams and are linked to each other. Rows that repeat an id are documents
    of their own and get equal rows; ids must be integers, and a null id forms no links. An empty
    table gives an empty result; further columns are ignored. with_kept adds text_sha256, and kept: whether the row has the least
    id, and of the texts under that id the least SHA-256, of its class.
    """
    limit = Fraction(threshold)
    count = bands_for(float(limit), rows, recall)
    shingler = docs.sparkSession.sparkContext.broadcast((n, count, rows))
    source = docs.select(F.col(id_col).cast("long").alias("id"), text_of(F.col(text_col)).alias("text"))
    keyed = source.withColumn("sha", F.sha2("text", 256) if with_kept else F.lit(""))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler(*shingler.value)
        for batch in small_batches(batches, "text"):
            digest, size, bands = [], [], []
            for text in batch.column("text").to_pylist():
                g = s.grams(text)
                digest.append(xxhash.xxh3_128_digest(g.tobytes()))
                size.append(len(g))
                bands.append(s.band_hashes(g).view(np.int64))
            flat = pa.array(np.concatenate(bands), pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * count, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("sha"), pa.array(digest, pa.binary()), pa.array(size, pa.int64()), lists], names=["id", "sha", "digest", "size", "bands"])

    signed = durable(keyed.mapInArrow(sign, "id bigint, sha string, digest binary, size bigint, bands array<bigint>"))
    # numbers, given once and written, are each node's own; no hash of them could be
    nodes = durable(signed.filter("id is not null").groupBy("digest").agg(F.min("id").alias("first_id"), F.min(F.struct("id", "sha")).alias("best"), F.count(F.lit(1)).alias("copies"), F.min("size").alias("size"), F.first("bands").alias("bands")).withColumn("node", F.monotonically_increasing_id()))

    # buckets of several nodes, as stars around the least node
    hashed = nodes.select("node", F.posexplode("bands").alias("band", "hash")).select("node", "band", "hash")
    buckets = hashed.groupBy("band", "hash").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = durable(hashed.join(buckets, ["band", "hash"]))
    units = durable(components(met.filter("node > least").select(F.col("least").alias("a"), F.col("node").alias("b"))).withColumnRenamed("component", "unit"))
    facts = units.join(nodes.select("node", "first_id", "digest", "copies", "size", "bands"), "node")
    weight = facts.groupBy("unit").agg(F.count(F.lit(1)).alias("__n"), F.sum("size").alias("__g"))
    facts = durable(facts.join(weight, "unit").withColumn("large", (F.col("__n") > unit_nodes) | (F.col("__g") > UNIT_GRAMS)).drop("__n", "__g"))

    # the sets of those nodes: a bitmap of their ids spares the other texts the shuffle
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler(n, 0, 0)
        for batch in small_batches(batches, "text"):
            sets = [s.grams(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary()), pa.array(sets, pa.binary())], names=["first_id", "digest", "grams"])

    sets = maybe_among(source, "id", facts.select("first_id"), facts.count()).mapInArrow(gather, "first_id bigint, digest binary, grams binary")
    # a repeated id can come with several texts, and repeated rows with one: the digest names the text, the least copy suffices
    whole = facts.join(sets.dropDuplicates(["first_id", "digest"]), ["first_id", "digest"])

    def opened(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        rows = rows.sort_by("node")
        node = rows.column("node").to_numpy()
        grams = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("grams").to_pylist()]
        bands = np.array(rows.column("bands").to_pylist(), dtype=np.int64).reshape(len(node), -1)
        return node, grams, bands, rows.column("copies").to_numpy()

    def result(node: np.ndarray, good: np.ndarray, copies: np.ndarray, links: list[tuple[int, int]]) -> pa.Table:
        both = good | good.T
        near = both @ copies
        some = np.flatnonzero(near)
        a = [node[min(x)] for x in links]
        b = [node[max(x)] for x in links]
        empty = [None] * len(a)
        return pa.table([pa.array([*node[some].tolist(), *empty], pa.int64()), pa.array([*near[some].tolist(), *empty], pa.int64()), pa.array([*[None] * len(some), *a], pa.int64()), pa.array([*[None] * len(some), *b], pa.int64())], names=["node", "near", "a", "b"])

    kinds = "node bigint, near bigint, a bigint, b bigint"

    def unit(rows: pa.Table) -> pa.Table:
        node, grams, bands, copies = opened(rows)
        good = similar(grams, shared_bands(bands), limit)
        return result(node, good, copies, spanning(good))

    def bucket(rows: pa.Table) -> pa.Table:
        band, x, y = (rows.column(c)[0].as_py() for c in ("band", "x", "y"))
        rows = rows.sort_by("node")
        own = rows.column("own").to_numpy()
        node, grams, bands, copies = opened(rows)
        good = np.triu(shared_bands(bands, band), 1)
        if x != y:
            good &= own[:, None] != own[None, :]
        good = similar(grams, good, limit)
        return result(node, good, copies, spanning(good))

    small = whole.filter("not large").select("unit", "node", "copies", "bands", "grams").groupBy("unit").applyInArrow(unit, kinds)
    held = met.join(facts.filter("large").select("node"), "node", "left_semi").withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    held = held.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = held.select("node", "band", "hash", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    large = held.join(whole.filter("large").select("node", "copies", "bands", "grams"), "node").groupBy("band", "hash", "x", "y").applyInArrow(bucket, kinds)
    found = durable(small.unionByName(large))
    sweep(docs.sparkSession)

    near = found.filter("node is not null").groupBy("node").agg(F.sum("near").alias("near"))
    classes = components(found.filter("a is not null").select("a", "b"))
    known = nodes.select("digest", "node", "first_id", "best", "copies").join(near, "node", "left").join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = known.groupBy("component").agg(F.min("first_id").alias("class_id"), F.min("best").alias("kept"), F.sum("copies").alias("class_size"))
    known = known.drop("best").join(sizes, "component").select("digest", "class_id", "kept", "class_size", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    alone = F.col("id").isNull()
    out = signed.select("id", "sha", "digest", "size").join(known, "digest", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.when(~alone, F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.col("size").alias("n_grams"),
        *[F.col("sha").alias("text_sha256"), (alone | (F.struct("id", "sha") == F.col("kept"))).alias("kept")] * with_kept,
    )


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs, all columns, with one row of each class, that of the least id; documents without an id stay."""
    lost = jaccard_classes(docs, id_col=id_col, text_col=text_col, with_kept=True, **options).filter(~F.col("kept"))
    lost = lost.select(F.col(id_col).alias("__lost_id"), F.col("text_sha256").alias("__lost_sha")).distinct()
    sha, row = free_name(docs, "__sha"), free_name(docs, "__row")
    marked = docs.withColumn(sha, F.sha2(text_of(F.col(text_col)), 256)).withColumn(row, F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()))
    stay = marked.join(lost, (F.col(id_col) == F.col("__lost_id")) & (F.col(sha) == F.col("__lost_sha")), "left_anti")
    return stay.dropDuplicates([id_col, sha, row]).drop(sha, row)


#: Counts the n-grams that each two documents share; classes are walked to along the links.
ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE c * 10 >= 8 * (p.n + q.n - c)),
walk AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT walk.doc_id, l.b FROM walk JOIN l ON l.a = walk.r)
SELECT n.doc_id, min(r) AS class_id, count(*) AS class_size, (SELECT count(*) FROM l WHERE l.a = n.doc_id) AS n_links, any_value(n.n) AS n_grams FROM n JOIN walk USING (doc_id) GROUP BY n.doc_id
"""

"""Best-fit packing of token sequences into bins of several permitted capacities.

Documents are encoded and packed by their numbers of tokens, longest first. A document goes into
the open bin that it fills best; where none has room, a bin is opened, of the permitted size whose
cost per token that it can expect to hold is least. When all are placed, each bin shrinks to the
smallest permitted size that holds its contents. Longer documents than the largest bin are cut into
pieces. A bin comes with its tokens, and with the documents that they are from.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of

#: Permitted sequence lengths, in tokens.
CAPACITIES = (2048, 4096, 8192, 16384)
#: Pieces that are packed together: shards of about so many are packed independently.
SHARD = 1000
#: Tokens that a task hands on at a time.
BATCH = 1 << 19


class Codec(Protocol):
    """What turns a text into token ids, at most one for a byte of UTF-8. It is sent to the workers."""

    end: int  #: the token that ends a document

    def encode(self, text: str) -> np.ndarray: ...


class Bytes:
    """A codec of bytes: one token for each byte of UTF-8."""

    end = 256

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(text.encode(), dtype=np.uint8)


def flat_cost(capacity: int) -> float:
    """A sequence costs its length and something for itself."""
    return capacity + 64.0


def best_fit(sizes: Sequence[int], capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = flat_cost) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each size, and the capacity of each bin. Sizes must not exceed the largest capacity.

    Equal sizes are placed in the order given; of equally full bins the oldest is taken.
    """
    caps = sorted(capacities)
    n = np.asarray(sizes, dtype=np.int64)
    order = np.argsort(-n, kind="stable")
    ascending = np.sort(n)
    below = np.concatenate([[0], np.cumsum(ascending)])  # tokens in the k smallest documents
    placed = np.zeros(len(n), dtype=np.int64)
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    filled: list[int] = []
    size_of: list[int] = []
    for step, i in enumerate(order.tolist()):
        size = int(n[i])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            rest = len(n) - step - 1  # the documents still to come are the smallest ones

            def per_token(c: int, size: int = size, rest: int = rest) -> float:
                fit = min(rest, int(np.searchsorted(ascending, c - size, side="right")))
                return cost(c) / max(1, min(c, size + int(below[fit])))

            left = min((c for c in caps if c >= size), key=lambda c: (per_token(c), c))
            b = len(filled)
            filled.append(0)
            size_of.append(left)
        placed[i] = b
        filled[b] += size
        if left - size:
            insort(room, (left - size, b))
    return placed, np.array([next(c for c in caps if c >= f) for f in filled], dtype=np.int64)


def _binary(sizes: list[int], data: bytes) -> pa.BinaryArray:
    """Values of so many bytes that lie end to end in data."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])


def pack(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text", capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = flat_cost, shard_pieces: int = SHARD) -> DataFrame:
    """One row per bin: bin_id, capacity, n_tokens, doc_ids, pieces, starts, lengths, tokens.

    tokens are ids as little-endian unsigned 32-bit integers. doc_ids, pieces, starts (in the document's tokens) and lengths have an element for each piece
    of a document in the bin, in the order in which they stand in tokens. A document is its tokens
    and codec.end, whole in one piece unless it is longer than the largest capacity: then it is cut
    into pieces of that capacity and a rest.

    A null text is empty (one token, the end). Nothing is dropped or repeated: repeated rows are
    packed each on their own, a null id stays null, and an empty table gives an empty result.
    Further columns are ignored, whatever their names.

    Texts are encoded in one narrow pass, and their tokens are shuffled once, to shards dealt by a
    hash of id, text, piece and partition: a task that runs again deals its rows as before. A shard
    holds about shard_pieces pieces of bounded size whatever the table's size, so a task's memory
    and time are bounded; the shards' last, half-empty bins stay a small share of all.
    """
    most = max(capacities)
    text = text_of(F.col(text_col))
    bound = docs.select(F.sum(F.ceil((F.octet_length(text) + 1) / most)).alias("n")).first()["n"]  # no text has more pieces
    shards = max(1, math.ceil((bound or 0) / shard_pieces))
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, own = shared.value, TaskContext.get().partitionId()
        rows, parts, held = [], [], 0

        def out() -> pa.RecordBatch:
            shard, at, key, piece, start = zip(*rows, strict=True)
            tokens = _binary([4 * len(p) for p in parts], np.concatenate(parts).astype("<u4").tobytes())
            return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), ids.take(pa.array(at, pa.int64())), pa.array(key, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), tokens], names=["shard", "id", "key", "piece", "start", "tokens"])

        for batch in small_batches(batches, "text"):
            ids = batch.column("id")
            for i, t in enumerate(batch.column("text").to_pylist()):
                found = np.append(c.encode(t), c.end)
                name = xxhash.xxh3_64_intdigest(t.encode(), seed=xxhash.xxh32_intdigest(f"{own} {ids[i].as_py()}"))
                for piece, start in enumerate(range(0, len(found), most)):
                    rows.append((xxhash.xxh32_intdigest(f"{name} {piece}") % shards, i, name - (1 << 63), piece, start))
                    parts.append(found[start : start + most])
                    held += len(parts[-1])
                    if held >= BATCH:
                        yield out()
                        rows, parts, held = [], [], 0
            if rows:
                yield out()
                rows, parts, held = [], [], 0

    def packed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("piece", "ascending")])
        size = pc.binary_length(rows.column("tokens")).to_numpy().astype(np.int64) // 4
        placed, caps = best_fit(size, capacities, cost)
        order = np.lexsort((np.arange(len(size)), -size, placed))
        size = size[order]
        data = b"".join(rows.column("tokens").take(pa.array(order)).to_pylist())
        rows = rows.drop_columns(["tokens"]).take(pa.array(order))
        many = np.bincount(placed, minlength=len(caps))
        held = np.bincount(placed[order], weights=size, minlength=len(caps)).astype(np.int64)
        ends = pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32())
        listed = lambda x: pa.ListArray.from_arrays(ends, x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x)
        tokens = _binary((4 * held).tolist(), data)
        bins = (np.int64(rows.column("shard")[0].as_py()) << 32) + np.arange(len(caps))
        return pa.table([bins, caps, held, listed(rows.column("id")), listed(rows.column("piece")), listed(rows.column("start")), listed(pa.array(size, pa.int64())), tokens], names=names)

    names = ["bin_id", "capacity", "n_tokens", "doc_ids", "pieces", "starts", "lengths", "tokens"]
    dealt = docs.select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(encoded, f"shard int, id {kind}, key bigint, piece int, start bigint, tokens binary")
    return dealt.groupBy("shard").applyInArrow(packed, f"bin_id bigint, capacity bigint, n_tokens bigint, doc_ids array<{kind}>, pieces array<int>, starts array<bigint>, lengths array<bigint>, tokens binary")


def placements(bins: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per piece of a document in bins of pack: id, piece, start, n_tokens, bin_id, capacity, offset (in the bin)."""
    each = F.arrays_zip(F.col("doc_ids").alias("id"), "pieces", "starts", "lengths")
    rows = bins.select("bin_id", "capacity", "lengths", F.posexplode(each).alias("k", "p"))
    offset = F.aggregate(F.slice("lengths", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda acc, n: acc + n)
    return rows.select(F.col("p.id").alias(id_col), F.col("p.pieces").alias("piece"), F.col("p.starts").alias("start"), F.col("p.lengths").alias("n_tokens"), "bin_id", "capacity", offset.alias("offset"))


def fill_rates(bins: DataFrame) -> DataFrame:
    """For each capacity: bins, tokens, and the share of the bins' room that tokens fill."""
    return bins.groupBy("capacity").agg(F.count(F.lit(1)).alias("bins"), F.sum("n_tokens").alias("tokens"), (F.sum("n_tokens") / F.sum("capacity")).alias("filled"))

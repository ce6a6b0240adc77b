"""Document fingerprints: a digest of the quartiles of hashed byte triplets, compared with a bounded score.

All triplets within five neighbouring bytes are hashed into buckets. A bucket's count is coded by
the quartile that it falls in, two bits a bucket; the digest also has a logarithm of the length and
the ratios of the quartiles. Two digests differ by the sum of their buckets' code differences and
the differences of length and ratios, each of them bounded.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, small_batches, text_of

BUCKETS = 256
#: Offsets within five bytes of the triplets that end at the last of them.
TRIPLETS = ((0, 1, 4), (0, 2, 4), (0, 3, 4), (1, 2, 4), (1, 3, 4), (2, 3, 4))
#: Bytes that are hashed at a time.
BLOCK = 1 << 18
#: Most that the length and each of the two quartile ratios may add to a difference.
LENGTH_MOST, RATIO_MOST = 24, 12
#: Mean code difference of two unrelated digests is about 1.25 a bucket: at that, likeness is 0.
UNRELATED = 1.25

_SHIFT = np.uint32(32 - (BUCKETS.bit_length() - 1))
_MUL = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def bucket_counts(data: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, max(0, len(data) - 2), BLOCK):
        b = np.frombuffer(data[at : at + BLOCK + 4], dtype=np.uint8).astype(np.uint32)
        n = len(b) - 4
        if n < 1:  # three or four bytes: the plain triplets
            if at == 0:
                for i in range(len(b) - 2):
                    h = (b[i] * _MUL[0] + b[i + 1] * _MUL[1]) ^ (b[i + 2] * _MUL[2])
                    counts[int((np.uint32(h) * _MUL[0]) >> _SHIFT)] += 1
            continue
        one, two, three = b * _MUL[0], b * _MUL[1], b * _MUL[2]
        for k, (x, y, z) in enumerate(TRIPLETS):
            h = ((one[x : x + n] + two[y : y + n] + np.uint32(k * 0x27D4EB2F & 0xFFFFFFFF)) ^ three[z : z + n]) * _MUL[0]
            counts += np.bincount((h >> _SHIFT).astype(np.intp), minlength=BUCKETS)
    return counts


def fingerprint(data: bytes) -> str:
    """Hex digest: one byte of length, two of quartile ratios, then two bits for each bucket."""
    with np.errstate(over="ignore"):
        counts = bucket_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]].tolist()
    code = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    body = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    length = min(255, round(8 * math.log2(1 + len(data))))
    head = bytes([length, round(255 * q1 / max(1, q3)), round(255 * q2 / max(1, q3))])
    return (head + body.astype(np.uint8).tobytes()).hex()


def difference(a: str, b: str) -> int:
    """Bounded difference of two digests: 0 for equal ones, at most 3 a bucket and the bounds of the head."""
    x, y = np.frombuffer(bytes.fromhex(a), dtype=np.uint8), np.frombuffer(bytes.fromhex(b), dtype=np.uint8)
    head = np.abs(x[:3].astype(int) - y[:3])
    body = sum(int(np.abs((x[3:] >> s & 3).astype(int) - (y[3:] >> s & 3)).sum()) for s in (0, 2, 4, 6))
    return body + min(int(head[0]), LENGTH_MOST) + min(int(head[1]) // 4, RATIO_MOST) + min(int(head[2]) // 4, RATIO_MOST)


def likeness(a: str, b: str) -> float:
    """1 for equal digests, falling with their difference to 0 for unrelated ones."""
    return max(0.0, 1.0 - difference(a, b) / (UNRELATED * BUCKETS))


def edited(text: str, following: str) -> str:
    """The text whose last quarter of code points is replaced by the first as many of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint of each text; a null text is empty, and empty texts have equal fingerprints. One narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            prints = [fingerprint(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.string())], names=[id_col, "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness and that to the next document.

    Documents are ordered by id, ties by text; the next of the last is the first, and a lone
    document is its own next. A null text is empty, a null id comes first. Repeated rows give a row
    each. An empty table gives an empty result, and further columns are ignored.

    The texts are shuffled once, into ranges of ids, and sorted there: within a task the next
    document is the next row. A task returns its first and its last text as an edge, and edges
    meet in a second, small step: there are as many as tasks.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(F.col(text_col)).alias("text"))
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "first_text", "last_text"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
    schema = "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, part int, first_text string, last_text string"

    def finish(i: int, own: str, own_mark: str, text: str, mark: str) -> tuple:
        new = edited(own, text).encode()
        new_mark = fingerprint(new)
        return i, len(own), hashlib.sha256(new).hexdigest(), own_mark, new_mark, likeness(own_mark, new_mark), likeness(own_mark, mark), None, None, None

    def out(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, None
        for batch in small_batches(batches, "text"):
            done = []
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                mark = fingerprint(text.encode())
                if held is None:
                    first = text
                else:
                    done.append(finish(*held, text, mark))
                held = (i, text, mark)
            if done:
                yield out(done)
        if held is not None:
            i, text, mark = held
            yield out([(i, len(text), None, mark, None, None, None, TaskContext.get().partitionId(), first, text)])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "next_text"):
            done = [finish(i, own, own_mark, text, fingerprint(text.encode())) for i, own, own_mark, text in zip(*(batch.column(c).to_pylist() for c in ("id", "last_text", "fingerprint", "next_text")), strict=True)]
            yield out(done)

    made = durable(rows.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(within, schema))
    edges = made.filter("part is not null")
    order = Window.orderBy("part")
    ring = edges.select("part").withColumn("next_part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)))
    firsts = edges.select(F.col("part").alias("next_part"), F.col("first_text").alias("next_text"))
    met = edges.join(ring, "part").join(firsts, "next_part").select("id", "last_text", "fingerprint", "next_text").mapInArrow(across, schema)
    return made.filter("part is null").unionByName(met).select(F.col("id").alias(id_col), *names[1:7])

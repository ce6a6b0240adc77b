"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest.

The vocabulary's strings sit in a minimal perfect hash: a bucket's displacement sends each of its
strings to a slot of its own among exactly as many slots as strings. A pre-token's slot holds the
only string that it can equal; if it does, its rank is the answer. Otherwise its bytes form a linked
list, and a heap gives the pair of lowest rank, leftmost first, until none can be merged.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, text_of

#: Distinct pre-tokens whose ids a worker remembers before it starts anew.
MEMO = 400_000
#: Pre-tokens of one text that are held at a time.
BLOCK = 500_000


def load_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """The strings of a rank file in order of rank, which must run from 0 without gaps."""
    lines = [x.value.split() for x in spark.read.text(path).collect()] if "://" in path else [x.split() for x in open(path) if x.strip()]
    ranked = sorted((int(r), base64.b64decode(s)) for s, r in lines)
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [s for _, s in ranked]


def _mix(h: np.ndarray, d: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h ^ (np.asarray(d, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Minimal perfect hash of byte strings: hash to a bucket, displace, and compare with the slot's string."""

    def __init__(self, keys: list[bytes], load: int = 4):
        n = self.n = len(keys)
        self.buckets = max(1, n // load)
        h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        if len(np.unique(h)) != n:
            raise ValueError("repeated keys")
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        members = np.split(order, np.cumsum(np.bincount(bucket, minlength=self.buckets))[:-1]) if n else []
        free, self.shift, self.slot = np.ones(n, dtype=bool), np.zeros(self.buckets, dtype=np.uint32), np.zeros(n, dtype=np.int32)
        for b in sorted(range(len(members)), key=lambda i: -len(members[i])):
            own, base = members[b], 0
            if not len(own):
                break
            while True:  # tries 256 displacements at once
                tries = np.arange(base, base + 256, dtype=np.uint64)
                at = (_mix(h[own][None, :], tries[:, None]) % np.uint64(n)).astype(np.int64)
                good = free[at].all(axis=1)
                if len(own) > 1:
                    good &= (np.diff(np.sort(at, axis=1), axis=1) > 0).all(axis=1)
                if good.any():
                    k = int(good.argmax())
                    self.shift[b], free[at[k]], self.slot[at[k]] = base + k, False, own
                    break
                base += 256
        self.keys = keys

    def find(self, words: list[bytes]) -> np.ndarray:
        """For each word the index of the key that it equals, or -1."""
        if not words or not self.n:
            return np.full(len(words), -1, dtype=np.int64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        slot = self.slot[(_mix(h, self.shift[(h % np.uint64(self.buckets)).astype(np.int64)].astype(np.uint64)) % np.uint64(self.n)).astype(np.int64)]
        keys = self.keys
        return np.fromiter((i if keys[i] == w else -1 for i, w in zip(slot.tolist(), words, strict=True)), dtype=np.int64, count=len(words))


class Codec:
    """Encodes and decodes by a list of strings in order of rank. Holds no Spark objects."""

    def __init__(self, vocabulary: list[bytes], pattern: str):
        self.vocabulary, self.pattern = vocabulary, pattern
        self.end = len(vocabulary)  # an id beyond the vocabulary, for what ends a document
        self.whole = PerfectHash(vocabulary)
        self._ready()

    def _ready(self) -> None:
        self.split = regex.compile(self.pattern)
        self.rank = {s: i for i, s in enumerate(self.vocabulary)}
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.start, self.length, self.pool = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int64), np.zeros(4096, dtype=np.uint32)
        self.used = self.filled = 0

    def __getstate__(self) -> dict:
        return {"vocabulary": self.vocabulary, "pattern": self.pattern, "end": self.end, "whole": self.whole}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._ready()

    def merge(self, word: bytes) -> list[int]:
        """Ids of a string by merges alone: always the pair of lowest rank, the leftmost of equals."""
        rank = self.rank.get
        parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if parts[i] is None or (j := after[i]) >= n or rank(pair := parts[i] + parts[j]) != r:
                continue  # a part of the pair has been merged since
            parts[i], parts[j] = pair, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := rank(pair + parts[k])) is not None:
                    heapq.heappush(heap, (s, i))
            if (p := before[i]) >= 0 and (s := rank(parts[p] + pair)) is not None:
                heapq.heappush(heap, (s, p))
        return [self.rank[x] for x in parts if x is not None]

    def _learn(self, words: list[str]) -> None:
        """Look up new pre-tokens: whole ones in the perfect hash, the others by merging."""
        raw = [w.encode() for w in words]
        found = self.whole.find(raw)
        ids = [[i] if i >= 0 else self.merge(b) for i, b in zip(found.tolist(), raw, strict=True)]
        flat = [i for x in ids for i in x]
        while self.used + len(words) > len(self.start):
            self.start, self.length = np.concatenate([self.start, self.start]), np.concatenate([self.length, self.length])
        while self.filled + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, self.pool])
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self.length[self.used : self.used + len(ids)] = sizes
        self.start[self.used : self.used + len(ids)] = self.filled + np.cumsum(sizes) - sizes
        self.pool[self.filled : self.filled + len(flat)] = flat
        self.memo.update(zip(words, range(self.used, self.used + len(words)), strict=True))
        self.used, self.filled = self.used + len(words), self.filled + len(flat)

    def _ids(self, words: list[str]) -> np.ndarray:
        if len(self.memo) > MEMO:
            self._forget()
        known = self.memo.get
        codes = np.fromiter(map(known, words, repeat(-1)), dtype=np.int64, count=len(words))
        if (lack := np.flatnonzero(codes < 0)).size:
            self._learn(list(dict.fromkeys([words[i] for i in lack.tolist()])))
            codes[lack] = [self.memo[words[i]] for i in lack.tolist()]
        sizes = self.length[codes]
        end = np.cumsum(sizes)
        return self.pool[np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[codes] - end + sizes, sizes)]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as unsigned 32-bit integers."""
        if len(text) < BLOCK:
            return self._ids(self.split.findall(text))
        found, blocks = (m.group() for m in self.split.finditer(text)), []
        while words := list(islice(found, BLOCK)):
            blocks.append(self._ids(words))
        return np.concatenate(blocks)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


class LibraryCodec:
    """The ids that Codec gives, by the tiktoken library, in a fraction of the time.

    The library's time grows with the square of a pre-token's length: a text with a run of over
    LONG characters, blank or not, is left to Codec.
    """

    LONG = 2000

    def __init__(self, vocabulary: list[bytes], pattern: str):
        self.vocabulary, self.pattern, self.end = vocabulary, pattern, len(vocabulary)
        self._ready()

    def _ready(self) -> None:
        import tiktoken

        self.library = tiktoken.Encoding("vocabulary", pat_str=self.pattern, mergeable_ranks={s: i for i, s in enumerate(self.vocabulary)}, special_tokens={})
        self.careful: Codec | None = None

    def __getstate__(self) -> dict:
        return {"vocabulary": self.vocabulary, "pattern": self.pattern, "end": self.end}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._ready()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as unsigned 32-bit integers."""
        words = text.split()
        if max(map(len, words), default=0) > self.LONG or len(text) - sum(map(len, words)) > len(words) + self.LONG:
            self.careful = self.careful or Codec(self.vocabulary, self.pattern)
            return self.careful.encode(text)
        return np.array(self.library.encode_ordinary(text), dtype=np.uint32)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


def bpe_digests(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array of long) of each text.

    A null text is empty: no ids, digests of nothing. Every row gives one row; repeated rows give
    equal ones, a null id stays null. Texts of any length are encoded whole, in blocks of
    pre-tokens. The work is one narrow pass: no shuffle, and memory is bounded by a batch of
    about 4 MB of text (or the largest text) and the memo of pre-tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in small_batches(batches, "text"):
            n, ids_hex, text_hex, every = [], [], [], []
            for text in batch.column("text").to_pylist():
                ids = c.encode(text)
                n.append(len(ids))
                ids_hex.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_hex.append(hashlib.sha256(c.decode(ids.tolist())).hexdigest())
                if with_ids:
                    every.append(ids.astype(np.int64))
            cols = [batch.column("id"), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(every, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<bigint>" * with_ids
    return docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text")).mapInArrow(run, schema)

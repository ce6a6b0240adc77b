"""Quality classifier: nearest-neighbour voting among labelled documents in a latent semantic space.

A document's terms are hashed words, the shapes of its tokens (letters and digits folded, other
signs kept) and bucketed measures of the whole text (repetition of words and lines, length of
words, case). Document frequencies are counted over all documents. A truncated singular value
decomposition of the labelled sample's weighted term matrix gives the space; the labelled vectors
are broadcast, every document's exact cosines with all of them are computed in blocks, and its nearest
neighbours vote with weights that grow with similarity.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, small_batches, text_of
from .toxicity import labelled_sample


@dataclass(frozen=True)
class Settings:
    word_terms: int = 4096
    shape_terms: int = 1024
    rank: int = 48  #: dimensions of the latent space
    neighbours: int = 15
    power: float = 8.0  #: a neighbour's vote weighs its cosine to this power
    sample: int = 1500  #: labelled documents of label 0 that are fitted and broadcast, at most
    sample_good: int = 3000  #: those of label 1, at most
    sample_chars: int = 60_000  #: longer labelled documents are left out of that sample
    block: int = 512  #: documents whose cosines are computed at a time
    memo: int = 300_000  #: distinct tokens whose terms a worker remembers


#: Bins of each measure of a whole text, and how much the three kinds of term weigh.
BINS = 12
#: Signs of a folded token that make one shape; a longer one has several.
PIECE = 12
#: Steps of a coordinate: products of two coordinates, and sums of such products, are exact in 64 bits.
GRAIN = 1 << 22
MEASURES = ("repeated words", "repeated lines", "share of the commonest word", "mean length of words", "signs", "upper case", "length")
WEIGHTS = (0.4, 1.0, 1.0)
_FOLD = str.maketrans({**{c: "0" for c in "0123456789"}})
#: Signs at a word's ends that aren't part of it.
ENDS = ".,;:!?"
_LETTERS = re.compile(r"[^\W\d_]+")


def shapes(token: str) -> list[str]:
    """Letters folded to a, A (all upper case) or Aa, digits to 0; runs of a sign to two at most; in pieces of PIECE."""
    s = _LETTERS.sub(lambda m: "A" if len(m[0]) > 1 and m[0].isupper() else "a", token).translate(_FOLD)
    s = re.sub(r"(.)\1+", r"\1\1", s)
    return [s[k : k + PIECE] for k in range(0, len(s), PIECE)]


class Terms:
    """Turns texts into rows of term weights."""

    def __init__(self, s: Settings):
        self.s, self.size = s, s.word_terms + s.shape_terms + len(MEASURES) * BINS
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.forms: dict[str, int] = {}  # shape term of each shape
        self.more: dict[int, list[int]] = {}  # shape terms after the first, of tokens with several
        self.facts = np.zeros((5, 1024), dtype=np.int32)  # by token: word term, shape term, signs, upper case, letters

    def _learn(self, tokens: list[str]) -> None:
        s, used = self.s, len(self.memo)
        while used + len(tokens) > self.facts.shape[1]:
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)], axis=1)
        forms, digest, words, first = self.forms, xxhash.xxh32_intdigest, s.word_terms, s.word_terms
        rows: list[int] = []
        for k, t in enumerate(tokens, used):
            core = t.rstrip(ENDS)
            own = None
            if core.isalpha():  # a word and the signs at its end; up to two of them are their own shape
                letters, word = len(core), core.lower()
                form = ("A" if letters > 1 and core.isupper() else "a") + t[letters:]
                if len(form) > 3:
                    own = shapes(t)
            else:
                letters, word, own = sum(map(str.isalnum, t)), t.lower().strip(ENDS), shapes(t)
            if own:
                form = own[0]
                if len(own) > 1:
                    self.more[k] = [first + digest(x) % s.shape_terms for x in own[1:]]
            number = forms.get(form)
            if number is None:
                number = forms[form] = first + digest(form) % s.shape_terms
            rows += digest(word) % words, number, len(t) - letters, len(t) > 1 and core.isupper(), letters
        self.facts[:, used : used + len(tokens)] = np.fromiter(rows, dtype=np.int32, count=len(rows)).reshape(-1, 5).T
        self.memo.update(zip(tokens, range(used, used + len(tokens)), strict=True))

    def rows(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its term numbers, ascending, and how often each occurs (1 for those of measures)."""
        if len(self.memo) > self.s.memo:
            self.forget()
        split = [t.split() for t in texts]
        if new := list(set().union(*split).difference(self.memo)):
            self._learn(new)
        return map(self._row, texts, split)

    def _row(self, text: str, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.fromiter(map(self.memo.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        n = len(tokens)
        bins = [0.0] * len(MEASURES)
        counts = np.zeros(0)
        if n:
            word, form, signs, upper, letters = self.facts[:, codes]
            distinct, uses = np.unique(codes, return_counts=True)
            lines = Counter(text.split("\n"))
            m = sum(lines.values())
            letters_all, signs_all = int(letters.sum()), int(signs.sum())
            bins = [(1 - len(uses) / n) * BINS, (1 - len(lines) / m) * BINS, uses.max() / n * 2 * BINS, letters_all / n, signs_all / max(1, letters_all + signs_all) * 2 * BINS, upper.sum() / n * BINS, math.log2(n)]
            more = [k for c, u in zip(distinct.tolist(), uses.tolist(), strict=True) if c in self.more for k in self.more[c] * u] if self.more else []
            counts = np.bincount(np.concatenate([word, form, np.array(more, dtype=np.int32)]), minlength=self.s.word_terms + self.s.shape_terms)
        at = np.flatnonzero(counts)
        base = self.s.word_terms + self.s.shape_terms
        own = np.array([base + k * BINS + min(BINS - 1, int(b)) for k, b in enumerate(bins)])
        return np.concatenate([at, own]), np.concatenate([counts[at], np.ones(len(own))])


def term_rows(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, terms, counts) of each whole text: its terms as 16-bit numbers, how often each occurs in 8, 16 or 32 bits.

    The one pass that reads texts. A null text is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(s)
        for batch in small_batches(batches, "text"):
            texts, at, counts = batch.column("text").to_pylist(), [], []
            for own, n in terms.rows(texts):
                at.append(own.astype(np.uint16).tobytes())
                most = n.max()
                counts.append(n.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(list(map(len, texts)), pa.int64()), pa.array(at, pa.binary()), pa.array(counts, pa.binary())], names=["id", "n_chars", "terms", "counts"])

    if Terms(s).size > 1 << 16:
        raise ValueError("more terms than 16 bits can number")
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text")).mapInArrow(run, f"id {kind}, n_chars bigint, terms binary, counts binary")


def opened(terms: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and counts of a row of term_rows."""
    at = np.frombuffer(terms, dtype=np.uint16)
    return at.astype(np.int64), np.frombuffer(counts, dtype={1: np.uint8, 2: np.uint16, 4: np.uint32}[len(counts) // len(at)]).astype(np.float64)


def document_frequencies(rows: DataFrame, s: Settings) -> tuple[int, np.ndarray]:
    """The number of documents, and for each term that of the documents with it, over all rows of term_rows."""
    size = Terms(s).size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            terms = batch.column("terms").to_pylist()
            n += len(terms)
            seen += np.bincount(np.frombuffer(b"".join(terms), dtype=np.uint16), minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(seen[at], n), pa.int64())], names=["term", "n"])

    total, seen = 0, np.zeros(size)
    counted = rows.select("terms").mapInArrow(run, "term int, n bigint")
    for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():  # as many rows as terms, which are fixed
        if r["term"] < 0:
            total = r["n"]
        else:
            seen[r["term"]] = r["n"]
    return total, seen


def grained(v: np.ndarray) -> np.ndarray:
    return np.rint(v * GRAIN) / GRAIN


@dataclass
class Model:
    settings: Settings
    weight: np.ndarray  # of each term: inverse document frequency
    space: np.ndarray  # (terms, rank)
    vectors: np.ndarray  # (rank, labelled documents), unit columns in steps of 1 / GRAIN
    labels: np.ndarray

    def vector(self, row: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, value = weighted(self, row)
        v = (value @ self.space[at]).astype(np.float64)
        return grained(v / max(1e-9, float(np.sqrt(v @ v))))


def weighted(m: Model, row: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A row's weights: log of counts by inverse document frequency, each kind of term scaled to its share."""
    at, n = row
    value = ((1 + np.log(n)) * m.weight[at]).astype(np.float32)
    cut = np.searchsorted(at, [m.settings.word_terms, m.settings.word_terms + m.settings.shape_terms])
    for part, share in zip(np.split(value, cut), WEIGHTS, strict=True):  # the parts are views
        part *= share / max(1e-9, float(np.sqrt(part @ part)))
    return at, value


def fit(sample: list[tuple[bytes, bytes, int]], total: int, seen: np.ndarray, s: Settings) -> Model:
    """The latent space of a labelled sample of term rows, and its vectors. Without a sample the space is empty."""
    m = Model(s, np.log((1 + total) / (1 + seen)).astype(np.float32) + 0.1, np.zeros((len(seen), s.rank), np.float32), np.zeros((s.rank, 0)), np.zeros(0, np.float32))
    if not sample:
        return m
    rows = [weighted(m, opened(at, n)) for at, n, _ in sample]
    dense = np.zeros((len(rows), len(seen)), dtype=np.float32)
    for x, (at, value) in zip(dense, rows, strict=True):
        x[at] = value
    # randomised range finder with two power steps, then an exact decomposition of the small matrix
    k = min(s.rank + 16, len(rows))
    q = np.linalg.qr(dense @ np.random.default_rng(5).normal(size=(len(seen), k)).astype(np.float32))[0]
    for _ in range(2):
        q = np.linalg.qr(dense @ (dense.T @ q))[0]
    _, scale, right = np.linalg.svd(q.T @ dense, full_matrices=False)
    r = min(s.rank, len(scale))
    m.space[:, :r] = right[:r].T
    m.labels = np.array([y for _, _, y in sample], dtype=np.float32)
    v = np.stack([value @ m.space[at] for at, value in rows]).astype(np.float64)
    m.vectors = np.ascontiguousarray(grained(v / np.maximum(1e-9, np.sqrt((v * v).sum(axis=1, keepdims=True)))).T)
    return m


def vote(m: Model, vectors: np.ndarray) -> np.ndarray:
    """Scores of unit vectors: their nearest neighbours' labels, weighted by similarity; 0.5 without neighbours.

    Vectors are multiples of 1 / GRAIN, so that products are exact in any order and equal texts get
    equal votes. Of neighbours with equal cosines at the last place the first ones of the sample count.
    """
    if not m.vectors.shape[1]:
        return np.full(len(vectors), 0.5)
    cosine = vectors @ m.vectors
    k = min(m.settings.neighbours, cosine.shape[1])
    last = -np.partition(-cosine, k - 1, axis=1)[:, k - 1, None]
    above, level = cosine > last, cosine == last
    lack = k - above.sum(axis=1, keepdims=True)
    if (level.sum(axis=1, keepdims=True) > lack).any():
        level &= np.cumsum(level, axis=1) <= lack
    near = np.nonzero(above | level)[1].reshape(len(vectors), k)
    w = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0) ** m.settings.power + 1e-9
    return (w * m.labels[near]).sum(axis=1) / w.sum(axis=1)


def score_rows(rows: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id") -> DataFrame:
    """id, score (0 to 1) and predicted (1 if score >= threshold) of each row of term_rows. One narrow pass; see score_quality."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, m.settings.block):
                part = batch.slice(k, m.settings.block)
                vectors = np.stack([m.vector(opened(at, n)) for at, n in zip(part.column("terms").to_pylist(), part.column("counts").to_pylist(), strict=True)])
                score = np.clip(vote(m, vectors), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32())], names=[id_col, "score", "predicted"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "terms", "counts").mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1) and predicted (1 if score >= threshold) of each whole text.

    A null text is empty; an empty text has only the terms of its measures and is scored by these.
    Each row gives one row, repeated rows equal ones; a null id stays null; ties among neighbours
    at the last place are broken by the order of the sample. An empty table gives an empty result,
    further columns are ignored. Narrow passes without a shuffle. The broadcast model's size is set
    by Settings: about 3 MB.
    """
    return score_rows(term_rows(docs, model.settings, id_col, text_col), model, threshold, id_col)


def fit_rows(rows: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, settings: Settings | None = None) -> Model:
    """Document frequencies over all rows of term_rows; the space from the labelled ones that are not held out."""
    s = settings or Settings()
    total, seen = document_frequencies(rows, s)
    sample = labelled_sample(rows.withColumnRenamed("id", "doc_id"), labels, "quality", folds, held_out, (s.sample_good, s.sample), F.col("n_chars") <= s.sample_chars, ["terms", "counts"])
    return fit([(bytes(at), bytes(n), y) for at, n, y in sample], total, seen, s)


def fitted_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, folds: int = 3, held_out: int = 1, settings: Settings | None = None) -> DataFrame:
    """score_quality of docs by a model fitted to the labelled ones among them; the texts are read once.

    Their term rows, about a third of the texts' size, are written to the shared folder.
    """
    s = settings or Settings()
    rows = durable(term_rows(docs, s))
    return score_rows(rows, fit_rows(rows, labels, folds, held_out, s), threshold)

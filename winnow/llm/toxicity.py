"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

A token is a run of word characters or a run of signs; nothing but white space is passed over. Its
characters are read as a sequence: at each place hashed n-grams that end there are the input of a
small bidirectional gated recurrent network, whose states attention pools. That reading stands
beside the token's own vector, if training has met it in several documents. A second network of
the same kind reads windows of tokens, and a logistic unit scores its pooled states. A text's score
is that of its worst window, in training and in use alike. The networks are trained in numpy, on
the driver, from a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_of, small_batches, text_of


@dataclass(frozen=True)
class Settings:
    """Parameters of the networks and of their training."""

    window: int = 64  #: tokens of a window
    stride: int = 48  #: tokens from one window's start to the next
    hidden: int = 10  #: states of the network over tokens, in each direction
    char_hidden: int = 4  #: states of the network over characters, in each direction
    width: int = 8  #: of a token's own vector, and of an n-gram's
    word_docs: int = 3  #: training documents in which a token or an n-gram must occur to have a vector
    gram_rows: int = 1 << 17
    sample: int = 1200  #: toxic documents that training reads, at most
    sample_clean: int = 2400  #: other labelled documents that it reads, at most
    sample_chars: int = 20_000  #: longer labelled documents are not sampled
    epochs: int = 12
    refresh: int = 3  #: rounds for which each text's worst window is taken to be the same
    steps: int = 100  #: batches that training takes at least: a small sample is gone through more often
    seed: int = 7
    memo: int = 150_000  #: distinct tokens whose inputs a worker remembers


#: A token; a longer run counts as several.
TOKEN = re.compile(r"\w{1,48}|[^\w\s]{1,48}")
#: Lengths of the n-grams that end at each character.
SIZES = (1, 3, 4, 5)
#: Tokens whose characters are read at a time, tokens of a text that are held at a time (a multiple of any stride), tokens of a block of texts.
PART, PIECE, HELD = 20_000, 1 << 17, 1 << 19
_M = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646C], dtype=np.uint32)


def tokens_of(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def _spread(h: np.ndarray, rows: int) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * _M[1]
    return ((h ^ (h >> np.uint32(13))) % np.uint32(rows)).astype(np.int32)


def places_of(words: list[str], gram_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the n-grams that end at each place of each word, word after word, and how many places each word has.

    A word's places are its characters and its end.
    """
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    starts = np.cumsum(lengths) - lengths
    out = np.zeros((int(lengths.sum()), len(SIZES)), dtype=np.int32)
    with np.errstate(over="ignore"):
        for low, high in ((0, 8), (8, 14), (14, 24), (24, 49)):
            own = np.flatnonzero((lengths - 1 > low) & (lengths - 1 <= high))
            if not own.size:
                continue
            lead = max(SIZES) - 1
            chars = np.zeros((len(own), lead + high + 1), dtype=np.uint32)
            chars[:, lead - 1] = 2
            chars[:, lead : lead + high] = np.array([words[i] for i in own.tolist()], dtype=f"U{high}").view(np.uint32).reshape(len(own), high)
            n = lengths[own]
            chars[np.arange(len(own)), lead + n - 1] = 3
            at, col = np.nonzero(np.arange(high + 1)[None, :] < n[:, None])
            row = starts[own[at]] + col
            for k, size in enumerate(SIZES):
                h = np.zeros((len(own), high + 1), dtype=np.uint32)
                for j in range(size):
                    h = h * _M[2] + chars[:, lead + 1 - size + j : lead + 2 - size + j + high] * _M[3] + np.uint32(size)
                out[row, k] = _spread(h[at, col], gram_rows)
    return out, lengths


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def window_starts(n: int, window: int, stride: int) -> range:
    """Starts of the windows that cover n tokens; one, of no tokens, for an empty text."""
    return range(0, max(1, n - window + stride), stride)


def read(d: dict[str, np.ndarray], k: str, p: np.ndarray, at: np.ndarray, n: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
    """Pooled states of sequences, by the parameters of d whose names begin with k.

    p: inputs by number; at: (steps, sequences) numbers; n: lengths, descending.
    """
    h = d[k + "Uf"].shape[0]
    steps, count = at.shape
    alive = [int(np.searchsorted(-n, -t, side="left")) for t in range(steps)]  # sequences longer than t
    states = np.zeros((steps, count, 2 * h), dtype=p.dtype)
    saved: dict = {"alive": alive}
    for side, cols, order in (("f", slice(0, h), range(steps)), ("b", slice(h, 2 * h), range(steps - 1, -1, -1))):
        u, base = d[f"{k}U{side}"], 0 if side == "f" else 3 * h
        uzr, uh = np.ascontiguousarray(u[:, : 2 * h]), np.ascontiguousarray(u[:, 2 * h :])
        prev = np.zeros((count, h), dtype=p.dtype)
        for t in order:
            m = alive[t]
            if not m:
                continue
            before = prev[:m]
            x = p[at[t, :m], base : base + 3 * h]
            g = x[:, : 2 * h] + before @ uzr
            g *= 0.5
            np.tanh(g, out=g)
            g += 1
            g *= 0.5
            z, r = g[:, :h], g[:, h:]
            c = r * before
            c = c @ uh
            c += x[:, 2 * h :]
            np.tanh(c, out=c)
            now = c - before
            now *= z
            now += before
            if keep:
                saved[side, t] = (before.copy(), z.copy(), r.copy(), c)
            prev[:m] = now
            states[t, :m, cols] = now
    e = states @ d[k + "v"]
    e[np.arange(steps)[:, None] >= np.maximum(n, 1)[None, :]] = -np.inf
    e -= e.max(axis=0)
    a = np.exp(e)
    a /= a.sum(axis=0)
    return np.einsum("tb,tbh->bh", a, states), saved | {"states": states, "a": a}


def read_back(d: dict[str, np.ndarray], k: str, p: np.ndarray, at: np.ndarray, saved: dict, d_pooled: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters of read, and of p, from that of what it pooled."""
    h = d[k + "Uf"].shape[0]
    states, a, alive = saved["states"], saved["a"], saved["alive"]
    grad = {k + "Uf": np.zeros_like(d[k + "Uf"]), k + "Ub": np.zeros_like(d[k + "Ub"])}
    d_a = np.einsum("tbh,bh->tb", states, d_pooled)
    d_e = a * (d_a - (a * d_a).sum(axis=0))
    grad[k + "v"] = np.einsum("tb,tbh->h", d_e, states)
    d_states = a[:, :, None] * d_pooled[None] + d_e[:, :, None] * d[k + "v"]
    d_p = np.zeros_like(p)
    steps, count = at.shape
    for side, cols, order in (("f", slice(0, h), range(steps - 1, -1, -1)), ("b", slice(h, 2 * h), range(steps))):
        u, base = d[f"{k}U{side}"], 0 if side == "f" else 3 * h
        own = grad[f"{k}U{side}"]
        flow = np.zeros((count, h), dtype=p.dtype)
        rows, gates = [], []
        for t in order:
            m = alive[t]
            if not m:
                continue
            before, z, r, c = saved[side, t]
            dh = flow[:m] + d_states[t, :m, cols]
            dc = dh * z * (1 - c * c)
            dz = dh * (c - before) * z * (1 - z)
            drb = dc @ u[:, 2 * h :].T
            dr = drb * before * r * (1 - r)
            gate = np.concatenate([dz, dr, dc], axis=1)
            own[:, : 2 * h] += before.T @ gate[:, : 2 * h]
            own[:, 2 * h :] += (r * before).T @ dc
            flow[:m] = dh * (1 - z) + drb * r + gate[:, : 2 * h] @ u[:, : 2 * h].T
            rows.append(at[t, :m])
            gates.append(gate)
        if rows:
            where, g = np.concatenate(rows), np.concatenate(gates)
            for j in range(3 * h):
                d_p[:, base + j] = np.bincount(where, g[:, j], minlength=len(p))
    return grad, d_p


@dataclass
class Model:
    settings: Settings
    known: dict[str, int]  # rows of the tokens that have one; row 0 is for all others
    words: np.ndarray
    grams: np.ndarray  # rows of character n-grams
    dense: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def new(s: Settings, known: list[str] = ()) -> Model:
        r = np.random.default_rng(s.seed)
        f = lambda *shape, scale: r.normal(0, scale, shape).astype(np.float32)
        dense = {}
        for k, h, d in (("c", s.char_hidden, s.width), ("w", s.hidden, s.width + 2 * s.char_hidden)):
            for side in "fb":
                dense |= {f"{k}W{side}": f(d, 3 * h, scale=d**-0.5), f"{k}U{side}": f(h, 3 * h, scale=0.5 * h**-0.5), f"{k}c{side}": np.zeros(3 * h, np.float32)}
            dense[k + "v"] = f(2 * h, scale=0.3)
        dense |= {"o": f(2 * s.hidden, scale=0.3), "b": np.full(1, -1.0, np.float32)}
        return Model(s, {w: i for i, w in enumerate(known, 1)}, f(len(known) + 1, s.width, scale=0.05), f(s.gram_rows, s.width, scale=0.05), dense)

    def projected(self, k: str, x: np.ndarray) -> np.ndarray:
        d = self.dense
        return np.concatenate([x @ d[k + "Wf"] + d[k + "cf"], x @ d[k + "Wb"] + d[k + "cb"]], axis=1)

    def inputs(self, words: list[str], keep: bool = False) -> tuple[np.ndarray, dict]:
        """Each token's own vector beside the reading of its characters."""
        rows = np.fromiter(map(self.known.get, words, repeat(0)), dtype=np.int64, count=len(words))
        grams, lengths = places_of(words, self.settings.gram_rows)
        order = np.argsort(-lengths, kind="stable")
        first, n = (np.cumsum(lengths) - lengths)[order], lengths[order]
        steps = np.arange(int(n[0]))[:, None]
        at = np.where(steps < n[None, :], first[None, :] + steps, 0)
        x = self.grams[grams].sum(axis=1)
        p = self.projected("c", x)
        pooled, saved = read(self.dense, "c", p, at, n, keep)
        chars = np.empty_like(pooled)
        chars[order] = pooled
        return np.concatenate([self.words[rows], chars], axis=1), {"rows": rows, "grams": grams, "order": order, "at": at, "x": x, "p": p, "saved": saved}

    def table(self, words: list[str]) -> np.ndarray:
        """What the network over tokens takes in for each token; some tokens at a time."""
        out = np.empty((len(words), 6 * self.settings.hidden), dtype=np.float32)
        for k in range(0, len(words), PART):
            out[k : k + PART] = self.projected("w", self.inputs(words[k : k + PART])[0])
        return out

    def logits(self, p: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return read(self.dense, "w", p, at, n)[0] @ self.dense["o"] + self.dense["b"][0]

    def gradients(self, words: list[str], at: np.ndarray, n: np.ndarray, slope: Callable[[np.ndarray], np.ndarray]) -> tuple[dict, tuple, tuple]:
        """Gradients of the dense parameters, of rows of words and of rows of grams (row numbers, gradients), given the loss's slope by the logits."""
        d, s = self.dense, self.settings
        x, own = self.inputs(words, keep=True)
        p = self.projected("w", x)
        pooled, saved = read(d, "w", p, at, n, keep=True)
        d_logit = slope(pooled @ d["o"] + d["b"][0])
        grad, d_p = read_back(d, "w", p, at, saved, d_logit[:, None] * d["o"][None, :])
        grad |= {"o": pooled.T @ d_logit, "b": d_logit.sum(keepdims=True)}
        d_x = self._unproject("w", x, d_p, grad)
        more, d_cp = read_back(d, "c", own["p"], own["at"], own["saved"], d_x[own["order"], s.width :])
        grad |= more
        d_g = self._unproject("c", own["x"], d_cp, grad)
        return grad, (own["rows"], d_x[:, : s.width]), (own["grams"].ravel(), np.repeat(d_g, len(SIZES), axis=0))

    def _unproject(self, k: str, x: np.ndarray, d_p: np.ndarray, grad: dict) -> np.ndarray:
        half = d_p.shape[1] // 2
        for side, part in (("f", d_p[:, :half]), ("b", d_p[:, half:])):
            grad |= {f"{k}W{side}": x.T @ part, f"{k}c{side}": part.sum(axis=0)}
        return d_p[:, :half] @ self.dense[k + "Wf"].T + d_p[:, half:] @ self.dense[k + "Wb"].T


def windows_of(lengths: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of texts of so many tokens, laid end to end: place of the first token, length and text of each; longest first."""
    lengths = np.asarray(lengths, dtype=np.int64)
    many = np.array([len(window_starts(int(x), s.window, s.stride)) for x in lengths], dtype=np.int64)
    owner = np.repeat(np.arange(len(lengths)), many)
    start = (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)) * s.stride
    n = np.minimum(s.window, lengths[owner] - start)
    first = (np.cumsum(lengths) - lengths)[owner] + start
    order = np.argsort(-n, kind="stable")
    return first[order], n[order], owner[order]


def grid_of(flat: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(steps, windows) token numbers; 0 beyond a window's end."""
    steps = np.arange(max(1, int(n.max(initial=0))))[:, None]
    if not len(flat):
        return np.zeros((len(steps), len(n)), dtype=np.int64)
    return np.where(steps < n[None, :], flat[np.minimum(first[None, :] + steps, len(flat) - 1)], 0)


def train(texts: list[str], labels: list[int], settings: Settings | None = None) -> Model:
    """Fit the networks to texts labelled 0 or 1. Without both classes they are left as they were made."""
    s = settings or Settings()
    y = np.array(labels, dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return Model.new(s)
    number: dict[str, int] = {}
    numbers = [np.array([number.setdefault(w, len(number)) for w in tokens_of(t)], dtype=np.int32) for t in texts]
    vocabulary = list(number)
    del number
    if not vocabulary:
        return Model.new(s)
    docs_of = np.zeros(len(vocabulary), dtype=np.int64)
    for x in numbers:
        docs_of[np.unique(x)] += 1
    m = Model.new(s, [w for w, k in zip(vocabulary, docs_of.tolist(), strict=True) if k >= s.word_docs])
    _begin(m, vocabulary, numbers, y)
    fixed = [~m.words.any(axis=1), ~m.grams.any(axis=1)]
    flat = np.concatenate(numbers)
    first, n, owner = windows_of(np.array([len(x) for x in numbers]), s)
    r = np.random.default_rng(s.seed)
    mean = {k: np.zeros_like(x) for k, x in m.dense.items()}
    square = {k: np.zeros_like(x) for k, x in m.dense.items()}
    sums = [np.full(len(m.words), 1e-3, np.float32), np.full(s.gram_rows, 1e-3, np.float32)]
    weight = np.sqrt(np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum())))  # halfway to equal classes
    tick = 0
    for turn in range(max(s.epochs, -(-s.steps * 256 // (2 * len(y))))):
        # the worst window of each text, and of texts without toxicity one more at random
        if turn % s.refresh == 0:
            p = m.table(vocabulary)
            logits = np.concatenate([m.logits(p, grid_of(flat, first[k : k + 2048], n[k : k + 2048]), n[k : k + 2048]) for k in range(0, len(n), 2048)])
            del p
            order = np.lexsort((-logits, owner))
            worst = order[np.r_[True, np.diff(owner[order]) > 0]]
        other = np.flatnonzero((y[owner] == 0) & (r.random(len(n)) < min(1.0, len(y) / max(1, len(n)))))
        chosen = r.permutation(np.union1d(worst, other))
        for k in range(0, len(chosen), 256):
            own = np.sort(chosen[k : k + 256])  # keeps the longest first
            used, inverse = np.unique(grid_of(flat, first[own], n[own]), return_inverse=True)
            t = owner[own]
            grad, *sparse = m.gradients([vocabulary[i] for i in used.tolist()], inverse.reshape(-1, len(own)), n[own], lambda logit, t=t, own=own: ((_sigmoid(logit) - y[t]) * weight[t] / len(own)).astype(np.float32))
            tick += 1
            for key, g in grad.items():
                mean[key] = 0.9 * mean[key] + 0.1 * g
                square[key] = 0.99 * square[key] + 0.01 * g * g
                m.dense[key] -= (0.01 * (mean[key] / (1 - 0.9**tick)) / (np.sqrt(square[key] / (1 - 0.99**tick)) + 1e-6)).astype(np.float32)
            for table, total, still, (index, g) in zip((m.words, m.grams), sums, fixed, sparse, strict=True):
                g, index = g[~still[index]], index[~still[index]]
                touched, inv = np.unique(index, return_inverse=True)
                g = np.stack([np.bincount(inv, g[:, j], minlength=len(touched)) for j in range(s.width)], axis=1)
                total[touched] += (g * g).mean(axis=1)
                table[touched] -= (0.006 * g / np.sqrt(total[touched])[:, None]).astype(np.float32)
    return m


def _begin(m: Model, vocabulary: list[str], numbers: list[np.ndarray], y: np.ndarray) -> None:
    """Let the first coordinate of each row begin at how much likelier its documents are to be toxic; rows of too few documents stay 0."""
    s = m.settings
    rows = np.array([m.known.get(w, 0) for w in vocabulary], dtype=np.int32)
    ends = np.concatenate([[0], np.cumsum([len(w) + 1 for w in vocabulary])])
    flat = np.empty((ends[-1], len(SIZES)), dtype=np.int32)
    for k in range(0, len(vocabulary), PART):
        flat[ends[k] : ends[min(k + PART, len(vocabulary))]] = places_of(vocabulary[k : k + PART], s.gram_rows)[0]
    of_word = lambda u: rows[u]
    of_grams = lambda u: np.concatenate([flat[ends[i] : ends[i + 1]] for i in u.tolist()])
    for table, keys in ((m.words, of_word), (m.grams, of_grams)):
        seen = np.zeros((2, len(table)), dtype=np.float64)
        for x, label in zip(numbers, y.tolist(), strict=True):
            if len(x):
                seen[int(label), np.unique(keys(np.unique(x)))] += 1
        share = (seen + 0.5) / (np.array([(y == 0).sum(), (y == 1).sum()])[:, None] + 1)
        common = seen.sum(axis=0) >= s.word_docs
        table[:, 0] += np.clip(np.log(share[1] / share[0]), -3, 3) * common * 0.25
        table[~common] = 0  # what too few documents have stays without a vector, so nothing is learnt by heart


class Scorer:
    """Scores texts by a model; remembers the inputs of tokens."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.table = np.zeros((1024, 6 * self.model.settings.hidden), dtype=np.float32)

    def _numbers(self, words: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.memo.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        lack = np.flatnonzero(out < 0)
        if lack.size:
            new = list(dict.fromkeys([words[i] for i in lack.tolist()]))
            used = len(self.memo)
            while used + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[used : used + len(new)] = self.model.table(new)
            self.memo.update(zip(new, range(used, used + len(new)), strict=True))
            out[lack] = [self.memo[words[i]] for i in lack.tolist()]
        return out

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """A text's tokens in pieces whose windows together are those of the text."""
        s = self.model.settings
        step, over = PIECE // s.stride * s.stride, s.window - s.stride
        found, held, begun = (m[0] for m in TOKEN.finditer(text.lower())), [], False
        while True:
            held += islice(found, step + over - len(held))
            if len(held) < step + over:
                break
            yield held
            held, begun = held[step:], True
        if not begun or len(held) > over:  # the windows so far have read what they share with the next
            yield held

    def scores(self, texts: list[str], block: int = 1024) -> np.ndarray:
        """The score of each text's worst window."""
        best = np.full(len(texts), -np.inf)
        words, lengths, owners = [], [], []

        def flush() -> None:
            if len(self.memo) > self.model.settings.memo:
                self.forget()
            flat = self._numbers(words)
            first, n, owner = windows_of(np.array(lengths), self.model.settings)
            of = np.array(owners)[owner]
            for k in range(0, len(n), block):
                at = grid_of(flat, first[k : k + block], n[k : k + block])
                np.maximum.at(best, of[k : k + block], self.model.logits(self.table, at, n[k : k + block]))
            words.clear(), lengths.clear(), owners.clear()

        for i, text in enumerate(texts):
            for piece in [tokens_of(text)] if len(text) < PIECE else self._pieces(text):
                words.extend(piece)
                lengths.append(len(piece))
                owners.append(i)
                if len(words) >= HELD:
                    flush()
        if owners:
            flush()
        return _sigmoid(best)


def labelled_sample(rows: DataFrame, labels: DataFrame, label_col: str, folds: int, held_out: int, most: tuple[int, int], fits: Column, values: list[str], id_col: str = "doc_id") -> list[tuple]:
    """Values of rows, and their labels, for training: of classes 1 and 0 the documents whose ids have the lowest hash, as many as `most` says.

    Only rows that fit are sampled. Held-out documents and null labels give none; of repeated or
    conflicting labels the larger counts.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold_of(id_col, folds) != held_out))
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("__label")).withColumn("__order", F.xxhash64("__id"))
    short = rows.filter(fits).select(F.col(id_col).alias("__id"), *values)
    there = known.join(short.select("__id").distinct(), "__id", "left_semi")
    chosen = there.filter("__label = 1").orderBy("__order", "__id").limit(most[0]).unionByName(there.filter("__label = 0").orderBy("__order", "__id").limit(most[1]))
    found = short.join(F.broadcast(chosen), "__id").select("__order", "__id", *values, "__label").collect()
    return [tuple(r)[2:] for r in sorted(found, key=lambda r: tuple(r)[:-1])]


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1) and predicted (1 if score >= threshold) of each whole text.

    A null or empty text is one window without tokens and gets that window's score. Each row gives
    one row; scores of equal texts agree to six digits, as products of blocks of other heights
    differ in the last ones. A null id stays null, an empty table gives an empty result, further
    columns are ignored. One narrow pass: nothing is shuffled, the broadcast model has a fixed size
    (about 5 MB), and a long text is read in pieces: memory is bounded by the text itself, some
    hundred thousand tokens and what is remembered of them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in small_batches(batches, "text"):
            score = np.clip(scorer.scores(batch.column("text").to_pylist()), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32())], names=[id_col, "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")


def keep_below(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """docs, all columns, without the rows whose text scores at the threshold or above. One narrow pass.

    A null text is scored as an empty one and stays null. Every row is judged on its own: repeated
    rows and null ids all stay or all go. A score equal to the threshold goes. An empty table gives
    an empty result; columns may have any names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in small_batches(batches, text_col):
            good = scorer.scores([t or "" for t in batch.column(text_col).to_pylist()]) < threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, settings: Settings | None = None) -> Model:
    """Train on the labelled documents that are not held out; see labelled_sample and Settings for the bounds."""
    s = settings or Settings()
    texts = docs.select("doc_id", text_of().alias("text"))
    sample = labelled_sample(texts, labels, "toxic", folds, held_out, (s.sample, s.sample_clean), F.length("text") <= s.sample_chars, ["text"])
    return train([t for t, _ in sample], [y for _, y in sample], s)

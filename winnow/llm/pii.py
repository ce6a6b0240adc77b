"""Personal data: plain patterns, and a semi-Markov conditional random field that adds what they miss.

The field reads the pieces (runs of letters, of digits, of blanks, single signs) around digits and
at-signs that the plain patterns left over. Every run of at most LONGEST pieces and REACH characters
that could be an entity is a candidate segment with features of the whole span: its digits and their grouping, signs,
checksum, what stands beside it. Dynamic programming over the pieces chooses boundaries and types of
all segments of a neighbourhood together. Its weights are trained here, by the gradient of the
likelihood, on examples drawn from a seeded generator of formats.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of

KINDS = ("email", "ip", "card", "phone")
#: Pieces of a segment, at most.
LONGEST = 18
#: Characters of a segment, at most.
REACH = 120
#: A segment is taken if the best labelling with it beats the best without it by so much.
MARGIN = 0.5

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PART = re.compile(r"[0-9]+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_PIECE = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
_SEED = re.compile(r"[0-9@]|[\[({] ?at ?[\])}]")
_SPELT = re.compile(r"[\[({] ?at ?[\])}]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield "email", start, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[Span]:
    for run in _DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        parts = [m.span() for m in _PART.finditer(text, *run.span())]
        for k in range(0, len(parts) - 3, 4):
            values = [text[a:b].lstrip("0") for a, b in parts[k : k + 4]]
            if all(len(v) < 4 and int(v or 0) <= 255 for v in values):
                yield "ip", parts[k][0], parts[k + 3][1]


def _cards(text: str) -> Iterator[Span]:
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            yield "card", *m.span()


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, m[0])) <= 15:
            yield "phone", *m.span()


def base_spans(text: str) -> list[Span]:
    """Spans of the plain patterns, by kind as listed, then by start. Linear in the text's length."""
    out = list(_emails(text)) if "@" in text else []
    if _SEED.search(text):
        out += [*_ips(text), *_cards(text)]
    return out + (list(_phones(text)) if "+" in text else [])


# --- the field -------------------------------------------------------------------------------


def _side(c: str) -> str:
    return "end" if not c else "word" if c.isalnum() or c == "_" else "space" if c.isspace() else c if c in "+-.@#$/=:\"'" else "sign"


@lru_cache(maxsize=1 << 14)
def features(span: str, left: str, right: str, word: str) -> tuple[str, ...]:
    """Features of a whole candidate span between its neighbouring characters, after a word."""
    runs = re.findall("[0-9]+", span)
    digits = "".join(runs)
    n = len(digits)
    letters = sum(map(str.isalpha, span))
    seps = "".join(sorted(set(re.sub(r"[0-9]|[^\W\d_]", "", span))))
    out = [f"digits:{min(n, 20)}", f"groups:{'-'.join(str(min(len(r), 9)) for r in runs[:6])}", f"seps:{seps[:6]}", f"left:{_side(left)}", f"right:{_side(right)}", f"word:{word if word in CUES else '-'}", f"letters:{min(letters, 3)}"]
    if letters:
        tail = re.search(r"(?:\.|dot|\[\.\])\W*([A-Za-z]{2,6})$", span)
        out += ["at" if "@" in span else "spelt at" if _SPELT.search(span) else "no at", "tail" if tail else "no tail", f"ends:{span[0].isalnum()}{span[-1].isalnum()}"]
    else:
        fits = 12 <= n <= 19
        out += [f"luhn:{fits and luhn(digits)}:{min(n, 20)}", f"four:{len(runs) == 4 and all(int(r) < 256 for r in runs if len(r) < 4) and all(len(r) < 4 for r in runs)}", f"same:{len(seps) <= 1}", f"first:{span[0] if not span[0].isdigit() else digits[0]}", f"last:{span[-1].isdigit()}"]
    return tuple(out)


#: Words before an entity that tell its kind.
CUES = frozenset("tel phone call fax mobile cell email mail contact card visa amex payment ip host server version date total order id isbn token".split())


def _may_be(span: str) -> bool:
    """Whether a run of pieces is a candidate at all."""
    if span[0].isspace() or span[-1].isspace() or not (span[-1].isalnum()):
        return False
    n = sum(map(str.isdigit, span))
    if any(map(str.isalpha, span)):
        return ("@" in span or _SPELT.search(span) is not None) and "\n" not in span and span.count(" ") <= 6 and span[0].isalnum()
    return n >= 7 and not re.search(r"[^0-9\x20().\[\]/:-]", span) or n >= 4 and span.count(".") == 3


class Field:
    """A zeroth-order semi-Markov conditional random field: a segment scores the sum of its features' weights."""

    def __init__(self) -> None:
        self.index: dict[tuple[str, str], int] = {}
        self.weights = np.zeros(0)

    def segments(self, text: str, pieces: list[tuple[int, int]], blocked: list[bool]) -> list[tuple[int, int, tuple[str, ...]]]:
        """Candidate segments of pieces that aren't blocked: first piece, piece after the last, features."""
        out = []
        for i, (a, _) in enumerate(pieces):
            if blocked[i] or text[a].isspace():
                continue
            for j in range(i, min(len(pieces), i + LONGEST)):
                if blocked[j]:
                    break
                b = pieces[j][1]
                if b - a > REACH:
                    break
                if _may_be(text[a:b]):
                    before = re.search(r"([^\W\d_]+)\W*$", text[max(0, a - 16) : a])
                    out.append((i, j + 1, features(text[a:b], text[a - 1 : a], text[b : b + 1], before[1].lower() if before else "")))
        return out

    def score(self, found: tuple[str, ...], kind: str) -> float:
        get, w = self.index.get, self.weights
        return sum(w[k] for f in found if (k := get((kind, f))) is not None) if len(w) else 0.0

    def best(self, n: int, segments: list[tuple[int, int, tuple[str, ...]]]) -> list[tuple[int, int, str]]:
        """The best labelling of n pieces."""
        by_end: dict[int, list] = {}
        for i, j, found in segments:
            by_end.setdefault(j, []).extend((i, k, s) for k in KINDS if (s := self.score(found, k) - MARGIN) > 0)
        top, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            top[j] = top[j - 1]
            for i, kind, s in by_end.get(j, ()):
                if top[i] + s > top[j]:
                    top[j], back[j] = top[i] + s, (i, kind)
        out, j = [], n
        while j:
            if back[j]:
                i, kind = back[j]
                out.append((i, j, kind))
                j = i
            else:
                j -= 1
        return out[::-1]

    def train(self, examples: list[tuple[str, list[Span]]], epochs: int = 40, rate: float = 0.2, decay: float = 2e-3) -> Field:
        """Gradient of the likelihood of the examples' segmentations, with per-weight step sizes."""
        ready = []
        for text, gold in examples:
            pieces = [m.span() for m in _PIECE.finditer(text)]
            want = {(a, b): k for k, a, b in gold}
            segs = []
            for i, j, found in self.segments(text, pieces, [False] * len(pieces)):
                kind = want.get((pieces[i][0], pieces[j - 1][1]))
                segs.append((i, j, [[self.index.setdefault((k, f), len(self.index)) for f in found] for k in KINDS], KINDS.index(kind) if kind else -1))
            if segs:
                ready.append((len(pieces), segs))
        self.weights = w = np.zeros(len(self.index))
        sums = np.full(len(w), 1e-2)
        for _ in range(epochs):
            for n, segs in ready:
                scores = [[float(w[ix].sum()) for ix in feats] for _, _, feats, _ in segs]
                ahead, behind = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
                ahead[0] = behind[n] = 0.0
                ends: dict[int, list[int]] = {}
                starts: dict[int, list[int]] = {}
                for q, (i, j, _, _) in enumerate(segs):
                    ends.setdefault(j, []).append(q)
                    starts.setdefault(i, []).append(q)
                log_sum = lambda xs: (m := max(xs)) + math.log(sum(math.exp(x - m) for x in xs))
                for j in range(1, n + 1):
                    ahead[j] = log_sum([ahead[j - 1], *(ahead[segs[q][0]] + s for q in ends.get(j, ()) for s in scores[q])])
                for i in range(n - 1, -1, -1):
                    behind[i] = log_sum([behind[i + 1], *(behind[segs[q][1]] + s for q in starts.get(i, ()) for s in scores[q])])
                grad: dict[int, float] = {}
                for q, (i, j, feats, gold) in enumerate(segs):
                    for k, s in enumerate(scores[q]):
                        g = (k == gold) - math.exp(ahead[i] + s + behind[j] - ahead[n])
                        if abs(g) > 1e-4:
                            for f in feats[k]:
                                grad[f] = grad.get(f, 0.0) + g
                if grad:
                    at, g = np.fromiter(grad, dtype=np.int64), np.fromiter(grad.values(), dtype=float)
                    g -= decay * w[at]
                    sums[at] += g * g
                    w[at] += rate * g / np.sqrt(sums[at])
        return self

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Spans that the field adds; none of them touches a base span."""
        out: list[Span] = []
        held, k = _merged(base), 0
        for a, b in _neighbourhoods(text):
            pieces = [m.span() for m in _PIECE.finditer(text, a, b)]
            while k < len(held) and held[k][1] <= a:  # both lists ascend: each stretch is met once
                k += 1
            blocked, at = [], k
            for p, q in pieces:
                while at < len(held) and held[at][1] <= p:
                    at += 1
                blocked.append(at < len(held) and held[at][0] < q)
            segs = self.segments(text, pieces, blocked)
            if segs:
                out += [(kind, pieces[i][0], pieces[j - 1][1]) for i, j, kind in self.best(len(pieces), segs)]
        return out


def _merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The stretches that spans cover, ascending and apart."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _neighbourhoods(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of text within a segment's reach of digits and at-signs: every candidate lies in one of them."""
    start = end = -1
    for m in _SEED.finditer(text):
        if start < 0:
            start, end = max(0, m.start() - REACH), m.end() + REACH
        elif m.start() - REACH <= end:
            end = m.end() + REACH
        else:
            yield _trim(text, start, end)
            start, end = m.start() - REACH, m.end() + REACH
    if start >= 0:
        yield _trim(text, start, min(len(text), end))


def _kind(c: str) -> int:
    """Which run of a piece a character belongs to; 0 if it is a piece of its own."""
    return 1 if "0" <= c <= "9" else 3 if c.isspace() else 2 if c.isalnum() and not c.isdecimal() else 0


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    """Without the pieces that the ends cut; these reach too far for any candidate."""
    while 0 < a < b and (k := _kind(text[a])) and _kind(text[a - 1]) == k:
        a += 1
    while a < b < len(text) and (k := _kind(text[b - 1])) and _kind(text[b]) == k:
        b -= 1
    return a, b


def examples(seed: int = 3, count: int = 60) -> list[tuple[str, list[Span]]]:
    """Texts with the spans in them, from a seeded generator of formats: each format count times."""
    r = np.random.default_rng(seed)
    d = lambda n: "".join(map(str, r.integers(0, 10, n)))
    word = lambda: "".join(r.choice(list("abcdefghilmnoprstu"), r.integers(2, 8)))

    def checked(n: int, good: bool) -> str:
        body = d(n - 1)
        last = next(c for c in "0123456789" if luhn(body + c))
        return body + (last if good else str((int(last) + 1 + int(r.integers(0, 9))) % 10))

    grouped = lambda s, sizes, sep: sep.join(s[sum(sizes[:i]) : sum(sizes[: i + 1])] for i in range(len(sizes)))
    part = lambda: str(r.integers(1, 256))
    top = lambda: str(r.choice(["com", "org", "net", "de", "fr", "es", "io", "edu"]))
    made = {
        "phone": [lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"{d(3)}.{d(3)}.{d(4)}", lambda: f"00{d(2)} {d(2)} {d(7)}", lambda: f"1-{d(3)}-{d(3)}-{d(4)}", lambda: f"({d(3)}){d(3)}-{d(4)}"],
        "email": [lambda: f"{word()}ë@{word()}.{top()}", lambda: f"{word()}[at]{word()}.{top()}", lambda: f"{word()} [at] {word()} [dot] {top()}", lambda: f"{word()}(at){word()}.{top()}", lambda: f"{word()}.{word()} (at) {word()} (dot) {top()}"],
        "ip": [lambda: f"{part()}[.]{part()}[.]{part()}[.]{part()}"],
        "card": [lambda: grouped(checked(16, True), [4, 4, 4, 4], "."), lambda: grouped(checked(15, True), [4, 6, 5], " "), lambda: grouped(checked(15, True), [4, 6, 5], "-"), lambda: grouped(checked(16, True), [4, 4, 4, 4], "/")],
        "": [
            lambda: checked(16, False), lambda: grouped(checked(16, False), [4, 4, 4, 4], " "), lambda: grouped(checked(16, False), [4, 4, 4, 4], "."), lambda: grouped(checked(15, False), [4, 6, 5], " "), lambda: d(int(r.integers(7, 25))), lambda: f"20{d(2)}-0{d(1)}-1{d(1)} 1{d(1)}:{d(2)}:{d(2)}",
            lambda: f"{d(2)}/{d(2)}/{d(4)}", lambda: f"{part()}.{part()}.{part()}.9{d(3)}", lambda: f"{d(1)}.{d(1)}.{d(2)}", lambda: f"{word()} at {word()}. {word()}", lambda: f"{word()} at {word()} {word()}", lambda: f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", lambda: f"{d(3)},{d(3)},{d(3)}.{d(2)}",
            lambda: f'token = "{"".join(r.choice(list("0123456789abcdef"), 40))}"', lambda: f"{d(5)} {d(5)}", lambda: f"{d(4)} {d(4)}", lambda: f"{d(8)}-{d(4)}", lambda: f"@{word()} {word()}.", lambda: f"{word()}@ {word()}", lambda: f"{d(2)} {d(2)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"{d(3)} {d(3)} {d(4)} {d(5)} {d(4)}", lambda: f"{d(4)}-{d(4)}-{d(4)}", lambda: f"{d(3)}-{d(4)}",
        ],
    }
    out = []
    for kind, formats in made.items():
        for f in formats:
            for _ in range(count if kind else count // 2):
                before = " ".join(word() for _ in range(r.integers(0, 3))) + str(r.choice([" ", ". ", ", ", "\n", ": "]))
                before = "" if r.random() < 0.15 else before
                own = f()
                after = "" if r.random() < 0.15 else f"{r.choice([' ', '. ', ', ', chr(10)])}{word()}"
                text = f"{before}{own}{after}"
                out.append((text, [(kind, len(before), len(before) + len(own))] if kind else []))
    return [out[i] for i in r.permutation(len(out))]


@lru_cache(maxsize=1)
def trained() -> Field:
    return Field().train(examples(count=24), epochs=15)


def find(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans together; both by kind as listed, then by start."""
    base = base_spans(text)
    if not _SEED.search(text):
        return base, base
    extra = field.added(text, base)
    return base, sorted([*base, *extra], key=lambda s: (KINDS.index(s[0]), s[1])) if extra else base


def redact(text: str, spans: list[Span]) -> str:
    """The text with each stretch of touching spans replaced by the name of its first one's kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def written(spans: list[Span]) -> str:
    return ",".join([f"{k}:{a}:{b}" for k, a, b in spans])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone (of base spans), base_sha256 and spans (all) of each whole text.

    Offsets are in code points, ends exclusive. with_text adds redacted, the text with all spans
    replaced by their kinds. A null text is empty and has no spans; each row gives one row,
    repeated rows equal ones; a null id stays null. One narrow pass of time linear in the text's
    length, without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    names = [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"] + ["redacted"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in small_batches(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                base, every = find(text, field)
                rows.append([*(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(written(base).encode()).hexdigest(), written(every)] + [redact(text, every)] * with_text)
            kinds = [pa.int64()] * 4 + [pa.string()] * (2 + with_text)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string" + ", redacted string" * with_text
    return docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text")).mapInArrow(run, schema)


def redact_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs, all columns, with every span in the text replaced by its kind; a null text stays null. One narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in small_batches(batches, text_col):
            texts = [t and redact(t, find(t, field)[1]) for t in batch.column(text_col).to_pylist()]
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)

"""Operators that read one text at a time, against brute force and the libraries that they should agree with."""

import hashlib
import math
import pickle
import random
import re
import time

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnow.llm import bpe, chat, fingerprint, licenses, pii, quality, toxicity
from winnow.llm.license_templates import TEMPLATES

LONG = "the quick brown fox " * 30_000
ODD = [None, "", " ", "a", "naïve   日本語 🎉", "x" * 5000, "1" * 3000, "a\n\n\nb", "\t", "'s 't don't", LONG[:100_000]]
SCHEMA = "doc_id bigint, text string, score double, id string, part int"


def odd(spark, texts=tuple(ODD)):
    """Odd texts under repeated, null and plain ids, beside columns whose names the operators use themselves."""
    rows = [(i, t, 1.0, "x", 9) for i, t in enumerate(texts)] + [(None, "no id", 1.0, "x", 9), (3, "a", 1.0, "x", 9), (3, "a", 1.0, "x", 9)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def codec():
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    ranked = bpe.load_ranks(None, tokenizers.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks={s: i for i, s in enumerate(ranked)}, special_tokens={})
    return bpe.Codec(ranked, tokenizers.PATTERN), own


def test_bpe_agrees_with_the_library(codec):
    c, own = codec
    r = random.Random(0)
    texts = [t or "" for t in ODD] + ["".join(r.choices("abc äé日'1 \n.!<|endoftext|>", k=r.randint(0, 60))) for _ in range(500)]
    for t in texts:
        ids = c.encode(t).tolist()
        assert ids == own.encode_ordinary(t), t[:50]
        assert c.decode(ids) == t.encode()


def test_library_codec_gives_the_same_ids(codec):
    c, _ = codec
    quick = pickle.loads(pickle.dumps(bpe.LibraryCodec(c.vocabulary, c.pattern)))
    r = random.Random(3)
    texts = [t or "" for t in ODD] + ["".join(r.choices("abc äé日'1 \n.!<|endoftext|>", k=r.randint(0, 60))) for _ in range(300)] + ["z" * 300_000, "a" + " " * 300_000 + "b", "word " * 5000, LONG]
    for t in texts:
        assert quick.encode(t).tolist() == c.encode(t).tolist(), t[:50]
    assert quick.careful is not None and quick.end == c.end and quick.decode(quick.encode("ab cd")) == b"ab cd"


def test_bpe_in_blocks(codec, monkeypatch):
    c, own = codec
    monkeypatch.setattr(bpe, "BLOCK", 7)
    assert c.encode("one two three four five six seven eight nine ten").tolist() == own.encode_ordinary("one two three four five six seven eight nine ten")


def test_merges_alone_give_the_library_s_ids(codec):
    c, own = codec
    for w in (" incomprehensibilities", "aaaaaaaaaaaaaaa", "ééééé", " zyxwv"):
        assert c.merge(w.encode()) == own.encode_ordinary(w)


def test_perfect_hash():
    keys = [str(i).encode() for i in range(3000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.slot.tolist()) == list(range(3000))
    assert h.find(keys).tolist() == list(range(3000))
    assert h.find([b"no", b"", b"3000"]).tolist() == [-1] * 3
    assert bpe.PerfectHash([]).find([b"x"]).tolist() == [-1]
    with pytest.raises(ValueError):
        bpe.PerfectHash([b"a", b"a"])


def test_bpe_table(spark, codec):
    c, own = codec
    got = bpe.bpe_digests(odd(spark), c, with_ids=True).collect()
    assert len(got) == len(ODD) + 3
    for r, t in zip(sorted((r for r in got if r["doc_id"] is not None and r["doc_id"] != 3), key=lambda r: r["doc_id"]), [t for i, t in enumerate(ODD) if i != 3], strict=True):
        assert r["ids"] == own.encode_ordinary(t or "") and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], dtype="<u4").tobytes()).hexdigest()
    assert bpe.bpe_digests(odd(spark).limit(0), c).count() == 0


def brute_spans(t):
    """The plain patterns, as they are written."""
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            d = re.sub(r"\D", "", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 16 <= len(d) <= 19 and pii.luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_spans_match_the_patterns():
    r = random.Random(1)
    for _ in range(20_000):
        t = "".join(r.choices("ab1299.@+- ()é", k=r.randint(0, 30)))
        assert pii.base_spans(t) == brute_spans(t), t
    cards = "4111 1111 1111 1111, 4111-1111-1111-1112, 4111111111111111"
    assert pii.base_spans(cards) == brute_spans(cards) and len(pii.base_spans(cards)) == 2


def test_base_spans_are_linear():
    for t in ("a" * 200_000 + "@", "1" * 200_000, "1." * 5_000, "+1" * 5_000, "a@" * 5_000, "@ " * 5_000):
        pii.find(t, pii.trained())


def test_contact_lists_take_linear_time():
    def took(n):
        t = "".join(f"Ann Bell, ann.{i}@mail.org, +1 (171) 555-{i % 10000:04}, bob{i} [at] post [dot] net, 10.0.{i % 256}.1\n" for i in range(n))
        spent = []
        for _ in range(2):
            began = time.process_time()
            base, every = pii.find(t, pii.trained())
            spent.append(time.process_time() - began)
        assert len(base) >= 3 * n and len(every) >= 4 * n
        return len(t), min(spent)

    took(200)
    (small, a), (large, b) = took(6_000), took(12_000)
    assert large > 1_000_000 and b < 3.5 * a, (small, a, large, b)


def test_neighbourhoods_lose_no_candidate():
    """The field on stretches around digits and signs finds what it finds on the whole text."""
    f, r = pii.trained(), random.Random(7)
    parts = ["ann", "[at]", " ", "example", "[dot]", "com", "555-1234", "(505) 555-1234", "7[.]7[.]7[.]7", "x" * 45, "y" * 50, "z" * 130, " " * 70, "word ", "12 ", "a1" * 70, "ë@b.com", "\u0663", "_", "\n"]
    for _ in range(400):
        t = "".join(r.choices(parts, k=r.randint(1, 25)))
        base = pii.base_spans(t)
        pieces = [m.span() for m in pii._PIECE.finditer(t)]
        segs = f.segments(t, pieces, [any(x < q and y > p for _, x, y in base) for p, q in pieces])
        want = [(kind, pieces[i][0], pieces[j - 1][1]) for i, j, kind in f.best(len(pieces), segs)]
        assert f.added(t, base) == want, t
    for t in ("a" * 50 + " [at] example [dot] com", "a" * 50 + "ë@example.com"):
        assert f.added(t, pii.base_spans(t)) == [("email", 0, len(t))]


#: Written by hand, not drawn from the generator: a text, and the spans that a reader marks in it.
BY_HAND = [
    ("Ring Maria on (0171) 555 0182 after six.", ["(0171) 555 0182"]), ("Our desk: 555-201-3344, ext 12", ["555-201-3344"]), ("fax 212.555.0199", ["212.555.0199"]), ("Call (415)555-2671!", ["(415)555-2671"]),
    ("Dial 0049 30 1234567 from abroad", ["0049 30 1234567"]), ("1-800-555-0147 is free of charge", ["1-800-555-0147"]), ("write to jane.doe[at]mail.org today", ["jane.doe[at]mail.org"]), ("peter (at) firma (dot) de", ["peter (at) firma (dot) de"]),
    ("zoë@kaffee.de gave the talk", ["zoë@kaffee.de"]), ("kim {at} host.net", ["kim {at} host.net"]), ("blocked 192[.]168[.]7[.]20 at the gate", ["192[.]168[.]7[.]20"]), ("card 4111.1111.1111.1111 exp 09", ["4111.1111.1111.1111"]),
    ("amex 3782 822463 10005 thanks", ["3782 822463 10005"]), ("Amex: 3714-496353-98431", ["3714-496353-98431"]),
    ("The war lasted from 1914 to 1918.", []), ("Version 10.4.2 of the tool", []), ("meet at noon. dot your letters", []), ("ISBN 978-3-16-148410-0", []), ("pages 123-456 and 789", []), ("order 20240117-0042", []), ("ratio 3.14159 to 2.71828", []), ("on 12/05/2021 at 08:15", []), ("2024-01-17 11:25:36", []), ("a total of 1,250,000.50", []),
]


def test_field_on_texts_written_by_hand():
    f = pii.trained()
    right = sum([t[a:b] for _, a, b in f.added(t, pii.base_spans(t))] == want for t, want in BY_HAND)
    assert right >= 20, [(t, [t[a:b] for _, a, b in f.added(t, pii.base_spans(t))]) for t, w in BY_HAND if [t[a:b] for _, a, b in f.added(t, pii.base_spans(t))] != w]


def test_field_adds_what_the_patterns_miss_and_leaves_numbers_alone():
    f = pii.trained()
    right = 0
    cases = pii.examples(seed=99, count=10)
    for text, gold in cases:
        base = pii.base_spans(text)
        want = [s for s in gold if not any(a < s[2] and b > s[1] for _, a, b in base)]
        right += sorted(f.added(text, base)) == sorted(want)
    assert right >= 0.95 * len(cases)
    for clean in ("Licensed under the Apache License, Version 2.0.", "on 2024-05-06 at 10:11:12", "4651971212855891 and 12345 67890", "meet me at home. com is a word"):
        assert pii.find(clean, f)[1] == []


def test_dynamic_programming_is_the_best_labelling():
    f = pii.trained()
    r = random.Random(2)
    for _ in range(40):
        text = " ".join(r.choices(["(505) 555-1234", "12", "x", "555-1234", "7.7.7.7", "ann[at]b.com", "-"], k=4))
        pieces = [m.span() for m in pii._PIECE.finditer(text)]
        segs = f.segments(text, pieces, [False] * len(pieces))
        scored = [(i, j, k, f.score(x, k) - pii.MARGIN) for i, j, x in segs for k in pii.KINDS]
        scored = [s for s in scored if s[3] > 0]

        def best(rest):
            if not rest:
                return 0.0
            i, j, _, s = rest[0]
            clear = [x for x in rest[1:] if x[0] >= j or x[1] <= i]
            return max(best(rest[1:]), s + best(clear))

        chosen = f.best(len(pieces), segs)
        total = sum(next(s[3] for s in scored if s[:3] == c) for c in chosen)
        assert total == pytest.approx(best(scored))


def test_pii_table(spark):
    texts = [*ODD, "mail ann.b@x.org and +1 (171) 555-2028, 10.0.0.1", "é" * 10 + "a@b.co"]
    got = {r["doc_id"]: r for r in pii.find_pii(odd(spark, texts), with_text=True).collect() if r["doc_id"] is not None}
    for i, t in enumerate(texts):
        base = brute_spans(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert got[i]["n_email"] == sum(s[0] == "email" for s in base)
        assert set(pii.written(base).split(",")) <= set(got[i]["spans"].split(","))
    assert got[len(ODD)]["redacted"] == "mail [EMAIL] and [PHONE], [IP]"
    assert pii.find_pii(odd(spark).limit(0)).count() == 0
    back = pii.redact_texts(odd(spark, texts))
    assert back.columns == odd(spark).columns and back.count() == len(texts) + 3 and back.filter("text is null").count() == 1
    assert pii.redact("ab@c.d x", [("email", 0, 6), ("phone", 2, 4)]) == "[EMAIL] x"


def slow_counts(data):
    counts = [0] * fingerprint.BUCKETS
    m = [int(x) for x in fingerprint._MUL]
    mask, shift = 0xFFFFFFFF, int(fingerprint._SHIFT)
    for i in range(len(data) - 4):
        for k, (x, y, z) in enumerate(fingerprint.TRIPLETS):
            a, b, c = data[i + x], data[i + y], data[i + z]
            h = (((a * m[0] + b * m[1] + (k * 0x27D4EB2F & mask)) & mask) ^ (c * m[2] & mask)) * m[0] & mask
            counts[h >> shift] += 1
    return counts


def test_fingerprint_counts(monkeypatch):
    r = random.Random(4)
    data = bytes(r.choices(range(256), k=700))
    assert fingerprint.bucket_counts(data).tolist() == slow_counts(data)
    monkeypatch.setattr(fingerprint, "BLOCK", 64)
    assert fingerprint.bucket_counts(data).tolist() == slow_counts(data)


def slow_fingerprint(data):
    """Length, quartile ratios and two bits a bucket, in plain loops."""
    counts = slow_counts(data) if len(data) > 4 else fingerprint.bucket_counts(data).tolist()
    n = fingerprint.BUCKETS
    q1, q2, q3 = sorted(counts)[n // 4 - 1], sorted(counts)[n // 2 - 1], sorted(counts)[3 * n // 4 - 1]
    codes = [sum(c > q for q in (q1, q2, q3)) for c in counts]
    head = [min(255, round(8 * math.log2(1 + len(data)))), round(255 * q1 / max(1, q3)), round(255 * q2 / max(1, q3))]
    return bytes(head + [codes[k] | codes[k + 1] << 2 | codes[k + 2] << 4 | codes[k + 3] << 6 for k in range(0, n, 4)]).hex()


def slow_likeness(a, b):
    x, y = bytes.fromhex(a), bytes.fromhex(b)
    total = min(abs(x[0] - y[0]), 24) + min(abs(x[1] - y[1]) // 4, 12) + min(abs(x[2] - y[2]) // 4, 12)
    for p, q in zip(x[3:], y[3:], strict=True):
        total += sum(abs((p >> s & 3) - (q >> s & 3)) for s in (0, 2, 4, 6))
    return max(0.0, 1 - total / (1.25 * 256))


def test_edit_report_matches_plain_loops(spark):
    r = random.Random(12)
    texts = ["".join(r.choices("abcdé 日\n", k=r.choice([0, 1, 4, 5, 40, 900]))) for _ in range(25)] + [None, "x" * 60_000, LONG[:50_000]]
    rows = [(i, t, "clash", 0.5, -1) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string, near_next double, part int").repartition(4)
    got = {x["doc_id"]: x for x in fingerprint.edit_report(table).collect()}
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        after = plain[(i + 1) % len(plain)]
        cut = len(t) // 4
        new = t[: len(t) - cut] + after[:cut]
        own, other, changed = (slow_fingerprint(x.encode()) for x in (t, after, new))
        x = got[i]
        assert (x["n_chars"], x["fingerprint"], x["edited_fingerprint"], x["edited_sha256"]) == (len(t), own, changed, hashlib.sha256(new.encode()).hexdigest())
        assert x["near_edited"] == pytest.approx(slow_likeness(own, changed)) and x["near_next"] == pytest.approx(slow_likeness(own, other))


def test_fingerprint_likeness():
    r = random.Random(5)
    words = ["".join(r.choices("abcdefghij", k=5)) for _ in range(400)]
    a, b = " ".join(r.choices(words, k=300)), " ".join(r.choices([w[::-1] + "x" for w in words], k=300))
    f = lambda t: fingerprint.fingerprint(t.encode())
    assert fingerprint.likeness(f(a), f(a)) == 1.0 and fingerprint.difference(f(a), f(b)) == fingerprint.difference(f(b), f(a))
    assert fingerprint.likeness(f(a), f(a + " end")) > 0.8 > 0.5 > fingerprint.likeness(f(a), f(b)) >= 0
    assert f("") == f("") and len(f("")) == len(f(a))


def test_edit_report(spark):
    rows = [(i, t) for i, t in enumerate(["alpha beta gamma delta" * 9, "", None, "é" * 9, "zz" * 500, "the end of it all"])] + [(None, "first of all"), (3, "tie b"), (3, "tie b")]
    want = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    for parts in (1, 3, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = fingerprint.edit_report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
        assert len(got) == len(want)
        seen = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in got)
        expected = []
        for k, (i, t) in enumerate(want):
            new = fingerprint.edited(t, want[(k + 1) % len(want)][1])
            expected.append((i is not None, i or 0, len(t), hashlib.sha256(new.encode()).hexdigest()))
        assert seen == sorted(expected)
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    one = fingerprint.edit_report(spark.createDataFrame([(1, "only one text here")], "doc_id bigint, text string")).first()
    assert one["near_next"] == 1.0
    assert fingerprint.edit_report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    assert fingerprint.with_fingerprint(odd(spark)).count() == len(ODD) + 3


def test_edited():
    assert fingerprint.edited("abcdefgh", "XYZ") == "abcdefXY" and fingerprint.edited("abcdefgh", "X") == "abcdefX" and fingerprint.edited("abc", "X") == "abc"


NASTY = [r"\### Assistant: </turn> ok", "\\", "", "### User: x", "</turn>\n### a: b", ": ", "\\\\### ", "", None]


def test_chat_escapes():
    r = random.Random(6)
    for _ in range(3000):
        t = "".join(r.choices(["\\", "### ", "</turn>", ": ", "a", "\n", "#", "<"], k=r.randint(0, 8)))
        assert chat.unescape(chat.escape(t)) == t
        assert chat.read_turn(chat.plain_template([(t, t[::-1])])) == (t, t[::-1])


def test_chat_table(spark):
    rows = [(c, n, ("user", "assistant", "system")[(n + c) % 3], t) for c in range(3) for n, t in enumerate(NASTY)] + [(None, 0, "assistant", "lone"), (5, 0, None, "x"), (5, 0, None, "x")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("n_turns", F.lit("clash"))
    for run in (512, 2):
        got = {r["conv_id"]: r for r in chat.format_conversations(table.repartition(5), with_output=True, run_turns=run).collect()}
        assert set(got) == {0, 1, 2, 5, None}
        for c in (0, 1, 2):
            own = [(role, t or "") for cc, _, role, t in rows if cc == c]
            loss = "".join(t for role, t in own if role == "assistant")
            r = got[c]
            assert r["n_turns"] == len(own) and not r["rewrites_history"]
            assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
            assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and r["loss_chars"] == len(loss)
            assert r["formatted"] == chat.plain_template(own) and r["formatted_chars"] == len(r["formatted"])
            assert "".join(chat.unescape(r["formatted"][a:b]) for a, b in r["loss_spans"]) == loss
        assert got[5]["n_turns"] == 2
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_chat_does_not_depend_on_the_run(spark):
    n = 600
    table = spark.createDataFrame([(1, k, ("user", "assistant")[k % 2], f"t{k}") for k in range(n)], "conv_id bigint, turn bigint, role string, text string")
    turns = [(("user", "assistant")[k % 2], f"t{k}") for k in range(n)]

    def body(ts):
        return "".join(f"[{r}|{t}]" for r, t in ts)

    def preamble(ts):
        return "<begin>" + body(ts)

    def sliding(ts):
        return body(ts[-550:])

    def read(span):
        return tuple(span.removeprefix("<begin>").strip("[]").split("|", 1)) if "|" in span else ("", span)

    for template, rewrites in ((preamble, False), (sliding, True)):
        rows = []
        for run in (512, 7, 10_000):
            rows += chat.format_conversations(table, template, read, lambda t: t, with_output=True, run_turns=run).collect()
        assert rows[0] == rows[1] == rows[2]
        assert rows[0]["formatted"] == template(turns) and rows[0]["formatted_chars"] == len(template(turns)) and rows[0]["rewrites_history"] == rewrites
    got = chat.format_conversations(table, preamble, read, lambda t: t, with_output=True).first()
    assert [got["formatted"][a:b] for a, b in got["loss_spans"]] == [t for r, t in turns if r == "assistant"]


def test_templates_that_rewrite_history_are_seen():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    assert not chat.locate(turns, chat.plain_template)[2]
    last_only = lambda ts: "".join(f"<{r}>{t if i == len(ts) - 1 else '...'}" for i, (r, t) in enumerate(ts))
    assert chat.locate(turns, last_only)[2]
    counted = lambda ts: f"{len(ts)} turns:" + "".join(f"<{r}>{t}" for r, t in ts)
    assert chat.locate(turns, counted)[2]
    closed = lambda ts: "".join(f"<{r}>{t}" for r, t in ts) + "<end>"
    out, spans, rewrites = chat.locate(turns, closed)
    assert rewrites and out[spans[2][2] : spans[2][3]] == "c"


def test_chat_with_long_texts(spark):
    rows = [(1, 0, "user", "long ### text </turn>: " * 40_000), (1, 1, "assistant", "\\### " * 50_000), (2, 0, "assistant", "x" * 1_000_000)]
    got = {r["conv_id"]: r for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    for c, text in ((1, rows[1][3]), (2, rows[2][3])):
        assert got[c]["loss_chars"] == len(text) and got[c]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_chat_content_behind_markup_of_later_turns():
    """Markup that only later turns get is not content."""
    def again(ts):
        return "".join(f"<{r}>{'(again) ' if 4 <= k <= 7 else ''}{t}" for k, (r, t) in enumerate(ts))

    turns = [("ab"[k % 2], "ab"[k % 2]) for k in range(9)]
    out, spans, rewrites = chat.locate(turns, again)
    assert not rewrites and [out[a:b] for _, _, a, b in spans] == [t for _, t in turns]


def test_chat_probes_every_turn():
    def later(ts):
        return "".join(f"{r}: {'[2] ' if k > 1 else ''}{t}{'<end>' if k > 2 else ''}" for k, (r, t) in enumerate(ts))

    turns = [("user", f"text {k}") for k in range(5)]
    out, spans, rewrites = chat.locate(turns, later)
    assert not rewrites and [out[a:b] for _, _, a, b in spans] == [t for _, t in turns]


def brute_notices(t, templates=TEMPLATES):
    """(template, first, last, containment, windows): every window of every template, merged, the worse of siblings left out."""
    split = lambda x: [w for w in re.split(r"[\W_]+", x.lower()) if w]
    w = split(t or "")
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    shingles_of = {name: {tuple(v[i : i + 5]) for i in range(len(v) - 4)} for name, text in templates.items() for v in [split(text)]}
    family = licenses.families({k: {" ".join(g) for g in x} for k, x in shingles_of.items()})
    out = []
    for name, text in templates.items():
        own, places = shingles_of[name], len(split(text)) - 4
        stride = max(1, places // 5)
        window = places + stride - 1
        for a in range(0, len(grams), stride):
            share = len(own & set(grams[a : a + window])) / len(own)
            if share >= 0.8:
                last = min(len(w), a + window + 4) - 1
                if out and out[-1][0] == name and a <= out[-1][2]:
                    _, first, before, best, n = out[-1]
                    out[-1] = (name, first, max(before, last), max(best, share), n + 1)
                else:
                    out.append((name, a, last, share, 1))
    loses = lambda x, y: family[x[0]] == family[y[0]] and x[0] != y[0] and y[3] > x[3] and (min(x[2], y[2]) - max(x[1], y[1]) + 1) * 2 > x[2] - x[1] + 1
    return sorted((k, a, b, round(c, 9), n) for k, a, b, c, n in out if not any(loses((k, a, b, c, n), y) for y in out))


def test_licence_scan(spark):
    r = random.Random(8)
    filler = lambda n: " ".join("".join(r.choices("abcdef", k=4)) for _ in range(n))
    texts = [*ODD]
    for text in TEMPLATES.values():
        w = text.split()
        texts += [text, f"{filler(37)}\n{text}\n{filler(11)}", f"{filler(9)} {' '.join(w[: len(w) // 2])} {filler(5)}", " ".join(w[: len(w) // 2] + ["odd"] + w[len(w) // 2 + 1 :])]
    texts.append(" ".join([TEMPLATES["mit-notice"], filler(30)] * 40))
    texts += [f"{TEMPLATES[a]} {TEMPLATES[b]}" for a, b in (("gpl-2.0", "gpl-3.0"), ("agpl-3.0", "lgpl-2.1"), ("bsd-3-clause", "mit"))]
    table = odd(spark, texts)
    found = {}
    for x in licenses.scan_licenses(table).filter("template <> 'all-rights-reserved'").collect():
        found.setdefault(x["doc_id"], []).append((x["template"], x["first_word"], x["last_word"], round(x["containment"], 9), x["n_windows"]))
    assert {i: sorted(x) for i, x in found.items()} == {i: b for i, t in enumerate(texts) if (b := brute_notices(t))}
    assert [x[0] for x in found[texts.index(TEMPLATES["lgpl-3.0"])]] == ["lgpl-3.0"]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    by_sql = {}
    for i, name, first, last, share, n in con.sql(licenses.oracle_sql(TEMPLATES)).fetchall():
        by_sql.setdefault(i, []).append((name, first, last, round(share, 9), n))
    assert {i: sorted(x) for i, x in by_sql.items()} == {i: sorted(x) for i, x in found.items()}
    assert licenses.scan_licenses(table.limit(0)).count() == 0
    plan = licenses.scan_licenses(table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_licence_bands_retrieve_damaged_notices(spark):
    """Occurrences that hold just the required share, at any place of the windows: the bands find them all."""
    r = random.Random(11)
    word = lambda: "".join(r.choices("abcdefgh", k=6))
    texts, want = [], 0
    for name in ("mit", "bsd-3-clause", "zlib", "gpl-2.0", "apache-2.0"):
        for _ in range(60):
            w = TEMPLATES[name].split()
            for k in sorted(r.sample(range(len(w)), max(1, len(w) // 40))):
                w[k] = word()
            t = " ".join([*(word() for _ in range(r.randint(0, 90))), *w, *(word() for _ in range(r.randint(0, 90)))])
            texts.append(t)
            want += name in {x[0] for x in brute_notices(t, {name: TEMPLATES[name]})}
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    chosen = {k: TEMPLATES[k] for k in ("mit", "bsd-3-clause", "zlib", "gpl-2.0", "apache-2.0")}
    assert want > 200 and licenses.scan_licenses(table, chosen).select("doc_id").distinct().count() >= want


def test_licence_scan_finds_short_notices(spark):
    texts = ["prose of some words\nAll rights reserved.", "ALL RIGHTS RESERVED", "all rights", "rights reserved all", "a. All rights\nreserved; b c all rights reserved", "", None, "We reserve all rights", f"All rights reserved. {TEMPLATES['mit-notice']}"]
    found = {}
    for x in licenses.scan_licenses(odd(spark, texts)).filter("template = 'all-rights-reserved'").collect():
        found.setdefault(x["doc_id"], []).append((x["first_word"], x["last_word"], x["containment"], x["n_windows"]))
    want = {}
    for i, t in enumerate(texts):
        w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
        if at := [k for k in range(len(w) - 2) if w[k : k + 3] == ["all", "rights", "reserved"]]:
            want[i] = [(k, k + 2, 1.0, 1) for k in at]
    assert {i: sorted(x) for i, x in found.items()} == want and len(want) == 4
    one = licenses.scan_licenses(odd(spark, ["x Copyleft y", "copy left"]), {"word": "Copyleft", **TEMPLATES}).collect()
    assert [(x["doc_id"], x["template"], x["first_word"], x["last_word"]) for x in one] == [(0, "word", 1, 1)]
    with pytest.raises(ValueError, match="without words"):
        licenses.scan_licenses(odd(spark), {"none": "..."})


def labelled(n, seed, bad):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefghi", k=r.randint(2, 7))) for _ in range(300)]
    out = []
    for i in range(n):
        w = r.choices(words, k=r.randint(10, 200))
        if i % 4 == 0:
            for _ in range(r.randint(1, 6)):
                w[r.randrange(len(w))] = bad(r)
        out.append((" ".join(w), int(i % 4 == 0)))
    return out


def test_toxicity_learns_words_and_their_parts():
    bad = lambda r: r.choice(["idiot", "scum"]) if r.random() < 0.5 else "zloq" + "".join(r.choices("abcdefghi", k=3))
    data = labelled(400, 1, bad)
    m = toxicity.train([t for t, _ in data], [y for _, y in data], toxicity.Settings(epochs=8, gram_rows=1 << 14))
    test = labelled(200, 1, bad)[100:] + labelled(120, 1, lambda r: "zloq" + "".join(r.choices("ihgfedcba", k=4)))
    s = toxicity.Scorer(m).scores([t for t, _ in test])
    y = np.array([y for _, y in test])
    assert ((s >= 0.3) == y).mean() > 0.95
    long = " ".join(t for t, y in data if y == 0)
    before, hidden = toxicity.Scorer(m).scores([long, long + " idiot scum idiot " + long])
    assert hidden > 0.5 and hidden > before


def test_toxicity_gradients():
    s = toxicity.Settings(hidden=3, char_hidden=2, width=2, window=6, stride=4, gram_rows=64)
    m = toxicity.Model.new(s, ["bad"])
    m.words, m.grams = m.words.astype(np.float64) * 20, m.grams.astype(np.float64) * 20
    m.dense = {k: v.astype(np.float64) for k, v in m.dense.items()}
    r = np.random.default_rng(0)
    words = ["bad", "a", "words", "!!", "longerword"]
    at, n = r.integers(0, 5, (6, 3)), np.array([6, 4, 2])
    weights = np.array([1.0, -2.0, 0.5])
    grad, *sparse = m.gradients(words, at, n, lambda logit: weights)
    value = lambda: float((m.logits(m.projected("w", m.inputs(words)[0]), at, n) * weights).sum())
    for table, (rows, g) in zip((m.words, m.grams), sparse, strict=True):
        whole = np.zeros_like(table)
        np.add.at(whole, rows, g)
        grad[id(table)] = whole
    for key, x in [*m.dense.items(), (id(m.words), m.words), (id(m.grams), m.grams)]:
        for i in [tuple(r.integers(0, k) for k in x.shape) for _ in range(6)] + [np.unravel_index(np.abs(grad[key]).argmax(), x.shape)]:
            old = x[i]
            x[i] = old + 1e-5
            up = value()
            x[i] = old - 1e-5
            down = value()
            x[i] = old
            assert grad[key][i] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7), key


def slow_score(m, text):
    """The score of a text in plain loops over windows, tokens, characters and states."""
    s, d = m.settings, {k: v.tolist() for k, v in m.dense.items()}
    sig = lambda x: 1 / (1 + math.exp(-x))

    def pooled(k, xs):
        h = len(d[k + "Uf"])
        states = [[0.0] * 2 * h for _ in xs] or [[0.0] * 2 * h]
        for side, base, order in (("f", 0, range(len(xs))), ("b", h, range(len(xs) - 1, -1, -1))):
            w, u, c, prev = d[f"{k}W{side}"], d[f"{k}U{side}"], d[f"{k}c{side}"], [0.0] * h
            for t in order:
                x = [c[j] + sum(xs[t][i] * w[i][j] for i in range(len(w))) for j in range(3 * h)]
                z = [sig(x[j] + sum(prev[i] * u[i][j] for i in range(h))) for j in range(h)]
                r = [sig(x[h + j] + sum(prev[i] * u[i][h + j] for i in range(h))) for j in range(h)]
                new = [math.tanh(x[2 * h + j] + sum(r[i] * prev[i] * u[i][2 * h + j] for i in range(h))) for j in range(h)]
                prev = [(1 - z[j]) * prev[j] + z[j] * new[j] for j in range(h)]
                states[t][base : base + h] = prev
        e = [math.exp(sum(a * b for a, b in zip(x, d[k + "v"], strict=True))) for x in states]
        return [sum(a * x[j] for a, x in zip(e, states, strict=True)) / sum(e) for j in range(2 * h)]

    def gram(codes):
        mul, mask, h = [int(x) for x in toxicity._M], 0xFFFFFFFF, 0
        for c in codes:
            h = (h * mul[2] + c * mul[3] + len(codes)) & mask
        h = (h ^ (h >> 15)) * mul[1] & mask
        return (h ^ (h >> 13)) % s.gram_rows

    def token(word):
        codes = [0] * (max(toxicity.SIZES) - 2) + [2] + [ord(c) for c in word] + [3]
        first = max(toxicity.SIZES) - 1
        places = [sum((m.grams[gram(codes[t + 1 - k : t + 1])] for k in toxicity.SIZES), np.zeros(s.width)).tolist() for t in range(first, len(codes))]
        return m.words[m.known.get(word, 0)].tolist() + pooled("c", places)

    words = [token(w) for w in re.findall(r"\w{1,48}|[^\w\s]{1,48}", text.lower())]
    starts = [k for k in range(0, len(words), s.stride) if k == 0 or k + s.window - s.stride < len(words)] or [0]
    return max(sig(d["b"][0] + sum(a * b for a, b in zip(pooled("w", words[k : k + s.window]), d["o"], strict=True))) for k in starts)


def test_toxicity_scores_match_plain_loops(monkeypatch):
    s = toxicity.Settings(hidden=3, char_hidden=2, width=3, window=6, stride=4, gram_rows=128)
    m = toxicity.Model.new(s, ["you", "fool"])
    m.words, m.grams = m.words * 20, m.grams * 20
    texts = ["", " \n", "You fool, you!", "a", "é" * 100, "one two three four five six seven eight nine ten eleven", "!!! 🤬 @#$%", "fool fool fool fool fool fool fool", "x_1 -- y"]
    want = [slow_score(m, t) for t in texts]
    assert toxicity.Scorer(m).scores(texts) == pytest.approx(want, abs=1e-5)
    long = " ".join(f"w{k}" for k in range(50))
    for piece in (4, 8, 10):  # long texts in pieces
        monkeypatch.setattr(toxicity, "PIECE", piece)
        assert toxicity.Scorer(m).scores([long, *texts]) == pytest.approx([slow_score(m, long), *want], abs=1e-5)
        for n in range(4, 40):
            got = list(toxicity.Scorer(m)._pieces(" ".join(["w"] * n)))
            assert sum(len(toxicity.window_starts(len(p), 6, 4)) for p in got) == len(toxicity.window_starts(n, 6, 4))


def test_toxicity_reads_runs_and_signs():
    m = toxicity.Model.new(toxicity.Settings())
    scores = toxicity.Scorer(m).scores(["", "!!! 🤬 @#$%", "bad", "bad bad bad", "bad!"])
    assert len({round(float(x), 7) for x in scores}) == 5
    assert toxicity.tokens_of("You, YOU!! 🤬x") == ["you", ",", "you", "!!", "🤬", "x"]


def test_windows_cover_every_word():
    for n in range(300):
        seen = set()
        for a in toxicity.window_starts(n, 64, 48):
            seen |= set(range(a, min(n, a + 64)))
        assert seen == set(range(n))


def test_classifier_tables(spark):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(20)] + [(None, 1, 1), (1, None, None)], "doc_id bigint, quality int, toxic int")
    table = odd(spark)
    small = toxicity.Settings(epochs=1, gram_rows=256)
    for got in (
        toxicity.score_toxicity(table, toxicity.fit(table, labels, settings=small)), toxicity.score_toxicity(table, toxicity.fit(table, labels.limit(0), settings=small)),
        quality.fitted_scores(table, labels), quality.fitted_scores(table, labels.limit(0)),
    ):
        rows = got.collect()
        assert len(rows) == len(ODD) + 3 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_toxicity(table.limit(0), toxicity.Model.new(small)).count() == 0
    kept = toxicity.keep_below(table, toxicity.Model.new(small), 1.1)
    assert kept.columns == table.columns and kept.count() == table.count()


def test_quality_separates_junk():
    r = random.Random(9)
    word = lambda: "".join(r.choices("abcdefghijklm", k=r.randint(2, 9)))

    def text(y):
        if y:
            return ". ".join(" ".join(word() for _ in range(8)).capitalize() for _ in range(r.randint(3, 12))) + "."
        kind = r.randrange(3)
        return " ".join(word() + "&&&" for _ in range(60)) if kind == 0 else f"{word()} {word()}. " * 40 if kind == 1 else " ".join(word().upper() + "!!" for _ in range(50))

    data = [(text(y), y) for y in [1, 1, 1, 0] * 80]
    s = quality.Settings()
    terms, seen = quality.Terms(s), np.zeros(quality.Terms(s).size)
    for at, _ in terms.rows([t for t, _ in data]):
        seen[at] += 1
    packed = [(at.astype(np.uint16).tobytes(), n.astype(np.uint16).tobytes(), y) for (at, n), (_, y) in zip(terms.rows([t for t, _ in data[:200]]), data[:200], strict=True)]
    m = quality.fit(packed, len(data), seen, s)
    got = quality.vote(m, np.stack([m.vector(x) for x in terms.rows([t for t, _ in data[200:]])]))
    assert ((got >= 0.5) == np.array([y for _, y in data[200:]])).mean() > 0.97
    vectors = np.stack([m.vector(x) for x in terms.rows([t for t, _ in data[200:]])])
    assert got == pytest.approx([brute_vote(m, v) for v in vectors], abs=1e-12)
    for height in (1, 7, 64):  # equal texts get equal votes in whatever block they are
        assert (np.concatenate([quality.vote(m, vectors[k : k + height]) for k in range(0, len(vectors), height)]) == got).all()


def brute_vote(m, v):
    c = [math.fsum(a * b for a, b in zip(v.tolist(), m.vectors[:, j].tolist(), strict=True)) for j in range(m.vectors.shape[1])]
    near = sorted(range(len(c)), key=lambda j: (-c[j], j))[: m.settings.neighbours]
    w = [max(c[j], 0) ** m.settings.power + 1e-9 for j in near]
    return sum(x * float(m.labels[j]) for x, j in zip(w, near, strict=True)) / sum(w)


def test_term_rows_and_frequencies(spark):
    s = quality.Settings()
    texts = [*ODD, "word " * 70_000, "one two. One TWO!! &&&x"]
    table = odd(spark, texts)
    rows = quality.term_rows(table, s)
    got = {r["id"]: (r["n_chars"], quality.opened(r["terms"], r["counts"])) for r in rows.collect() if r["id"] is not None}
    seen = np.zeros(quality.Terms(s).size)
    for i, t in enumerate(texts):
        at, n = next(quality.Terms(s).rows([t or ""]))
        assert got[i][0] == len(t or "") and got[i][1][0].tolist() == at.tolist() and got[i][1][1].tolist() == n.tolist()
        seen[at] += 1
    for t in ("no id", "a", "a"):
        seen[next(quality.Terms(s).rows([t]))[0]] += 1
    total, found = quality.document_frequencies(rows, s)
    assert total == len(texts) + 3 and (found == seen).all()
    assert quality.document_frequencies(rows.limit(0), s)[0] == 0 and quality.score_rows(rows.limit(0), quality.fit([], 0, seen, s)).count() == 0


def test_quality_ties_go_to_the_first_of_the_sample():
    r, s = np.random.default_rng(3), quality.Settings(neighbours=5, rank=6)
    v = r.normal(size=(4, 6))
    v = quality.grained(v / np.sqrt((v * v).sum(axis=1, keepdims=True)))
    for labels in ([1, 0] * 20, [0] * 8 + [1] * 32, r.integers(0, 2, 40).tolist()):
        m = quality.Model(s, np.ones(1), np.zeros((1, 6)), np.ascontiguousarray(v[r.integers(0, 4, 40)].T), np.array(labels, dtype=np.float32))
        assert quality.vote(m, v) == pytest.approx([brute_vote(m, x) for x in v], abs=1e-12)


def test_quality_reads_long_tokens_whole():
    s = quality.Settings()
    letters, first = "a" * 64, s.word_terms + s.shape_terms

    def row(t):
        return dict(zip(*(x.tolist() for x in next(quality.Terms(s).rows([t]))), strict=True))

    def measures(t):
        return {k for k in row(t) if k >= first}

    assert measures(letters + "&" * 14_000) != measures(letters + "b" * 14_000)
    signs = first + quality.MEASURES.index("signs") * quality.BINS
    assert signs + quality.BINS - 1 in measures(letters + "&" * 14_000) and signs in measures(letters + "b" * 14_000)
    assert "".join(quality.shapes("a.b-" * 100)) == "a.a-" * 100 and quality.shapes(letters + "&" * 14_000) == ["a&&"]
    assert sum(n for k, n in row("a.b-" * 100 + " x " + "a.b-" * 100).items() if s.word_terms <= k < first) == 2 * 34 + 1


def test_document_frequencies_cover_all_rows(spark):
    s = quality.Settings()
    total, seen = quality.document_frequencies(quality.term_rows(odd(spark), s), s)
    want = np.zeros(quality.Terms(s).size)
    for at, _ in quality.Terms(s).rows([t or "" for t in [*ODD, "no id", "a", "a"]]):
        want[at] += 1
    assert total == len(ODD) + 3 and (seen == want).all()

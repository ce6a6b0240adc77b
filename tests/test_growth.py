"""What must not grow faster than its input: results on awkward shapes, and the plans or pieces of work behind them."""


import random
import re

import numpy as np

from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from winnow.functions.dom import parse
from winnow.operators import crawl, forum, html, index, rules, similarity


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_names_travel_with_their_codes(spark):
    """A page's row must not carry the names of its whole section; a code listed twice has two names."""
    listed = spark.createDataFrame([("21-clutch", "a", "A", ["21-1"]), ("21-clutch", "b", None, ["21-1", "x"]), ("21-clutch", "a", "Other", ["x"])], "section string, code string, name string, pages array<string>")
    pages = spark.createDataFrame([("21-01", "21", "Clutch"), ("x", "21", "Clutch"), ("y", "21", "Clutch")], "page_id string, section_id string, section_name string")
    met = index.with_procedures(pages, listed)
    got = {r["page_id"]: (r["procedures_covered"], r["procedures_names"]) for r in met.collect()}
    assert got == {"21-01": (["a", "b"], ["A", None]), "x": (["a", "b"], ["Other", None]), "y": ([], [])}
    assert "map" not in plan(met).lower().replace("mappartitions", "")


def test_jaccard_pairs_join_prefixes_alone(spark):
    """Against brute force; whole sets are met only by pairs whose prefixes share enough, and sets with a frequent item aren't met for it."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    sets = [["all", *rng.sample(words, rng.randint(1, 60))] for _ in range(150)]
    sets += [[*rng.sample(s, max(1, len(s) - rng.randint(0, 6))), f"x{i}"] for i, s in enumerate(sets)] + [["all"], ["all", "w1", "w2", "w3"], ["all", "w1", "w2", "w3", "w4"]]
    rows = [(i, i % 2, s) for i, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "id int, s int, words array<string>")
    for t in (0.05, 0.5, 0.8, 1.0):
        want = {(i, j): round(len(set(a) & set(b)) / len(set(a) | set(b)), 9) for i, p, a in rows for j, q, b in rows if i < j and p == q and len(set(a) & set(b)) / len(set(a) | set(b)) >= t}
        pairs = similarity.jaccard_pairs(table, t, ("s",))
        assert {(r["a"], r["b"]): round(r["similarity"], 9) for r in pairs.collect()} == want
    assert "__rest" in plan(pairs)


def test_leaders_without_pairs(spark, monkeypatch):
    """Against one row after the other, with scopes, ties, nulls and zero vectors, over several rounds; no pair is listed."""
    monkeypatch.setattr(similarity, "TURN", 7)
    monkeypatch.setattr(similarity, "HELD", 9)
    monkeypatch.setattr(similarity, "cosine_pairs", None)
    r = np.random.default_rng(8)
    rows = [(i, "ab"[i % 2], int(r.integers(0, 40)), [0.0] * 3 if i % 50 == 7 else r.normal(size=3).tolist()) for i in range(120)] + [(900, "a", 1, None), (901, None, 1, [1.0, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "id bigint, page string, ord int, embedding array<double>")
    for scope in ((), ("page",)):
        want, chosen = {900: (900, 1.0)} | ({901: (901, 1.0)} if scope else {}), []
        for i, p, _, v in sorted(rows, key=lambda x: (x[2], x[0])):
            if i in want:
                continue
            cos = lambda w: float(np.dot(v, w) / ((np.linalg.norm(v) or 1) * (np.linalg.norm(w) or 1)))  # noqa: E731, B023
            want[i] = next(((j, cos(w)) for j, q, w in chosen if (not scope or p == q) and cos(w) >= 0.8), (i, 1.0))
            if want[i][0] == i:
                chosen.append((i, p, v))
        got = {x["id"]: (x["leader"], x["similarity"]) for x in similarity.leaders(table, 0.8, scope).collect()}
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert all(abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    assert {(x["id"], x["leader"]) for x in similarity.leaders(table, 1.1).collect()} == {(x[0], x[0]) for x in rows}
    assert similarity.leaders(table.limit(0), 0.8).count() == 0


def test_equal_questions_are_compared_once(spark, monkeypatch):
    """A page of few different questions is folded however many rows it has; later ones are like what the first is like."""
    monkeypatch.setattr(rules, "diverse_by_pairs", None)
    asked = ["a b c d", "b a d c", "a b c e", "A b c d?", None, "", "x y", None, "y x"]
    table = spark.createDataFrame([(p, n, f"{p}-{n}", q) for p in ("p", None) for n, q in enumerate(asked * 30)], "page_id string, pair_ord int, qa_id string, question string")
    got, want = ({(x["page_id"], x["pair_ord"], x["similar_to"], x["similarity"]) for x in f.collect()} for f in (rules.diverse_any(table, threshold=0.6, folded=20), rules.diverse(table, threshold=0.6)))
    assert got == want and len(got) == 2 * 30 * len(asked)


def test_scopes_of_any_name(spark):
    sets = spark.createDataFrame([(1, 5, ["a", "b"]), (2, 5, ["a", "b", "c"]), (3, 6, ["a", "b", "d"])], "id int, p int, words array<string>")
    assert [tuple(x)[:3] for x in similarity.jaccard_pairs(sets, 0.6, ("p",)).collect()] == [(5, 1, 2)]


def test_levels_of_forums_stay_off_the_driver(spark):
    ids = []
    join = DataFrame.join
    try:
        DataFrame.join = lambda self, *a: ids.append(plan(out := join(self, *a))) or out
        got = crawl.flatten_forums(spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "d")], "forum_id string, parent_id string"))
    finally:
        DataFrame.join = join
    assert {tuple(x) for x in got.select("forum_id", "depth").collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", None)}
    assert ids and not any("BroadcastHashJoin" in p for p in ids)


def test_boxes_are_read_one_by_one(monkeypatch):
    """Against whole trees, on broken and nested markup too; what is remembered holds for any digits, and no row waits for the end of its page."""
    monkeypatch.setattr(html, "TRIES", 10**9)
    rng = random.Random(3)
    bits = ["<div class='b-post'>", '<div class="b-post" id="post_12">', '<div class="b-post" data-post-id="7" title="5>4">', "</div>", "</div>", "</div>", '<a class="username" href="/members/31-u">Ann 31 &amp; Co</a>', "<a href='/threads/9-x'>T9</a>", '<a href="/threads/10-x?p=2&amp;q=3">T10', "</a>", "<time>Jan 5, 2001</time>", '<img src="/i/77.jpg">', "<br/>", "<div/>", "<p>", "</p>", '<section class="author">', "</section>", "&#65;&#66", "&frac12; 12% {0}", "<h1>1</h2></h1>", "<!-- 3 <div class='b-post'> -->", "<script>if (1<2) '</div>'</script>", "<", "5 < 6", "\x00", "\U000f0000", "é٣", '<div class="author b-post"><blockquote>Q 5</blockquote></div>', '<DIV class="b-post">4</DIV>', "<td", '<b class="x', "<li class='topic-item'>"]
    part, boxes = html.Part, html.Boxes
    inner = {"by": part(".author a, .username"), "body": part("blockquote, p", markup=True), "images": part("img", every=True), "quotes": part("blockquote", inside="body", every=True)}
    read = [("", "text"), ("", "markup"), ("", "@id"), ("", "@data-post-id"), ("by", "text"), ("by", "@href"), ("body", "markup"), ("images", "@src"), ("images", "@alt"), ("quotes", "text"), None]
    remembered = 0
    for wanted in ({"posts": boxes(".b-post, [data-post-id], .author div", inner), "links": boxes("a[href*='/threads/']")}, {"page": boxes("", inner)}):
        values = {k: read if k != "links" else [("", "text"), ("", "@href"), *[None] * 9] for k in wanted}
        got: list = []
        reader = html._Reader(wanted, values, got.extend)
        for _ in range(1500):
            page = "".join(rng.choices(bits, k=rng.randint(0, 14)))
            for text in (page, re.sub("[0-9]", lambda m: str(rng.randint(0, 9)), page), None):
                root, want = parse(text), []
                for kind, w in wanted.items():
                    want += [(kind, reader.row(n, w.parts, values[kind])) for n in (root.all(w.selector) if w.selector else [root])]
                got.clear()
                reader.read(text)
                assert sorted(got, key=lambda x: x[0]) == sorted(want, key=lambda x: x[0]), text
        remembered += sum(isinstance(x, html._Layout) for x in reader.known.values())
    assert remembered > 100
    got.clear()
    sizes = []
    reader = html._Reader({"links": boxes("a[href]")}, {"links": [("", "text")]}, lambda rows: sizes.append(len(rows)))
    reader.read("".join(f"<p><a href='{i}'>x{i}</a></p><a href=\"{i}\">x</a>" for i in range(500)))
    assert sizes == [1] * 1000 and not reader.root.children


def test_threads_of_a_page_are_rows(spark, monkeypatch):
    """No page's boxes lie in one row; boxes count where one names a thread, else each thread's first link; equal pages stay two."""
    monkeypatch.setattr(forum, "elements_of", None)
    link = lambda i, t: f'<a href="/threads/{i}-x">{t}</a>'
    boxes = "".join(f'<li class="topic-item">{link(i, f"Thread {i}")}</li>' for i in range(2500))
    plain = link(1, "abc") + link(2, "First") + link(1, "Later") + link(2, "Second") + "<p>" + link(3, "Third")
    untitled = f'<li class="topic-item">{link(7, " ")}</li>' + link(8, "Eight")
    pages = spark.createDataFrame([("a", boxes + link(9999, "Not listed")), ("b", plain), ("b", plain), ("c", untitled), ("d", None)], "forum_id string, html string")
    found = forum.threads_of(pages, "https://x.org")
    got = sorted((x["forum_id"], x["thread_id"], x["title"]) for x in found.collect())
    assert got == sorted([("a", str(i), f"Thread {i}") for i in range(2500)] + [("b", "2", "First"), ("b", "3", "Third")] * 2 + [("c", "8", "Eight")])


def test_pages_are_dealt_evenly(spark):
    """Pages of one input partition are read by many tasks."""
    pages = spark.range(0, 400, 1, 1).select("id", F.concat(F.lit("<div class='pagenav'><strong>"), "id", F.lit("</strong></div>")).alias("html"))
    out = forum.pagination_of(pages, "https://x.org", keep=["id"])
    assert {x["id"] for x in out.collect()} == {x["current_page"] for x in out.collect()} == set(range(400))
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 3


def test_blocks_meet_in_strips(spark, monkeypatch):
    """Against brute force, with scopes, nulls, zero vectors and vectors without numbers; a block meets another in strips, and nothing twice."""
    monkeypatch.setattr(similarity, "STRIP", 5)
    r = np.random.default_rng(2)
    rows = [(i, "abc"[i % 3 % 2], [0.0] * 4 if i % 20 == 3 else r.normal(size=4).tolist()) for i in range(90)] + [(900, "a", None), (None, "a", [1.0] * 4), (901, "c", []), (902, "c", [])]
    table = spark.createDataFrame(rows, "id bigint, s string, embedding array<double>")
    cos = lambda v, w: float(np.dot(v, w) / ((np.linalg.norm(v) or 1) * (np.linalg.norm(w) or 1)))
    want = {(i, j) for i, p, v in rows[:90] for j, q, w in rows[:90] if i < j and p == q and cos(v, w) >= 0.4}
    got = [(x["a"], x["b"]) for x in similarity.cosine_pairs(table, 0.4, block=11, scope=("s",)).collect()]
    assert len(got) == len(set(got)) and set(got) == want

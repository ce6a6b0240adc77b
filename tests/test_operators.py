import json
import random
import struct
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.functions.dom import parse
from winnow.operators import crawl, dedup, emit, fetch, forum, generate, html, index, media, order, rules, similarity, split, stats, validate
from winnow.plans import reports, stages
from winnow.sources import config, readers, sinks

DOC = readers.QA_DOCUMENT


def pair(i, q, a, t="factual"):
    return {"id": i, "question": q, "answer": a, "question_type": t, "_warnings": None}


def docs(spark, given):
    rows = [{"page_id": p, "qa_pairs": pairs, "section_id": "s", "doc_ord": n} for n, (p, pairs) in enumerate(given)]
    return spark.createDataFrame(rows, DOC + ", doc_ord bigint")


def verdict(spark, q, a, t="factual", **changed):
    r = spark.createDataFrame([(q, a, t)], "question string, answer string, question_type string").select(rules.first_failure(rules=rules.Rules(**changed)).alias("v")).first()["v"]
    return r and (r["filter_name"], r["reason"])


GOOD = "What is the torque of the bolt?"


@pytest.mark.parametrize(
    ("q", "a", "t", "want"),
    [
        (GOOD, "x" * 10, "factual", None), (GOOD, "  " + "x" * 9 + " ", "factual", ("answer_length", "answer_too_short")), (GOOD, "x" * 500, "factual", None), (GOOD, "x" * 501, "factual", ("answer_length", "answer_too_long")),
        ("Too short now?", "x" * 20, "factual", ("question_length", "question_too_short")), ("What is the torque of the bolt", "x" * 20, "factual", ("question_format", "missing_question_mark")), (GOOD + "  ", "x" * 20, "factual", None),
        (GOOD, "It Cannot Determine, typically", "factual", ("generic_answer", "generic_answer: cannot determine")), ("What is shown In This Image?", "x" * 20, "factual", ("self_referential", "self_referential: in this image")),
        (GOOD, "x" * 20, "odd", ("question_type", "invalid_question_type: odd")), (GOOD, "x" * 20, None, None), (None, None, None, ("answer_length", "answer_too_short")),
    ],
)
def test_rules(spark, q, a, t, want):
    assert verdict(spark, q, a, t) == want


def test_no_types_switch_the_rule_off(spark):
    assert verdict(spark, GOOD, "x" * 20, "odd", question_types=()) is None


def test_diversity_is_first_wins(spark):
    r = random.Random(1)
    rows = [(f"p{p}", n, f"p{p}-{n}", " ".join(r.choices("abcdefg", k=5))) for p in range(6) for n in range(12)]
    table = spark.createDataFrame(rows, "page_id string, pair_ord int, qa_id string, question string")
    got = {x["qa_id"]: x["similar_to"] for x in rules.diverse(table, threshold=0.6).collect()}
    assert {x["qa_id"]: x["similar_to"] for x in rules.diverse_by_pairs(table, threshold=0.6).collect()} == got
    for p in range(6):
        kept = []
        for _, _, i, q in (x for x in rows if x[0] == f"p{p}"):
            w = set(q.split())
            near = next((k for k, v in kept if len(v & w) / len(v | w) >= 0.6), None)
            assert got[i] == near
            if near is None:
                kept.append((i, w))


def test_apply_rules_and_log(spark):
    same = "What is the flywheel bolt torque specification?"
    d = docs(spark, [("p1", [pair("1", same, "x" * 20), pair("2", same, "y" * 20), pair("3", same, "z"), pair("4", "What is the flywheel bolt torque value?", "v" * 20)]), ("p2", []), ("p3", [pair("5", same, "w" * 20)])])
    flat = emit.flatten_pairs(d)
    m = rules.apply_rules(flat)
    assert {r["qa_id"]: r["filter_name"] for r in m.collect()} == {"1": None, "2": "question_similarity", "3": "answer_length", "4": None, "5": None}
    assert [r["rejection_reason"] for r in rules.rejection_log(m, "t").filter("qa_id = '2'").collect()] == ["question_similarity: 1.00 with 1"]
    w = {(r["page_id"], r["warning"]) for r in rules.page_warnings(d, m.filter("filter_name is null")).collect()}
    assert ("p2", "p2: All Q&A pairs filtered out") in w and ("p1", "p1: Only 2 Q&A pairs remaining") in w and ("p3", "p3: Only 1 question type(s): factual") in w
    assert "Rejections" in reports.filter_report(m, rules.page_warnings(d, m.filter("filter_name is null")))


def test_generation_check(spark):
    f = spark.createDataFrame([("short", "x" * 9, "factual"), ("Is this a question?", "bad", "factual"), ("Is this a question", "maybe usually", "odd"), ("Is this a question?", "an answer", "too short type")], "question string, answer string, question_type string")
    got = [(r["g"]["ok"], len(r["g"]["warnings"])) for r in f.select(rules.generation_warnings().alias("g")).collect()]
    assert got == [(False, 1), (False, 1), (True, 3), (False, 1)]
    assert [r["valid"] for r in rules.route_generated(f, strict=True).collect()] == [False] * 4


def test_exact_groups_and_survivors(spark):
    rows = spark.createDataFrame([("p1", "a", "What  is it?", "short", 0, 0), ("p2", "b", "what is IT", "longer answer", 1, 0), ("p2", "c", "other", "x", 1, 1), ("p3", "d", "Other!", "x", 2, 0)], "page_id string, qa_id string, question string, answer string, doc_ord int, pair_ord int")
    g = dedup.exact_groups(rows)
    assert {r["qa_id"]: r["group_id"] for r in g.collect()} == {"a": "exact-001", "b": "exact-001", "c": "exact-002", "d": "exact-002"}
    kept, marked = dedup.deduplicate(rows)
    assert {r["qa_id"] for r in kept.collect()} == {"b", "c"}
    assert {r["qa_id"] for r in dedup.deduplicate(rows, strategy="first_seen")[0].collect()} == {"a", "c"}
    assert dedup.deduplicate(rows, cross_page=False)[0].count() == 4
    assert [r["action"] for r in dedup.duplicate_log(marked).collect()] == ["kept", "dropped"] * 2
    assert dedup.dedup_totals(rows, marked).first()["removed"] == 2
    with pytest.raises(ValueError):
        dedup.survivor_order("no")
    assert {r["qa_id"] for r in dedup.deduplicate(rows.repartition(7))[0].collect()} == {"b", "c"}


def test_semantic_groups_leave_exact_ones_out(spark):
    rows = spark.createDataFrame([("p", i, q, "a", 0, n) for n, (i, q) in enumerate([("a", "one"), ("b", "one"), ("c", "two"), ("d", "three"), ("e", "four")])], "page_id string, qa_id string, question string, answer string, doc_ord int, pair_ord int")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [1.0, 0.1]), ("d", [1.0, 0.12]), ("e", [0.0, 1.0])], "qa_id string, embedding array<double>")
    kept, marked = dedup.deduplicate(rows, vectors, threshold=0.99)
    assert {r["qa_id"]: r["match_type"] for r in marked.collect()} == {"a": "exact", "b": "exact", "c": "semantic", "d": "semantic"}
    assert {r["qa_id"] for r in kept.collect()} == {"a", "c", "e"}


def test_leaders_match_the_sequential_ones(spark):
    r = random.Random(3)
    for _ in range(3):
        n = 30
        near = {(a, b) for a in range(n) for b in range(a + 1, n) if r.random() < 0.12}
        rows = spark.createDataFrame([(i, i) for i in range(n)], "id int, ord int")
        got = {x["id"]: x["leader"] for x in similarity.lead(rows, spark.createDataFrame([(a, b, 0.9) for a, b in near], "a int, b int, similarity double")).collect()}
        want = {}
        for i in range(n):
            if i not in want:
                want[i] = i
                want |= {j: i for j in range(i + 1, n) if (i, j) in near and j not in want}
        assert got == want


def slow_leaders(near, ids):
    leader, score = {}, {}
    for i in ids:
        if i not in leader:
            leader[i], score[i] = i, 1.0
            for j in ids:
                if j > i and j not in leader and (i, j) in near:
                    leader[j], score[j] = i, near[i, j]
    return {(i, leader[i], score[i]) for i in ids}


@pytest.mark.parametrize("in_turn", [0, 10, 10_000])
def test_leaders_of_chains_stars_and_dense_graphs(spark, in_turn):
    r = random.Random(4)
    chain = {(i, i + 1): 0.9 for i in range(150 if in_turn else 12)}
    star = {(1000, 1000 + k): 0.8 for k in range(1, 30)} | {(1001, 1040): 0.7}
    dense = {(2000 + a, 2000 + b): round(r.random(), 6) for a in range(30) for b in range(a + 1, 30) if r.random() < 0.3}
    near = chain | star | dense
    ids = sorted({i for pair in near for i in pair} | {5000})
    rows = spark.createDataFrame([(i, i) for i in ids], "id bigint, ord bigint")
    pairs = spark.createDataFrame([(a, b, s) if r.random() < 0.5 else (b, a, s) for (a, b), s in near.items()], "a bigint, b bigint, similarity double")
    got = {(x["id"], x["leader"], x["similarity"]) for x in similarity.lead(rows, pairs, in_turn=in_turn).collect()}
    assert got == slow_leaders(near, ids)
    assert similarity.lead(rows.limit(0), pairs.limit(0), in_turn=in_turn).count() == 0


def test_candidate_pairs_find_what_all_pairs_show(spark):
    r = np.random.default_rng(5)
    base = r.normal(size=(60, 24))
    made = [(int(i * 10 + k), f"s{i % 2}", (base[i] + r.normal(size=24) * 0.2 * k).tolist()) for i in range(60) for k in range(6)]
    made += [(9000 + k, "s0", base[0].tolist()) for k in range(4)] + [(9100 + k, "s1", [0.0] * 24) for k in range(3)] + [(9200, "s0", None), (None, "s0", base[0].tolist())]
    table = spark.createDataFrame(made, "id bigint, page string, embedding array<double>")
    for scope in ((), ("page",)):
        pairs = lambda f, **k: {(x["a"], x["b"]): x["similarity"] for x in f(table, 0.9, scope=scope, **k).collect()}  # noqa: E731, B023
        want, got = pairs(similarity.cosine_pairs), pairs(similarity.candidate_pairs)
        assert len(want) > 150 and set(got) <= set(want) and len(got) >= 0.98 * len(want)
        assert all(got[p] == pytest.approx(want[p]) for p in got)
    assert similarity.tables_for(0.9, 0.99) == 53 and similarity.tables_for(1.0, 0.99) == 1
    assert similarity.candidate_pairs(table.limit(0), 0.9).count() == 0
    lead = similarity.leaders(table.filter("embedding is not null and id is not null").withColumn("ord", F.col("id")), 0.9, recall=0.999)
    assert lead.count() == 60 * 6 + 4 + 3


def test_pages_of_any_size_are_compared_alike(spark):
    r = random.Random(6)
    words = [f"w{k}" for k in range(12)]
    rows = spark.createDataFrame([(f"p{k % 3}" if k < 40 else "large", k, f"q{k}", " ".join(r.choices(words, k=4))) for k in range(120)], "page_id string, pair_ord bigint, qa_id string, question string")
    a, b = (sorted((x["qa_id"], x["similar_to"], x["similarity"]) for x in rules.diverse_any(rows, threshold=0.5, folded=n).collect()) for n in (1000, 20))
    assert a == b and any(x[1] for x in a)


def test_similar_groups_keep_to_their_page(spark):
    rows = spark.createDataFrame([("a", "a-1", "What is it?", "x", 0, 0), ("b", "b-1", "What was it?", "xx", 1, 0), ("b", "b-2", "What is that?", "x", 1, 1)], "page_id string, qa_id string, question string, answer string, doc_ord int, pair_ord int")
    vectors = spark.createDataFrame([("a-1", [1.0, 0.0]), ("b-1", [1.0, 0.1]), ("b-2", [1.0, 0.05])], "qa_id string, embedding array<double>")
    stay = lambda **k: sorted(r["qa_id"] for r in dedup.deduplicate(rows, vectors, **k)[0].collect())
    assert stay() == ["b-1"] and stay(cross_page=False) == ["a-1", "b-1"]
    twice = rows.unionByName(rows.filter("qa_id = 'a-1'").withColumn("qa_id", F.lit("a-2")))
    kept = lambda **k: sorted(r["qa_id"] for r in dedup.deduplicate(twice, **k)[0].collect())
    assert kept() == ["a-1", "b-1", "b-2"] and kept(exact=False) == ["a-1", "a-2", "b-1", "b-2"]


def test_pairs_of_equal_sets(spark):
    sets = spark.createDataFrame([(i, list("abcde") if i % 2 else list("abcdf")) for i in range(6)] + [(9, list("xyz")), (None, list("xyz")), (10, []), (11, None)], "id bigint, words array<string>")
    got = {(r["a"], r["b"]): round(r["similarity"], 6) for r in similarity.jaccard_pairs(sets, 0.6).collect()}
    assert got == {(i, j): 1.0 if (i - j) % 2 == 0 else round(4 / 6, 6) for i in range(6) for j in range(i + 1, 6)}
    assert [(r["a"], r["b"]) for r in similarity.jaccard_pairs(sets, 0.6, expand=False).collect()] == [(0, 1)]
    assert {(r["id"], r["rep"]) for r in similarity.class_of(sets).collect()} == {(i, i % 2) for i in range(6)} | {(9, 9)}


def test_fetching(spark):
    def turned_away(url, proxy):
        if proxy == "bad" or url == "never":
            raise OSError(f"no {proxy}")
        return url + "!"

    urls = spark.createDataFrame([("a",), ("never",), (None,)], "url string")
    got = {r["url"]: (r["html"], r["error"]) for r in fetch.fetch(urls, turned_away, 1e6, retries=2, pause=0.0, proxies=("bad", "good")).collect()}
    assert got["a"] == ("a!", None) and got["never"][0] is None and got["never"][1].startswith("OSError") and got[None] == (None, "no url")
    began = time.monotonic()
    assert fetch.fetch(spark.range(4).selectExpr("cast(id as string) as url"), lambda u, p: u, 10.0).count() == 4 and time.monotonic() - began >= 0.3
    pages = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "")], "url string, next_url string")
    walk = {(r["start"], r["n"], r["url"]) for r in fetch.follow(pages.filter("url in ('a', 'x')"), lambda u: u.join(pages, "url")).collect()}
    assert walk == {("a", 1, "a"), ("a", 2, "b"), ("a", 3, "c"), ("x", 1, "x")}
    assert fetch.follow(pages.filter("url = 'a'"), lambda u: u.join(pages, "url"), most=2).count() == 2


def test_pair_joins_match_brute_force(spark):
    r = random.Random(5)
    sets = [(i, "ab"[i % 2], r.sample("abcdefgh", r.randint(0, 6))) for i in range(60)]
    got = {(x["a"], x["b"]) for x in similarity.jaccard_pairs(spark.createDataFrame(sets, "id int, s string, words array<string>"), 0.5, ("s",)).collect()}
    assert got == {(a, b) for a, s, x in sets for b, t, y in sets if a < b and s == t and x and y and len({*x} & {*y}) >= 0.5 * len({*x} | {*y})}
    vectors = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(50)] + [(50, [0.0] * 4), (51, None)]
    got = {(x["a"], x["b"]) for x in similarity.cosine_pairs(spark.createDataFrame(vectors, "id int, embedding array<double>"), 0.6, block=9).collect()}
    cos = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True)) / ((sum(p * p for p in x) * sum(q * q for q in y)) ** 0.5 or 1)
    assert got == {(a, b) for a, x in vectors[:51] for b, y in vectors[:51] if a < b and cos(x, y) >= 0.6}


def test_splits(spark):
    rows = spark.createDataFrame([(f"q{i}", "A" if i < 50 else "B") for i in range(100)] + [("one", "C"), ("none", None)], "qa_id string, section_id string")
    got = split.stratified_split(rows, 0.9).groupBy(F.coalesce("section_id", F.lit("unknown")).alias("s"), "split").count().collect()
    assert {(r["s"], r["split"]): r["count"] for r in got} == {("A", "train"): 45, ("A", "val"): 5, ("B", "train"): 45, ("B", "val"): 5, ("C", "val"): 1, ("unknown", "val"): 1}
    all_ = rows.limit(100)
    assert split.stratified_split(all_, 0.8, by=None).filter("split = 'train'").count() == 80
    again = lambda n: {r["qa_id"] for r in split.stratified_split(rows.repartition(n), 0.9).filter("split = 'val'").collect()}
    assert again(2) == again(9)
    assert split.stratified_split(rows.limit(0)).count() == 0
    assert split.sample(rows, 5).count() == 5 and split.sample(rows, 500).count() == 102
    with pytest.raises(ValueError):
        split.stratified_split(rows, 1.5)


def test_budget_and_slices(spark):
    rows = spark.createDataFrame([(i, f"p{i}", 4.0) for i in range(5)], "ord int, page_id string, cost double")
    assert [r["status"] for r in split.within_budget(rows, 10.0).orderBy("ord").collect()] == ["done", "done", "crossing", "not_run", "not_run"]
    assert {r["status"] for r in split.within_budget(rows, None).collect()} == {"done"}
    assert [r["page_id"] for r in split.page_slice(rows, 3, "p1").orderBy("ord").collect()] == ["p1", "p2"]
    assert split.page_slice(rows, 3, "unknown").count() == 3


def test_order_over_the_whole_table(spark):
    r = random.Random(7)
    values = list(range(500))
    r.shuffle(values)
    rows = spark.createDataFrame([(v, float(v % 7)) for v in values], "v int, c double").repartition(9)
    assert {x["v"]: x["rank"] for x in order.with_rank(rows, ["v"]).collect()} == {v: v + 1 for v in values}
    assert {x["v"]: x["spent"] for x in order.with_sum_before(rows, ["v"], "c").collect()} == {v: sum(float(u % 7) for u in range(v)) for v in values}
    assert order.with_rank(rows.limit(0), ["v"]).count() == 0


def test_length_stats(spark):
    f = lambda n: spark.createDataFrame([("x" * i,) for i in n], "answer string")
    assert tuple(stats.length_stats(f([1, 2, 3, 4])).first()) == (1, 4, 2.5, 3)
    assert tuple(stats.length_stats(f([])).first()) == (0, 0, 0.0, 0)


def test_validation(spark):
    raws = ['{"image": null, "conversations": [{"role": "user", "content": "short"}, {"role": "assistant", "content": "ok"}], "metadata": {}}', '{"conversations": "x"}', '{"image": 1, "conversations": [1, {"role": "system", "content": ""}], "metadata": 1}', '{"image": 1, "metadata": 1, "conversations": []}']
    rows = spark.createDataFrame([("train", i, r) for i, r in enumerate(raws)], "split string, ordinal int, raw string")
    v, messages = stages.check_records(rows)
    by = {}
    for r in messages.collect():
        by.setdefault(r["ordinal"], set()).add(r["message"].split(": ", 1)[1])
    assert by[0] == {"Question too short (5 chars)", "Answer too short (2 chars)"}
    assert {"Missing 'image' field", "Missing 'metadata' field", "'conversations' must be a list", "Empty conversations list"} <= by[1]
    assert {"Conversation 0 is not a dict", "Invalid role 'system' at conversation 1"} <= by[2]
    assert by[3] == {"Empty conversations list"}
    assert v.first()["passed"] is False


def png(w, h):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0) + struct.pack(">I", zlib.crc32(b""))


def test_images(spark):
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 50, 200) + b"\x01" * 9
    assert validate.image_size(png(120, 130)) == (120, 130) and validate.image_size(jpeg) == (200, 50) and validate.image_size(b"nothing") is None
    files = spark.createDataFrame([("a.png", png(120, 130)), ("b.jpg", jpeg), ("c.png", b""), ("d.png", b"xx")], "path string, content binary")
    sizes = validate.with_image_size(files)
    recs = spark.createDataFrame([("a.png",), ("b.jpg",), ("d.png",), ("no.png",), (None,)], "image string")
    got = {r["image"]: (r["image_error"], r["image_warning"]) for r in validate.image_findings(recs, sizes).collect()}
    assert got == {"a.png": (None, None), "b.jpg": (None, "Image too small: 200x50"), "d.png": ("Image not readable: d.png", None), "no.png": ("Image not found: no.png", None), None: (None, None)}
    assert {r["path"]: r["ok"] for r in media.validate_images(files).collect()} == {"a.png": True, "b.jpg": True, "c.png": False, "d.png": False}
    pages = media.fan_out_pdfs(files.limit(2), lambda c: [b"1", b"2"] if c[:1] == b"\x89" else 1 / 0)
    assert sorted((r["path"], r["page"]) for r in pages.collect() if r["error"] is None) == [("a.png", 1), ("a.png", 2)]
    assert media.fit_image(png(9000, 10), lambda d, side, q: b"x" * q * 100_000) == b"x" * 4_500_000


def test_index_merge(spark):
    e = [("s", 1, "11", "Engine", "", None), ("s", 2, "11", "Motor", "21-1", None), ("s", 3, "11", "", "", None), ("s", 4, "", "x", "1", None), ("s", 5, "12", "Clutch", "21-1", None), ("s", 6, "13", "Bad", "1", "err")]
    entries = spark.createDataFrame(e, "section string, ord int, code string, name string, page string, error string")
    got = {r["code"]: (r["name"], r["pages"], r["warnings"]) for r in index.merge_procedures(entries).collect()}
    assert got == {"11": ("Engine", ["", "21-1"], ["Code 11: name mismatch 'Engine' vs 'Motor'"]), "12": ("Clutch", ["21-1"], [])}
    full = entries.withColumns({"section_id": F.lit("21"), "section_name": F.lit("C"), "source_filename": F.lit("f.jpg")})
    r = index.merge_sections(full).first()
    assert r["page_to_procedures"] == {"": ["11"], "21-1": ["11", "12"]} and r["index_pages"] == ["f.jpg"] and [p["code"] for p in r["procedures"]] == ["11", "12"]
    pages = spark.createDataFrame([("21-01", "21", "Clutch"), ("99", "21", "Clutch")], "page_id string, section_id string, section_name string")
    met = index.with_procedures(pages, index.merge_procedures(entries.withColumn("section", F.lit("21-clutch"))))
    assert {r["page_id"]: (r["procedures_covered"], r["procedures_names"]) for r in met.collect()} == {"21-01": (["11", "12"], ["Engine", "Clutch"]), "99": ([], [])}


def test_generation(spark):
    pages = spark.createDataFrame([("21-00-index-a.jpg",), ("21-01.jpg",), ("bad.jpg",)], "filename string")
    say = lambda asked: ['{"content_type": "procedure", "confidence": 0.8}' if a["filename"] == "21-01.jpg" else "what?" for a in asked]
    got = {r["filename"]: (r["content_type"], r["confidence"], r["needs_review"]) for r in generate.classify(pages, say).collect()}
    assert got == {"21-00-index-a.jpg": ("index", 0.95, False), "21-01.jpg": ("procedure", 0.8, False), "bad.jpg": ("unknown", 0.3, True)}
    assert generate.classify(pages, None).filter("confidence = 0.0").count() == 2

    def fails(asked):
        raise OSError("down")

    assert generate.call(pages, ["filename"], fails, retries=1, pause=0.0).filter("answer is null").count() == 3
    short = generate.call(pages, ["filename"], lambda asked: ["x"] * (len(asked) + 1), retries=0)
    assert short.filter("answer is null and error like '%answers to%'").count() == 3
    answers = spark.createDataFrame([("p", '[{"question": "a?", "answer": "b", "question_type": "factual"}, {"question": "c?", "answer": "d", "question_type": "tool"}]'), ("x", "none")], "page_id string, answer string")
    assert [(r["qa_id"], r["answer"]) for r in generate.parse_answers(answers).orderBy("qa_id").collect()] == [("p-q01", "b"), ("p-q02", "d")]
    one = spark.createDataFrame([("procedure", ["1", "2"], ["A", "B"]), ("specification", [], []), ("text", [], [])], "t string, c array<string>, n array<string>")
    blocks = [r[0] for r in one.select(generate.context_block("t", "c", "n")).collect()]
    assert blocks[0].endswith("- 1: A\n- 2: B") and blocks[1].startswith("Read the values") and blocks[2] == ""
    assert [r[0] for r in one.select(generate.questions_for("t")).collect()] == [12, 10, 6]
    p = one.select(generate.prompt(F.lit("service_manual"), "t", F.lit("Clutch"), F.lit(3), F.lit("ctx"))).first()[0]
    assert "3 question" in p and "Clutch" in p and p.endswith("ctx")
    assert one.select(generate.cost_text(generate.cost(F.lit(2000), F.lit(800)))).first()[0] == "0.0180"
    assert generate.embed(pages, "filename", lambda t: [[float(len(x))] for x in t], "filename").count() == 3
    assert generate.embed(pages, "filename", None, "filename").count() == 0

    def breaks_once(texts):
        if any("b" in t for t in texts):
            raise OSError("out of memory")
        return [[1.0] for _ in texts]

    with pytest.warns(UserWarning, match="out of memory"):
        assert generate.embed(spark.createDataFrame([("a",), ("b",), ("c",)], "filename string"), "filename", breaks_once, "filename", batch=1).count() == 0


SPEC = """<table><tr><th>Category</th><th>Spec</th><th>Value</th></tr><tr><td>Engine</td><td>Displacement</td><td>2302</td><td>cc</td></tr><tr><td>Engine</td><td>Empty</td><td> </td></tr>
<tr><td>x</td></tr></table><table><tr><td>Weight</td><td>1200 <b>kg</b></td></tr><tr><td>Item</td><td>skip</td></tr></table><table><tr><td>lone</td><td>row</td></tr></table>"""


def test_spec_tables(spark):
    assert html.spec_rows(SPEC) == [{"category": "Engine", "spec_name": "Displacement", "spec_value": "2302 cc"}, {"category": "", "spec_name": "Weight", "spec_value": "1200kg"}]
    assert html.spec_rows(None) == [] and html.spec_rows("<table><tr") == []
    d = html.html_documents(spark.createDataFrame([("x/M3-techspec.html", SPEC)], "path string, html string"), "Test Car").first()
    assert d["page_id"] == "html-m3-techspec" and d["model_detected"] == "M3" and [p["id"] for p in d["qa_pairs"]] == [f"html-m3-techspec-q{i:02d}" for i in range(1, 6)]
    assert d["qa_pairs"][1]["answer"] == "The displacement for the Test Car M3 is 2302 cc."


FORUM = """<html><head><link rel="next" href="/forum/5-general/page3"><link rel="prev" href="/forum/5-general"></head><body>
<div class="b-channel__title"><a href="/forum/7-sub">Sub</a></div><div class="b-channel__title"><a href="/forum/7-sub">Again</a></div>
<ul><li class="topic-item sticky"><a class="topic-title" href="/forum/5-general/123456-first">First  thread</a><span class="username">Ann</span><span class="posts-count">1,234</span><span class="reply-count">5 replies</span></li>
<li class="topic-item"><a class="topic-title" href="/forum/5-general/9-x"></a></li></ul>
<div class="pagenav"><a href="?page=9">9</a><span class="current">2</span></div></body></html>"""
THREAD = """<article class="post" data-post-id="77"><span class="username">Bob</span><time datetime="2020-01-01T00:00:00">x</time><div class="post-content">Hi <img src="/a.jpg"><img src="/smilies/x.png"><blockquote>quoted</blockquote></div></article>"""


def forum_rows(spark, parse, text, **more):
    """What a parser of pages makes of one page."""
    page = spark.createDataFrame([{"html": text, **more}], "html string" + "".join(f", {k} string" for k in more))
    return [r.asDict(recursive=True) for r in parse(page, "https://x.org/").collect()]


def test_forum_pages(spark):
    assert [(r["forum_id"], r["title"], r["parent_id"]) for r in forum_rows(spark, forum.subforums_of, FORUM, forum_id="5")] == [("7", "Sub", "5")]
    (t,) = forum_rows(spark, forum.threads_of, FORUM, forum_id="5")
    assert (t["thread_id"], t["title"], t["author"], t["is_sticky"], t["reply_count"], t["forum_id"]) == ("5", "First thread", "Ann", True, 0, "5")
    (p,) = forum_rows(spark, forum.pagination_of, FORUM)
    assert p == {"current_page": 2, "total_pages": 9, "has_next": True, "has_prev": True, "next_url": "https://x.org/forum/5-general/page3", "prev_url": "https://x.org/forum/5-general"}
    (post,) = forum_rows(spark, forum.posts_of, THREAD, thread_id="9")
    assert post["post_id"] == "77" and post["images"] == ["https://x.org/a.jpg"] and post["quotes"] == ["quoted"] and post["created_at"] == "2020-01-01T00:00:00" and post["is_first_post"]
    assert post["content_html"] == '<div class="post-content">Hi <img src="/a.jpg"/><img src="/smilies/x.png"/><blockquote>quoted</blockquote></div>'
    assert forum_rows(spark, forum.forums_of, "<div><a href='/forum/3-a'> </a><a href='/forum/3-a'>Late</a><a href='/forum/b'>B</a></div>") == [{"forum_id": "b", "title": "B", "url": "https://x.org/forum/b", "description": "", "parent_id": None}]
    assert [r["thread_id"] for r in forum_rows(spark, forum.threads_of, "<a href='/threads/12-abcd'>Long title</a><a href='/threads/13-x'>abc</a><a href='/threads/12-abcd'>Again</a>", forum_id="1")] == ["12"]
    pages = spark.createDataFrame([(1, FORUM, "5"), (2, None, "6"), (3, "<li class='topic-item'", "7")], "n int, html string, forum_id string")
    assert forum.threads_of(pages, "https://x.org", keep=["n"]).count() == 1
    assert forum.pagination_of(pages, "https://x.org", keep=["n"]).count() == 3
    assert forum.posts_of(pages.select("n", F.lit(THREAD).alias("html"), F.lit("9").alias("thread_id")), "https://x.org").count() == 3


def test_forum_fallbacks(spark):
    posts = forum_rows(spark, forum.posts_of, "<div class='b-post' id='post_8'><p class='date'> Jan 5, 2001 </p></div><div class='b-post'><i id='post12'></i></div><div class='b-post'><span class='date'>long ago</span></div>", thread_id="t")
    assert [(p["post_id"], p["created_at"], p["post_number"]) for p in posts] == [("8", "2001-01-05T00:00:00", 1), ("12", "", 2), ("t_2", "long ago", 3)]
    for text, want in (
        ("<div class='pager'><input name='page' value='3'><a href='x'>2</a><a href='x'>7</a><span class='last'><a href='/f?page=11'>end</a></span></div>", (3, 11, True, False, "", "")),
        ("<div class='pager'><input name='page'><a class='prev' href='/p1'>1</a></div>", (1, 1, False, True, "", "https://x.org/p1")),
        ("<link rel='next' href='/f/page4'><p>none</p>", (3, 4, True, False, "https://x.org/f/page4", "")),
        ("<div class='pager'><a class='next h-disabled' href='/n'>n</a><strong>x</strong></div>", (1, 1, False, False, "", "")),
        ("", (1, 1, False, False, "", "")),
    ):
        (p,) = forum_rows(spark, forum.pagination_of, text)
        assert tuple(p[k] for k in ("current_page", "total_pages", "has_next", "has_prev", "next_url", "prev_url")) == want, text


def test_dom():
    root = parse("<div class='a b'><p id=x>one<br>two</div><p>three")
    assert root.first("p").text() == "onetwo" and [n.text() for n in root.all("div p, p")] == ["onetwo", "three"]
    assert root.first(".b").get("class") == "a b" and root.first("[id='x']") is not None and root.first("p:not(.c)") is not None


def test_dom_writes_what_it_read():
    text = "<div title='a\"b'><b>&lt;i&gt; &amp; x</b><br><p class=\"c d\">1 &lt; 2</p><script>if (a < b) {}</script></div>"
    once = parse(text).first("div").html()
    assert once == "<div title='a\"b'><b>&lt;i&gt; &amp; x</b><br/><p class=\"c d\">1 &lt; 2</p><script>if (a < b) {}</script></div>"
    assert parse(once).first("div").html() == once
    deep = "<p><i>" * 30_000 + "x"
    assert parse(deep).first("p").html().count("<i>") == 30_000 and parse(deep).first("p").text() == "x"


def test_crawl(spark):
    forums = spark.createDataFrame([("1", None, "u1"), ("2", "1", "u2"), ("3", "2", "u3")], "forum_id string, parent_id string, url string")
    assert {r["forum_id"]: (r["depth"], r["root_id"]) for r in crawl.flatten_forums(forums).collect()} == {"1": (0, "1"), "2": (1, "1"), "3": (2, "1")}
    deep = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(9)] + [("a", "b"), ("b", "a"), ("c", "a"), ("d", "gone"), ("e", None)], "forum_id string, parent_id string")
    want = {str(i): (i, "0") for i in range(9)} | dict.fromkeys("abcd", (None, None)) | {"e": (0, "e")}
    assert {r["forum_id"]: (r["depth"], r["root_id"]) for r in crawl.flatten_forums(deep).collect()} == want
    assert crawl.flatten_forums(deep.limit(0)).count() == 0
    assert {r["url"] for r in crawl.forum_urls(spark.createDataFrame([("2",), ("9",)], "forum_id string"), forums, "b").collect()} == {"u2", "b/forum/9"}
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("b", "a")], "src string, dst string")
    assert {r["url"]: r["depth"] for r in crawl.reachable(spark.createDataFrame([("a",)], "url string"), links, 3).collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}
    posts = spark.createDataFrame([("p1", "t", "f", "x", 1, ["u1", "u2"]), ("p2", "t", "f", "x", 2, ["u1"])], "post_id string, thread_id string, forum_id string, file string, line int, images array<string>")
    images = crawl.distinct_images(posts)
    assert {(r["url"], r["post_id"]) for r in images.collect()} == {("u1", "p1"), ("u2", "p1")}
    m = crawl.image_manifest(images, spark.createDataFrame([("u1", "/x")], "url string, local_path string"))
    assert tuple(crawl.manifest_totals(m).first()) == (2, 1, 1)


def test_whole_pipeline_and_files(spark, tmp_path):
    given = [("21-03_clutch", [pair("21-03_clutch-q01", "What is the torque of the bolt?", "It is 25 Nm for all."), pair("21-03_clutch-q02", "what is the Torque of the bolt", "It is 25 Nm.")]), ("b", [pair("b-q01", "How is the clutch removed here?", "Remove the gearbox first.", "procedural")])]
    folder = tmp_path / "qa"
    folder.mkdir()
    for p, pairs in given:
        (folder / f"{p}.json").write_text(json.dumps({"page_id": p, "section_id": "21", "qa_pairs": pairs}))
    (folder / "broken.json").write_text("{")
    read = readers.read_documents(spark, str(folder)).filter("page_id is not null")
    assert read.count() == 2
    done = stages.quality_control(read, rules.Rules(question_mark=False))
    assert {r["qa_id"] for r in done.rows.collect()} == {"21-03_clutch-q01", "b-q01"}
    assert {r["page_id"]: len(r["qa_pairs"]) for r in done.docs.collect()} == {"21-03_clutch": 1, "b": 1}
    records = stages.finalize(done.rows)
    n = sinks.write_jsonl(records.drop("split"), str(tmp_path / "out"))
    assert n == 2 and readers.count_jsonl(spark, str(tmp_path / "out")) == 2
    back = readers.read_jsonl(spark, str(tmp_path / "out"))
    assert back.count() == 2 and stages.check_records(back.withColumn("split", F.lit("train")))[0].first()["n_errors"] == 0
    rows = split.stratified_split(done.rows)
    assert "train" in reports.dataset_card("d", rows) and "Sections" in reports.validation_report(stages.check_records(back.withColumn("split", F.lit("train")))[0], stages.check_records(back.withColumn("split", F.lit("train")))[1], rows)
    assert stages.describe(rows)["images"].first()["text_only"] == 2
    with pytest.raises(FileNotFoundError):
        readers.read_documents(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    assert readers.read_documents(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(ValueError):
        readers.read_documents(spark, str(tmp_path / "empty"), strict=True)
    (tmp_path / "bad.jsonl").write_text('{"image": null}\n\nnot json\n')
    with pytest.raises(Exception, match="line 3 is not JSON"):
        readers.read_jsonl(spark, str(tmp_path / "bad.jsonl")).collect()


def test_inventory(spark, tmp_path):
    for name in ("21 - Clutch/21-01.JPG", "21 - Clutch/a.pdf", "x.html", "notes.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"<table>" if name.endswith("html") else b"1")
    got = [tuple(r) for r in readers.scan_inventory(spark, str(tmp_path)).collect()]
    assert got == [("21 - Clutch/21-01.JPG", "jpg", "21 - Clutch", "21-01.JPG", "false"), ("21 - Clutch/a.pdf", "pdf", "21 - Clutch", "a.pdf", "true"), ("x.html", "html", "", "x.html", "false")]
    assert readers.scan_inventory(spark, str(tmp_path), "21 - Clutch").count() == 2
    sinks.write_csv(readers.scan_inventory(spark, str(tmp_path)), str(tmp_path / "inv"))
    assert readers.read_image_rows(spark, str(tmp_path / "inv")).count() == 1
    assert readers.read_html(spark, str(tmp_path)).count() == 1
    assert stats.inventory_summary(readers.read_csv(spark, str(tmp_path / "inv"), readers.INVENTORY)).count() == 3
    with pytest.raises(FileNotFoundError):
        readers.scan_inventory(spark, str(tmp_path / "no"))


def test_emit(spark, tmp_path):
    paths = spark.createDataFrame([("a/x.jpg",), ("data_src/b.jpg",), ("gone/c.jpg",), ("nowhere.jpg",)], "image_path string")
    files = spark.createDataFrame([("a/x.jpg",), ("b.jpg",), ("z/c.jpg",), ("y/c.jpg",)], "path string")
    assert {r["image_path"]: r["source"] for r in emit.resolve_images(paths, files).collect()} == {"a/x.jpg": "a/x.jpg", "data_src/b.jpg": "b.jpg", "gone/c.jpg": "y/c.jpg", "nowhere.jpg": None}
    assert emit.name_collisions(spark.createDataFrame([("a/b.jpg",), ("a_b.jpg",)], "image_path string")).first()["n"] == 2
    src = tmp_path / "s.jpg"
    src.write_bytes(b"1")
    images = spark.createDataFrame([(str(src), "images/s.jpg"), ("/no", "images/n.jpg")], "source string, image string")
    assert sorted(r["status"] for r in sinks.materialise_images(images, str(tmp_path / "out"), "copy").collect()) == ["made", "missing"]


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("filters: {min_answer_length: 3, valid_question_types: [a]}\noutput: {train_split: 0.8, stratify_by: none}\n")
    raw = config.read_yaml(str(tmp_path / "c.yaml"))
    assert config.stage_settings(raw, "filters").min_answer == 3 and config.stage_settings(raw, "filters").question_types == ("a",)
    assert config.stage_settings(raw, "output").stratify_by is None and config.stage_settings({}, "deduplication").threshold == 0.9
    for stage, bad in (("output", {"train_split": 2}), ("output", {"image_copy_mode": "x"}), ("deduplication", {"prefer_strategy": "x"})):
        with pytest.raises(ValueError):
            config.stage_settings({stage: bad}, stage)
    assert config.layered({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}, "d": 4}) == {"a": {"b": 3, "c": 2}, "d": 4}
    assert sinks.token_of(None, {"HF_TOKEN": "x"}) == "x" and sinks.token_of("y", {}) == "y" and sinks.token_of(None, {}) is None

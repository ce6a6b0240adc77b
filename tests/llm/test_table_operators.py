"""Operators that compare or arrange documents, against brute force."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from winnow.llm import exact_dedup, jaccard, packing, queries, toxicity
from winnow.llm.common import maybe_among
from winnow.llm.components import _joined, components

from ..oracle import same, views

SCHEMA = "doc_id bigint, text string, size bigint, node string, kept string"
ODD = [None, "", " ", "a", "a b", "one two three four five", "é" * 9]


def table(spark, rows):
    """(id, text) rows beside columns with names that the operators use themselves."""
    return spark.createDataFrame([(i, t, 5, "n", "k") for i, t in rows], SCHEMA)


def test_exact_groups(spark):
    rows = [(i, t) for i, t in enumerate(ODD * 3)] + [(4, "a b"), (4, "a b"), (100, "only"), (None, "a"), (7, "other text, same id")]
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    for keep, best in (("min", min), ("max", max)):
        got = exact_dedup.exact_groups(table(spark, rows).repartition(5), keep=keep).collect()
        want = set()
        for i, t in rows:
            own = groups[t or ""]
            k = best(x for x in own if x is not None)
            want.add((i, k, len(own), i == k, hashlib.sha256((t or "").encode()).hexdigest()))
        assert len(got) == len(want) and {tuple(r) for r in got} == want
        kept = exact_dedup.exact_dedup(table(spark, rows), keep=keep)
        assert kept.columns == table(spark, rows).columns
        assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == sorted((w[1], t) for t in groups for w in [next(x for x in want if x[4] == hashlib.sha256(t.encode()).hexdigest())])
    assert exact_dedup.exact_groups(table(spark, [])).count() == 0 and exact_dedup.exact_dedup(table(spark, [])).count() == 0


def test_colliding_hashes_do_not_merge_texts(spark):
    rows = [(1, "x"), (2, "y"), (3, "x"), (4, "z")]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(table(spark, rows), content_hash=lambda t: F.lit("same")).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1)}


def test_bitmap_keeps_all_that_are_among_the_keys(spark):
    rows = spark.range(2000).withColumn("k", F.md5(F.col("id").cast("string")))
    keys = rows.filter("id % 50 = 0").select("k")
    for most in (40, 40_000):
        got = {r["id"] for r in maybe_among(rows, "k", keys, most).collect()}
        assert set(range(0, 2000, 50)) <= got and len(got) < 300
    assert maybe_among(rows, "k", keys.limit(0), 0).count() == 0


def near_texts(seed, n=120):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghij", k=5))
    out = []
    while len(out) < n:
        base = [word() for _ in range(r.choice([3, 5, 8, 40, 120]))]
        for _ in range(r.choice([1, 1, 1, 2, 6, 15])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                w[r.randrange(len(w))] = word()
            out.append(" ".join(w).upper() if r.random() < 0.2 else "  ".join(w))
    return out


def brute_classes(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    n = len(rows)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for a in range(n):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if (not sets[a] and not sets[b]) or (i and i >= threshold * len(sets[a] | sets[b])):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    members = collections.defaultdict(list)
    for k in range(n):
        members[find(k)].append(rows[k][0])
    return sorted((rows[k][0], min(members[find(k)]), len(members[find(k)]), links[k], len(sets[k])) for k in range(n))


@pytest.mark.parametrize(("unit_nodes", "block"), [(400, 200), (1, 3), (10, 4)])
def test_jaccard_classes(spark, unit_nodes, block):
    rows = list(enumerate([*near_texts(unit_nodes), *ODD, *ODD])) + [(3, "one two three four five six"), (3, "one two three four five six")]
    got = jaccard.jaccard_classes(table(spark, rows).repartition(6), unit_nodes=unit_nodes, block=block).collect()
    assert sorted(map(tuple, got)) == brute_classes(rows)


def test_classes_of_drifting_texts(spark):
    """Each text is near the next ones only, so that a class is a chain."""
    r = random.Random(21)
    word = lambda: "".join(r.choices("abcdefghij", k=6))
    rows = []
    for k in range(4):
        words = [word() for _ in range(60)]
        for step in range(30):
            rows.append((1000 * k + step, " ".join(words)))
            words = words[r.choice([1, 2, 7]) :]
            words += [word() for _ in range(60 - len(words))]
    want = brute_classes(rows)
    assert len({x[1] for x in want}) > 8
    for unit_nodes, block in ((400, 200), (1, 4)):
        got = jaccard.jaccard_classes(table(spark, rows), unit_nodes=unit_nodes, block=block).collect()
        assert sorted(map(tuple, got)) == want


def test_jaccard_odd_tables(spark):
    assert jaccard.jaccard_classes(table(spark, [])).count() == 0
    got = {tuple(r) for r in jaccard.jaccard_classes(table(spark, [(None, "a b c"), (1, "a b c"), (2, "a b c")])).collect()}
    assert got == {(None, None, 1, 0, 1), (1, 1, 2, 1, 1), (2, 1, 2, 1, 1)}
    kept = jaccard.one_of_each_class(table(spark, [(None, "a b c"), (1, "a b c"), (2, "a b c"), (3, "x y")]))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "None"] and kept.columns == table(spark, []).columns


def test_bands_reach_the_recall():
    n = jaccard.bands_for(0.8, jaccard.ROWS, jaccard.RECALL)
    assert 1 - (1 - 0.8**jaccard.ROWS) ** n >= jaccard.RECALL > 1 - (1 - 0.8**jaccard.ROWS) ** (n - 1)
    s = jaccard.Shingler(5, n, jaccard.ROWS)
    r = np.random.default_rng(0)
    found = 0
    for _ in range(300):
        pool = np.unique(r.integers(0, 1 << 63, 100, dtype=np.uint64))
        found += (s.band_hashes(pool[:90]) == s.band_hashes(pool[10:])).any()
    assert found == 300


def test_similar_by_products_and_by_pairs():
    from fractions import Fraction

    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 30, 20).astype(np.uint64)) for _ in range(40)]
    want = np.array([[i < j and 10 * len({*a} & {*b}) >= 6 * len({*a} | {*b}) for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    assert (jaccard.similar(sets, np.ones((40, 40), bool), Fraction("0.6")) == want).all()
    few = np.zeros((40, 40), bool)
    few[3, 7] = few[8, 9] = True
    assert (jaccard.similar(sets, few, Fraction("0.6")) == (want & few)).all()


def test_components(spark):
    r = random.Random(2)
    for n, m in ((60, 30), (200, 190)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, k) for k in range(2001, 2060)]
        root = {}

        def find(x, root=root):
            root.setdefault(x, x)
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            if a != b:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
        for in_task in (0, 10_000):
            got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a bigint, b bigint"), in_task=in_task).collect()}
            assert got == {x: find(x) for x in root}
        rounds = [e for e in edges if e[0] != e[1]]
        r.shuffle(rounds)
        joined = _joined(pa.table({"a": [a for a, _ in rounds], "b": [b for _, b in rounds]}))
        assert {b: a for a, b in zip(*(c.to_pylist() for c in joined.columns), strict=True)} == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_best_fit_bins_hold_their_contents():
    r = random.Random(3)
    for _ in range(50):
        caps = sorted(r.sample([16, 32, 64, 128, 256], r.randint(1, 4)))
        sizes = [r.randint(0, caps[-1]) for _ in range(r.randint(0, 80))]
        placed, own = packing.best_fit(sizes, caps)
        held = np.bincount(placed, weights=sizes, minlength=len(own)) if sizes else np.zeros(0)
        assert (held <= own).all() and set(own.tolist()) <= set(caps) and set(placed.tolist()) == set(range(len(own)))
        assert all(c == next(x for x in caps if x >= h) for c, h in zip(own.tolist(), held.tolist(), strict=True))


def test_best_fit_is_best_fit():
    placed, own = packing.best_fit([70, 60, 40, 30], [100])
    assert placed.tolist() == [0, 1, 1, 0] and own.tolist() == [100, 100]
    assert packing.best_fit([10], [16, 1024])[1].tolist() == [16]
    few = packing.best_fit([100] * 10, [128, 1024])[1]
    assert few.tolist() == [1024]


def slow_best_fit(sizes, capacities, cost):
    """Best fit in plain loops: contents of the bins, as sorted lists of sizes with the bin's capacity."""
    rest, bins = sorted(sizes, reverse=True), []
    while rest:
        n = rest.pop(0)
        open_ = [b for b in bins if b[0] - sum(b[1]) >= n and b[0] > sum(b[1])]
        if open_:
            min(open_, key=lambda b: b[0] - sum(b[1]))[1].append(n)
            continue

        def per_token(c, n=n, rest=tuple(rest)):
            held = n
            for k, x in enumerate(sorted(rest)):
                if x > c - n:
                    break
                held += x
            return cost(c) / max(1, min(c, held))

        bins.append((min((c for c in sorted(capacities) if c >= n), key=per_token), [n]))
    return sorted((min(c for c in capacities if c >= sum(b)), sorted(b)) for _, b in bins)


def least_cost(sizes, capacities, cost):
    """The least cost of any arrangement, by trying all."""
    def go(k, bins):
        if k == len(sizes):
            return sum(cost(min(c for c in capacities if c >= b)) for b in bins)
        out = go(k + 1, [*bins, sizes[k]])
        for i, b in enumerate(bins):
            if b + sizes[k] <= max(capacities):
                out = min(out, go(k + 1, [*bins[:i], b + sizes[k], *bins[i + 1 :]]))
        return out

    return go(0, [])


def test_best_fit_matches_plain_loops_and_comes_near_the_least_cost():
    r = random.Random(5)
    for n in (0, 1, 2, 5, 7, 60):
        for _ in range(25):
            caps = sorted(r.sample([8, 16, 32, 64], r.randint(1, 4)))
            sizes = [r.randint(1, caps[-1]) for _ in range(n)]
            cost = r.choice([packing.flat_cost, lambda c: c + 3.0, lambda c: c**0.9])
            placed, own = packing.best_fit(sizes, caps, cost)
            bins = [(int(c), sorted(x for x, b in zip(sizes, placed.tolist(), strict=True) if b == k)) for k, c in enumerate(own.tolist())]
            assert sorted(bins) == slow_best_fit(sizes, caps, cost)
            if n <= 7:
                assert sum(cost(c) for c, _ in bins) <= 1.7 * least_cost(sizes, caps, cost) + 1e-9


def read_back(bins, decode, end):
    """Documents by (id, first token's place), put together again from the bins' tokens."""
    pieces = collections.defaultdict(list)
    for b in bins:
        at, tokens = 0, np.frombuffer(b["tokens"], dtype="<u4").tolist()
        assert b["n_tokens"] == len(tokens) == sum(b["lengths"]) <= b["capacity"]
        for i, piece, start, n in zip(b["doc_ids"], b["pieces"], b["starts"], b["lengths"], strict=True):
            pieces[i].append((piece, start, tokens[at : at + n]))
            at += n
    out = []
    for i, parts in pieces.items():
        flat = [t for _, _, x in sorted(parts) for t in x]
        if len({p for p, _, _ in parts}) == len(parts):
            assert [start for _, start, _ in sorted(parts)] == np.cumsum([0, *(len(x) for _, _, x in sorted(parts))]).tolist()[:-1]
        assert flat[-1] == end
        while flat:
            k = flat.index(end)
            out.append((i, decode(flat[:k])))
            flat = flat[k + 1 :]
    return sorted(out, key=str)


def test_pack(spark):
    r = random.Random(4)
    rows = [(i, "x" * r.randint(0, 900)) for i in range(300)] + [(i, t) for i, t in enumerate(ODD, 300)] + [(5, "again"), (5, "again"), (None, "no id"), (900, "yz" * 250_000)]
    caps = (256, 512, 1024)
    bins = packing.pack(table(spark, rows).repartition(5), packing.Bytes(), capacities=caps, shard_pieces=50)
    got = bins.collect()
    assert read_back(got, bytes, 256) == sorted(((i, (t or "").encode()) for i, t in rows), key=str)
    shards = collections.defaultdict(list)
    for b in got:
        shards[b["bin_id"] >> 32].append((b["capacity"], sorted(b["lengths"])))
    assert len(shards) > 5 and len({b["bin_id"] for b in got}) == len(got)
    for own in shards.values():
        assert sorted(own) == slow_best_fit([n for _, x in own for n in x], caps, packing.flat_cost)
    each = packing.placements(bins).collect()
    assert len(each) == sum(len(b["doc_ids"]) for b in got)
    tokens = {b["bin_id"]: np.frombuffer(b["tokens"], dtype="<u4").tolist() for b in got}
    long = sorted((x["piece"], x["start"], x["bin_id"], x["offset"], x["n_tokens"]) for x in each if x["doc_id"] == 900)
    assert [t for _, _, b, o, n in long for t in tokens[b][o : o + n]] == [*(b"yz" * 250_000), 256]
    rates = {x["capacity"]: x for x in packing.fill_rates(bins).collect()}
    assert sum(x["tokens"] for x in rates.values()) == sum(map(len, tokens.values())) and all(0 < x["filled"] <= 1 for x in rates.values())
    assert packing.pack(table(spark, []), packing.Bytes()).count() == 0


def test_packing_query_gives_every_text_back(spark):
    codec = queries.public_codec(spark)
    got = queries.op8_packing(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert read_back(got, codec.decode, codec.end) == sorted(((r["doc_id"], (r["text"] or "").encode()) for r in docs), key=str)
    lengths = {r["doc_id"]: r["n_tokens"] + 1 for r in queries.op2_bpe(spark, SMALL).collect()}
    held = collections.Counter()
    for b in got:
        for i, n in zip(b["doc_ids"], b["lengths"], strict=True):
            held[i] += n
    assert held == lengths


SMALL, FIXTURE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries(spark, name):
    got = queries.queries()[name](spark, SMALL).toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    if name in queries.oracle_sql():
        same(got, views(SMALL).sql(queries.oracle_sql()[name]).df())
    elif name not in ("op4_license_scan", "op8_packing"):
        assert sorted(got["doc_id"]) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_jaccard_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, queries.op5_jaccard_join(spark, SMALL).collect())) == brute_classes([tuple(r) for r in docs])


@pytest.mark.parametrize(("name", "label", "folds", "fold", "least"), [("op1_toxicity", "toxic", 4, 2, 0.95), ("op3_quality", "quality", 3, 1, 0.98)])
def test_held_out_accuracy(spark, name, label, folds, fold, least):
    got = queries.queries()[name](spark, FIXTURE).join(spark.read.parquet(f"{FIXTURE}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert (got["predicted"] == got[label]).mean() >= least
    assert len(got) == spark.read.parquet(f"{FIXTURE}/labels.parquet").filter(F.crc32(F.col("doc_id").cast("string")) % folds == fold).count()


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, SMALL).write.parquet(str(tmp_path / name))
        seen[name] = (now.toPandas(), spark.read.parquet(str(tmp_path / name)).toPandas())
        now = spark.read.parquet(str(tmp_path / name))
        assert name == "packing" or now.columns == docs.columns
    before, after = seen["toxicity"]
    model = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = toxicity.Scorer(model).scores(before["text"].tolist())
    assert sorted(after["doc_id"]) == sorted(before["doc_id"][scores < 0.3])
    before, after = seen["exact_dedup"]
    assert sorted(after["doc_id"]) == sorted(before.groupby("text")["doc_id"].min())
    before, after = seen["near_dedup"]
    want = brute_classes(list(before[["doc_id", "text"]].itertuples(index=False, name=None)))
    assert sorted(after["doc_id"]) == sorted({x[1] for x in want})
    before, after = seen["pii"]
    assert sorted(after["doc_id"]) == sorted(before["doc_id"]) and (after["n_chars"] == after["text"].str.len()).all()
    before, after = seen["packing"]
    codec = queries.public_codec(spark)
    bins = spark.read.parquet(str(tmp_path / "packing")).collect()
    assert read_back(bins, codec.decode, codec.end) == sorted(((i, t.encode()) for i, t in before[["doc_id", "text"]].itertuples(index=False, name=None)), key=str)
    assert corpus_pipeline.run(spark, SMALL).count() == len(after)


def test_pipeline_on_odd_tables(spark, tmp_path):
    odd = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(ODD)] + [(3, "a", None, None, None), (None, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for k, start in enumerate((odd, odd.limit(0))):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, now, SMALL).write.parquet(str(tmp_path / f"{k}{name}"))
            now = spark.read.parquet(str(tmp_path / f"{k}{name}"))
        assert (now.count() == 0) == (k == 1)


def test_near_dedup_tells_texts_of_one_id_apart(spark):
    words = [f"w{k}" for k in range(60)]
    a, near, other = " ".join(words), " ".join([*words[:-1], "end"]), " ".join(f"v{k}" for k in range(40))
    twin = " ".join(f"u{k}" for k in range(60))
    rows = [(1, a), (5, near), (5, other), (7, twin), (7, twin + " end"), (None, other + " x y"), (None, other + " x y")]
    got = jaccard.one_of_each_class(spark.createDataFrame(rows, "doc_id bigint, text string"))
    left = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert (1, a) in left and (5, other) in left and (5, near) not in left
    assert sum(i == 7 for i, _ in left) == 1 and sum(i is None for i, _ in left) == 2 and len(left) == 5


def test_long_texts_and_clashing_columns(spark):
    """Texts of a million characters, beside columns of the names that the operators use inside."""
    long = " ".join(f"w{k % 5000}" for k in range(200_000))
    rows = [(1, long), (2, long), (3, long + " end"), (4, "short one"), (5, None)]
    table = spark.createDataFrame([(i, t, "a", "b", 7, "c", 8, "d") for i, t in rows], "doc_id bigint, text string, __sha string, __row string, id int, sha string, __id int, __keep string")
    kept = exact_dedup.exact_dedup(table)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5] and kept.columns == table.columns and kept.filter("__sha = 'a' and __keep = 'd'").count() == 4
    assert {r["doc_id"]: r["group_size"] for r in exact_dedup.exact_groups(table).collect()} == {1: 2, 2: 2, 3: 1, 4: 1, 5: 1}
    near = jaccard.one_of_each_class(table)
    assert sorted(r["doc_id"] for r in near.collect()) == [1, 4, 5] and near.columns == table.columns and near.filter("__row = 'b'").count() == 3
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.jaccard_classes(table).collect()} == {(1, 1, 2), (2, 1, 2), (3, 1, 2), (4, 4, 0), (5, 5, 0)}


def test_pipeline_on_long_texts_and_more_columns(spark, tmp_path):
    r = random.Random(9)
    word = lambda: "".join(r.choices("abcdefghijk", k=6))
    long = " ".join(word() for _ in range(60_000))
    rows = [(1, long, "en", "s", 0, "x"), (2, long, "en", "s", 0, "x"), (3, long + " more", "en", "s", 0, "y"), (4, f"{long[:300_000]} call (505) 555-1234", "en", "s", 0, "z"), (5, None, None, None, None, None)]
    now = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, __sha string")
    columns, ids = now.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, SMALL).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert now.columns == columns
            ids[name] = sorted(x["doc_id"] for x in now.collect())
    assert set(ids["exact_dedup"]) == set(ids["toxicity"]) - {2} and set(ids["near_dedup"]) == set(ids["exact_dedup"]) - {3} and ids["pii"] == ids["near_dedup"]
    codec = queries.public_codec(spark)
    back = dict(read_back(now.collect(), codec.decode, codec.end))
    assert sorted(back) == ids["pii"] and (4 not in back or back[4].endswith(b"call [PHONE]"))

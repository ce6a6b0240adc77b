"""Licence scans: MinHash bands over overlapping windows retrieve templates, shingle containment verifies them.

Built from DataFrame functions alone. Every template has its own windows: as long as the template
and a stride's slack, so that some window holds any occurrence whole. For a window that holds the
required share of a template's shingles, the least possible Jaccard similarity follows, and with it
the number of bands, of one row each, that retrieve the template with the target probability. A
window meets a template in a band only if it contains the shingle that is the template's minimum
there. So a first pass over the texts finds the places of those shingles, and bands are computed
for the windows around these places; all other windows meet no template in any band.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import let
from .common import text_of
from .license_templates import SHORT_TEMPLATES, TEMPLATES

N, CONTAINMENT, RECALL = 5, 0.8, 0.99999


@dataclass(frozen=True)
class Plan:
    """Windows and bands for the templates of one length. Positions are those of shingles of n words."""

    number: int
    n: int
    window: int
    stride: int
    bands: int


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingle_hash(hashes: Column, i: Column, n: int = N) -> Column:
    """Hash of the n words from place i, counted from 0, given the words' hashes."""
    return F.xxhash64(*[F.get(hashes, i + k) for k in range(n)])


def shingles(words: Column, n: int = N) -> Column:
    """The shingles of words as strings."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def permuted(band: Column) -> Callable[[Column], Column]:
    """The band's permutation of shingle hashes. (A lambda of two arguments would be given the index too.)"""
    return lambda h: F.xxhash64(h, band)


def band_values(hashes: Column, bands: Column) -> Column:
    """For each band the least value of its permutation over an array of shingle hashes."""
    return F.transform(F.sequence(F.lit(0), bands - 1), lambda k: F.array_min(F.transform(hashes, permuted(k))))


def band_minima(hashes: Column, bands: Column) -> Column:
    """For each band the shingle hash whose permuted value is least."""

    def beside(k: Column) -> Callable[[Column], Column]:
        return lambda h: F.struct(permuted(k)(h).alias("v"), h.alias("h"))

    return F.transform(F.sequence(F.lit(0), bands - 1), lambda k: F.array_min(F.transform(hashes, beside(k)))["h"])


def _hashed(words: Column, n: int = N) -> Column:
    """The hash of each shingle of words."""
    whole = let(F.transform(words, lambda w: F.xxhash64(w)), lambda own: F.transform(F.sequence(F.lit(0), F.size(own) - n), lambda i: shingle_hash(own, i, n)))
    return F.when(F.size(words) >= n, whole).otherwise(F.array().cast("array<bigint>"))


def _by_length(n: Column, lengths: list[int], value: Callable[[int], Column]) -> Column:
    """value of a row's shingle length, which is one of lengths."""
    return F.coalesce(*[F.when(n == k, value(k)) for k in lengths])


def families(shingles_of: dict[str, set[str]]) -> dict[str, int]:
    """Templates of one family have at least half of the larger one's shingles in common: one notice can look like several of them."""
    names = sorted(shingles_of)
    of = {name: k for k, name in enumerate(names)}
    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            x, y = shingles_of[a], shingles_of[b]
            if 2 * len(x & y) >= max(len(x), len(y)) and of[a] != of[b]:
                old, new = max(of[a], of[b]), min(of[a], of[b])
                of = {name: new if f == old else f for name, f in of.items()}
    return of


def plan_templates(spark: SparkSession, templates: dict[str, str], containment: float = CONTAINMENT, recall: float = RECALL) -> tuple[DataFrame, dict[int, dict[int, list[Plan]]]]:
    """A table (plan, band, value, template, family, own) of the templates' bands, and by shingle length the plans of each hash that is a minimum in a band.

    The table has a row for each band of each template, own being the template's shingles: its size
    is that of the template list. A template of fewer than N words is one shingle of its own length.
    """
    given = F.array(*[F.struct(F.lit(name).alias("template"), F.lit(text).alias("text")) for name, text in sorted(templates.items())])
    rows = spark.range(1).select(F.explode(given).alias("t")).select("t.*").withColumn("words", words_of(F.col("text")))
    rows, lengths = rows.withColumn("n", F.least(F.size("words"), F.lit(N))), list(range(1, N + 1))
    own, hashes = (_by_length(F.col("n"), lengths, lambda k, f=f: f(F.col("words"), k)) for f in (shingles, _hashed))
    rows = rows.select("template", "n", F.array_distinct(own).alias("own"), hashes.alias("hashes"))
    facts = rows.select("template", "n", F.size("hashes").alias("places"), "own").collect()
    if empty := [r["template"] for r in facts if not r["n"]]:
        raise ValueError(f"templates without words: {empty}")
    family = families({r["template"]: set(r["own"]) for r in facts})
    made: dict[tuple[int, int, int, int], Plan] = {}
    of: list[tuple[str, int, int, int]] = []
    for r in sorted(facts, key=lambda r: (r["places"], r["template"])):
        m = len(r["own"])
        need, stride = math.ceil(containment * m), max(1, r["places"] // 5)
        window = r["places"] + stride - 1
        least = need / (window + m - need)
        bands = 1 if least >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - least))
        plan = made.setdefault((r["n"], window, stride, bands), Plan(len(made), r["n"], window, stride, bands))
        of.append((r["template"], plan.number, bands, family[r["template"]]))
    rows = rows.join(F.broadcast(spark.createDataFrame(of, "template string, plan int, bands int, family int")), "template")
    tables = rows.select("plan", F.posexplode(band_values(F.col("hashes"), F.col("bands"))).alias("band", "value"), "template", "family", "own")
    anchors: dict[int, dict[int, list[Plan]]] = {p.n: {} for p in made.values()}
    plans = {p.number: p for p in made.values()}
    for r in rows.select("plan", F.explode(band_minima(F.col("hashes"), F.col("bands"))).alias("h")).distinct().collect():  # as many rows as the templates have bands
        p = plans[r["plan"]]
        anchors[p.n].setdefault(r["h"], []).append(p)
    return tables, anchors


#: Notices of a family beside one another that are compared: a place can look like all templates of a family.
BESIDE = 8


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per licence notice found: id, template, first_word, last_word, containment, n_windows.

    A notice is a stretch of overlapping windows each of which holds at least the given share of
    the template's five-word shingles, or all words of a template of fewer; its bounds are those of
    the windows (words counted from 0), its containment is the best window's. Templates that differ
    in few words find each other's notices: of those that cover more than half of a notice, the one
    of the highest containment is kept, all that tie for it. A template that differs from its
    occurrence by longer insertions than a window's slack is judged by the part that a window holds.

    A null, empty or short text has no notices. Rows that repeat an id and a text are read once; a
    null id stays null. An empty table gives an empty result, and further columns are ignored. Only
    windows around a template's minima leave the scan; texts are never shuffled. What the scan looks
    for is data, so the plan is the same for any number of templates.
    """
    spark = docs.sparkSession
    bands, anchors = plan_templates(spark, {**TEMPLATES, **SHORT_TEMPLATES} if templates is None else templates, containment, recall)
    text = text_of(F.col(text_col))
    lengths = sorted(anchors)
    kind = "struct<plan: int, n: int, window: int, stride: int, bands: int>"

    def plans_of(n: int, h: Column) -> Column:
        listed = {str(a): [{"plan": p.number, "n": p.n, "window": p.window, "stride": p.stride, "bands": p.bands} for p in plans] for a, plans in anchors[n].items()}
        return F.try_element_at(F.from_json(F.lit(json.dumps(listed)), f"map<string, array<{kind}>>"), h.cast("string"))

    def starts(i: Column, p: Column) -> Column:
        """The windows of a plan that hold place i: multiples of the stride."""
        low = F.greatest(F.lit(0), F.ceil((i - (p["window"] - 1)) / p["stride"]).cast("int"))
        return F.transform(F.sequence(low, F.floor(i / p["stride"]).cast("int")), lambda k: F.struct(p.alias("p"), (k * p["stride"]).alias("start")))

    def around(words: Column) -> Column:
        def of(n: int, own: Column) -> Column:
            every = sorted(anchors[n])
            places = F.filter(F.transform(F.sequence(F.lit(0), F.size(own) - n), lambda i: F.struct(i.alias("i"), shingle_hash(own, i, n).alias("h"))), lambda x: x["h"].isin(every))
            places = F.when(F.size(own) >= n, places).otherwise(F.array().cast("array<struct<i:int,h:bigint>>"))
            return F.array_distinct(F.flatten(F.transform(places, lambda x: F.flatten(F.transform(plans_of(n, x["h"]), lambda p: starts(x["i"], p))))))

        met = let(F.transform(words, lambda w: F.xxhash64(w)), lambda own: F.concat(*[of(n, own) for n in lengths]))
        return F.transform(met, lambda x: F.struct(x["p"].alias("p"), x["start"].alias("start"), F.slice(words, x["start"] + 1, x["p"]["window"] + x["p"]["n"] - 1).alias("part")))

    # explode_outer, and the filter behind it: a filter before it would compute the windows twice
    seen = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), F.explode_outer(let(words_of(text), around)).alias("w")).filter("w is not null").select("id", "key", "w.p.plan", "w.p.n", "w.p.bands", "w.start", "w.part")
    seen = seen.withColumn("hashes", _by_length(F.col("n"), lengths, lambda n: _hashed(F.col("part"), n)))
    met = seen.select("id", "key", "plan", "n", "start", "part", F.posexplode(band_values(F.col("hashes"), F.col("bands"))).alias("band", "value")).join(F.broadcast(bands), ["plan", "band", "value"])
    met = met.select("id", "key", "n", "start", "part", "template", "family", "own").dropDuplicates(["id", "key", "start", "template"])
    share = F.size(F.array_intersect("own", _by_length(F.col("n"), lengths, lambda n: shingles(F.col("part"), n)))) / F.size("own")
    found = met.select("id", "key", "template", "family", F.col("start").alias("first"), (F.col("start") + F.size("part") - 1).alias("last"), share.alias("share")).filter(F.col("share") >= containment)
    # overlapping windows of a template in a text are one notice
    order = Window.partitionBy("id", "key", "template").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum((F.col("first") > F.coalesce(reach, F.lit(-1))).cast("int")).over(order)
    merged = found.withColumn("island", island).groupBy("id", "key", "template", "family", "island")
    notices = merged.agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max("share").alias("share"), F.count(F.lit(1)).alias("n_windows"))
    beside = F.collect_list(F.struct("template", "first", "last", "share")).over(Window.partitionBy("id", "key", "family").orderBy("first", "last", "template").rowsBetween(-BESIDE, BESIDE))
    common = lambda x: F.least(x["last"], F.col("last")) - F.greatest(x["first"], F.col("first")) + 1
    better = F.exists("beside", lambda x: (x["template"] != F.col("template")) & (x["share"] > F.col("share")) & (common(x) * 2 > F.col("last") - F.col("first") + 1))
    out = notices.withColumn("beside", beside).filter(~better)
    return out.select(F.col("id").alias(id_col), "template", F.col("first").cast("long").alias("first_word"), F.col("last").cast("long").alias("last_word"), F.col("share").alias("containment"), "n_windows")


def oracle_sql(templates: dict[str, str]) -> str:
    """Counts, for each window that holds any, the shingles that it has in common with each template."""
    listed = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in item)) for item in sorted(templates.items()))
    words = r"list_filter(string_split_regex(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    return f"""
WITH RECURSIVE tw AS (SELECT template, {words.format("txt")} AS w FROM (VALUES {listed}) v(template, txt)),
tn AS (SELECT *, least(len(w), {N}) AS n, len(w) - least(len(w), {N}) + 1 AS places FROM tw),
ts AS (SELECT DISTINCT template, n, places, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, places + 1)) AS i FROM tn)),
tm AS (SELECT template, n, count(*) AS m, greatest(1, places // 5) AS stride, places + greatest(1, places // 5) - 1 AS win FROM ts GROUP BY template, n, places),
kin AS (SELECT x.template AS a, y.template AS b FROM ts x JOIN ts y ON x.g = y.g JOIN tm p ON p.template = x.template JOIN tm q ON q.template = y.template GROUP BY ALL HAVING 2 * count(*) >= max(greatest(p.m, q.m))),
reach AS (SELECT template, template AS r FROM tm UNION SELECT reach.template, kin.b FROM reach JOIN kin ON kin.a = reach.r),
family AS (SELECT template, min(r) AS family FROM reach GROUP BY 1),
dw AS (SELECT doc_id, {words.format("coalesce(text, '')")} AS w FROM documents),
dg AS (SELECT doc_id, n, nw, i - 1 AS i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, len(w) AS nw, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM tm) WHERE len(w) >= n)),
hits AS (SELECT dg.doc_id, dg.nw, dg.i, dg.g, tm.* FROM dg JOIN ts ON ts.g = dg.g AND ts.n = dg.n JOIN tm ON tm.template = ts.template),
wins AS (SELECT DISTINCT doc_id, nw, template, n, m, win, g, s * stride AS start FROM (SELECT *, unnest(range(CAST(greatest(0, ceil((i - (win - 1)) / stride)) AS BIGINT), i // stride + 1)) AS s FROM hits)),
scored AS (SELECT doc_id, template, start AS first, least(nw, start + win + n - 1) - 1 AS last, CAST(count(*) AS DOUBLE) / m AS share FROM wins GROUP BY doc_id, nw, template, n, m, win, start HAVING count(*) >= {CONTAINMENT} * m),
marked AS (SELECT *, CASE WHEN first > coalesce(max(last) OVER (PARTITION BY doc_id, template ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 1 ELSE 0 END AS new FROM scored),
isles AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY first) AS isle FROM marked),
notices AS (SELECT doc_id, template, family, min(first) AS first, max(last) AS last, max(share) AS share, count(*) AS n_windows FROM isles JOIN family USING (template) GROUP BY doc_id, template, family, isle)
SELECT doc_id, template, first AS first_word, last AS last_word, share AS containment, n_windows FROM notices x
WHERE NOT EXISTS (SELECT 1 FROM notices y WHERE y.doc_id = x.doc_id AND y.family = x.family AND y.template <> x.template AND y.share > x.share AND (least(x.last, y.last) - greatest(x.first, y.first) + 1) * 2 > x.last - x.first + 1)
"""


ORACLE_SQL = oracle_sql({**TEMPLATES, **SHORT_TEMPLATES})

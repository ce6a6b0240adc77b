"""Duplicate groups of question-answer rows, exact and by similarity, and the choice of survivors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import match_key
from .order import with_rank
from .similarity import leaders

#: Survivor strategies: the order within a group whose first row stays. higher_confidence is longer_answer.
SURVIVORS = ("longer_answer", "first_seen", "higher_confidence")


def survivor_order(strategy: str, answer: str = "answer", page: str = "page_id", qa_id: str = "qa_id") -> Column:
    """What a group's rows are ordered by; the least stays."""
    if strategy not in SURVIVORS:
        raise ValueError(f"no such strategy: {strategy}")
    if strategy == "first_seen":
        return F.struct(F.col(page).alias("x"), F.col(qa_id).alias("id"))
    return F.struct((-F.length(F.coalesce(F.col(answer), F.lit("")))).alias("x"), F.col(qa_id).alias("id"))


def rank_within(rows: DataFrame, scope: tuple[str, ...], order: str, name: str) -> DataFrame:
    """rows numbered from 1 in each scope: ranked in ranges of the whole table, less what comes before the scope."""
    ranked = with_rank(rows, [*scope, order], name)
    if not scope:
        return ranked
    first = ranked.groupBy(*scope).agg(F.min(name).alias("__before"))
    return ranked.join(first, [*scope]).withColumn(name, F.col(name) - F.col("__before") + 1).drop("__before")


def exact_groups(rows: DataFrame, question: str = "question", scope: tuple[str, ...] = (), order: tuple[str, ...] = ("doc_ord", "pair_ord"), unicode: bool = False) -> DataFrame:
    """The rows of groups with an equal match key, with group_id, match_type and similarity_score.

    Groups are numbered exact-001 and so on in the order of their first rows; scope columns confine
    groups, and numbers begin anew in each scope. Groups are found by counting keys, which combines
    before the shuffle; only rows of groups are numbered.
    """
    keyed = rows.withColumn("__key", match_key(F.coalesce(F.col(question), F.lit("")), unicode))
    on = [*scope, "__key"]
    many = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*order)).alias("__first")).filter("__n > 1")
    numbered = rank_within(many, scope, "__first", "__g")
    out = keyed.join(numbered, on)
    return out.select(*rows.columns, F.format_string("exact-%03d", "__g").alias("group_id"), F.lit("exact").alias("match_type"), F.lit(1.0).alias("similarity_score"))


def pick_survivors(groups: DataFrame, strategy: str = "longer_answer", **names) -> DataFrame:
    """Rows of groups with kept (one id in each group) and kept_qa_id.

    The best row of a group is an aggregate, combined before the shuffle, and comes back by a join,
    so that a group with a third of all rows isn't sorted in one task.
    """
    own = groups.withColumn("__o", survivor_order(strategy, **names))
    best = own.groupBy("group_id").agg(F.min("__o").alias("__best"))
    met = own.join(best, "group_id")
    return met.select(*groups.columns, (F.col("__o") == F.col("__best")).alias("kept"), F.col("__best.id").alias("kept_qa_id"))


def drop_ids(rows: DataFrame, groups: DataFrame, keys: tuple[str, ...] = ("page_id", "qa_id")) -> DataFrame:
    """rows without those whose keys are dropped from a group; keys=("qa_id",) drops an id on every page."""
    lost = groups.filter(~F.col("kept")).select(*keys)
    if "page_id" not in keys:
        lost = lost.join(groups.filter("kept").select(*keys), list(keys), "left_anti")
    return rows.join(lost.distinct(), list(keys), "left_anti")


def semantic_groups(rows: DataFrame, vectors: DataFrame, exact: DataFrame, threshold: float = 0.9, qa_id: str = "qa_id", order: tuple[str, ...] = ("doc_ord", "pair_ord"), scope: tuple[str, ...] = (), recall: float | None = None) -> DataFrame:
    """Groups by cosine among rows in no exact group: leaders with the later rows near them, numbered semantic-001 and on.

    All members of exact groups are left out, the kept ones too. vectors holds (qa_id, embedding);
    rows without a vector are in no group. A group's similarity_score is the mean of its members'
    cosines with the leader. Scope columns confine groups, and numbers begin anew in each scope.
    Without a recall all pairs of rows are compared; with one, as for very many rows, near pairs are
    found with that probability.
    """
    key = [qa_id, *[c for c in scope if c != qa_id]]
    free = rows.join(exact.select(*key).distinct(), key, "left_anti")
    placed = free.join(vectors.select(qa_id, "embedding"), qa_id).withColumn("__id", F.to_json(F.struct(*key)))
    lead = leaders(placed.select(*scope, F.col("__id").alias("id"), F.struct(*order, F.col(qa_id)).alias("ord"), "embedding"), threshold, scope, recall)
    scored = lead.groupBy("leader").agg(F.count(F.lit(1)).alias("__n"), F.avg(F.when(F.col("id") != F.col("leader"), F.col("similarity"))).alias("similarity_score"), F.min("ord").alias("__first")).filter("__n > 1")
    if scope:
        scored = scored.join(placed.select(F.col("__id").alias("leader"), *scope), "leader")
    numbered = rank_within(scored, scope, "__first", "__g").withColumn("group_id", F.format_string("semantic-%03d", "__g")).select("leader", "group_id", "similarity_score")
    members = lead.select(F.col("id").alias("__id"), "leader").join(numbered, "leader").drop("leader")
    return placed.join(members, "__id").withColumn("match_type", F.lit("semantic")).select(*rows.columns, "group_id", "match_type", "similarity_score")


def deduplicate(rows: DataFrame, vectors: DataFrame | None = None, strategy: str = "longer_answer", threshold: float = 0.9, cross_page: bool = True, compatible: bool = False, exact: bool = True, recall: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows of all groups with kept and kept_qa_id): exact groups first, then similar ones.

    exact=False leaves the exact groups out, no vectors the similar ones. cross_page=False confines
    both kinds of groups to a page. compatible=True drops by id alone, on whatever page. recall is
    that of semantic_groups.
    """
    scope = () if cross_page else ("page_id",)
    equal = exact_groups(rows if exact else rows.limit(0), scope=scope)
    groups = equal if vectors is None else equal.unionByName(semantic_groups(rows, vectors, equal, threshold, scope=scope, recall=recall))
    if not cross_page:
        groups = groups.withColumn("group_id", F.concat_ws("/", "page_id", "group_id"))
    marked = pick_survivors(groups, strategy)
    return drop_ids(rows, marked, ("qa_id",) if compatible else ("page_id", "qa_id")), marked


def duplicate_log(marked: DataFrame) -> DataFrame:
    """Log rows of groups: the kept row first, then the dropped ones."""
    return marked.select("group_id", "page_id", "qa_id", "question", "answer", "similarity_score", F.when(F.col("kept"), "kept").otherwise("dropped").alias("action"), "kept_qa_id").orderBy("group_id", F.col("action").desc(), "qa_id")


def dedup_totals(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """Rows before and removed, groups by kind, percentage removed: one row."""
    g = marked.agg(F.count_if(~F.col("kept")).alias("removed"), F.count_distinct(F.when(F.col("match_type") == "exact", F.col("group_id"))).alias("exact_groups"), F.count_distinct(F.when(F.col("match_type") == "semantic", F.col("group_id"))).alias("semantic_groups"))
    n = rows.agg(F.count(F.lit(1)).alias("total"))
    return n.crossJoin(g).withColumn("removed_percent", F.when(F.col("total") > 0, F.col("removed") * 100.0 / F.col("total")).otherwise(0.0))


def first_by(rows: DataFrame, key: str | Column, order: list[str | Column]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")

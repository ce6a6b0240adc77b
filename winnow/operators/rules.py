"""Quality rules for question-answer pairs: each pair carries the first rule that it breaks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import matches_glob
from ..functions.text import as_col, first_phrase, jaccard, strip, stripped_length, word_set
from ..session import durable
from .similarity import jaccard_pairs, lead

#: Phrases and question types of the standard configuration, in order.
GENERIC_ANSWERS = ("cannot determine", "not visible", "unclear from", "I don't see", "I cannot see", "I can't determine", "the image doesn't show", "not specified", "please refer to", "typically", "usually", "generally")
SELF_REFERENCES = ("on this page", "in this image", "as shown here", "the manual states", "according to the page", "depicted in")
QUESTION_TYPES = ("factual", "procedural", "visual", "inspection", "tool", "safety", "navigation", "wiring", "connector", "component", "diagnostic", "troubleshooting", "signal", "parameter", "operation")
#: Fixed values of the check at generation. Its hedges are compared as written with lower-cased answers, so those with a capital never match.
HEDGES = ("I cannot see", "I can't determine", "not visible", "image doesn't show", "unclear from the image", "I would need", "typically", "usually", "generally")
GENERATED_SELF_REFERENCES = ("on this page", "in this image", "as shown", "the manual states", "according to the page")


#: Questions of a page that are compared in one expression.
FOLDED = 200


@dataclass(frozen=True)
class Rules:
    min_answer: int = 10
    max_answer: int = 500
    min_question: int = 15
    question_mark: bool = True
    generic_answers: tuple[str, ...] = GENERIC_ANSWERS
    self_references: tuple[str, ...] = SELF_REFERENCES
    question_types: tuple[str, ...] = QUESTION_TYPES
    max_similarity: float = 0.80
    min_types: int = 2


def _verdict(name: str, reason: Column) -> Column:
    """A struct (filter_name, reason), null where the reason is."""
    return F.when(reason.isNotNull(), F.struct(F.lit(name).alias("filter_name"), reason.alias("reason")))


def answer_length(answer: Column, r: Rules) -> Column:
    n = stripped_length(F.coalesce(answer, F.lit("")))
    return _verdict("answer_length", F.when(n < r.min_answer, "answer_too_short").when(n > r.max_answer, "answer_too_long"))


def question_length(question: Column, r: Rules) -> Column:
    return _verdict("question_length", F.when(stripped_length(F.coalesce(question, F.lit(""))) < r.min_question, "question_too_short"))


def question_mark(question: Column, r: Rules) -> Column:
    missing = ~strip(F.coalesce(question, F.lit(""))).endswith("?") if r.question_mark else F.lit(False)
    return _verdict("question_format", F.when(missing, "missing_question_mark"))


def _phrase_rule(name: str, text: Column, phrases: tuple[str, ...]) -> Column:
    return _verdict(name, F.concat(F.lit(f"{name}: "), first_phrase(F.coalesce(text, F.lit("")), list(phrases))))


def generic_answer(answer: Column, r: Rules) -> Column:
    return _phrase_rule("generic_answer", answer, r.generic_answers)


def self_referential(question: Column, r: Rules) -> Column:
    return _phrase_rule("self_referential", question, r.self_references)


def question_type(kind: Column, r: Rules) -> Column:
    """A null type passes; an empty list of types switches the rule off."""
    bad = kind.isNotNull() & ~kind.isin(*r.question_types) if r.question_types else F.lit(False)
    return _verdict("question_type", F.when(bad, F.concat(F.lit("invalid_question_type: "), kind)))


def first_failure(question: Column | str = "question", answer: Column | str = "answer", kind: Column | str = "question_type", rules: Rules | None = None) -> Column:
    """The first rule that a pair breaks, as (filter_name, reason); null for a pair that passes. Later rules aren't evaluated."""
    q, a, t, r = as_col(question), as_col(answer), as_col(kind), rules or Rules()
    return F.coalesce(answer_length(a, r), question_length(q, r), question_mark(q, r), generic_answer(a, r), self_referential(q, r), question_type(t, r))


def diverse(rows: DataFrame, page: str = "page_id", order: str = "pair_ord", qa_id: str = "qa_id", question: str = "question", threshold: float = 0.80) -> DataFrame:
    """rows with similar_to and similarity: the earliest kept question of the page that a question is too similar to.

    Questions are taken in order; one is kept unless its word set reaches the threshold with one
    already kept. A page's questions fold in one expression: the page is the unit of grouping, as
    small as a document's list of questions. Kept questions have nulls. A null question is an empty
    one and like no other; rows with a null page are one page; (page, order) must be unique.
    """
    item = F.struct(F.col(order).alias("ord"), F.col(qa_id).alias("id"), word_set(F.coalesce(F.col(question), F.lit(""))).alias("words"))
    state = "struct<kept: array<struct<id: string, words: array<string>>>, seen: array<struct<ord: bigint, similar_to: string, similarity: double>>>"
    start = F.struct(F.array().cast("array<struct<id: string, words: array<string>>>").alias("kept"), F.array().cast("array<struct<ord: bigint, similar_to: string, similarity: double>>").alias("seen")).cast(state)

    def step(acc: Column, x: Column) -> Column:
        near = F.get(F.filter(F.transform(acc["kept"], lambda k: F.struct(k["id"].alias("id"), jaccard(k["words"], x["words"]).alias("s"))), lambda k: k["s"] >= threshold), F.lit(0))
        kept = F.when(near.isNull(), F.concat(acc["kept"], F.array(F.struct(x["id"].cast("string").alias("id"), x["words"].alias("words"))))).otherwise(acc["kept"])
        seen = F.concat(acc["seen"], F.array(F.struct(x["ord"].cast("bigint").alias("ord"), near["id"].cast("string").alias("similar_to"), near["s"].alias("similarity"))))
        return F.struct(kept.alias("kept"), seen.alias("seen")).cast(state)

    folded = rows.groupBy(page).agg(F.aggregate(F.array_sort(F.collect_list(item)), start, step)["seen"].alias("seen"))
    marks = folded.select(F.col(page).alias("__page"), F.explode("seen").alias("m")).select("__page", F.col("m.ord").alias("__ord"), "m.similar_to", "m.similarity")
    return rows.join(marks, F.col(page).eqNullSafe(F.col("__page")) & (F.col(order) == F.col("__ord"))).drop("__page", "__ord")


def diverse_by_pairs(rows: DataFrame, page: str = "page_id", order: str = "pair_ord", qa_id: str = "qa_id", question: str = "question", threshold: float = 0.80) -> DataFrame:
    """What diverse returns, for pages of any size: near pairs by a join, then leaders in rounds; a page is never gathered."""
    keyed = rows.withColumn("__id", F.struct(F.col(page).alias("p"), F.col(order).alias("o")))
    sets = keyed.select(page, "__id", word_set(F.coalesce(F.col(question), F.lit(""))).alias("words"))
    near = jaccard_pairs(sets, threshold, (page,), "__id").select("a", "b", "similarity")
    found = lead(keyed.select(F.col("__id").alias("id"), F.col(order).alias("ord")), near)
    names = keyed.select(F.col("__id").alias("leader"), F.col(qa_id).cast("string").alias("__name"))
    mark = found.join(names, "leader").select(F.col("id").alias("__id"), F.when(F.col("id") != F.col("leader"), F.struct(F.col("__name").alias("n"), F.col("similarity").alias("s"))).alias("__m"))
    return keyed.join(mark, "__id").select(*rows.columns, F.col("__m.n").alias("similar_to"), F.col("__m.s").alias("similarity"))


def diverse_any(rows: DataFrame, page: str = "page_id", order: str = "pair_ord", qa_id: str = "qa_id", question: str = "question", threshold: float = 0.80, folded: int = FOLDED) -> DataFrame:
    """What diverse returns: pages of at most `folded` different questions in one fold each, larger ones by pairs. Both ways give the same rows.

    Questions of a page with one set of words fare as the first of them does: they are like it if it
    stays, and else like what it is like. So only those first ones are compared.
    """
    words = F.array_sort(word_set(F.coalesce(F.col(question), F.lit(""))))
    some = F.size("__w") > 0  # a question without words is like no other
    keyed = rows.withColumn("__w", words).withColumns({"__h": F.when(some, F.xxhash64("__w")), "__k": F.when(some, F.xxhash64("__w", F.lit(1)))}).drop("__w")
    own = F.struct(*[F.col(c).alias(n) for c, n in ((order, "o"), (qa_id, "i"), (question, "q"))])
    least = keyed.filter("__h is not null").groupBy(F.col(page).alias("p"), "__h", "__k").agg(F.min_by(own, order).alias("f"))
    firsts = durable(least.select("p", "__h", "__k", "f.o", "f.i", "f.q"))
    sizes = firsts.groupBy(F.col("p").alias("__page")).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > folded)
    names = ("p", "o", "i", "q", threshold)
    if sizes.isEmpty():
        marked = diverse(firsts, *names)
    else:
        same = F.col("p").eqNullSafe(F.col("__page"))
        marked = diverse(firsts.join(sizes, same, "left_anti"), *names).unionByName(diverse_by_pairs(firsts.join(sizes, same, "left_semi"), *names))
    marks = marked.select(F.col("p").alias("__p"), F.col("__h").alias("__fh"), F.col("__k").alias("__fk"), F.col("o").alias("__o"), F.col("i").cast("string").alias("__i"), F.col("similar_to").alias("__to"), F.col("similarity").alias("__like"))
    met = keyed.join(marks, (F.col("__h") == F.col("__fh")) & (F.col("__k") == F.col("__fk")) & F.col(page).eqNullSafe(F.col("__p")), "left")
    later = F.col(order) > F.col("__o")
    return met.select(*rows.columns, F.coalesce("__to", F.when(later, F.col("__i"))).alias("similar_to"), F.when(F.col("__to").isNotNull(), F.col("__like")).when(later, F.lit(1.0)).alias("similarity"))


def apply_rules(rows: DataFrame, rules: Rules | None = None, page: str = "page_id", order: str = "pair_ord", qa_id: str = "qa_id") -> DataFrame:
    """rows with filter_name and reason (null for pairs that pass), similar_to and similarity.

    The rules of a single pair come first; the questions that pass them are then compared within
    their page, however many it has. (page, order) must be unique.
    """
    r = rules or Rules()
    marked = rows.withColumn("__f", first_failure(rules=r))
    passed = diverse_any(marked.filter("__f is null"), page, order, qa_id, threshold=r.max_similarity)
    failed = marked.filter("__f is not null").withColumns({"similar_to": F.lit(None).cast("string"), "similarity": F.lit(None).cast("double")})
    near = F.when(F.col("similar_to").isNotNull(), F.struct(F.lit("question_similarity").alias("filter_name"), F.lit("question_similarity").alias("reason")))
    out = failed.unionByName(passed.withColumn("__f", near))
    return out.withColumns({"filter_name": F.col("__f.filter_name"), "reason": F.col("__f.reason")}).drop("__f")


def rejection_log(marked: DataFrame, timestamp: str) -> DataFrame:
    """Log rows of the pairs that apply_rules rejects."""
    near = F.format_string("question_similarity: %.2f with %s", "similarity", "similar_to")
    reason = F.when(F.col("similar_to").isNotNull(), near).otherwise(F.col("reason"))
    return marked.filter("filter_name is not null").select(F.lit(timestamp).alias("timestamp"), "page_id", "qa_id", "question", "answer", reason.alias("rejection_reason"), "filter_name")


def rejection_counts(marked: DataFrame) -> DataFrame:
    """filter_name, n and its percentage of all rejections."""
    n = marked.filter("filter_name is not null").groupBy("filter_name").agg(F.count(F.lit(1)).alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("total")))).select("filter_name", "n", (F.col("n") * 100.0 / F.col("total")).alias("percent"))


def rejection_samples(marked: DataFrame, k: int = 5, order: tuple[str, ...] = ("page_id", "pair_ord")) -> DataFrame:
    """The first k rejected pairs of each rule."""
    w = Window.partitionBy("filter_name").orderBy(*order)
    return marked.filter("filter_name is not null").withColumn("sample", F.row_number().over(w)).filter(F.col("sample") <= k)


def totals(marked: DataFrame) -> DataFrame:
    """Pages, pairs, passed and rejected."""
    return marked.agg(F.count_distinct("page_id").alias("pages"), F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("filter_name").isNull()).alias("passed"), F.count_if(F.col("filter_name").isNotNull()).alias("rejected"))


def page_warnings(pages: DataFrame, passed: DataFrame, min_types: int = 2, page: str = "page_id") -> DataFrame:
    """(page, warning) rows: no pair left (then nothing else), fewer than three left, too few question types."""
    left = passed.groupBy(page).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(F.when(F.col("question_type") != "", F.col("question_type")))).alias("types"))
    all_ = pages.select(page).distinct().join(left, page, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    kinds = F.size(F.coalesce("types", F.array().cast("array<string>")))
    listed = F.when(kinds > 0, F.array_join("types", ", ")).otherwise("none")
    few = F.when(F.col("n") < 3, F.format_string("%s: Only %d Q&A pairs remaining", F.col(page).cast("string"), F.col("n")))
    narrow = F.when(kinds < min_types, F.format_string("%s: Only %d question type(s): %s", F.col(page).cast("string"), kinds, listed))
    none = F.format_string("%s: All Q&A pairs filtered out", F.col(page).cast("string"))
    return all_.select(page, F.explode(F.when(F.col("n") == 0, F.array(none)).otherwise(F.array_compact(F.array(few, narrow)))).alias("warning"))


def generation_warnings(question: Column | str = "question", answer: Column | str = "answer", kind: Column | str = "question_type", min_question: int = 10, min_answer: int = 5) -> Column:
    """Struct (ok, warnings) of the check that freshly generated pairs undergo; texts are not stripped.

    A pair with a missing or too short part fails with that one warning. So does one whose other
    warnings contain "too short" or "missing", as an odd question type can.
    """
    q, a, t = as_col(question), as_col(answer), as_col(kind)
    low_a, low_q = F.lower(a), F.lower(q)
    end = lambda c: F.regexp_replace(c, r"(?U)\s+\z", "").endswith("?")
    soft = [F.when(~end(q), "Question doesn't end with '?'"), F.when(end(a), "Answer ends with '?' (may be a question)")]
    soft += [F.when(low_a.contains(p), f"Potential hedge/hallucination: '{p}'") for p in HEDGES]
    soft += [F.when(low_q.contains(p), f"Self-referential question: '{p}'") for p in GENERATED_SELF_REFERENCES]
    soft += [F.when(t.isNull() | ~t.isin(*QUESTION_TYPES), F.concat(F.lit("Invalid question_type: "), F.coalesce(t, F.lit("None"))))]
    mild = F.array_compact(F.array(*soft))
    hard = lambda text: F.struct(F.lit(False).alias("ok"), F.array(F.lit(text)).alias("warnings"))
    return (
        F.when(F.coalesce(F.length(q), F.lit(0)) < min_question, hard("Question too short or missing"))
        .when(F.coalesce(F.length(a), F.lit(0)) < min_answer, hard("Answer too short or missing"))
        .otherwise(F.struct((~F.exists(mild, lambda w: w.contains("too short") | w.contains("missing"))).alias("ok"), mild.alias("warnings")))
    )


def route_generated(rows: DataFrame, strict: bool = False) -> DataFrame:
    """rows with valid and _warnings: strict rejects every pair with a warning, otherwise only failed ones."""
    checked = rows.withColumn("__g", generation_warnings())
    valid = F.col("__g.ok") & (F.size("__g.warnings") == 0) if strict else F.col("__g.ok")
    return checked.withColumn("valid", valid).withColumn("_warnings", F.col("__g.warnings")).drop("__g")


def skip_reason(has_output: Column, page: Column | str, content_type: Column | str, patterns: tuple[str, ...] = ("*-blank-*", "*-cover-*", "*-title-*"), types: tuple[str, ...] = ("blank", "cover", "title")) -> Column:
    """Why a page need not be processed: its output exists, its id matches a pattern, its type is listed; null if none."""
    reasons = [F.when(has_output, "Output file already exists")]
    reasons += [F.when(matches_glob(page, p), f"Matches skip pattern: {p}") for p in patterns]
    reasons += [F.when(as_col(content_type).isin(*types), F.concat(F.lit("Content type '"), as_col(content_type), F.lit("' is in skip list")))]
    return F.coalesce(*reasons)

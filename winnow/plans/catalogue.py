"""Queries over the driver's tables, each with the SQL that gives the same rows.

Tables stand in for the data that an operator is for: conversations for question-answer pages (a
page is a conversation), documents for texts by section, labels for verdicts, events for calls with
a cost, lineitem and part for an index.
"""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths, text, web
from ..operators import crawl, dedup, emit, generate, html, index, rules, similarity, split, stats, validate
from ..operators.rules import Rules
from .registry import QUERIES, SQL, Query, query, table

#: No user turn of conversations ends in a question mark.
RULES = Rules(question_mark=False)
SEED = 42


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emit.pair_turns(table(spark, sf_dir, "conversations"))


PAIRS = """
pairs AS (
  SELECT CAST(conv_id AS VARCHAR) AS page_id, conv_id AS doc_ord, pair_ord, CAST(conv_id AS VARCHAR) || '-q' || CASE WHEN pair_ord < 10 THEN '0' ELSE '' END || pair_ord AS qa_id, question, answer, 'factual' AS question_type
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pair_ord
        FROM (SELECT conv_id, turn, role, text AS question, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations)
        WHERE role = 'user' AND next_role = 'assistant')
)"""
STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
KEY = "trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))"
WORDS = "list_distinct(regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}_]+'))"
_A, _Q = "length(" + STRIP.format("answer") + ")", "length(" + STRIP.format("question") + ")"


def _phrases(column: str, phrases: tuple[str, ...]) -> str:
    escaped = [p.replace("'", "''") for p in phrases]
    return "CASE " + " ".join(f"WHEN contains(lower({column}), '{p.lower()}') THEN '{p}'" for p in escaped) + " END"


#: The phrases as they are configured, written out.
_GENERIC = ("cannot determine", "not visible", "unclear from", "I don't see", "I cannot see", "I can't determine", "the image doesn't show", "not specified", "please refer to", "typically", "usually", "generally")
_SELF = ("on this page", "in this image", "as shown here", "the manual states", "according to the page", "depicted in")

VERDICT = f"""
marked AS (
  SELECT *, CASE WHEN {_A} < 10 OR {_A} > 500 THEN 'answer_length' WHEN {_Q} < 15 THEN 'question_length' WHEN {_phrases("answer", _GENERIC)} IS NOT NULL THEN 'generic_answer'
                 WHEN {_phrases("question", _SELF)} IS NOT NULL THEN 'self_referential' END AS filter_name,
            CASE WHEN {_A} < 10 THEN 'answer_too_short' WHEN {_A} > 500 THEN 'answer_too_long' WHEN {_Q} < 15 THEN 'question_too_short' WHEN {_phrases("answer", _GENERIC)} IS NOT NULL THEN 'generic_answer: ' || {_phrases("answer", _GENERIC)}
                 WHEN {_phrases("question", _SELF)} IS NOT NULL THEN 'self_referential: ' || {_phrases("question", _SELF)} END AS reason
  FROM pairs
)"""


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = rules.first_failure(rules=RULES)
    return _pairs(spark, sf_dir).withColumn("v", v).withColumn("filter_name", F.col("v.filter_name")).withColumn("reason", F.col("v.reason")).drop("v")


@query(f"WITH {PAIRS} SELECT page_id, pair_ord, qa_id, md5(question) AS question_md5, md5(answer) AS answer_md5 FROM pairs")
def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("page_id", F.col("pair_ord").cast("long").alias("pair_ord"), "qa_id", F.md5("question").alias("question_md5"), F.md5("answer").alias("answer_md5"))


@query(f"WITH {PAIRS}, {VERDICT} SELECT qa_id, filter_name, reason FROM marked")
def filter_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(spark, sf_dir).select("qa_id", "filter_name", "reason")


@query(f"WITH {PAIRS}, {VERDICT} SELECT filter_name, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM marked WHERE filter_name IS NOT NULL GROUP BY filter_name")
def filter_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rejection_counts(_marked(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


@query(f"WITH {PAIRS}, {VERDICT}, s AS (SELECT *, row_number() OVER (PARTITION BY filter_name ORDER BY page_id, pair_ord) AS sample FROM marked WHERE filter_name IS NOT NULL) SELECT filter_name, sample, qa_id FROM s WHERE sample <= 5")
def filter_samples_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rejection_samples(_marked(spark, sf_dir)).select("filter_name", F.col("sample").cast("long").alias("sample"), "qa_id")


@query(f"WITH {PAIRS}, {VERDICT} SELECT count(DISTINCT page_id) AS pages, count(*) AS pairs, count(*) FILTER (filter_name IS NULL) AS passed, count(*) FILTER (filter_name IS NOT NULL) AS rejected FROM marked")
def filter_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.totals(_marked(spark, sf_dir))


@query("SELECT doc_id, CASE WHEN NOT ends_with(" + STRIP.format("text") + ", '?') THEN 'missing_question_mark' END AS reason FROM documents")
def question_mark_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", rules.question_mark(F.col("text"), Rules())["reason"].alias("reason"))


_DOC_PHRASES = ("thation", "ciónes", "lich", "eaux")


@query(f"SELECT doc_id, 'generic_answer: ' || {_phrases('text', _DOC_PHRASES)} AS reason FROM documents")
def generic_phrase_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", rules.generic_answer(F.col("text"), Rules(generic_answers=_DOC_PHRASES))["reason"].alias("reason"))


@query("SELECT event_id, CASE WHEN event_type IS NOT NULL AND event_type NOT IN ('click', 'view') THEN 'invalid_question_type: ' || event_type END AS reason FROM events")
def type_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", rules.question_type(F.col("event_type"), Rules(question_types=("click", "view")))["reason"].alias("reason"))


@query(f"""WITH {PAIRS}, {VERDICT}, pages AS (SELECT DISTINCT page_id FROM pairs), kept AS (SELECT page_id, count(*) AS n FROM marked WHERE filter_name IS NULL GROUP BY page_id), w AS (SELECT page_id, coalesce(n, 0) AS n FROM pages LEFT JOIN kept USING (page_id))
SELECT page_id, page_id || ': All Q&A pairs filtered out' AS warning FROM w WHERE n = 0
UNION ALL SELECT page_id, page_id || ': Only ' || n || ' Q&A pairs remaining' FROM w WHERE n BETWEEN 1 AND 2
UNION ALL SELECT page_id, page_id || ': Only 1 question type(s): factual' FROM w WHERE n > 0""")
def page_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _marked(spark, sf_dir)
    return rules.page_warnings(m, m.filter("filter_name is null"))


@query("SELECT doc_id, md5(" + KEY.format("text") + ") AS key_md5 FROM documents")
def norm_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.match_key("text")).alias("key_md5"))


@query("SELECT doc_id, CAST(len(" + WORDS.format("text") + ") AS BIGINT) AS n_words, md5(array_to_string(list_sort(" + WORDS.format("text") + "), ' ')) AS words_md5 FROM documents")
def word_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.word_set("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(words).cast("long").alias("n_words"), F.md5(F.array_join(F.array_sort(words), " ")).alias("words_md5"))


@query("SELECT doc_id, length(" + STRIP.format("text") + ") AS stripped, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS collapsed_md5, substr(text, 1, 50) AS head FROM documents")
def text_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.stripped_length("text").cast("long").alias("stripped"), F.md5(text.collapse("text")).alias("collapsed_md5"), text.truncate("text", 50).alias("head"))


def _doc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("qa_id"), F.col("source").alias("page_id"), F.col("text").alias("question"), F.col("text").alias("answer"), F.col("doc_id").alias("doc_ord"), F.lit(0).alias("pair_ord"), "lang")


_EXACT = "keyed AS (SELECT CAST(doc_id AS VARCHAR) AS qa_id, source AS page_id, doc_id, text, {key} AS k FROM documents), grouped AS (SELECT *, count(*) OVER (PARTITION BY {by}) AS n, min(doc_id) OVER (PARTITION BY {by}) AS first_id FROM keyed), g AS (SELECT * FROM grouped WHERE n > 1)".replace("{key}", KEY.format("text"))


@query(f"WITH {_EXACT.replace('{by}', 'k')} SELECT qa_id, 'exact-' || lpad(CAST(dense_rank() OVER (ORDER BY first_id) AS VARCHAR), CAST(greatest(3, length(CAST(dense_rank() OVER (ORDER BY first_id) AS VARCHAR))) AS INTEGER), '0') AS group_id FROM g")
def exact_dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_groups(_doc_rows(spark, sf_dir)).select("qa_id", "group_id")


def _kept_sql(order: str) -> str:
    return f"WITH {_EXACT.replace('{by}', 'k')} SELECT qa_id, row_number() OVER (PARTITION BY first_id ORDER BY {order}) = 1 AS kept, first_value(qa_id) OVER (PARTITION BY first_id ORDER BY {order}) AS kept_qa_id FROM g"


@query(_kept_sql("length(text) DESC, qa_id"))
def exact_dedup_kept_longer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.pick_survivors(dedup.exact_groups(_doc_rows(spark, sf_dir)), "longer_answer").select("qa_id", "kept", "kept_qa_id")


@query(_kept_sql("page_id, qa_id"))
def exact_dedup_kept_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.pick_survivors(dedup.exact_groups(_doc_rows(spark, sf_dir)), "first_seen").select("qa_id", "kept", "kept_qa_id")


@query(f"WITH {_EXACT.replace('{by}', 'k')}, r AS (SELECT *, row_number() OVER (PARTITION BY first_id ORDER BY length(text) DESC, qa_id) AS rn, first_value(qa_id) OVER (PARTITION BY first_id ORDER BY length(text) DESC, qa_id) AS kept_qa_id FROM g) SELECT qa_id, page_id, 1.0 AS similarity_score, CASE WHEN rn = 1 THEN 'kept' ELSE 'dropped' END AS action, kept_qa_id FROM r")
def dup_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_log(dedup.pick_survivors(dedup.exact_groups(_doc_rows(spark, sf_dir)))).select("qa_id", "page_id", "similarity_score", "action", "kept_qa_id")


@query(f"WITH {_EXACT.replace('{by}', 'k, page_id')} SELECT qa_id, page_id, n AS group_size FROM g")
def dedup_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = dedup.exact_groups(_doc_rows(spark, sf_dir), scope=("page_id",))
    n = g.groupBy("page_id", "group_id").agg(F.count(F.lit(1)).alias("group_size"))
    return g.join(n, ["page_id", "group_id"]).select("qa_id", "page_id", "group_size")


@query(f"WITH {_EXACT.replace('{by}', 'k')}, r AS (SELECT *, row_number() OVER (PARTITION BY first_id ORDER BY length(text) DESC, qa_id) AS rn FROM g) SELECT qa_id FROM keyed WHERE qa_id NOT IN (SELECT qa_id FROM r WHERE rn > 1)")
def dedup_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate(_doc_rows(spark, sf_dir))[0].select("qa_id")


@query(f"WITH {_EXACT.replace('{by}', 'k')}, r AS (SELECT *, row_number() OVER (PARTITION BY first_id ORDER BY length(text) DESC, qa_id) AS rn FROM g), t AS (SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM r WHERE rn > 1) AS removed, (SELECT count(DISTINCT first_id) FROM r) AS exact_groups) SELECT total, removed, exact_groups, CAST(0 AS BIGINT) AS semantic_groups, round(removed * 100.0 / total, 6) AS removed_percent FROM t")
def dedup_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _doc_rows(spark, sf_dir)
    return dedup.dedup_totals(rows, dedup.pick_survivors(dedup.exact_groups(rows))).withColumn("removed_percent", F.round("removed_percent", 6))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def drop_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.pending(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter("quality = 0"), "doc_id").select("doc_id")


@query("SELECT doc_id, 'cached' AS origin FROM labels UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def cache_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, cache = index.with_cache(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    return cache.select("doc_id", F.lit("cached").alias("origin")).unionByName(new.select("doc_id", F.lit("new").alias("origin")))


@query(f"WITH {PAIRS}, w AS (SELECT page_id, qa_id, {WORDS.format('question')} AS s FROM pairs), j AS (SELECT x.page_id, x.qa_id AS a, y.qa_id AS b, len(list_intersect(x.s, y.s)) AS i, len(x.s) + len(y.s) AS n FROM w x JOIN w y ON x.page_id = y.page_id AND x.qa_id < y.qa_id) SELECT page_id, a, b, round(i * 1.0 / (n - i), 9) AS similarity FROM j WHERE i * 1.0 / (n - i) >= 0.05")
def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _pairs(spark, sf_dir).select("page_id", "qa_id", text.word_set("question").alias("words"))
    return similarity.jaccard_pairs(sets, 0.05, ("page_id",), "qa_id").withColumn("similarity", F.round("similarity", 9))


_SETS = "w AS (SELECT source, doc_id, list_sort(" + WORDS.format("text") + ") AS s FROM documents), c AS (SELECT *, min(doc_id) OVER (PARTITION BY source, s) AS rep FROM w)"


@query("WITH " + _SETS + ", r AS (SELECT source, doc_id, s FROM c WHERE rep = doc_id), j AS (SELECT x.source, x.doc_id AS a, y.doc_id AS b, len(list_intersect(x.s, y.s)) AS i, len(x.s) + len(y.s) AS n FROM r x JOIN r y ON x.source = y.source AND x.doc_id < y.doc_id AND least(len(x.s), len(y.s)) >= 0.8 * greatest(len(x.s), len(y.s))) SELECT source, a, b, round(i * 1.0 / (n - i), 9) AS similarity FROM j WHERE i * 1.0 / (n - i) >= 0.8")
def jaccard_pairs_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different sets of words, by the least id that has each; sets_by_source says which documents these stand for."""
    sets = table(spark, sf_dir, "documents").select("source", "doc_id", text.word_set("text").alias("words"))
    return similarity.jaccard_pairs(sets, 0.8, ("source",), "doc_id", expand=False).withColumn("similarity", F.round("similarity", 9))


@query("WITH " + _SETS + " SELECT source, doc_id, rep FROM c WHERE len(s) > 0")
def sets_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = table(spark, sf_dir, "documents").select("source", "doc_id", text.word_set("text").alias("words"))
    return similarity.class_of(sets, ("source",), "doc_id").select("source", F.col("id").alias("doc_id"), "rep")


@query(f"""WITH RECURSIVE {PAIRS}, w AS (SELECT page_id, pair_ord, qa_id, {WORDS.format("question")} AS s FROM pairs),
near AS (SELECT x.page_id, x.pair_ord, y.pair_ord AS earlier FROM w x JOIN w y ON x.page_id = y.page_id AND y.pair_ord < x.pair_ord WHERE len(list_intersect(x.s, y.s)) * 1.0 / (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s))) >= 0.05),
near_list AS (SELECT page_id, pair_ord, list(earlier) AS es FROM near GROUP BY ALL),
walk AS (SELECT page_id, CAST(1 AS BIGINT) AS pair_ord, [CAST(1 AS BIGINT)] AS kept, true AS ok FROM w WHERE pair_ord = 1
  UNION ALL SELECT w.page_id, w.pair_ord, CASE WHEN n.es IS NOT NULL AND list_has_any(n.es, walk.kept) THEN walk.kept ELSE list_append(walk.kept, w.pair_ord) END, NOT (n.es IS NOT NULL AND list_has_any(n.es, walk.kept))
  FROM walk JOIN w ON w.page_id = walk.page_id AND w.pair_ord = walk.pair_ord + 1 LEFT JOIN near_list n ON n.page_id = w.page_id AND n.pair_ord = w.pair_ord)
SELECT w.qa_id, walk.ok AS kept FROM walk JOIN w ON w.page_id = walk.page_id AND w.pair_ord = walk.pair_ord""")
def diversity_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.diverse(_pairs(spark, sf_dir), threshold=0.05).select("qa_id", F.col("similar_to").isNull().alias("kept"))


_COS = "u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), near AS (SELECT x.vec_id AS a, y.vec_id AS b, list_cosine_similarity(x.v, y.v) AS s FROM u x JOIN u y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(x.v, y.v) >= 0.3)"


@query(f"WITH {_COS} SELECT a, b, round(s, 6) AS similarity FROM near")
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.cosine_pairs(table(spark, sf_dir, "embeddings"), 0.3, "vec_id").withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH RECURSIVE {_COS}, nl AS (SELECT b AS id, list(a) AS es FROM near GROUP BY b), ids AS (SELECT vec_id AS id, row_number() OVER (ORDER BY vec_id) AS i FROM embeddings),
walk AS (SELECT i, id, [id] AS kept, id AS leader FROM ids WHERE i = 1
  UNION ALL SELECT x.i, x.id, CASE WHEN n.es IS NOT NULL AND list_has_any(n.es, w.kept) THEN w.kept ELSE list_append(w.kept, x.id) END,
    CASE WHEN n.es IS NOT NULL AND list_has_any(n.es, w.kept) THEN list_min(list_intersect(n.es, w.kept)) ELSE x.id END
  FROM walk w JOIN ids x ON x.i = w.i + 1 LEFT JOIN nl n ON n.id = x.id)
SELECT w.id, w.leader, coalesce(round(s, 6), 1.0) AS similarity FROM walk w LEFT JOIN near ON a = w.leader AND b = w.id""")
def leader_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("vec_id").alias("ord"), "embedding")
    return similarity.leaders(v, 0.3).select("id", "leader", F.round("similarity", 6).alias("similarity"))


@query("WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), n AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM u) SELECT vec_id, round(norm, 6) AS norm, round(v[1] / norm, 6) AS first, round(v[2] / norm, 6) AS second FROM n")
def unit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"), similarity.unit("embedding").alias("u"))
    return v.select("vec_id", F.round(F.sqrt(similarity.dot(F.col("v"), F.col("v"))), 6).alias("norm"), F.round(F.col("u")[0], 6).alias("first"), F.round(F.col("u")[1], 6).alias("second"))


_SPLIT = "r AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY md5('42' || {id}), {id}) AS rn, count(*) OVER (PARTITION BY {by}) AS n FROM {t}), s AS (SELECT *, CASE WHEN rn <= floor(n * CAST(0.9 AS DOUBLE)) THEN 'train' ELSE 'val' END AS split FROM r)"


@query("WITH " + _SPLIT.format(by="lang", id="doc_id", t="documents") + " SELECT doc_id, split FROM s")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(table(spark, sf_dir, "documents"), 0.9, SEED, "lang", "doc_id").select("doc_id", "split")


@query("WITH " + _SPLIT.format(by="1", id="o_orderkey", t="orders") + " SELECT o_orderkey, split FROM s")
def unstratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(table(spark, sf_dir, "orders"), 0.9, SEED, None, "o_orderkey").select("o_orderkey", "split")


@query("WITH " + _SPLIT.format(by="o_orderpriority", id="o_orderkey", t="orders") + " SELECT o_orderpriority, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val FROM s GROUP BY 1")
def split_counts_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.split_counts(split.stratified_split(table(spark, sf_dir, "orders"), 0.9, SEED, "o_orderpriority", "o_orderkey"), "o_orderpriority")


@query("SELECT doc_id FROM documents ORDER BY md5('42' || doc_id), doc_id LIMIT 50")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.sample(table(spark, sf_dir, "documents"), 50, SEED, "doc_id").select("doc_id")


@query("""WITH p AS (SELECT doc_id, source, CASE WHEN regexp_matches(text, '[0-9]') THEN 0 WHEN regexp_matches(text, 'ción') THEN 1 WHEN lang <> 'de' THEN 2 END AS priority FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY priority, doc_id) AS rn FROM p WHERE priority IS NOT NULL) SELECT source, doc_id, CAST(priority AS BIGINT) AS priority FROM r WHERE rn = 1 ORDER BY priority, doc_id LIMIT 10""")
def diverse_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return split.diverse_sample(docs, 10, ["[0-9]", "ción"], F.col("lang") == "de", "source", "text", "doc_id").select("source", "doc_id", F.col("priority").cast("long").alias("priority"))


@query("WITH s AS (SELECT event_id, user_id, value, coalesce(sum(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM events) SELECT event_id, CASE WHEN spent >= 100 THEN 'not_run' WHEN spent + value >= 100 THEN 'crossing' ELSE 'done' END AS status FROM s")
def budget_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.within_budget(table(spark, sf_dir, "events"), 100.0, "event_id", "value", "user_id").select("event_id", "status")


@query("SELECT event_id, round(user_id * (0.003::DOUBLE / 1000) + event_id * (0.015::DOUBLE / 1000), 9) AS cost_usd FROM events")
def call_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.round(generate.cost("user_id", "event_id"), 9).alias("cost_usd"))


def _turn_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct("turn", F.struct("role", F.col("text").alias("content")).alias("t"))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]).alias("turns"))


@query("WITH p AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations), e AS (SELECT *, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END AS want FROM p) SELECT conv_id, 'Wrong role order at position ' || i || ': expected ''' || want || ''', got ''' || role || '''' AS error FROM e WHERE role <> want")
def role_alternation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turn_lists(spark, sf_dir).select("conv_id", F.explode(validate.order_errors(F.col("turns"))).alias("error"))


@query("WITH p AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations) SELECT conv_id, 'Invalid role ''' || role || ''' at conversation ' || i AS error FROM p WHERE role NOT IN ('user', 'assistant') UNION ALL SELECT DISTINCT conv_id, 'Missing ''image'' field' FROM conversations")
def schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.to_json(F.struct(F.col("turns").alias("conversations"), F.lit("x").alias("metadata")))
    return _turn_lists(spark, sf_dir).select("conv_id", F.explode(validate.schema_errors(raw)).alias("error"))


@query("SELECT conv_id, CASE WHEN role = 'user' THEN 'Question too short (' || length(text) || ' chars)' WHEN length(text) < 5 THEN 'Answer too short (' || length(text) || ' chars)' ELSE 'Answer too long (' || length(text) || ' chars)' END AS warning FROM conversations WHERE (role = 'user' AND length(text) < 10) OR (role = 'assistant' AND (length(text) < 5 OR length(text) > 1000))")
def length_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turn_lists(spark, sf_dir).select("conv_id", F.explode(validate.length_warnings(F.col("turns"))).alias("warning"))


@query("WITH p AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations), t AS (SELECT count(*) FILTER (role <> CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END) AS e, count(*) FILTER ((role = 'user' AND length(text) < 10) OR (role = 'assistant' AND (length(text) < 5 OR length(text) > 1000))) AS w FROM p) SELECT e AS n_errors, w AS n_warnings, e = 0 AND w = 0 AS passed FROM t")
def dataset_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _turn_lists(spark, sf_dir).withColumn("errors", validate.order_errors(F.col("turns"))).withColumn("warnings", validate.length_warnings(F.col("turns")))
    return validate.verdict(t, strict=True)


@query("SELECT 'lang' AS field, coalesce(nullif(lang, ''), 'unknown') AS value, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT 'source', coalesce(nullif(source, ''), 'unknown'), count(*) FROM documents GROUP BY ALL")
def distribution_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histograms(table(spark, sf_dir, "documents"), ["lang", "source"])


@query("WITH o AS (SELECT length(text) AS l, row_number() OVER (ORDER BY length(text)) - 1 AS i, count(*) OVER () AS n FROM documents) SELECT min(l) AS n_min, max(l) AS n_max, round(avg(l), 6) AS n_mean, max(l) FILTER (i = n // 2) AS n_median FROM o")
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.length_stats(table(spark, sf_dir, "documents"), "text").withColumn("n_mean", F.round("n_mean", 6))


@query("WITH c AS (SELECT source AS section_id, count(*) FILTER (length(text) > 3000) AS n FROM documents GROUP BY 1) SELECT section_id, n, CASE WHEN n < 5 THEN 'Section ''' || section_id || ''' has only ' || n || ' examples' ELSE 'Section ''' || section_id || ''' has ' || n || ' examples' END AS warning FROM c WHERE n < 5 OR n > 12")
def section_count_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("section_id")).agg(F.count_if(F.length("text") > 3000).alias("n"))
    return validate.section_warnings(c, validate.Limits(max_section=12))


_CONF = "c AS (SELECT l.doc_id, source, (length(text) % 100) / 100.0::DOUBLE AS confidence, CASE WHEN quality = 1 THEN 'text' ELSE 'unknown' END AS content_type FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


def _confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    met = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    return met.select("doc_id", "source", ((F.length("text") % 100) / F.lit(100.0)).alias("confidence"), F.when(F.col("quality") == 1, "text").otherwise("unknown").alias("content_type"))


@query(f"WITH {_CONF} SELECT CASE WHEN confidence >= 0.9 THEN 'high' WHEN confidence >= 0.7 THEN 'medium' ELSE 'low' END AS bucket, count(*) AS n FROM c GROUP BY 1")
def confidence_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.confidence_histogram(_confidence(spark, sf_dir))


@query(f"WITH {_CONF} SELECT doc_id, confidence, content_type FROM c WHERE confidence < 0.7 OR content_type = 'unknown'")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confidence(spark, sf_dir).filter(paths.needs_review("confidence", "content_type")).orderBy("confidence", "doc_id").select("doc_id", "confidence", "content_type")


@query(f"WITH {_CONF} SELECT content_type AS value, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM c GROUP BY 1")
def content_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.counts(_confidence(spark, sf_dir), "content_type").withColumn("percent", F.round("percent", 6))


_ENTRIES = "e AS (SELECT l_returnflag AS section, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS ord, CAST(l_suppkey AS VARCHAR) AS code, 'n' || (l_partkey % 3) AS name, CAST(l_linenumber AS VARCHAR) AS page FROM lineitem)"


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("section"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")).alias("ord"), F.col("l_suppkey").cast("string").alias("code"), F.concat(F.lit("n"), (F.col("l_partkey") % 3).cast("string")).alias("name"), F.col("l_linenumber").cast("string").alias("page"), F.lit(None).cast("string").alias("error"))


@query(f"WITH {_ENTRIES}, f AS (SELECT *, first_value(name) OVER (PARTITION BY section, code ORDER BY ord) AS first_name FROM e) SELECT section, code, first_name AS name, array_to_string(list_sort(list_distinct(list(page))), ',') AS pages, count(*) FILTER (name <> first_name) AS n_warnings FROM f GROUP BY section, code, first_name")
def index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.merge_procedures(_entries(spark, sf_dir)).select("section", "code", "name", F.array_join("pages", ",").alias("pages"), F.size("warnings").cast("long").alias("n_warnings"))


@query(f"WITH {_ENTRIES} SELECT section, page, array_to_string(list_sort(list_distinct(list(code))), ',') AS codes FROM e GROUP BY section, page")
def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.page_to_codes(index.merge_procedures(_entries(spark, sf_dir))).select("section", "page", F.array_join("codes", ",").alias("codes"))


_PATH = "regexp_extract(url, '^(?:[a-z]+:)?(?://[^/?#]*)?([^?#]*)', 1)"


@query(f"SELECT page_id, {_PATH} AS path, CAST(len(list_filter(string_split({_PATH}, '/'), lambda x: x <> '')) AS BIGINT) AS n_parts FROM pages")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", web.url_path("url").alias("path"), F.size(web.path_parts("url")).cast("long").alias("n_parts"))


@query(f"WITH p AS (SELECT page_id, list_filter(string_split({_PATH}, '/'), lambda x: x <> '') AS parts FROM pages), q AS (SELECT page_id, list_filter(list_transform(parts, lambda x: regexp_extract(x, '^([0-9]+)(?:-.*)?$', 1)), lambda x: x <> '') AS nums, list_filter(parts, lambda x: x NOT IN ('forum', 'forums', 'threads', 'thread')) AS slugs FROM p) SELECT page_id, coalesce(nums[1], slugs[-1], '') AS id FROM q")
def url_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", web.id_from_url("url").alias("id"))


@query("SELECT page_id, 'https://forum.example.org' || CASE WHEN regexp_extract(url, '^[a-z]+://[^/?#]*(.*)', 1) LIKE '/%' THEN '' ELSE '/sub/' END || regexp_extract(url, '^[a-z]+://[^/?#]*(.*)', 1) AS resolved FROM pages WHERE regexp_extract(url, '^[a-z]+://[^/?#]*(.*)', 1) <> ''")
def resolve_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://[^/?#]*(.*)", 1).alias("rest")).filter("rest <> ''")
    return rest.select("page_id", web.resolve_url("rest", "https://forum.example.org/sub").alias("resolved"))


@query("""SELECT page_id, CAST(i - 1 AS INTEGER) AS n, hrefs[i] AS href, trim(regexp_replace(replace(titles[i], '&amp;', '&'), '\\s+', ' ', 'g')) AS title FROM (SELECT page_id, hrefs, titles, unnest(range(1, len(hrefs) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href=["'']?([^"''>]*)["'']?[^>]*>([^<]*)</a>', 1) AS hrefs, regexp_extract_all(html, '<a [^>]*href=["'']?([^"''>]*)["'']?[^>]*>([^<]*)</a>', 2) AS titles FROM pages))""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.links_of(table(spark, sf_dir, "pages"), keep=["page_id"])


@query("""SELECT page_id, CAST(i - 1 AS INTEGER) AS n, hrefs[i] AS href FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href=["'']?([^"''>]*)["'']?[^>]*>', 1) AS hrefs FROM pages))""")
def page_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.links_of(table(spark, sf_dir, "pages"), keep=["page_id"]).select("page_id", "n", "href")


@query("WITH f AS (SELECT page_id, url, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM pages) SELECT page_id, url FROM f WHERE rn = 1")
def distinct_urls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_by(table(spark, sf_dir, "pages"), "url", ["page_id"]).select("page_id", "url")


@query("SELECT page_id, page_id || '_0_' || substr(md5(url), 1, 8) || CASE WHEN lower(regexp_extract(" + _PATH + ", '(\\.[^./]+)$', 1)) IN ('.jpg', '.jpeg', '.png', '.gif', '.webp') THEN lower(regexp_extract(" + _PATH + ", '(\\.[^./]+)$', 1)) ELSE '.jpg' END AS filename FROM pages")
def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", web.image_filename("url", F.col("page_id").cast("string"), F.lit(0)).alias("filename"))


@query("SELECT c_custkey, lower(regexp_replace(c_mktsegment, '[^A-Za-z]', '', 'g')) || '-' || c_custkey AS slug, CASE WHEN c_custkey < 10 THEN c_name || '-q0' || c_custkey ELSE c_name || '-q' || c_custkey END AS qa_id FROM customer")
def ids_and_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", paths.section_slug(F.concat("c_mktsegment", F.lit(" - "), F.col("c_custkey").cast("string"))).alias("slug"), paths.numbered_id("c_name", "c_custkey").alias("qa_id"))


@query(f"WITH {PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY md5('42' || qa_id), qa_id) AS rn, count(*) OVER (PARTITION BY page_id) AS n FROM pairs) SELECT qa_id, question AS user_text, answer AS assistant_text, CASE WHEN rn <= floor(n * CAST(0.9 AS DOUBLE)) THEN 'train' ELSE 'val' END AS split FROM r")
def emit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pairs(spark, sf_dir).withColumns({"image_path": F.lit(None).cast("string"), "section_id": F.col("page_id"), "section_name": F.lit(""), "source_type": F.lit(""), "content_type": F.lit("")})
    out = emit.emit_records(split.stratified_split(rows, 0.9, SEED, "section_id"))
    return out.select(F.col("metadata.qa_id").alias("qa_id"), F.col("conversations")[0]["content"].alias("user_text"), F.col("conversations")[1]["content"].alias("assistant_text"), "split")


@query(f"WITH {PAIRS}, {VERDICT} SELECT page_id, count(*) FILTER (filter_name IS NULL) AS n_pairs FROM marked GROUP BY page_id")
def rebuild_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _marked(spark, sf_dir)
    docs = m.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct(F.col("qa_id").alias("id"), "question", "answer", "question_type"))).alias("qa_pairs"))
    return emit.nest_pairs(docs, m.filter("filter_name is null")).select("page_id", F.size("qa_pairs").cast("long").alias("n_pairs"))


@query("SELECT count(*) AS tested, count(*) FILTER (quality = toxic) AS correct, round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM labels")
def classifier_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.accuracy(table(spark, sf_dir, "labels"), "quality", "toxic").withColumn("accuracy", F.round("accuracy", 9))


@query("WITH g AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rn FROM lineitem) SELECT l_orderkey, l_linenumber FROM g WHERE rn = 1")
def top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.top_per_group(table(spark, sf_dir, "lineitem"), "l_orderkey", 1, [F.col("l_extendedprice").desc(), "l_linenumber"]).select("l_orderkey", "l_linenumber")


@query("WITH o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || '-q' || CASE WHEN n < 10 THEN '0' ELSE '' END || n AS qa_id FROM o")
def number_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumn("page_id", F.col("conv_id").cast("string"))
    return generate.number_pairs(rows, "page_id", "turn").select("conv_id", "turn", "qa_id")


@query("SELECT doc_id, CASE WHEN lang LIKE 'e%' THEN 'Matches skip pattern: e*' WHEN source IN ('src0', 'src1') THEN 'Content type ''' || source || ''' is in skip list' END AS reason FROM documents")
def skip_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", rules.skip_reason(F.lit(False), "lang", "source", ("e*",), ("src0", "src1")).alias("reason"))


@query(f"WITH {PAIRS} SELECT qa_id, length(question) >= 10 AND length(answer) >= 5 AS valid FROM pairs")
def generation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.route_generated(_pairs(spark, sf_dir)).select("qa_id", "valid")


@query("SELECT lang AS forum_id, count(*) AS n FROM documents GROUP BY 1")
def threads_per_forum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.threads_per_forum(table(spark, sf_dir, "documents").withColumn("forum_id", F.col("lang")))


def queries() -> dict[str, Query]:
    """All queries of the library: those of this module and of those that register theirs beside it."""
    for module in ("curation_queries", "file_queries", "web_queries"):
        import_module(f"{__package__}.{module}")
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)

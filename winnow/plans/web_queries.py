"""Queries over addresses and forum pages, which are made from the driver's tables and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import web
from ..operators import crawl, fetch, forum, html
from .registry import query, table

BASE = "https://x.org"


def _text(*parts: Column | str) -> Column:
    """Columns and plain pieces of text, joined."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _joined(rows: DataFrame, by: str, order: str, piece: Column, head: str = "", foot: str = "") -> DataFrame:
    """(by, html): the pieces of each group, in order, between a head and a foot."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("p"))))
    return rows.groupBy(by).agg(F.concat(F.lit(head), F.array_join(F.transform(items, lambda x: x["p"]), ""), F.lit(foot)).alias("html"))


# --- addresses, counts, dates ------------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS id FROM orders")
def url_id_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    url = F.when(F.col("o_orderkey") % 7 == 0, "https://x.org/about").when(F.col("o_orderkey") % 2 == 0, _text("https://x.org/threads/", F.col("o_orderkey"), "-some-title/page2")).otherwise(_text("https://x.org/f/", F.col("o_custkey"), "-name"))
    return o.select("o_orderkey", web.id_after(url).alias("id"))


@query("SELECT o_orderkey, o_orderkey % 5 <> 0 AND (o_orderkey % 3 = 0 OR o_custkey > 1000) AS is_thread FROM orders")
def thread_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    url = _text("https://x.org/", F.when(k % 3 == 0, "a/b/c/").otherwise("f/"), F.col("o_custkey"), F.when(k % 5 == 0, "").otherwise("-title"))
    return table(spark, sf_dir, "orders").select("o_orderkey", web.looks_like_thread(url).alias("is_thread"))


_SOURCES = ("https://x/emoji/1.png", "/SMILies/a.png", "x/icon.jpg", "avatar-1.png", "/misc/z.png", "/images/buttons/q.png", "a.GIF", "photo.jpg")


@query("SELECT p_partkey, p_partkey % 8 <> 7 AS is_symbol FROM part")
def symbol_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = F.element_at(F.array(*[F.lit(s) for s in _SOURCES]), (F.col("p_partkey") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", web.is_symbol(src).alias("is_symbol"))


@query("SELECT p_partkey, CAST(CASE p_partkey % 5 WHEN 0 THEN p_partkey * 1000 + 500 WHEN 1 THEN p_partkey * 1000 + 500 WHEN 2 THEN p_partkey * 1000000 ELSE 0 END AS BIGINT) AS plain, CAST(CASE p_partkey % 5 WHEN 0 THEN p_partkey * 1000 + 500 WHEN 1 THEN p_partkey * 1000 + 500 WHEN 2 THEN p_partkey * 1000000 WHEN 3 THEN p_partkey ELSE 0 END AS BIGINT) AS labelled FROM part")
def counts_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    said = F.when(k % 5 == 0, _text(k, ",500")).when(k % 5 == 1, _text(" ", k, ".5k")).when(k % 5 == 2, _text(k, "M ")).when(k % 5 == 3, _text(k, " replies")).otherwise("none")
    return table(spark, sf_dir, "part").select("p_partkey", web.parse_count(said).alias("plain"), web.parse_count(said, labelled=True).alias("labelled"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN 'about ' || strftime(CAST(o_orderdate AS DATE), '%Y') ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%dT00:00:00') END AS found FROM orders")
def dates_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    said = F.lit(None).cast("string")
    for k, form in enumerate(web.DATE_FORMATS):
        said = F.when(F.col("o_orderkey") % 6 == k, F.concat(F.lit(" "), F.date_format(day, form))).otherwise(said)
    said = F.when(F.col("o_orderkey") % 6 == 5, _text("about \n ", F.date_format(day, "yyyy"))).otherwise(said)
    return table(spark, sf_dir, "orders").select("o_orderkey", web.parse_date(said).alias("found"))


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'https://x.org/f/' || p_partkey WHEN 1 THEN 'https://x.org/' || p_partkey WHEN 2 THEN 'https://x.org/f/g/b/' || p_partkey || '?q=..' WHEN 3 THEN 'https://y.org/' || p_partkey WHEN 4 THEN 'mailto:' || p_partkey ELSE 'https://x.org/f/g/#' || p_partkey END AS resolved FROM part")
def urls_with_dots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    href = F.when(k % 6 == 0, _text("../", k)).when(k % 6 == 1, _text("/a/./b/../../", k)).when(k % 6 == 2, _text("a/../b//", k, "?q=..")).when(k % 6 == 3, _text("//y.org/", k)).when(k % 6 == 4, _text("mailto:", k)).otherwise(_text("#", k))
    return table(spark, sf_dir, "part").select("p_partkey", web.resolve_url(href, "https://x.org/f/g").alias("resolved"))


# --- forum pages -------------------------------------------------------------------------------


@query("SELECT n_regionkey AS page, CAST(n_nationkey AS VARCHAR) AS forum_id, n_name AS title, 'https://x.org/forum/' || n_nationkey || '-' || lower(n_name) AS url, 'About ' || n_name AS description FROM nation WHERE n_nationkey % 5 <> 4")
def forum_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each region links each nation twice; one whose first link has no title counts as seen, and is left out. A thread's link is no forum."""
    k, name = F.col("n_nationkey"), F.col("n_name")
    link = lambda title: F.concat(_text('<a href="/forum/', k, "-", F.lower(name), '">'), title, F.lit("</a>"))
    piece = F.concat(F.lit("<div>"), link(F.when(k % 5 == 4, " ").otherwise(name)), _text('<p class="forum-desc">About ', name, "</p></div>"), link(F.lit("again")), F.lit('<a href="/forum/1-a/20000-thread">thread</a>'))
    pages = _joined(table(spark, sf_dir, "nation"), "n_regionkey", "n_nationkey", piece).withColumnRenamed("n_regionkey", "page")
    return forum.forums_of(pages, BASE, keep=["page"]).drop("parent_id")


@query("SELECT n_regionkey AS page, CAST(n_nationkey AS VARCHAR) AS forum_id, n_name AS title, 'https://x.org/forum/' || n_nationkey || '-x' AS url, CAST(n_regionkey AS VARCHAR) AS parent_id FROM nation WHERE n_nationkey <> n_regionkey")
def forum_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    piece = _text('<div class="subforum-item"><a href="/forum/', F.col("n_nationkey"), '-x">', F.col("n_name"), '</a></div><div class="b-channel__title"><a href="/members/', F.col("n_nationkey"), '-y">no forum</a></div>')
    pages = _joined(table(spark, sf_dir, "nation"), "n_regionkey", "n_nationkey", piece).withColumnRenamed("n_regionkey", "page").withColumn("forum_id", F.col("page").cast("string"))
    return forum.subforums_of(pages, BASE, keep=["page"]).drop("description")


def _thread_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forum page for each nation, with its customers as threads: in boxes, or every third nation as plain links."""
    k, seg = F.col("c_custkey"), F.lower("c_mktsegment")
    title = F.when((F.col("c_nationkey") % 3 == 0) & (k % 7 == 0), "abc").otherwise(F.col("c_name"))
    link = F.concat(_text('<a href="/threads/', k, "-", seg, '">'), title, F.lit("</a>"))
    classes = F.concat(F.lit("b-post threadbit"), F.when(k % 4 == 0, " sticky").otherwise(""), F.when(k % 6 == 0, " locked").otherwise(""))
    box = F.concat(F.lit('<div class="'), classes, _text('" id="thread_', k, '"><div class="b-post__title">'), link, _text('</div><a class="username" href="/members/', k, '-u">User ', k, "</a><div class='b-post__stats'><span>", k, " replies</span><span>1,234 views</span></div></div>"))
    return _joined(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey", F.when(F.col("c_nationkey") % 3 == 0, F.concat(F.lit("<p>"), link, link, F.lit("</p>"))).otherwise(box)).withColumn("forum_id", F.col("c_nationkey").cast("string"))


@query("SELECT CAST(c_nationkey AS VARCHAR) AS forum_id, CAST(c_custkey AS VARCHAR) AS thread_id, c_name AS title, 'https://x.org/threads/' || c_custkey || '-' || lower(c_mktsegment) AS url, CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE 'User ' || c_custkey END AS author, CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS author_id, CAST(0 AS BIGINT) AS reply_count, CAST(0 AS BIGINT) AS view_count, c_nationkey % 3 <> 0 AND c_custkey % 4 = 0 AS is_sticky, c_nationkey % 3 <> 0 AND c_custkey % 6 = 0 AS is_locked FROM customer WHERE NOT (c_nationkey % 3 = 0 AND c_custkey % 7 = 0)")
def forum_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled counts read as 0, as they always did."""
    return forum.threads_of(_thread_pages(spark, sf_dir), BASE)


@query("""SELECT CAST(o_custkey AS VARCHAR) AS thread_id, CAST(o_orderkey AS VARCHAR) AS post_id, 'Cust ' || o_custkey AS author, CAST(o_custkey AS VARCHAR) AS author_id,
'Total <' || o_orderstatus || '> & moreQ ' || o_orderkey AS content_text, '<div class="b-post__content">Total &lt;' || o_orderstatus || '&gt; &amp; more<img src="/img/' || o_orderkey || '.jpg"/><img src="/smilies/' || o_orderkey || '.png"/><blockquote>Q ' || o_orderkey || '</blockquote></div>' AS content_html,
CASE WHEN o_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%dT00:00:00') END AS created_at, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS post_number,
row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 AS is_first_post, 'https://x.org/img/' || o_orderkey || '.jpg' AS images, 'Q ' || o_orderkey AS quotes FROM orders""")
def thread_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each customer with its orders as posts."""
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    when = F.when(k % 2 == 0, _text('<time datetime="', F.date_format(day, "yyyy-MM-dd"), '">then</time>')).otherwise(_text("<time>", F.date_format(day, "MMM d, yyyy"), "</time>"))
    body = _text('<div class="b-post__content">Total &lt;', F.col("o_orderstatus"), '&gt; &amp; more<img src="/img/', k, '.jpg"><img src="/smilies/', k, '.png"><blockquote>Q ', k, "</blockquote></div>")
    piece = F.concat(_text('<div class="b-post" data-post-id="', k, '"><a class="username" href="/members/', F.col("o_custkey"), '-m">Cust ', F.col("o_custkey"), "</a>"), when, body, F.lit("</div>"))
    pages = _joined(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", piece).withColumn("thread_id", F.col("o_custkey").cast("string"))
    out = forum.posts_of(pages, BASE)
    return out.withColumns({"images": F.array_join("images", "|"), "quotes": F.array_join("quotes", "|")})


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey % 9 + 1 AS INTEGER) WHEN 1 THEN CAST(c_custkey % 7 + 1 AS INTEGER) ELSE 1 END AS current_page,
CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey % 9 + 2 AS INTEGER) WHEN 1 THEN CAST(greatest(2, c_custkey % 11 + 1) AS INTEGER) ELSE 1 END AS total_pages, c_custkey % 3 <> 2 AS has_next, c_custkey % 3 = 0 AS has_prev,
CASE c_custkey % 3 WHEN 0 THEN 'https://x.org/threads/' || c_custkey || '-x/page' || (c_custkey % 9 + 2) WHEN 1 THEN 'https://x.org/threads/' || c_custkey || '/n' ELSE '' END AS next_url, CASE WHEN c_custkey % 3 = 0 THEN 'https://x.org/threads/' || c_custkey || '-x' ELSE '' END AS prev_url FROM customer""")
def thread_pagination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose head names the next one, pages with a pager, and pages without either."""
    k = F.col("c_custkey")
    head = _text('<link rel="next" href="/threads/', k, "-x/page", k % 9 + 2, '"><link rel="prev" href="/threads/', k, '-x">')
    pager = _text('<div class="pagenav"><strong>', k % 7 + 1, '</strong><a href="?page=2">2</a><a href="?page=x">', k % 11 + 1, '</a><a class="next" href="/threads/', k, '/n">Next</a></div>')
    pages = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 3 == 0, head).when(k % 3 == 1, pager).otherwise("<p>one page</p>").alias("html"))
    return forum.pagination_of(pages, BASE, keep=["c_custkey"])


# --- trees, links, walks -----------------------------------------------------------------------

_FORUMS = "f AS (SELECT CAST(p_partkey AS VARCHAR) AS forum_id, CASE WHEN p_partkey = 0 THEN NULL WHEN p_partkey % 500 = 499 THEN CAST(p_partkey AS VARCHAR) ELSE CAST((p_partkey - 1) // 2 AS VARCHAR) END AS parent_id FROM part), t AS (SELECT forum_id, 0 AS depth FROM f WHERE parent_id IS NULL UNION ALL SELECT f.forum_id, t.depth + 1 FROM t JOIN f ON f.parent_id = t.forum_id)"


def _forums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of two children a node; every 500th node is its own parent, and its subtree hangs on no top."""
    k = F.col("p_partkey")
    parent = F.when(k == 0, F.lit(None)).when(k % 500 == 499, k).otherwise(F.floor((k - 1) / 2)).cast("string")
    return table(spark, sf_dir, "part").select(k.cast("string").alias("forum_id"), parent.alias("parent_id"))


@query(f"WITH RECURSIVE {_FORUMS} SELECT f.forum_id, coalesce(t.depth, -1) AS depth, CASE WHEN t.depth IS NOT NULL THEN '0' END AS root_id FROM f LEFT JOIN t USING (forum_id)")
def flat_forums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.flatten_forums(_forums(spark, sf_dir)).select("forum_id", F.coalesce("depth", F.lit(-1)).alias("depth"), "root_id")


@query(f"WITH RECURSIVE {_FORUMS} SELECT depth, count(*) AS n FROM t GROUP BY 1")
def forums_by_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.flatten_forums(_forums(spark, sf_dir)).filter("depth is not null").groupBy("depth").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS forum_id, CASE WHEN c_nationkey % 2 = 0 THEN 'https://x.org/known/' || c_nationkey ELSE 'https://x.org/forum/' || c_nationkey END AS url FROM customer")
def forum_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("forum_id"), _text("https://x.org/known/", F.col("n_nationkey")).alias("url"))
    ids = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("forum_id")).distinct()
    return crawl.forum_urls(ids, known, BASE + "/")


@query("SELECT l_orderkey AS thread_id, l_linenumber, l_partkey, o_orderpriority AS thread_title FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def posts_with_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("thread_id"), "l_linenumber", "l_partkey")
    return crawl.with_thread_titles(posts, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("thread_id"), F.col("o_orderpriority").alias("title")))


@query("WITH e AS (SELECT event_id, 'u' || user_id || '.png' AS url, 0 AS i FROM events UNION ALL SELECT event_id, 'v' || (event_id % 50) || '.txt', 1 FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id, i) AS rn FROM e) SELECT url, event_id AS post_id, CAST(i AS INTEGER) AS index, event_id || '_' || i || '_' || substr(md5(url), 1, 8) || CASE WHEN i = 0 THEN '.png' ELSE '.jpg' END AS filename FROM r WHERE rn = 1")
def first_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = F.array(_text("u", F.col("user_id"), ".png"), _text("v", F.col("event_id") % 50, ".txt"))
    posts = table(spark, sf_dir, "events").select(F.col("event_id").alias("post_id"), F.col("user_id").alias("thread_id"), F.lit(1).alias("forum_id"), images.alias("images"))
    return crawl.distinct_images(posts, order=("post_id",)).select("url", "post_id", "index", "filename")


@query("WITH RECURSIVE l AS (SELECT c_custkey AS src, c_custkey * 2 AS dst FROM customer UNION ALL SELECT c_custkey, c_custkey * 3 + 1 FROM customer UNION ALL SELECT c_custkey, c_custkey // 2 FROM customer), w AS (SELECT CAST(7 AS BIGINT) AS url, 0 AS depth UNION SELECT l.dst, w.depth + 1 FROM w JOIN l ON l.src = w.url WHERE w.depth < 3) SELECT url, min(depth) AS depth FROM w GROUP BY 1")
def pages_in_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    links = table(spark, sf_dir, "customer").select(k.alias("src"), F.explode(F.array(k * 2, k * 3 + 1, F.floor(k / 2))).alias("dst"))
    return crawl.reachable(spark.createDataFrame([(7,)], "url bigint"), links, 3)


@query("SELECT CAST(c_custkey % 25 AS VARCHAR) AS start, CAST(c_custkey // 25 + 1 AS INTEGER) AS n, CAST(c_custkey AS VARCHAR) AS url FROM customer WHERE c_custkey < 150")
def followed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each of 25 pages to the next of its thread; one thread's last page leads back to its first."""
    k = F.col("c_custkey")
    pages = table(spark, sf_dir, "customer").filter("c_custkey < 150").select(k.cast("string").alias("url"), F.when(k < 125, k + 25).when(k % 25 == 3, 3).cast("string").alias("next_url"))
    return fetch.follow(pages.filter(F.col("url").cast("int") < 25), lambda urls: urls.join(pages, "url"))


def half_down(url: str, proxy: str | None) -> str:
    """A stand-in for a network that never answers for addresses in 5 and 0."""
    if url[-1] in "05":
        raise OSError("down")
    return f"<p>{url}</p>"


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN '<p>/p/' || s_suppkey || '</p>' END AS html, CAST(CASE WHEN s_suppkey % 5 = 0 THEN 3 ELSE 1 END AS INTEGER) AS attempts, CASE WHEN s_suppkey % 5 = 0 THEN 'OSError: down' END AS error FROM supplier")
def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "supplier").select("s_suppkey", _text("/p/", F.col("s_suppkey")).alias("url"))
    return fetch.fetch(urls, half_down, per_second=1e6, retries=2, pause=0.0, proxies=("a", "b")).drop("url")


# --- specification tables ----------------------------------------------------------------------


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part), q AS (
SELECT p_brand, n, 1 AS v, 'What is the ' || lower(p_name || ' ' || p_partkey) || ' for the Test Car 325is?' AS question, CAST(p_size AS VARCHAR) || ' mm' AS answer FROM r
UNION ALL SELECT p_brand, n, 2, 'What is the ' || lower(p_name || ' ' || p_partkey) || '?', 'The ' || lower(p_name || ' ' || p_partkey) || ' for the Test Car 325is is ' || p_size || ' mm.' FROM r
UNION ALL SELECT p_brand, n, 3, 'What is the ' || lower(p_type) || ' ' || lower(p_name || ' ' || p_partkey) || ' specification?', CAST(p_size AS VARCHAR) || ' mm' FROM r WHERE p_partkey % 4 <> 0),
m AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n, v) AS i FROM q) SELECT 'html-' || lower(p_brand) || '-325is-techspec' AS page_id, 'html-' || lower(p_brand) || '-325is-techspec-q' || CASE WHEN i < 10 THEN '0' ELSE '' END || i AS id, question, answer FROM m""")
def spec_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each brand, with its parts in a table of category, name, value and unit; every fourth category is General."""
    k = F.col("p_partkey")
    row = _text("<tr><td>", F.when(k % 4 == 0, "General").otherwise(F.col("p_type")), "</td><td>", F.col("p_name"), " ", k, "</td><td>", F.col("p_size"), "</td><td> mm </td></tr>")
    pages = _joined(table(spark, sf_dir, "part"), "p_brand", "p_partkey", row, "<table><tr><th>Category</th><th>Specification</th><th>Value</th></tr><tr><td>x</td><td>Item</td><td>skip</td></tr><tr><td>x</td><td>Blank</td><td> </td></tr>", "</table><table><tr><td>lone</td><td>row</td></tr></table>")
    docs = html.html_documents(pages.withColumn("path", F.concat(F.lit("specs/"), "p_brand", F.lit("-325is-techspec.html"))), "Test Car")
    return docs.select("page_id", F.inline("qa_pairs")).select("page_id", "id", "question", "answer")


@query("SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS n, CASE WHEN p_partkey % 4 = 0 THEN 'General' ELSE p_type END AS category, p_name AS spec_name, p_size || ' mm' AS spec_value FROM part")
def spec_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = _text("<tr><td>", F.when(F.col("p_partkey") % 4 == 0, "General").otherwise(F.col("p_type")), "</td><td>", F.col("p_name"), "</td><td>", F.col("p_size"), "</td><td> mm </td></tr>")
    pages = _joined(table(spark, sf_dir, "part"), "p_brand", "p_partkey", row, "<table><tr><th>a</th><th>b</th></tr>", "</table>")
    return html.generate(pages, ["html"], lambda text: [{**r, "n": n} for n, r in enumerate(html.spec_rows(text))], html.SPEC + ", n bigint", ["p_brand"])

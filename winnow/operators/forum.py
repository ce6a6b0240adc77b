"""Forum pages as tables: forums, threads, posts and pagination.

Where forum software puts things is a table of selectors; one pass over the markup finds the
elements, and what they mean (addresses, ids, counts, dates, which of them count) is said in
column expressions over them, so that each rule exists once, in functions.web.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import web
from ..functions.text import let
from .html import Boxes, Part, attr, boxes_of, elements_of, part, text_of

#: Selectors.
FORUM_LINK = "a[href*='/forum/'], a[href*='/forums/'], .b-channel__title a, .forum-title a"
DESCRIPTION = ".forum-desc, .b-channel__description, [class*='description']"
SUBFORUM_LINK = ".b-channel__title a, .subforum-item a, [class*='subforum'] a, .child-forum a"
THREAD_BOX = ".b-post, .thread-item, [class*='threadbit'], tr[id*='thread'], li[class*='thread'], .topic-item"
THREAD_LINK = "a[href*='/threads/'], .thread-title a, .b-post__title a, [class*='title'] a, a.topic-title, a.js-topic-title"
PLAIN_LINK = "a[href*='/threads/']"
THREAD_AUTHOR = ".b-post__author a, .author a, [class*='starter'] a, .username, [class*='author']"
THREAD_STATS = "[class*='count'], [class*='stats'], .b-post__stats span"
POST_BOX = ".b-post, [class*='postbit'], [id*='post_'], .message-container, [data-post-id], article[class*='post']"
POST_ANCHOR = "[id*='post']"
POST_AUTHOR = ".b-post__author a, .username, [class*='author'] a, .postcontent .username, [itemprop='author']"
POST_CONTENT = ".b-post__content, .postcontent, [class*='message-body'], .post-content, [itemprop='text'], .js-post__content-text"
POST_TIME = "time, [class*='date'], .b-post__timestamp, [datetime], .postcontent .date"
QUOTE = "blockquote, .bbcode_quote, [class*='quote']"
PAGER = ".pagination, .b-pagination, [class*='pagenav'], .pageNav, [class*='pager']"
PAGE_INPUT = "input.js-pagenum, input[name='page']"
CURRENT = ".current, [class*='active'], [aria-current='page'], strong, .b-pagination__current"
TOTAL = ".pagetotal, [class*='total']"
LAST = "[class*='last'] a, a[title*='Last']"
NEXT = "a[class*='next']:not(.h-disabled), [class*='next']:not(.h-disabled) a, a[rel='next']:not(.h-disabled), [aria-label*='Next'] a:not(.h-disabled)"
PREVIOUS = "a[class*='prev']:not(.h-disabled), [class*='prev']:not(.h-disabled) a, a[rel='prev']:not(.h-disabled), [aria-label*='Previous'] a:not(.h-disabled)"
#: Characters of a quote that are kept; of the title of a thread that is only a link, more than.
QUOTE_CHARS, LINK_TITLE = 500, 3


def firsts(rows: Column, key: Callable[[Column], Column]) -> Column:
    """Of an array's elements those whose key no earlier one has."""
    return let(rows, lambda r: let(F.transform(r, key), lambda keys: F.filter(r, lambda x, i: F.array_position(keys, key(x)) == i + 1)))


def forums_of(pages: DataFrame, base_url: str, html: str = "html", keep: list[str] = ()) -> DataFrame:
    """Forums that index pages link to. An id's first link counts, even one without a title, which is left out."""
    found = elements_of(pages, {"links": Boxes(FORUM_LINK, {"about": Part(DESCRIPTION, around=("div", "li", "tr"))})}, html, keep)
    seen = F.transform("links", lambda b: F.struct(text_of(b["own"]).alias("title"), web.resolve_url(attr(b["own"], "href"), base_url).alias("url"), text_of(part(b, "about")).alias("description")))
    named = F.transform(seen, lambda x: F.struct(web.id_from_url(x["url"]).alias("forum_id"), x["title"].alias("title"), x["url"].alias("url"), x["description"].alias("description"), F.lit(None).cast("string").alias("parent_id")))
    known = F.filter(named, lambda x: (x["forum_id"] != "") & (x["url"] != "") & ~web.looks_like_thread(x["url"]))
    return found.select(*keep, F.inline(F.filter(firsts(known, lambda x: x["forum_id"]), lambda x: x["title"] != "")))


def subforums_of(pages: DataFrame, base_url: str, html: str = "html", forum_id: str = "forum_id", keep: list[str] = ()) -> DataFrame:
    """Forums that a forum's page links to as its own, each id once; the forum itself is left out."""
    found = elements_of(pages.withColumn("__parent", F.col(forum_id)), {"links": Boxes(SUBFORUM_LINK)}, html, [*keep, "__parent"])
    named = F.transform("links", lambda b: F.struct(web.id_from_url(web.resolve_url(attr(b["own"], "href"), base_url)).alias("forum_id"), text_of(b["own"]).alias("title"), web.resolve_url(attr(b["own"], "href"), base_url).alias("url"), F.lit("").alias("description"), F.col("__parent").alias("parent_id")))
    known = F.filter(named, lambda x: x["url"].rlike("/forums?/") & (x["forum_id"] != "") & ~x["forum_id"].eqNullSafe(x["parent_id"]))
    return found.select(*keep, F.inline(firsts(known, lambda x: x["forum_id"])))


def threads_of(pages: DataFrame, base_url: str, html: str = "html", forum_id: str = "forum_id", keep: list[str] = ()) -> DataFrame:
    """Threads of forum pages: those of the listing's boxes; on a page without any, its plain links to threads."""
    box = {"link": Part(THREAD_LINK), "by": Part(THREAD_AUTHOR), "stats": Part(THREAD_STATS, every=True)}
    listing = {"__link": ("link", "@href"), "__title": ("link", "text"), "__by": ("by", "text"), "__by_href": ("by", "@href"), "__stats": ("stats", "text"), "__class": ("", "@class")}
    paged = pages.withColumns({"__forum": F.col(forum_id), "__page": F.expr("uuid()")})
    found = boxes_of(paged, {"listing": Boxes(THREAD_BOX, box), "links": Boxes(PLAIN_LINK)}, {"listing": listing, "links": {"__link": ("", "@href"), "__title": ("", "text")}}, html, [*keep, "__forum", "__page"])
    given = lambda name: F.coalesce(f"__{name}", F.lit(""))
    url = web.resolve_url(given("link"), base_url)
    named = found.withColumns({"__url": url, "__id": web.id_from_url(url)}).filter((F.col("__id") != "") & ((F.col("__kind") == "links") | (F.col("__title") != "")))
    # a page's boxes count where there are any; of its plain links each thread's first does
    page = Window.partitionBy("__page")
    first = F.row_number().over(Window.partitionBy("__page", "__id", "__kind").orderBy("__n")) == 1
    listed = F.max(F.col("__kind") == "listing").over(page)
    chosen = named.withColumns({"__listed": listed, "__first": first}).filter(((F.col("__kind") == "listing") == F.col("__listed")) & (F.col("__listed") | (F.col("__first") & (F.length(given("title")) > LINK_TITLE))))
    said = F.transform(F.coalesce("__stats", F.array().cast("array<string>")), F.lower)
    replies = lambda t: t.contains("repl") | t.contains("post")
    last = lambda test: web.parse_count(F.try_element_at(F.filter(said, test), F.lit(-1)))
    has = lambda *words: F.coalesce(*[F.when(given("class").contains(w), True) for w in words], F.lit(False))
    return chosen.select(
        *keep, F.col("__id").alias("thread_id"), given("title").alias("title"), F.col("__url").alias("url"), F.col("__forum").alias("forum_id"),
        given("by").alias("author"), web.id_from_url(given("by_href")).alias("author_id"),
        last(replies).alias("reply_count"), last(lambda t: t.contains("view") & ~replies(t)).alias("view_count"),
        has("sticky", "pinned").alias("is_sticky"), has("locked", "closed").alias("is_locked"),
    )


def posts_of(pages: DataFrame, base_url: str, html: str = "html", thread_id: str = "thread_id", keep: list[str] = ()) -> DataFrame:
    """Posts of thread pages, numbered from 1."""
    box = {"anchor": Part(POST_ANCHOR), "by": Part(POST_AUTHOR), "body": Part(POST_CONTENT, markup=True), "time": Part(POST_TIME), "images": Part("img", inside="body", every=True), "quotes": Part(QUOTE, inside="body", every=True)}
    values = {"own_id": ("", "@data-post-id"), "box_id": ("", "@id"), "anchor_id": ("anchor", "@id"), "by": ("by", "text"), "by_href": ("by", "@href"), "markup": ("body", "markup"), "body": ("body", "text")}
    values |= {"datetime": ("time", "@datetime"), "title": ("time", "@title"), "when": ("time", "text"), "src": ("images", "@src"), "data_src": ("images", "@data-src"), "quoted": ("quotes", "text")}
    found = boxes_of(pages.withColumn("__thread", F.col(thread_id)), {"posts": Boxes(POST_BOX, box)}, {"posts": {f"__{k}": v for k, v in values.items()}}, html, [*keep, "__thread"])
    bare = lambda c: F.replace(F.replace(c, F.lit("post_"), F.lit("")), F.lit("post"), F.lit(""))
    some = lambda *options: F.coalesce(*[F.nullif(o, F.lit("")) for o in options], F.lit(""))
    sources = F.zip_with("__src", "__data_src", lambda a, b: some(a, b))
    shown = F.filter(sources, lambda u: (u != "") & ~web.is_symbol(u))
    said = F.coalesce(F.nullif("__datetime", F.lit("")), F.nullif("__title", F.lit("")))
    return found.select(
        *keep, some("__own_id", bare("__box_id"), bare("__anchor_id"), F.concat_ws("_", "__thread", "__n")).alias("post_id"), F.col("__thread").alias("thread_id"),
        F.coalesce("__by", F.lit("")).alias("author"), web.id_from_url(F.coalesce("__by_href", F.lit(""))).alias("author_id"), F.coalesce("__markup", F.lit("")).alias("content_html"), F.coalesce("__body", F.lit("")).alias("content_text"),
        F.when(said.isNotNull(), said).otherwise(web.parse_date(F.coalesce("__when", F.lit("")))).alias("created_at"), (F.col("__n") + 1).alias("post_number"), (F.col("__n") == 0).alias("is_first_post"),
        F.transform(shown, lambda u: web.resolve_url(u, base_url)).alias("images"), F.filter(F.transform("__quoted", lambda q: F.substring(q, 1, QUOTE_CHARS)), lambda q: q != "").alias("quotes"),
    )


def pagination_of(pages: DataFrame, base_url: str, html: str = "html", keep: list[str] = ()) -> DataFrame:
    """One row a page: its number, how many there are, its neighbours' addresses. Links of the page's head count before those of the visible pager."""
    whole = {"head_next": Part("link[rel='next']"), "head_prev": Part("link[rel='prev']"), "pager": Part(PAGER)}
    whole |= {name: Part(selector, inside="pager") for name, selector in (("input", PAGE_INPUT), ("current", CURRENT), ("total", TOTAL), ("last", LAST), ("next", NEXT), ("prev", PREVIOUS))}
    values = {"head_next": ("head_next", "@href"), "head_prev": ("head_prev", "@href"), "next": ("next", "@href"), "prev": ("prev", "@href"), "last": ("last", "@href"), "input": ("input", "text"), "value": ("input", "@value"), "current": ("current", "text"), "total": ("total", "text"), "numbers": ("numbers", "text")}
    found = boxes_of(pages, {"page": Boxes("", whole | {"numbers": Part("a[href]", inside="pager", every=True)})}, {"page": {f"__{k}": v for k, v in values.items()}}, html, keep)
    given = lambda name: F.coalesce(f"__{name}", F.lit(""))
    number = lambda t: F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("int"))
    address = lambda side: F.coalesce(F.nullif(f"__head_{side}", F.lit("")), given(side))
    following = web.page_in_url(given("head_next"))
    said = F.when(F.col("__input").isNotNull(), F.coalesce("__value", F.lit("1"))).otherwise(given("current"))
    current = F.coalesce(number(F.trim(said)), following - 1, F.lit(1))
    total = F.greatest(F.lit(1), following, number(given("total")), F.array_max(F.transform("__numbers", number)), web.page_in_url(given("last")))
    out = found.select(*keep, current.alias("current_page"), total.alias("total_pages"), web.resolve_url(address("next"), base_url).alias("next_url"), web.resolve_url(address("prev"), base_url).alias("prev_url"))
    return out.select(*keep, "current_page", "total_pages", ((F.col("next_url") != "") | (F.col("total_pages") > F.col("current_page"))).alias("has_next"), (F.col("prev_url") != "").alias("has_prev"), "next_url", "prev_url")

"""Forum data as tables: trees, denormalised posts, image manifests, link frontiers over fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.web import image_filename
from ..session import durable


def flatten_forums(forums: DataFrame) -> DataFrame:
    """forums with depth (0 at the top) and root_id, from (forum_id, parent_id) rows, however deep the tree.

    Rows that no top leads to (in a cycle, or below a forum that isn't there) stay, with null depth
    and root_id. One join a level, against the level above; levels are written to the shared folder.
    Levels are joined by sorting, since a broadcast would send each of them through the driver.
    """
    level = durable(forums.filter("parent_id is null").withColumn("depth", F.lit(0)).withColumn("root_id", F.col("forum_id")))
    out, rest, d = level, durable(forums.filter("parent_id is not null")), 0
    while True:
        d += 1
        up = level.groupBy(F.col("forum_id").alias("parent_id")).agg(F.min("root_id").alias("root_id")).hint("merge")
        level = durable(rest.join(up, "parent_id").withColumn("depth", F.lit(d)).select(*out.columns))
        if level.isEmpty():
            return out.unionByName(rest.withColumns({"depth": F.lit(None).cast("int"), "root_id": F.lit(None).cast(out.schema["root_id"].dataType)}))
        out = out.unionByName(level)
        rest = durable(rest.join(up.select("parent_id").hint("merge"), "parent_id", "left_anti").select(*forums.columns))


def forum_urls(ids: DataFrame, forums: DataFrame, base_url: str) -> DataFrame:
    """ids with url: the forum's own, or one built from its id."""
    first = forums.groupBy("forum_id").agg(F.min("url").alias("url"))
    return ids.join(first, "forum_id", "left").withColumn("url", F.coalesce("url", F.concat(F.lit(base_url.rstrip("/") + "/forum/"), "forum_id")))


def with_thread_titles(posts: DataFrame, threads: DataFrame) -> DataFrame:
    first = threads.groupBy("thread_id").agg(F.min("title").alias("thread_title"))
    return posts.join(first, "thread_id")


def pending(items: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    """Items whose key is not completed."""
    return items.join(completed.select(key).distinct(), key, "left_anti")


def distinct_images(posts: DataFrame, order: tuple[str, ...] = ("file", "line")) -> DataFrame:
    """One row per image URL, from the first post that shows it: url, post_id, thread_id, forum_id, index, filename."""
    each = posts.select("post_id", "thread_id", "forum_id", F.struct(*order).alias("o"), F.posexplode("images").alias("index", "url"))
    first = each.withColumn("__rn", F.row_number().over(Window.partitionBy("url").orderBy("o", "index"))).filter("__rn = 1")
    return first.select("url", "post_id", "thread_id", "forum_id", "index", image_filename("url", "post_id", "index").alias("filename"))


def image_manifest(images: DataFrame, downloads: DataFrame) -> DataFrame:
    """url, local_path ('' if not there), post_id, thread_id, forum_id, downloaded."""
    got = downloads.groupBy("url").agg(F.min("local_path").alias("local_path"))
    met = images.join(got, "url", "left")
    return met.select("url", F.coalesce("local_path", F.lit("")).alias("local_path"), "post_id", "thread_id", "forum_id", F.col("local_path").isNotNull().alias("downloaded"))


def manifest_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count(F.lit(1)).alias("total_images"), F.count_if("downloaded").alias("downloaded"), F.count_if(~F.col("downloaded")).alias("failed"))


def threads_per_forum(threads: DataFrame) -> DataFrame:
    return threads.groupBy("forum_id").agg(F.count(F.lit(1)).alias("n"))


def reachable(seeds: DataFrame, links: DataFrame, depth: int = 3) -> DataFrame:
    """(url, depth): pages reached from seed urls over (src, dst) links in at most so many steps, each at its least depth.

    One join a step, against what was found in the step before; found pages are written to the
    shared folder so that a step doesn't repeat the ones before.
    """
    seen = durable(seeds.select("url").distinct().withColumn("depth", F.lit(0)))
    front = seen
    for d in range(1, depth + 1):
        nxt = front.join(links, front.url == links.src).select(F.col("dst").alias("url")).distinct().join(seen.select("url"), "url", "left_anti")
        front = durable(nxt.withColumn("depth", F.lit(d)))
        if front.isEmpty():
            break
        seen = durable(seen.unionByName(front))
    return seen

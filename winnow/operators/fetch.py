"""Fetching behind a narrow interface: pace, retries, a round of proxies, and following pages one after the other.

A fetcher is any picklable callable from (url, proxy) to a page's text; it raises where it can't.
None is bundled: what reaches a network is the caller's.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable

Fetcher = Callable[[str, str | None], str]


def fetch(urls: DataFrame, fetcher: Fetcher, per_second: float = 1.0, retries: int = 3, pause: float = 2.0, proxies: tuple[str, ...] = (), tasks: int = 1, url: str = "url") -> DataFrame:
    """urls with html, attempts and error: what the fetcher returns for each row's url, or its last failure.

    per_second bounds the calls of all tasks together, retries among them: each task keeps to its
    share. A failed call is tried again after pause, 2 * pause and so on, by the next proxy.
    Repeated urls are fetched once for each row; a null url is an error of its row. Rows are dealt
    to `tasks` tasks, as many as may fetch at a time.
    """
    none = F.lit(None).cast("string")
    schema = urls.withColumns({"html": none, "attempts": F.lit(0), "error": none}).schema
    names = [*urls.columns, "html", "attempts", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free, turn = 0.0, 0
        for batch in batches:
            for k, address in enumerate(batch.column(url).to_pylist()):
                html, why, tries = None, "no url", 0
                while address is not None and tries <= retries:
                    time.sleep(max(0.0, free - time.monotonic()))
                    free, tries = time.monotonic() + tasks / per_second, tries + 1
                    try:
                        html, why = fetcher(address, proxies[turn % len(proxies)] if proxies else None), None
                        break
                    except Exception as failure:  # whatever a network does wrong
                        why, turn = f"{type(failure).__name__}: {failure}", turn + 1
                        if tries <= retries:
                            time.sleep(pause * 2 ** (tries - 1))
                one = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([html], pa.string()), pa.array([tries], pa.int32()), pa.array([why], pa.string())], names=names)

    return urls.repartition(tasks).mapInArrow(run, schema)


def follow(starts: DataFrame, load: Callable[[DataFrame], DataFrame], most: int | None = None) -> DataFrame:
    """(start, n, url): the pages that lead on from each start url, by their links to a next one, numbered from 1.

    load turns a table with url into (url, next_url) rows, whether it fetches them or reads pages
    that are there. A page that load has nothing for ends its walk; so does one that the walk has
    been to, and, if most is given, the page of that number. One step for all walks at a time; what
    a step finds is written to the shared folder.
    """
    front = durable(starts.select(F.col("url").alias("start")).distinct().withColumns({"n": F.lit(1), "url": F.col("start")}))
    seen, n = front, 1
    while not front.isEmpty() and (most is None or n < most):
        n += 1
        led = load(front.select("url").distinct()).filter("next_url <> ''").groupBy("url").agg(F.min("next_url").alias("next_url"))
        step = front.join(led, "url").select("start", F.lit(n).alias("n"), F.col("next_url").alias("url"))
        front = durable(step.join(seen.select("start", "url"), ["start", "url"], "left_anti").select("start", "n", "url"))
        seen = durable(seen.unionByName(front))
    return seen

"""Links of pages, the frontier, and a breadth-first crawl over a table of pages."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.markup import links
from corpusmill.session import materialize

BASE = "https://en.wikipedia.org"


def links_of(pages: DataFrame, key: str, base: str = BASE) -> DataFrame:
    """key, pos, url: links to articles of each page (key, text), in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [links(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=[key, "hrefs"])

    kind = pages.schema[key].dataType.simpleString()
    read = pages.select(key, "text").mapInArrow(run, f"`{key}` {kind}, hrefs array<string>")
    return read.select(key, F.posexplode("hrefs").alias("pos", "href")).select(key, "pos", F.concat(F.lit(base), "href").alias("url"))


def is_article(url: str = "url", base: str = BASE):
    """Whether an address is of an article under `base`: no list, no main page, no namespace."""
    path = F.substring(F.col(url), F.lit(len(base) + 1), F.length(url))
    return F.col(url).startswith(base + "/wiki/") & ~path.startswith("/wiki/List_of") & ~path.startswith("/wiki/Main_Page") & ~path.contains(":")


def next_links(found: DataFrame, known: DataFrame, base: str = BASE) -> DataFrame:
    """url, seq: addresses to be crawled, each at its first seq, without those in `known` (url)."""
    first = found.where(is_article("url", base)).groupBy("url").agg(F.min("seq").alias("seq"))
    return first.join(known.select("url").distinct(), "url", "left_anti")


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """`rows` with rank: 0, 1, ... by `order`, without bringing them to one task."""
    from pyspark import TaskContext

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(batch), pa.int32()), pa.array(range(at, at + len(batch)), pa.int64())], names=[*batch.schema.names, "_part", "rank"])
            at += len(batch)

    schema = T.StructType([*rows.schema, T.StructField("_part", T.IntegerType()), T.StructField("rank", T.LongType())])
    local = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema), "ranks")
    sizes = local.groupBy("_part").count().orderBy("_part").collect()  # one row for each partition
    before, shift = 0, []
    for part, n in sizes:
        shift.append((part, before))
        before += n
    offsets = local.sparkSession.createDataFrame(shift, "_part int, _before long")
    return local.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("rank") + F.col("_before")).drop("_part", "_before")


def crawl(spark: SparkSession, pages: DataFrame, seeds: list[str] | DataFrame, max_pages: int, base: str = BASE, visited: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(crawled, queue) of a breadth-first crawl: crawled has url, level and rank, queue has url and rank.

    `pages` has url (unique), text and http_status; an address that is not there is not found. Only pages of status 200
    count and are read for links; a status of 429 stops the crawl, and that address is lost; others are dropped. With
    `visited` and a frame of addresses (url, rank) as seeds a crawl goes on where it ended. Each level is one step over
    all its addresses; an address found twice stands where it was found first.
    """
    if isinstance(seeds, list):
        if not seeds:
            raise ValueError("a crawl needs seeds")
        seeds = spark.createDataFrame([(u, k) for k, u in enumerate(dict.fromkeys(seeds))], "url string, rank long")
    queue = materialize(seeds.select("url", "rank"), "queue")
    known = queue.select("url") if visited is None else queue.select("url").unionByName(visited.select("url"))
    done = spark.createDataFrame([], "url string, level int, rank long")
    left, level = max_pages, 0
    while left > 0 and queue.limit(1).count():
        answers = materialize(queue.join(pages.select("url", "http_status"), "url", "left"), "answers")
        refused = answers.where("http_status = 429").agg(F.min("rank")).first()[0]
        good = answers.where("http_status = 200")
        if refused is not None:
            good = good.where(F.col("rank") < refused)
        n = good.count()
        last = None
        if n >= left:
            last = good.orderBy("rank").limit(left).agg(F.max("rank")).first()[0]
            good, n = good.where(F.col("rank") <= last), left
        done = materialize(done.unionByName(good.select("url", F.lit(level).alias("level"), "rank")), "crawled")
        stop = last if last is not None else refused
        waiting = queue.where(F.col("rank") > stop) if stop is not None else queue.where(F.lit(False))
        found = links_of(pages.join(good.select("url", "rank"), "url").select("rank", "text"), "rank", base)
        first = found.groupBy("url").agg(F.min(F.struct("rank", "pos")).alias("at")).join(known, "url", "left_anti")
        fresh = ranked(materialize(first, "found"), "at").select("url", "rank")
        top = queue.agg(F.max("rank")).first()[0]
        fresh = fresh.withColumn("rank", F.col("rank") + F.lit((top or 0) + 1))
        queue = materialize(waiting.unionByName(fresh), "queue")
        known = materialize(known.unionByName(fresh.select("url")), "known")
        left, level = left - n, level + 1
        if refused is not None and last is None:
            break
    return done, queue

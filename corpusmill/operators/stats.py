"""Counts of characters and lengths, and search by a predicate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The quotation marks, primes and dashes that the character report is about.
REPORT = "\"'“”‘’″′-–—−"


def texts_of(pages: DataFrame) -> DataFrame:
    """url, idx, text of each section that is not null."""
    return pages.select("url", F.posexplode("text_list").alias("idx", "text")).where("text is not null")


def char_counts(pages: DataFrame | list[DataFrame], chars: str | list[str] = REPORT) -> DataFrame:
    """ch, code, n: how often each of `chars` occurs in all texts; 0 for those that do not. Several inputs are summed up."""
    for p in (pages := pages if isinstance(pages, list) else [pages])[1:]:
        pages[0] = pages[0].select("text_list").unionByName(p.select("text_list"))
    chars = list(dict.fromkeys(chars))
    text = F.concat_ws("", "text_list")
    sums = pages[0].agg(*(F.coalesce(F.sum(F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))), F.lit(0)).alias(f"c{k}") for k, c in enumerate(chars)))
    rows = F.array(*(F.struct(F.lit(c).alias("ch"), F.lit(f"U+{ord(c):X}").alias("code"), F.col(f"c{k}").cast("long").alias("n")) for k, c in enumerate(chars)))
    return sums.select(F.inline(rows))


def length_stats(pages: DataFrame) -> DataFrame:
    """Mean and deviation (of the population) of sections a page and of characters a section, in one row."""
    size = F.size("text_list")
    lengths = F.transform("text_list", lambda t: F.length(t).cast("double"))
    add = lambda f: F.aggregate(lengths, F.lit(0.0), lambda a, x: a + F.coalesce(f(x), F.lit(0.0)))
    sums = pages.where("text_list is not null").select(size.cast("double").alias("k"), add(lambda x: x).alias("s"), add(lambda x: x * x).alias("q"))
    each = sums.agg(F.avg("k").alias("avg_pars_per_article"), F.stddev_pop("k").alias("std_pars_per_article"), F.sum("k").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    mean = F.col("s") / F.col("n")
    return each.select("avg_pars_per_article", "std_pars_per_article", mean.alias("avg_chars_per_par"), F.sqrt(F.greatest(F.col("q") / F.col("n") - mean * mean, F.lit(0.0))).alias("std_chars_per_par"))


def length_histogram(pages: DataFrame) -> DataFrame:
    """len_text, n: how many sections have each length."""
    return texts_of(pages).groupBy(F.length("text").alias("len_text")).agg(F.count("*").alias("n"))


def find_texts(pages: DataFrame, condition: Callable[[Column], Column]) -> DataFrame:
    """url, idxs: positions of the sections that meet the condition, rising; a repeated address has one row."""
    found = texts_of(pages).where(condition(F.col("text")))
    return found.groupBy("url").agg(F.sort_array(F.collect_list("idx")).alias("idxs"))


def count_texts(pages: DataFrame, **conditions: Callable[[Column], Column]) -> DataFrame:
    """One row with the number of sections that meet each condition."""
    return texts_of(pages).agg(*(F.count_if(c(F.col("text"))).alias(k) for k, c in conditions.items()))


def find_texts_where(pages: DataFrame, predicate: Callable[[str], bool]) -> DataFrame:
    """find_texts with any Python function of a text; texts go to Python in Arrow batches and only positions come back."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            keep = [predicate(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["url", "idx"])

    found = texts_of(pages).mapInArrow(run, "url string, idx int")
    return found.groupBy("url").agg(F.sort_array(F.collect_list("idx")).alias("idxs"))

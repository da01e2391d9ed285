"""Occurrences and pages of every word, kept up to date by signed deltas.

A delivery is compared with the one before by fingerprints; only pages that were added, changed or deleted are counted,
with a sign, and the sums are merged into a table of counts that lasts as long as the driver; counts are kept for no later run.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.pages import once_each
from corpusmill.functions.prefilter import key_filter
from corpusmill.session import materialize

#: A word is a piece of a sentence between these, exactly as stored.
SEPARATOR = " "
RARE_BELOW_PAGES = 3
COMMON_ABOVE_SHARE = 0.5
_COUNTS = "word string, n_occurrences long, n_pages long"
#: Words that a worker holds before it hands its sums on; only bounds memory.
_HELD = 500_000


def _page_sums(sign: int):
    """Signed counts summed within a task; the empty word, which is none, counts pages that have any word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, on = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            words = list(on)
            out = pa.record_batch([pa.array(words, pa.string()), pa.array([sign * seen[w] for w in words], pa.int64()), pa.array([sign * on[w] for w in words], pa.int64())], names=["word", "n_occurrences", "n_pages"])
            seen.clear(), on.clear()
            return out

        for batch in batches:
            for page in batch.column("text_list"):
                words: Counter = Counter()
                for section in page.as_py() or ():
                    for sentence in section or ():
                        if sentence:
                            words.update(sentence.split(SEPARATOR))
                words.pop("", None)
                if words:
                    total = sum(words.values())
                    seen.update(words)
                    on.update(words.keys())
                    seen[""] += total
                    on[""] += 1
                if len(on) > _HELD:
                    yield flush()
        yield flush()

    return run


def _summed(df: DataFrame) -> DataFrame:
    return df.groupBy("word").agg(F.sum("n_occurrences").alias("n_occurrences"), F.sum("n_pages").alias("n_pages"))


def _only(pages: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `pages` whose ids are among `ids`; others are dropped before their texts move."""
    maybe = key_filter(ids, "page_id")

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe(np.asarray(batch.column("page_id"), dtype=np.int64))))

    return pages.mapInArrow(thin, pages.schema).join(ids, "page_id", "left_semi")


def count_deltas(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """word, n_occurrences, n_pages: signed changes from one delivery to the next; 0 changes are left out.

    Both have page_id and text_list (sections, then sentences); `before` may be None at the first delivery. A page in
    several rows counts once. Null ids, lists, sections and sentences count nothing. The word '' stands for the pages
    with any word and all occurrences. Other columns are ignored.
    """
    after = once_each(after.select("page_id", "text_list"))
    if before is None:
        return _summed(after.mapInArrow(_page_sums(1), _COUNTS))
    before = once_each(before.select("page_id", "text_list"))
    prints = [d.select("page_id", F.xxhash64("text_list").alias(f"print_{k}"), F.lit(True).alias(f"in_{k}")) for k, d in enumerate((before, after))]
    changed = prints[0].join(prints[1], "page_id", "full").where(~F.col("print_0").eqNullSafe(F.col("print_1")) | F.col("in_0").isNull() | F.col("in_1").isNull())
    changed = materialize(changed.select("page_id", "in_0", "in_1"), "changed-pages")
    gone = _only(before, changed.where("in_0").select("page_id")).mapInArrow(_page_sums(-1), _COUNTS)
    come = _only(after, changed.where("in_1").select("page_id")).mapInArrow(_page_sums(1), _COUNTS)
    return _summed(gone.unionByName(come)).where("n_occurrences <> 0 or n_pages <> 0")


def merge_counts(counts: DataFrame | None, deltas: DataFrame) -> DataFrame:
    """The counts after `deltas`, written as a table in the shared folder; words that have gone are left out."""
    every = deltas if counts is None else _summed(counts.unionByName(deltas))
    return materialize(every.where("n_pages > 0"), "term-counts")


def marked(counts: DataFrame) -> DataFrame:
    """word, n_occurrences, n_pages, mark: rare, common or useful; the total is one row, so its broadcast is too."""
    total = counts.where("word = ''").select(F.col("n_pages").alias("all_pages"))
    mark = F.when(F.col("n_pages") < RARE_BELOW_PAGES, "rare").when(F.col("n_pages") > COMMON_ABOVE_SHARE * F.col("all_pages"), "common").otherwise("useful")
    return counts.where("word <> ''").join(F.broadcast(total)).select("word", "n_occurrences", "n_pages", mark.alias("mark"))


def delivered_counts(pages: DataFrame) -> DataFrame:
    """Counts of a page table taken as two deliveries: what was loaded up to the middle of the load times, then all of it;
    the second adds only what it changes. Rows without a load time belong to the first."""
    middle = pages.select(F.percentile_approx(F.unix_micros("loaded_at"), 0.5)).first()[0]
    early = F.coalesce(F.unix_micros("loaded_at") <= F.lit(middle), F.lit(True))
    first = pages.where(early)
    counts = merge_counts(None, count_deltas(None, first))
    return merge_counts(counts, count_deltas(first, pages))

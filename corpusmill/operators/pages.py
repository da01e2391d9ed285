"""Pages that count once, however many rows deliver them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.prefilter import key_filter
from corpusmill.session import materialize


def once_each(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """One row for each key; rows without a key are left out.

    Only the keys are shuffled to find those given more than once; of the texts, only theirs move. Rows of a key hold
    the same content, so any of them stands for it.
    """
    rows = rows.where(F.col(key).isNotNull())
    again = materialize(rows.select(key).groupBy(key).count().where("count > 1").select(key), "keys-again")
    maybe = key_filter(again, key)
    place = rows.columns.index(key)

    def split(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(maybe(np.asarray(batch.column(place), dtype=np.int64)) == wanted))

        return run

    alone = rows.mapInArrow(split(False), rows.schema)
    return alone.unionByName(rows.mapInArrow(split(True), rows.schema).dropDuplicates([key]))


def sections(rows: DataFrame, *keep: str) -> DataFrame:
    """page_id, sec_idx, text of each section; null and empty lists have none."""
    return rows.select("page_id", *keep, F.posexplode("text_list").alias("sec_idx", "text"))

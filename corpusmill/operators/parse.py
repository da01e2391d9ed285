"""Pages of HTML as sections of text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.functions.markup import sections


def parsed(pages: DataFrame, keys: list[str] | None = None, strict: bool = False, drop_comments: bool = False) -> DataFrame:
    """keys (url unless others are named) and text_list of each page with a text; pages without sections have an empty list.

    Null pages are read as empty ones.
    """
    keys = keys or ["url"]
    given = pages.select(*keys, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 100):
                batch = whole.slice(begin, 100)
                lists = [sections(t, strict, drop_comments) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(lists, pa.list_(pa.string()))], names=[*keys, "text_list"])

    return given.mapInArrow(run, f"{fields}, text_list array<string>")

"""Reading and writing the stage files: JSON lines, JSON objects and arrays, lists of lines, YAML settings."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def paths_of(paths: str | list[str]) -> list[str]:
    """One path or a list of paths; anything else is an error."""
    if isinstance(paths, str):
        return [paths]
    if isinstance(paths, list):
        return paths
    raise ValueError(f"paths must be a string or a list of strings, not {type(paths).__name__}")


def read_pages(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """Pages in JSON lines; all files are read into one frame, and a broken line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths_of(paths))


def write_pages(pages: DataFrame, path: str, append: bool = False) -> None:
    """Pages as JSON lines; `append` adds to what is there, else it is replaced."""
    pages.write.mode("append" if append else "overwrite").json(path)


def read_json(path: str) -> Any:
    """A whole JSON file on the driver, for settings and vocabularies."""
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def read_settings(path: str) -> Any:
    """A YAML file on the driver; the key crawl_seeds lists the addresses a crawl starts from."""
    import yaml

    with open(path, encoding="utf-8") as file:
        return yaml.safe_load(file)


def read_lines(spark: SparkSession, paths: str | list[str], name: str = "url") -> DataFrame:
    """One value a line, stripped."""
    return spark.read.text(paths_of(paths)).select(F.trim("value").alias(name))


def write_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """The single column of `df`, one value a line."""
    df.write.mode("append" if append else "overwrite").text(path)


def write_json_object(counts: DataFrame, path: str, key: str, value: str, order: str) -> None:
    """A JSON object {key: value} in the order of a column, written as it is read off the partitions, sorted."""
    with open(path, "w", encoding="utf-8") as file:
        file.write("{")
        for k, row in enumerate(counts.orderBy(order).select(key, value).toLocalIterator()):
            file.write((", " if k else "") + json.dumps(row[0]) + ": " + json.dumps(row[1]))
        file.write("}")


def write_json_array(df: DataFrame, path: str, column: str, order: str) -> None:
    """A JSON array of a column, in the order of another."""
    with open(path, "w", encoding="utf-8") as file:
        json.dump([row[0] for row in df.orderBy(order).select(column).toLocalIterator()], file)


def reset(spark: SparkSession, paths: dict[str, StructType]) -> None:
    """Empty stage files of the given schemas."""
    for path, schema in paths.items():
        spark.createDataFrame([], schema).write.mode("overwrite").json(path)


def read_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """word, freq, first_pos of a JSON object {word: count}, whose order is that of first appearance."""
    rows = [(word, int(n), (k, 0, 0, 0)) for k, (word, n) in enumerate(read_json(path).items())]
    return spark.createDataFrame(rows, "word string, freq long, first_pos struct<page:long,sec:int,sent:int,pos:int>")


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """token of a JSON array of tokens."""
    return spark.createDataFrame([(t,) for t in dict.fromkeys(read_json(path))], "token string")

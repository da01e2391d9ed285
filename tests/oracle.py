"""Holds queries against their SQL, as rows in any order."""

from collections import Counter
from pathlib import Path

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


def same_rows(spark, folder: str, query, sql: str) -> None:
    df = query(spark, folder)
    columns = sorted(df.columns)
    con = duck(folder)
    assert sorted(con.sql(sql).columns) == columns
    want = con.sql(f"select {', '.join(columns)} from ({sql})").fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert Counter(map(repr, got)) == Counter(map(repr, want))

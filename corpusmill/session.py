"""Session settings, the shared folder for intermediate tables, and small join helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDER = "corpusmill-tables"
_written: list[tuple[SparkSession, str]] = []


def local_session(cpus: int | str = 8, name: str = "corpusmill") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in spark.checkpoint.dir.

    Where the setting is missing a temporary folder is made, which only a local master may use.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session has ended before
            pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: lineage is cut, a lost executor costs nothing.

    The table is removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{_FOLDER}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key is hot if it holds more than this share of the rows; so there are fewer than 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 64


def hot_keys(many: DataFrame, on: list[str]) -> DataFrame:
    """The keys that hold more than HOT_SHARE of all rows: fewer than 1 / HOT_SHARE rows, so small enough to broadcast.

    Only the keys are read; counts are partially aggregated.
    """
    counts = materialize(many.groupBy(*on).agg(F.count("*").alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.where(F.col("_n") > max(total * HOT_SHARE, 1)).select(*on)


def salted_join(many: DataFrame, one: DataFrame, on: list[str], salts: int = 16, how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """Join where one key may hold a large part of `many`.

    Hot keys are found first, from `counted` if it is given (a cheaper frame with the same keys), and they alone are
    salted: their rows in `many` are dealt over `salts` partitions, and their rows in `one` are repeated `salts` times.
    Rows with other keys, in `one` most of all, move once. Of `one` each key should have few rows.
    """
    hot = hot_keys(many if counted is None else counted, on).withColumn("_hot", F.lit(True))
    if not hot.head(1):
        return many.join(one, on, how)
    hot = F.broadcast(hot)  # fewer than 1 / HOT_SHARE rows
    rest = [c for c in many.columns if c not in on]
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*(F.col(c) for c in rest)) if rest else F.lit(0), F.lit(salts)).cast("int")).otherwise(0)
    left = many.join(hot, on, "left").withColumn("_salt", salt).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = one.join(hot, on, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str | Column) -> DataFrame:
    """One of the test tables, pruned to `columns`."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df

"""Pages as they arrive: a stream of JSON lines, normalized and appended to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corpusmill.operators.normalize import normalized
from corpusmill.operators.parse import parsed
from corpusmill.schemas import RAW_PAGE


def page_stream(spark: SparkSession, folder: str, schema: StructType = RAW_PAGE, files_at_once: int = 100) -> DataFrame:
    """Pages of the files that come into a folder; each file is read once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).json(folder)


def append_sections(pages: DataFrame, table: str, checkpoint: str, len_cutoff: int = -1, once: bool = False) -> StreamingQuery:
    """Parse and normalize a stream of raw pages (url, text) into a Parquet table; with `once` what is there, then end.

    The checkpoint makes each page appear once, also after a restart.
    """
    ready = normalized(parsed(pages), len_cutoff)
    writer = ready.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

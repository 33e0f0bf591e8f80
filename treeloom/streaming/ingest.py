"""Records of files as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from treeloom.sources import files

_SOURCE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_records(spark: SparkSession, root: str) -> DataFrame:
    """A stream of records, by the same stateless transformation as the batch scan. It sees what
    Spark's file source sees: not names with a leading `_` or `.`, and not empty files."""
    arrived = (
        spark.readStream.format("binaryFile").schema(_SOURCE)
        .option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").load(root)
    )
    return files.to_records(arrived.select(
        files.relative(spark, root).alias("file_path"), F.col("length").alias("size"), F.col("content").alias("data")))


def append_records(records: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the files present now to a Parquet table, each once over all runs of a checkpoint."""
    return (
        records.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )

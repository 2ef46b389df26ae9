"""Incremental ingestion: documents that arrive as files become chunk tables, micro-batch by micro-batch.

Documents are self-contained, so the pipeline of a batch is that of a table; nothing is kept between batches but the
file source's own log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codexloom.sources.files import txt_pages


def read_files(spark: SparkSession, root: str, pattern: str = "*.txt") -> DataFrame:
    stream = spark.readStream.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return stream.schema("path string, modificationTime timestamp, length long, content binary").load(root).select("path", F.col("modificationTime").alias("modified"), "length", "content")


def ingest(spark: SparkSession, root: str, target: str, checkpoint: str, build: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Writes build(pages of new files) to target, a batch at a time, and stops when nothing new is left."""

    def batch(files: DataFrame, number: int) -> None:
        build(txt_pages(files)).withColumn("batch", F.lit(number)).write.mode("append").parquet(target)

    return read_files(spark, root).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

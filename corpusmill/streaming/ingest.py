"""Incremental capture: new posts are appended, known ones skipped; as batches and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusmill.cluster import exists


def append_new(old: DataFrame, new: DataFrame, key: str = "url") -> DataFrame:
    """old and those rows of new whose key it lacks; of a key that new repeats, the row captured first."""
    first = new.groupBy(key).agg(F.min_by(F.struct(*new.columns), F.struct("captured", "post_id")).alias("r")).select("r.*")
    return old.unionByName(first.join(old.select(key).distinct(), key, "left_anti").select(*old.columns))


def capture_stream(spark: SparkSession, folder: str, schema: T.StructType, late: str = "60 days", key: str = "url", files: int = 16) -> DataFrame:
    """Captures from a folder as they arrive, each key once; state older than the watermark is dropped, so it stays bounded."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
    return stream.withWatermark("captured", late).dropDuplicatesWithinWatermark([key])


def write_stream(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Appends to a Parquet folder exactly once, and ends when all that is there has been read."""
    return stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def merge_stream(stream: DataFrame, folder: str, checkpoint: str, key: str = "url") -> StreamingQuery:
    """Appends those rows of each micro-batch whose key the table lacks; a batch that is run again adds nothing. Only the keys are read again."""

    def merge(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates([key])
        if exists(batch.sparkSession, folder):
            fresh = fresh.join(batch.sparkSession.read.schema(batch.schema).parquet(folder).select(key), key, "left_anti")
        fresh.write.mode("append").parquet(folder)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, length: str, late: str, *keys: str) -> DataFrame:
    """Events by time window and keys, with a watermark; an addition that the capture pipeline doesn't need."""
    return stream.withWatermark(time, late).groupBy(F.window(time, length), *keys).agg(F.count("*").alias("n"))

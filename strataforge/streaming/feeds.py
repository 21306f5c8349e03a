"""Streams: change feeds and events applied in micro-batches, and windowed summaries with late data.

The merges are the batch ones, run by foreachBatch on a versioned table; a merge that gives a Change writes only what the
micro-batch changes. The batch id is stored with the version, so a micro-batch repeated after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strataforge.operators.conform import Change
from strataforge.session import scratch_tables
from strataforge.sinks.writers import VersionedTable


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1, source: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(source).load(path)


def merge_stream(stream: DataFrame, table: VersionedTable, merge: Callable[[Any, DataFrame], DataFrame | Change], first: Callable[[DataFrame], DataFrame], checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Applies merge(now, batch) to each micro-batch; now(*parts) gives the table's rows. ``first`` makes the empty table from the
    first batch.

    Without an interval all that is there is processed and the query ends; with one it runs on at that target lag.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        key = str(batch_id)
        if table.has_batch(key):
            return
        with scratch_tables():
            done = merge(table.read if table.exists() else lambda *_: first(batch), batch)
            table.apply(done, key) if isinstance(done, Change) else table.replace(done, key)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def refresh_stream(stream: DataFrame, table: VersionedTable, source: Callable[[], DataFrame], build: Callable[[DataFrame], DataFrame], checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """A derived table that is built anew whenever its source has new rows, at most once an interval."""
    return merge_stream(stream, table, lambda _, __: build(source()), lambda b: b, checkpoint, interval)


def windowed_counts(stream: DataFrame, at: str, keys: list[str], width: str = "1 day", late: str = "2 days", slide: str | None = None) -> DataFrame:
    """Counts per keys and event-time window; rows later than the watermark are left out."""
    window: Column = F.window(at, width, slide) if slide else F.window(at, width)
    counted = stream.withWatermark(at, late).groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")

"""Streaming forms: event logs, append-only sinks with resume, windows over late events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENT = "ts timestamp, component string, event string, data string"


def read_events(spark: SparkSession, folder: str, schema: str = EVENT) -> DataFrame:
    """An append-only folder of JSON line files as a stream."""
    return spark.readStream.schema(schema).json(folder)


def read_parquet_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(folder)


def windowed_counts(events: DataFrame, key: str, width: str = "10 minutes", late: str = "30 minutes", ts: str = "ts") -> DataFrame:
    """(start, key, n, total) of tumbling windows; events later than the watermark are left out when streaming."""
    # A watermark needs an instant; the window's start goes back to the wall clock it came from.
    grouped = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, width), key)
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").cast("timestamp_ntz").alias("start"), key, "n", "total")


def append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is new to a Parquet folder and stop; the checkpoint makes a restart resume."""
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def routed(rows: DataFrame, reasons: str, path: str, checkpoint: str) -> StreamingQuery:
    """Every candidate to one folder, then accepted and rejected rows to theirs, one batch at a time."""

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        for name, part in (("candidates", kept), ("rows", kept.where(F.size(reasons) == 0)), ("rejected", kept.where(F.size(reasons) > 0))):
            part.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{path}/{name}")
        kept.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_memory(rows: DataFrame, name: str, mode: str = "complete", on_start: Callable[[StreamingQuery], None] | None = None) -> StreamingQuery:
    """Run a stream over what is there into an in-memory table, for small results and tests."""
    query = rows.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    if on_start is not None:
        on_start(query)
    query.awaitTermination()
    return query


def snapshots(events: DataFrame) -> DataFrame:
    """The last value of every component by time."""
    return events.groupBy("component").agg(F.max_by("data", "ts").alias("data"), F.max("ts").alias("ts"))

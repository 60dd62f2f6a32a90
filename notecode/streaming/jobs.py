"""The batch stages as streams: each micro-batch of new charts is processed once and published."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def run_available(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Process what is new in ``stream`` since the last run and stop.

    A batch is written to a folder of its own number, so a batch that is repeated after a
    failure replaces its own output instead of adding to it.
    """

    def write(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_rates(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events per window and type of a stream or table; rows later than ``late`` are left out of a stream."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    g = rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")

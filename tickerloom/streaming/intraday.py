"""Intraday ticks as an event-time stream.

The state of the stream is the latest tick per index and day, so it is bounded by the indices and the days that the
watermark still keeps open; ticks that come twice or late leave it as it is, or find their place by their own time. What
is landed stands in for the ticks themselves: ``latest_price_with_fallback`` gives the same prices from either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TICK_SCHEMA = "index_name string, ts timestamp, event_id long, price double"


def latest_ticks(ticks: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """The latest tick per index and day, ties by event; a batch or a stream. Ticks without a time or index are left out.

    In a stream a tick of a day that ended more than ``lateness`` before the newest tick is dropped with its closed day.
    """
    known = ticks.where("ts IS NOT NULL AND index_name IS NOT NULL").withWatermark("ts", lateness)
    newest = known.groupBy("index_name", F.window("ts", "1 day").alias("day")).agg(
        F.max(F.struct("ts", "event_id", "price")).alias("tick"))
    return newest.select("index_name", "tick.ts", "tick.event_id", "tick.price")


def land_ticks(spark: SparkSession, source: str, target: str, checkpoint: str, lateness: str = "1 hour",
               files_per_batch: int = 1000):
    """Read new tick files (Parquet) below ``source``; returns the query, which ends when it has read them.

    Each micro-batch writes the ticks that became the latest to a folder of its own and replaces it when it is retried.
    """
    raw = spark.readStream.schema(TICK_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target.rstrip('/')}/landing={number}")

    stream = latest_ticks(raw, lateness).writeStream.outputMode("update").foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landed_ticks(spark: SparkSession, target: str) -> DataFrame:
    """All landed ticks, in place of the raw ones."""
    return spark.read.schema(f"{TICK_SCHEMA}, landing int").parquet(target).drop("landing")

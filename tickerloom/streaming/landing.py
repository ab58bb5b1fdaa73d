"""Incremental landing of daily exchange summaries.

A file stream remembers in its checkpoint which files it has read, so each run takes only
the summaries that are new since the last one, then stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.sources.market import clean_flow_snapshot, split_flow_per_ticker

SNAPSHOT_SCHEMA = (
    "`Stock Code` string, `Last Trading Date` string, `Foreign Sell` double, `Foreign Buy` double, "
    "`Non Regular Volume` double, `Non Regular Value` double, `Non Regular Frequency` double"
)


def land_snapshots(spark: SparkSession, source: str, target: str, checkpoint: str):
    """Read new summary files, clean them and append them below ``target``; returns the query.

    Each micro-batch owns one folder and replaces it when it is retried, so a batch that is
    run twice leaves its rows once.
    """
    raw = spark.readStream.schema(SNAPSHOT_SCHEMA).option("header", "true").csv(source)

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("place", F.monotonically_increasing_id()).write.mode("overwrite").parquet(
            f"{target.rstrip('/')}/landing={number}")

    named = clean_flow_snapshot(raw.withColumn("file", F.col("_metadata.file_name")), ("file",))
    stream = named.writeStream.foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landed_flow(spark: SparkSession, target: str) -> DataFrame:
    """Flow per (ticker, date) of everything landed: the first landing of a key, then the first file and row of it."""
    return split_flow_per_ticker(spark.read.parquet(target), ("landing", "file", "place"))

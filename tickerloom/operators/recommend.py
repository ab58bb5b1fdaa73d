"""Daily recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.scalar import clean_float, score_bin, target_buy_price, target_sell_price


def latest_per_ticker(df: DataFrame, columns: list[str]) -> DataFrame:
    """The newest row per ticker; an aggregate, so nothing is sorted."""
    newest = df.groupBy("ticker").agg(F.max_by(F.struct("date", *columns), "date").alias("r"))
    return newest.select("ticker", "r.*")


def single_date(df: DataFrame) -> DataFrame:
    """One row: how many dates ``df`` has, its rows, and whether it has one date at most."""
    return df.agg(F.count_distinct("date").alias("dates"), F.count("*").alias("rows")).withColumn("passed", F.col("dates") <= 1)


def assert_single_date(df: DataFrame) -> DataFrame:
    """Passes ``df`` through; the query fails when it holds more than one date."""
    dates = df.agg(F.count_distinct("date").alias("dates"))
    check = F.assert_true(dates.scalar() <= 1, F.lit("the latest scores are not all of one date"))
    return df.where(check.isNull())


def attach_bin_targets(scored: DataFrame, targets: DataFrame, strict: bool = True) -> DataFrame:
    """Buy and sell percentages by score bin; an unseen bin fails the query if ``strict``."""
    joined = scored.join(F.broadcast(targets), "bin", "left")
    if not strict:
        return joined
    missing = F.raise_error(F.concat(F.lit("no simulated trades for score bin "), F.col("bin"))).cast("double")
    return joined.withColumn("buy_pct", F.when(F.col("sell_pct").isNull(), missing).otherwise(F.col("buy_pct")))


def daily_recommendation(scores: DataFrame, bars: DataFrame, targets: DataFrame, strict: bool = True,
                         one_date: bool = True) -> DataFrame:
    """Score, latest close and target prices of every ticker.

    ``targets`` has one row per score bin (six at most). ``one_date`` fails the query when the latest scores are not all
    of one date; turn it off where tickers trade on different days.
    """
    latest = latest_per_ticker(scores, ["score"])
    latest = assert_single_date(latest) if one_date else latest
    latest = latest.withColumnRenamed("date", "score_date").withColumn("bin", score_bin("score"))
    closes = latest_per_ticker(bars, ["close"]).drop("date")
    priced = attach_bin_targets(latest.join(closes, "ticker"), targets, strict)
    return priced.select(
        "ticker", "score_date", "score", "bin", "close", "buy_pct", "sell_pct",
        target_buy_price("close", "buy_pct").alias("target_buy_price"),
        target_sell_price("close", "sell_pct").alias("target_sell_price"),
    ).orderBy(F.desc("score"), "ticker")


def recommendation_records(recommendations: DataFrame, window: str) -> DataFrame:
    """Flat response records without missing numbers."""
    return recommendations.select(
        F.col("score_date").cast("string").alias("score_date"),
        F.lit(window).alias("rolling_window"),
        F.col("ticker").cast("string").alias("ticker"),
        *[clean_float(c).alias(c) for c in ("score", "target_buy_price", "target_sell_price")],
    )

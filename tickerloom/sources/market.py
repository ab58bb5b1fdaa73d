"""Cleaning of landed prices and exchange summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.constants import CORPORATE_ACTION_COLUMNS, SNAPSHOT_COLUMNS
from tickerloom.functions.scalar import parse_local_date


def normalize_ohlcv(raw: DataFrame, zone: str = "UTC") -> DataFrame:
    """Drop corporate actions and turn timestamps into exchange-local dates."""
    local = F.convert_timezone(F.current_timezone(), F.lit(zone), F.col("Date").cast("timestamp_ntz"))
    return raw.drop(*CORPORATE_ACTION_COLUMNS).withColumn("Date", F.to_date(local))


def clean_flow_snapshot(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The seven wanted columns with a parsed date."""
    return raw.select(*SNAPSHOT_COLUMNS, *keep).withColumn("Last Trading Date", parse_local_date("Last Trading Date"))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in ``order``, which must be a total order within the key.

    An aggregate, not a ranking window: copies of a key are reduced before the shuffle, so
    a key with very many copies costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def split_flow_per_ticker(snapshots: DataFrame, order: tuple[str, ...] = ("landing",)) -> DataFrame:
    """Flow keyed by (ticker, date); of several rows of a key the first in ``order`` stays."""
    named = snapshots.withColumnsRenamed({
        "Stock Code": "ticker", "Last Trading Date": "date", "Foreign Sell": "foreign_sell",
        "Foreign Buy": "foreign_buy", "Non Regular Volume": "non_regular_volume",
        "Non Regular Value": "non_regular_value", "Non Regular Frequency": "non_regular_frequency",
    })
    return first_per_key(named, ["ticker", "date"], list(order)).drop(*order)


def active_market_dates(bars: DataFrame) -> DataFrame:
    """Sorted distinct trading dates over all tickers."""
    return bars.select("date").distinct().orderBy("date")


def backfill_dates(dates: DataFrame, landed: DataFrame, stem: str = "stem") -> DataFrame:
    """Active dates without a landed ``yyyyMMdd`` file."""
    done = landed.select(F.to_date(stem, "yyyyMMdd").alias("date")).distinct()
    return dates.join(done, "date", "left_anti").orderBy("date")

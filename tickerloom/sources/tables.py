"""Adapters: market tables derived from the given star-schema tables.

Suppliers stand for tickers, shipments for trades, nations for industries, event streams
for market indices. Every adapter is a plain aggregation with map-side combine, so one very
busy (ticker, date) is reduced before it is shuffled. The results have one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.constants import FUNDAMENTALS
from tickerloom.functions.scalar import to_local_date
from tickerloom.session import small_tasks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    small_tasks(spark, path)
    return spark.read.parquet(path)


def trades(spark, sf_dir) -> DataFrame:
    """One row per shipment line: ticker, date, price, quantity and a total order."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("ticker"),
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_returnflag").alias("side"),
        F.col("l_linestatus").alias("board"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("seq"),
    )


def bars(spark, sf_dir) -> DataFrame:
    """Daily bars (ticker, date, open, high, low, close, volume)."""
    return (
        trades(spark, sf_dir)
        .groupBy("ticker", "date")
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("quantity").alias("volume"),
        )
    )


def flow(spark, sf_dir) -> DataFrame:
    """Investor flow per (ticker, date); days without foreign trades have no row."""
    def total(column, condition):
        return F.sum(F.when(condition, F.col(column)).otherwise(0.0))

    sold, bought, negotiated = F.col("side") == "A", F.col("side") == "R", F.col("board") == "F"
    return (
        trades(spark, sf_dir)
        .where(sold | bought)
        .groupBy("ticker", "date")
        .agg(
            total("quantity", sold).alias("foreign_sell"),
            total("quantity", bought).alias("foreign_buy"),
            total("quantity", negotiated).alias("non_regular_volume"),
            total("value", negotiated).alias("non_regular_value"),
            F.count_if(negotiated).cast("double").alias("non_regular_frequency"),
        )
    )


def snapshots(spark, sf_dir) -> DataFrame:
    """Raw daily exchange summaries with localized dates.

    Days on which foreigners bought were landed twice; the second landing (``landing`` 1)
    repeats the key with other numbers.
    """
    first = flow(spark, sf_dir).withColumn("landing", F.lit(0))
    second = first.where("foreign_buy > 0").withColumn("landing", F.lit(1)).withColumn(
        "foreign_buy", F.col("foreign_buy") + 1)
    return first.unionByName(second).select(
        F.col("ticker").alias("Stock Code"),
        to_local_date("date").alias("Last Trading Date"),
        F.col("foreign_sell").alias("Foreign Sell"),
        F.col("foreign_buy").alias("Foreign Buy"),
        F.col("non_regular_volume").alias("Non Regular Volume"),
        F.col("non_regular_value").alias("Non Regular Value"),
        F.col("non_regular_frequency").alias("Non Regular Frequency"),
        "landing",
    )


def raw_prices(spark, sf_dir) -> DataFrame:
    """Bars as a market-data client delivers them: timestamps and corporate actions."""
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_suppkey").alias("Ticker"),
            F.to_date("l_shipdate").alias("day"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            "l_quantity", "l_discount", "l_tax",
            F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("seq"),
        )
        .groupBy("Ticker", "day")
        .agg(
            F.min_by("price", "seq").alias("Open"),
            F.max("price").alias("High"),
            F.min("price").alias("Low"),
            F.max_by("price", "seq").alias("Close"),
            F.sum("l_quantity").alias("Volume"),
            F.sum("l_discount").alias("Dividends"),
            F.sum("l_tax").alias("Stock Splits"),
        )
        .withColumn("Date", F.col("day").cast("timestamp") + F.expr("INTERVAL 9 HOURS"))
        .drop("day")
    )


def industry(spark, sf_dir) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("ticker"), F.col("n_name").alias("industry")
    )


def fundamentals(spark, sf_dir) -> DataFrame:
    """19 nullable measures per supplier, from its balance, key and traded value."""
    k, bal = F.col("s_suppkey"), F.col("s_acctbal")

    def mod(a, m):
        return (k * a % m).cast("double")

    def gap(m, r, value):
        return F.when(k % m != r, value)

    traded = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("value")
    )
    columns = {
        "trailingPE": gap(7, 0, 5.0 + mod(13, 40)),
        "forwardPE": gap(5, 0, 4.0 + mod(11, 35)),
        "pegRatio": gap(3, 0, mod(29, 50) / 10.0),
        "priceToBook": gap(11, 0, mod(17, 60) / 10.0),
        "returnOnEquity": bal / 10000.0,
        "returnOnAssets": bal / 20000.0,
        "profitMargins": gap(17, 0, mod(37, 150) / 100.0 - 0.6),
        "operatingMargins": gap(19, 0, mod(41, 150) / 100.0 - 0.6),
        "debtToEquity": gap(6, 1, mod(43, 400)),
        "currentRatio": gap(8, 1, mod(23, 50) / 10.0),
        "quickRatio": gap(9, 1, mod(19, 40) / 10.0),
        "freeCashflow": gap(10, 1, bal * (1000.0 + mod(7, 100))),
        "operatingCashflow": gap(12, 1, bal * (1200.0 + mod(3, 100))),
        "revenueGrowth": gap(14, 1, mod(31, 300) / 100.0 - 0.8),
        "earningsGrowth": gap(15, 1, mod(47, 300) / 100.0 - 0.8),
        "averageVolume": F.col("qty"),
        "volume": F.col("qty") / 10.0,
        "marketCap": F.when(k % 13 == 0, 0.0).otherwise(100000000.0 + mod(53, 1000) * 1000000.0),
        "regularMarketPrice": F.col("value") * 157.0 / F.col("qty"),
    }
    return (
        table(spark, sf_dir, "supplier")
        .join(traded, "s_suppkey")
        .select(k.alias("ticker"), *[columns[name].alias(name) for name in FUNDAMENTALS])
    )


def index_bars(spark, sf_dir) -> DataFrame:
    """Daily closes per index: the last event of the day."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("index_name"), F.to_date("ts").alias("date"))
        .agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"))
    )


def intraday(spark, sf_dir) -> DataFrame:
    """Ticks of every index but ``error``, whose market has not opened."""
    return table(spark, sf_dir, "events").where("event_type != 'error'").select(
        F.col("event_type").alias("index_name"), "ts", "event_id", F.col("value").alias("price")
    )


def day_number(date="date"):
    return F.date_diff(F.col(date), F.lit("1995-01-01").cast("date"))


def score_of(a: int, b: int):
    """Deterministic number in [0, 1) per (ticker, date)."""
    return ((F.col("ticker") * a + day_number() * b) % 1000) / F.lit(1000.0)


def scores(bars_df: DataFrame) -> DataFrame:
    return bars_df.select("ticker", "date", score_of(31, 17).alias("score"))


def _forecast_arrays(bars_df: DataFrame, available: DataFrame, label_types, windows, versions):
    """(ticker, date, covered) of the bars, and the array of a bar's forecasts."""
    offsets = {"median_gain": 0, "median_loss": 3}
    rows = F.array(*[
        F.struct(
            F.lit(v).alias("model_version"), F.lit(label).alias("label_type"), F.lit(w).alias("window"),
            score_of(31 + v, 17 + w + offsets[label]).alias("p"),
        )
        for v in versions for label in label_types for w in windows if v < 4 or label == "median_gain"
    ])
    covered = available.select("ticker").distinct().withColumn("covered", F.lit(True))
    flagged = bars_df.select("ticker", "date").join(covered, "ticker", "left")
    return flagged, F.filter(rows, lambda f: (f["model_version"] != 3) | F.coalesce("covered", F.lit(False)))


def forecasts(bars_df: DataFrame, available: DataFrame, label_types, windows, versions=(1, 2, 3)) -> DataFrame:
    """Long forecasts; model 3 covers only the tickers of ``available``, model 4 (the stacker) gains only.

    The bars are read once.
    """
    flagged, kept = _forecast_arrays(bars_df, available, label_types, windows, versions)
    return flagged.select("ticker", "date", F.explode(kept).alias("f")).select("ticker", "date", "f.*")


def packed_forecasts(bars_df: DataFrame, available: DataFrame, label_types, windows, versions=(1, 2, 3)) -> DataFrame:
    """(ticker, date, forecasts): the rows of ``forecasts``, those of a bar in one array, the bars of a ticker together.

    Bars are shuffled by ticker before their arrays are made.
    """
    flagged, kept = _forecast_arrays(bars_df, available, label_types, windows, versions)
    return flagged.repartition("ticker").select("ticker", "date", kept.alias("forecasts"))


def market_index(bars_df: DataFrame, name: str = "IHSG") -> DataFrame:
    """A volume-weighted index over all tickers, one close per date."""
    value = F.sum(F.col("close") * F.col("volume")) / F.sum("volume")
    return bars_df.groupBy("date").agg(value.alias("close")).select(F.lit(name).alias("index_name"), "date", "close")

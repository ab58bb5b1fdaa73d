"""Window functions, indicators and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.functions import series as w
from tickerloom.functions.scalar import pct_change_to
from tickerloom.operators import features, labels, outlook, recommend
from tickerloom.operators.indicators import INDICATORS, indicator
from tickerloom.operators.metrics import first_threshold as threshold_of
from tickerloom.plans import inputs
from tickerloom.plans.registry import QUERIES, query, rounded
from tickerloom.sources import market
from tickerloom.sources import tables as t


@query
def forward_quantile(spark, sf):
    bars = t.bars(spark, sf)
    return rounded(bars.select("ticker", "date", *[
        w.forward_quantile("close", n, 0.4).alias(f"ahead_{n}") for n in (5, 10)]))


@query
def forward_max(spark, sf):
    return rounded(t.bars(spark, sf).select("ticker", "date", w.forward_max("close", 5).alias("max_close")))


@query
def forward_min(spark, sf):
    return rounded(t.bars(spark, sf).select("ticker", "date", w.forward_min("close", 5).alias("min_close")))


@query
def forward_return(spark, sf):
    bars = t.bars(spark, sf).select("ticker", "date", "close", w.forward_max("close", 10).alias("best"))
    return rounded(bars.select("ticker", "date", pct_change_to("best", "close").alias("move")))


@query
def rolling_sum(spark, sf):
    return t.bars(spark, sf).select("ticker", "date", *[
        w.rolling_sum("volume", n).alias(f"sum_{n}") for n in (15, 60, 90)])


@query
def rolling_mean(spark, sf):
    return rounded(t.bars(spark, sf).select("ticker", "date", w.rolling_mean("volume", 20).alias("mean_20")))


@query
def rolling_median_adaptive(spark, sf):
    return rounded(t.bars(spark, sf).select("ticker", "date", w.rolling_median("close", 50).alias("median_50")))


@query
def pct_change(spark, sf):
    return rounded(t.bars(spark, sf).select("ticker", "date", *[
        w.pct_change("close", n).alias(f"change_{n}") for n in (5, 10, 20)]))


@query
def lag_diff(spark, sf):
    return rounded(t.bars(spark, sf).select("ticker", "date", *[
        w.lag_diff("close", n).alias(f"diff_{n}") for n in (5, 10)]))


@query
def shift_all(spark, sf):
    """Flow columns one joined row later."""
    joined = features.join_bars_flow(t.bars(spark, sf), t.flow(spark, sf))
    return joined.select("ticker", "date", *[
        F.lag(c, 1).over(w.by_ticker()).alias(c) for c in ("foreign_buy", "foreign_sell", "volume")])


@query
def trend_slope(spark, sf):
    df = t.bars(spark, sf).withColumn("_rn", F.row_number().over(w.by_ticker()))
    for layer in w.trend_layers("close", 10, "rising", "falling"):
        df = df.withColumns(layer)
    return df.select("ticker", "date", "rising", "falling")


@query
def positives_share(spark, sf):
    df = t.bars(spark, sf).withColumn("move", F.col("close") - F.col("open"))
    df = df.withColumn("place", w.position("move"))
    return df.select("ticker", "date", w.share_flag(F.col("place"), F.col("move") > 0, 10, 4).alias("mostly_up"))


@query
def crossover_flag(spark, sf):
    df = t.bars(spark, sf)
    return df.select("ticker", "date", w.crossover_flag(F.col("close") >= F.col("open")).alias("crossed"))


@query
def sign_change_flag(spark, sf):
    df = t.bars(spark, sf).withColumn("move", F.col("close") - F.lag("close").over(w.by_ticker()))
    return df.select("ticker", "date", w.sign_change_flag("move").alias("changed"))


@query
def latest_per_ticker(spark, sf):
    return rounded(recommend.latest_per_ticker(t.bars(spark, sf), ["close", "volume"]))


@query
def latest_and_previous(spark, sf):
    stats = outlook.latest_and_previous(t.index_bars(spark, sf))
    return stats.select("index_name", "date", "close", "previous", outlook.change_pct("close", "previous").alias("change_pct"))


@query
def tail_mean(spark, sf):
    stats = outlook.latest_and_previous(t.index_bars(spark, sf))
    return rounded(stats.select("index_name", "sma20", pct_change_to("close", "sma20").alias("deviation_pct")))


@query
def first_threshold(spark, sf):
    return rounded(threshold_of(inputs.predictions(spark, sf)))


@query
def dedupe_first(spark, sf):
    """The first trade per ticker and date."""
    trades = t.trades(spark, sf).select("ticker", "date", "price", "quantity", "seq")
    first = market.first_per_key(trades, ["ticker", "date"], ["seq"])
    return rounded(first.select("ticker", "date", "price", "quantity"))


# ---- indicators --------------------------------------------------------------------------


def _register(name):
    def run(spark, sf):
        return rounded(indicator(t.bars(spark, sf), name), 4)

    QUERIES[f"ind_{name}"] = run


for _name in INDICATORS:
    _register(_name)


@query
def ind_flow(spark, sf):
    return rounded(features.flow_features(t.bars(spark, sf), t.flow(spark, sf)), 4)


@query
def feature_table(spark, sf):
    return rounded(features.feature_table(t.bars(spark, sf), t.flow(spark, sf)), 4)


# ---- labels ------------------------------------------------------------------------------


@query
def label_median_gain(spark, sf):
    return rounded(labels.with_labels(t.bars(spark, sf).select("ticker", "date", "close"), ("median_gain",), (5,)))


@query
def label_median_loss(spark, sf):
    return rounded(labels.with_labels(t.bars(spark, sf).select("ticker", "date", "close"), ("median_loss",), (5,)))


@query
def label_all(spark, sf):
    return rounded(inputs.labelled(spark, sf))

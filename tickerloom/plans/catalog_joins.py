"""Joins and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.constants import LABEL_WINDOWS, LABELS
from tickerloom.functions.naming import label_config
from tickerloom.functions.quantiles import describe as summary
from tickerloom.operators import cleaning, features, forecasts, metrics, models, outlook, recommend, scoring, universe
from tickerloom.operators.indicators import INDICATORS, indicator
from tickerloom.operators.labels import label_threshold as thresholds
from tickerloom.operators.labels import make_splits as splits
from tickerloom.plans import inputs
from tickerloom.plans.registry import query, rounded
from tickerloom.session import through_table
from tickerloom.sources import tables as t

COMBOS = ["model_version", "label_type", "window"]


def _simulation(spark, sf):
    """The simulated trades, written once: the statistics below read them several times."""
    return through_table(
        scoring.trading_simulation(inputs.test_scores(spark, sf), t.bars(spark, sf), 5), "simulation")


@query
def join_bars_flow(spark, sf):
    return rounded(features.join_bars_flow(t.bars(spark, sf), t.flow(spark, sf)), 4)


@query
def assemble_features(spark, sf):
    """Every feature that does not repaint, incomplete rows included."""
    names = tuple(n for n in INDICATORS if n != "zigzag")
    table = features.assemble(t.bars(spark, sf), t.flow(spark, sf), names)
    return rounded(table.drop("open", "high", "low", "close", "volume"), 4)


@query
def rsi_outer_join(spark, sf):
    return rounded(indicator(t.bars(spark, sf), "rsi_multi"))


@query
def join_performance(spark, sf):
    perf = inputs.gain_performance(spark, sf).select("ticker", "train_gini", "test_gini")
    return rounded(t.scores(t.bars(spark, sf)).join(perf, "ticker"))


@query
def join_industry(spark, sf):
    scored = universe.fundamental_score(t.fundamentals(spark, sf)).select("ticker", "fundamental_score")
    known = universe.join_industry(scored, t.industry(spark, sf)).withColumn("source", F.lit("table"))
    unknown = universe.join_industry(scored, None).withColumn("source", F.lit("none"))
    return rounded(known.unionByName(unknown))


@query
def combine_forecasts(spark, sf):
    labels = inputs.labelled(spark, sf)
    return rounded(forecasts.combine_forecasts(inputs.forecasts(spark, sf), labels, tuple(LABELS), LABEL_WINDOWS))


@query
def trading_simulation(spark, sf):
    return rounded(scoring.trading_simulation(inputs.test_scores(spark, sf), t.bars(spark, sf), 5))


@query
def join_index_score(spark, sf):
    bars = t.bars(spark, sf)
    return rounded(outlook.join_index_score(t.market_index(bars), t.scores(bars), 5))


@query
def ticker_availability(spark, sf):
    return forecasts.ticker_availability(inputs.forecasts(spark, sf), tuple(LABELS), LABEL_WINDOWS)


@query
def threshold_sweep_join(spark, sf):
    """Rows and mean loss per threshold."""
    simulation = _simulation(spark, sf)
    return rounded(scoring.threshold_sweep(simulation, "loss").select("threshold", "rows", "mean"))


@query
def attach_bin_targets(spark, sf):
    simulation = _simulation(spark, sf)
    targets = scoring.bin_buy_sell_pct(simulation)
    scored = t.scores(t.bars(spark, sf)).withColumn("bin", recommend.score_bin("score"))
    return rounded(recommend.attach_bin_targets(scored, targets).select(
        "ticker", "date", "bin", "buy_pct", "sell_pct"))


@query
def route_model(spark, sf):
    industries = t.industry(spark, sf)
    parts = [
        models.route_model(industries, industries, v, tuple(LABELS), LABEL_WINDOWS).withColumn("model_version", F.lit(v))
        for v in (1, 2, 3, 4)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ---- aggregations ------------------------------------------------------------------------


@query
def liquidity_cutoff(spark, sf):
    scored = universe.fundamental_score(t.fundamentals(spark, sf))
    return rounded(universe.liquidity_cutoff(scored).select("ticker", "avg_value_traded"), 2)


@query
def industry_counts(spark, sf):
    return universe.industry_counts(t.industry(spark, sf))


@query
def label_threshold(spark, sf):
    bars = t.bars(spark, sf)
    gain = thresholds(bars, "median_gain", 5).withColumn("label_type", F.lit("median_gain"))
    loss = thresholds(bars, "median_loss", 5).withColumn("label_type", F.lit("median_loss"))
    return rounded(gain.unionByName(loss))


@query
def make_splits(spark, sf):
    parts = []
    for w in LABEL_WINDOWS:
        name = label_config("median_gain", w)["target"]
        parts.append(splits(inputs.labelled(spark, sf, ("median_gain",), (w,)), name).withColumn("window", F.lit(w)))
    return parts[0].unionByName(parts[1])


@query
def avg_score_by_date(spark, sf):
    return rounded(outlook.avg_score_by_date(t.scores(t.bars(spark, sf))))


@query
def describe(spark, sf):
    return rounded(summary(t.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice"), 4)


@query
def bin_buy_sell_pct(spark, sf):
    simulation = _simulation(spark, sf)
    return rounded(scoring.bin_buy_sell_pct(simulation))


@query
def threshold_sweep(spark, sf):
    simulation = _simulation(spark, sf)
    return rounded(scoring.threshold_sweep(simulation, "profit"))


@query
def score_distribution(spark, sf):
    simulation = _simulation(spark, sf)
    return rounded(scoring.score_distribution(simulation, "profit"))


@query
def classification_metrics(spark, sf):
    made = inputs.predictions(spark, sf)
    return rounded(metrics.classification_metrics(made, ["ticker", "split"], "High Gain", "Low Gain"))


@query
def gini(spark, sf):
    return rounded(metrics.gini(inputs.predictions(spark, sf), ["ticker", "split"], "High Gain"))


@query
def performance_by_ticker(spark, sf):
    return rounded(inputs.gain_performance(spark, sf))


@query
def select_best_restart(spark, sf):
    """The three forecasting models stand for restarts."""
    perf = inputs.performance(spark, sf).select(
        F.col("model_version").alias("restart"), "ticker", F.col("test_gini").alias("gini"))
    return rounded(metrics.select_best_restart(through_table(perf, "restarts")))


@query
def percentile_rank(spark, sf):
    index = t.index_bars(spark, sf)
    values = outlook.latest_and_previous(index).select("index_name", F.col("close").alias("value"))
    return outlook.percentile_rank(index, values)


@query
def single_date_assert(spark, sf):
    """Both outcomes of the check: the scores of the newest date pass, the latest ones of all tickers don't."""
    scores = t.scores(t.bars(spark, sf))
    newest = scores.agg(F.max("date").alias("d"))
    one_day = recommend.assert_single_date(scores.where(F.col("date") == newest.scalar()))
    latest = recommend.latest_per_ticker(scores, ["score"])
    return recommend.single_date(one_day).withColumn("checked", F.lit("newest date")).unionByName(
        recommend.single_date(latest).withColumn("checked", F.lit("latest of each ticker")))


@query
def tickers_meeting_gini(spark, sf):
    return rounded(metrics.tickers_meeting_gini(inputs.gain_performance(spark, sf), 0.1))


@query
def run_summary(spark, sf):
    listed = t.table(spark, sf, "customer").select(F.col("c_custkey").alias("ticker"))
    return cleaning.run_summary(cleaning.quality_gate_full(listed, t.bars(spark, sf), t.flow(spark, sf)))

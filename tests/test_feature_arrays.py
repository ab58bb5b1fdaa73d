"""The array pass of the feature table against the window layers, on odd rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickerloom.operators import feature_arrays, features
from tickerloom.operators.indicators import INDICATORS, with_indicators
from tickerloom.operators.recursive import SERIES, averaged, series_of
from tickerloom.plans import inputs
from tickerloom.sources import tables

DAY = dt.date(2024, 1, 1)
BARS = "ticker string, date date, open double, high double, low double, close double, volume double, note string"
FLOW = "ticker string, date date, foreign_sell double, foreign_buy double"


def odd_tables(spark):
    """Tickers of many lengths, without moves, without volume, with gaps in every column, without a name; days without flow."""
    rng = np.random.default_rng(8)
    bars, flow = [], []
    lengths = {"a": 260, "b": 1, "c": 25, "d": 91, "flat": 130, "still": 130, "gaps": 260, "start": 200, "none": 60, "dry": 120, None: 120}
    for ticker, n in lengths.items():
        close = np.full(n, 7.1) if ticker == "flat" else (100 * np.exp(np.cumsum(rng.normal(scale=0.03, size=n)))).round(2)
        if ticker == "still":
            close[40:90] = close[40]
        frame = pd.DataFrame({"open": close * 1.01, "high": close + 0.5, "low": close - 0.5, "close": close, "volume": rng.integers(1, 90, n) * 1.0})
        if ticker == "flat":
            frame[["open", "high", "low"]] = 7.1
        if ticker == "dry":
            frame["volume"] = 0.0
        frame = frame.astype(object)
        for c in frame.columns:
            if ticker == "gaps":
                frame.loc[rng.random(n) < 0.04, c] = None
            if ticker == "start":
                frame.loc[:17, c] = None
            if ticker == "none":
                frame[c] = None
        for i, row in enumerate(frame.itertuples(index=False)):
            day = DAY + dt.timedelta(days=i)
            bars.append((ticker, day, *row, f"{ticker} {i}"))
            if rng.random() < 0.85:
                flow.append((ticker, day, float(rng.integers(0, 9)), None if ticker == "gaps" and i % 40 == 0 else float(rng.integers(0, 9))))
    order = rng.permutation(len(bars))
    return spark.createDataFrame([bars[i] for i in order], BARS), spark.createDataFrame(flow, FLOW)


def by_windows(bars, flow):
    attached = bars.join(flow.select("ticker", "date", "foreign_buy", "foreign_sell", F.lit(True).alias("has_flow")), ["ticker", "date"], "left")
    df, made = with_indicators(attached.withColumn("has_flow", F.coalesce("has_flow", F.lit(False))), tuple(INDICATORS))
    return features.with_flow_features(df).select(*bars.columns, *sorted(made + features.FLOW_FEATURES))


@pytest.mark.parametrize("rows", [1, 32_768])
def test_the_same_features_as_by_windows(spark, rows, monkeypatch):
    """Also when a batch of Spark holds a part of a ticker only, and chunks hold one ticker each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    monkeypatch.setattr(feature_arrays, "CHUNK_ROWS", rows)
    monkeypatch.setattr(feature_arrays, "OUT_ROWS", 100)
    bars, flow = odd_tables(spark)
    try:
        spark.conf.set(key, "37" if rows == 1 else before)
        made = features.assemble(bars, flow)
        found = made.toPandas()
    finally:
        spark.conf.set(key, before)
    wanted = by_windows(bars, flow)
    assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in wanted.schema]
    wanted = wanted.toPandas()
    assert len(found) == bars.count() and wanted.drop(columns=bars.columns).notna().any().all()
    found, wanted = (x.sort_values("note", ignore_index=True) for x in (found, wanted))
    pd.testing.assert_frame_equal(found, wanted, check_exact=False, rtol=1e-9, atol=1e-9)


def test_one_exchange_brings_the_bars_together(spark):
    """The window pass had a node for each layer and kind of frame."""
    bars, flow = odd_tables(spark)
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    plan = features.feature_table(bars, flow)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("MapInArrow") == 1
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"  # methods that the JVM compiles


def test_empty_tables_have_all_features(spark):
    bars, flow = odd_tables(spark)
    made = features.feature_table(bars.limit(0), flow.limit(0))
    assert made.count() == 0 and len(features.feature_list(made, bars)) == 76


def test_averages_equal_those_of_pandas():
    rng = np.random.default_rng(3)
    rows = np.array([rng.normal(size=90), np.full(90, 0.1), np.where(rng.random(90) < 0.1, np.nan, rng.normal(size=90)), np.full(90, np.nan)])
    for alpha in (2 / 14, 1 / 7, 1 / 21):
        for x, found in zip(rows, averaged(rows, alpha)):
            assert np.array_equal(found, pd.Series(x).ewm(alpha=alpha, adjust=False).mean().to_numpy(), equal_nan=True)


def test_series_of_many_tickers_are_those_of_each():
    """Tickers of like length take their steps together, beside shorter ones and ones with gaps."""
    rng = np.random.default_rng(4)
    lengths = np.array([1, 2, 9, 22, 34, 60, 61, 127, 128, 300])
    close = 100 * np.exp(np.cumsum(rng.normal(scale=0.03, size=lengths.sum())))
    close[rng.random(len(close)) < 0.01] = np.nan
    prices, ends = [close, close + 1, close - 1, close, close], np.cumsum(lengths)
    together = series_of(SERIES, prices, ends - lengths, ends)
    for first, end in zip(ends - lengths, ends):
        alone = series_of(SERIES, [p[first:end] for p in prices], np.array([0]), np.array([end - first]))
        for c, x in alone.items():
            assert np.array_equal(x, together[c][first:end], equal_nan=True), c


def test_forecasts_of_a_bar_part_after_the_shuffles(spark):
    """Fourteen rows of each bar used to be shuffled twice on their way to the performance of their models."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "true")
        plan = inputs.performance(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set(key, before)
    parted = next(i for i, line in enumerate(plan) if "Generate explode(forecasts" in line)
    assert not [line for line in plan[:parted] if "Exchange" in line] and any("Exchange" in line for line in plan[parted:])


def test_packed_forecasts_are_the_long_ones(spark):
    bars = spark.createDataFrame([(1, DAY), (1, DAY + dt.timedelta(days=1)), (2, DAY), (None, DAY), (3, None)], "ticker long, date date")
    available = spark.createDataFrame([(1,), (1,), (None,)], "ticker long")
    long = tables.forecasts(bars, available, ("median_gain", "median_loss"), (5, 10), (1, 2, 3, 4))
    packed = tables.packed_forecasts(bars, available, ("median_gain", "median_loss"), (5, 10), (1, 2, 3, 4))
    apart = packed.select("ticker", "date", F.explode("forecasts").alias("f")).select("ticker", "date", "f.*")
    assert sorted(map(str, apart.collect())) == sorted(map(str, long.collect())) and long.count() == 2 * 14 + 3 * 10

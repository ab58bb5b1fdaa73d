"""Scans, sinks and stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.constants import LABEL_WINDOWS, LABELS
from tickerloom.functions.naming import FEATURE_COLUMNS, combined_columns
from tickerloom.operators.features import feature_list as added_columns
from tickerloom.operators.features import feature_table as build_features
from tickerloom.operators.forecasts import combine_forecasts
from tickerloom.operators.labels import make_splits, split_document, split_row, with_labels
from tickerloom.plans import inputs
from tickerloom.plans.registry import query, rounded
from tickerloom.session import shared_folder
from tickerloom.sources import files, market
from tickerloom.sources import tables as t


@query
def scan_ticker_files(spark, sf):
    folder = shared_folder(spark, "ticker-files")
    files.write_overwrite_partitioned(t.bars(spark, sf), folder, "csv")
    schema = "date date, open double, high double, low double, close double, volume double"
    return rounded(files.scan_ticker_files(spark, folder, schema))


@query
def scan_pruned(spark, sf):
    return rounded(files.scan_pruned(t.bars(spark, sf), ["ticker", "date", "close"]))


@query
def scan_tickers_of_industry(spark, sf):
    return rounded(files.scan_tickers_of_industry(t.bars(spark, sf), t.industry(spark, sf), "NATION_15"))


@query
def normalize_ohlcv(spark, sf):
    return rounded(market.normalize_ohlcv(t.raw_prices(spark, sf)))


@query
def clean_flow_snapshot(spark, sf):
    return rounded(market.clean_flow_snapshot(t.snapshots(spark, sf)), 4)


@query
def split_flow_per_ticker(spark, sf):
    clean = market.clean_flow_snapshot(t.snapshots(spark, sf), ("landing",))
    return rounded(market.split_flow_per_ticker(clean), 4)


@query
def active_market_dates(spark, sf):
    return market.active_market_dates(t.bars(spark, sf))


@query
def backfill_dates(spark, sf):
    # pending urgent orders mark the days already landed
    landed = t.table(spark, sf, "orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'").select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("stem"))
    return market.backfill_dates(market.active_market_dates(t.bars(spark, sf)), landed)


@query
def write_overwrite_partitioned(spark, sf):
    folder = shared_folder(spark, "overwrite")
    bars = t.bars(spark, sf)
    # other tickers, whose folders have to go, and other volumes of the same ones
    older = bars.withColumns({"ticker": F.col("ticker") - F.when(F.col("ticker") % 2 == 0, 1_000_000).otherwise(0), "volume": F.lit(-1.0)})
    files.write_overwrite_partitioned(older, folder)
    files.write_overwrite_partitioned(bars, folder)
    back = spark.read.schema(bars.schema).parquet(folder)
    return rounded(back.groupBy("ticker").agg(F.count("*").alias("bars"), F.sum("volume").alias("volume")))


@query
def refresh_tickers(spark, sf):
    """A stored table of which every third ticker is replaced, twice; the others keep what they had."""
    folder = shared_folder(spark, "refreshed")
    bars = t.bars(spark, sf)
    files.write_overwrite_partitioned(bars.withColumn("volume", F.lit(-1.0)), folder)
    for _ in range(2):
        files.refresh_tickers(bars.where("ticker % 3 = 0"), folder)
    back = spark.read.schema(bars.schema).parquet(folder)
    return rounded(back.groupBy("ticker").agg(F.count("*").alias("bars"), F.sum("volume").alias("volume")))


@query
def bucketed_labels(spark, sf):
    """Labels of the days with flow, from bars and flow that are stored bucketed by ticker."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bars = files.write_bucketed(t.bars(spark, sf).select("ticker", "date", "close"), shared_folder(spark, "bars"), buckets)
    flow = files.write_bucketed(t.flow(spark, sf), shared_folder(spark, "flow"), buckets)
    return rounded(with_labels(bars, ("median_gain",), (5,)).join(flow.select("ticker", "date"), ["ticker", "date"], "left_semi"))


@query
def split_dates_sink(spark, sf):
    path = shared_folder(spark, "splits")
    document = split_document(make_splits(inputs.labelled(spark, sf, ("median_gain",), (5,)), "Median Gain 5dd"))
    files.write_json(document, path)
    return split_row(files.read_json(spark, path, document.schema))


@query
def column_info_config(spark, sf):
    """Roles and positions of the stacked columns, with how many rows fill them."""
    labels, windows = tuple(LABELS), LABEL_WINDOWS
    info = combined_columns(labels, windows)
    wide = combine_forecasts(inputs.forecasts(spark, sf), inputs.labelled(spark, sf), labels, windows)
    named = [("feature", c) for c in info["feature_columns"]]
    named += [("target", info["target_column"]), ("threshold", info["threshold_column"])]
    counts = wide.agg(*[F.count(f"`{c}`").alias(f"c{i}") for i, (_, c) in enumerate(named)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(role).alias("role"), F.lit(c).alias("column_name"),
                 F.col(f"c{i}").alias("filled"))
        for i, (role, c) in enumerate(named)
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


@query
def feature_list(spark, sf):
    """Sorted feature names with how many complete rows carry a value other than 0 (beyond rounding)."""
    bars = t.bars(spark, sf)
    table = build_features(bars, t.flow(spark, sf))
    names = added_columns(table, bars)
    assert set(names) == set(FEATURE_COLUMNS.values())
    counts = table.agg(*[F.count_if(F.abs(f"`{c}`") > 1e-9).alias(f"c{i}") for i, c in enumerate(names)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(f"c{i}").alias("nonzero"))
        for i, c in enumerate(names)
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


@query
def ticker_list_scan(spark, sf):
    path = shared_folder(spark, "ticker-list")
    files.write_text_list(t.table(spark, sf, "supplier"), "s_name", path)
    return files.ticker_list_scan(spark, path)


@query
def performance_scan(spark, sf):
    folder = shared_folder(spark, "performance")
    files.write_performance(inputs.performance(spark, sf), folder)
    return rounded(files.performance_scan(spark, folder))

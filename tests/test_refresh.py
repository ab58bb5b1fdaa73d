"""Partial refreshes, bucketed tables and pruned files of stored tables, and the stream of intraday ticks."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import features, labels, outlook
from tickerloom.session import SETTINGS
from tickerloom.sources import files
from tickerloom.sources import tables as t
from tickerloom.streaming import intraday

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 5, 2)


def stored(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def test_refresh_leaves_other_tickers(spark, tmp_path):
    folder = str(tmp_path / "bars")
    rows = spark.range(300).select((F.col("id") % 5).alias("ticker"), F.date_add(F.lit(DAY.date()), (F.col("id") / 5).cast("int")).alias("date"),
                                   F.lit(1.0).alias("close"))
    files.write_overwrite_partitioned(rows, folder)
    before = stored(folder)
    newer = rows.where("ticker IN (1, 3)").withColumn("close", F.lit(2.0)).union(
        spark.createDataFrame([(9, DAY.date(), 2.0)], "ticker long, date date, close double"))
    for _ in range(2):
        files.refresh_tickers(newer, folder)
        after = stored(folder)
        assert {f for f in before if not f.startswith(("ticker=1", "ticker=3"))} == {
            f for f in after if not f.startswith(("ticker=1", "ticker=3", "ticker=9"))}
        found = spark.read.schema(rows.schema).parquet(folder).groupBy("ticker").agg(F.count("*"), F.sum("close")).collect()
        assert {r[0]: (r[1], r[2]) for r in found} == {0: (60, 60.0), 1: (60, 120.0), 2: (60, 60.0), 3: (60, 120.0), 4: (60, 60.0), 9: (1, 2.0)}
    files.refresh_tickers(newer.limit(0), folder)
    assert stored(folder) == after


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan_of(df).count("Exchange hashpartitioning(")


def same(one, other):
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_bucketed_tables_need_no_exchange(spark, tmp_path):
    bars, flow = t.bars(spark, SF), t.flow(spark, SF)
    stored_bars = files.write_bucketed(bars, str(tmp_path / "bars"), 6)
    stored_flow = files.write_bucketed(flow, str(tmp_path / "flow"), 6)
    assert same(stored_bars, bars) and same(stored_flow, flow)
    together = "spark.sql.requireAllClusterKeysForCoPartition"
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", together: SETTINGS[together]}
    before = {key: spark.conf.get(key) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        for name, make in (("labels", lambda b, f: labels.with_labels(b.select("ticker", "date", "close"))),
                           ("join", features.join_bars_flow), ("flow", features.flow_features)):
            assert shuffles(make(bars, flow)) > 0 == shuffles(make(stored_bars, stored_flow)), name
        # the recursive series leave the JVM, which loses the partitioning once
        assert shuffles(features.feature_table(stored_bars, stored_flow)) == 1 < shuffles(features.feature_table(bars, flow))
        assert same(labels.with_labels(stored_bars.select("ticker", "date", "close")), labels.with_labels(bars.select("ticker", "date", "close")))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_bucketed_tables_are_replaced(spark, tmp_path):
    folder = str(tmp_path / "rows")
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("", 3), ("b", None)], "ticker string, x int")
    first = files.write_bucketed(rows, folder, 3)
    assert same(first, rows)
    again = files.write_bucketed(rows.where("x > 1"), f"{folder}/", 5)
    assert same(again, rows.where("x > 1")) and same(spark.read.parquet(folder), again)
    assert files.write_bucketed(rows.limit(0), str(tmp_path / "none"), 2).columns == ["ticker", "x"]
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError, match="at least one bucket"):
        files.write_bucketed(rows, folder, 0)


def test_a_filter_on_tickers_opens_their_files(spark, tmp_path):
    folder, schema = str(tmp_path / "csv"), "date date, open double, high double, low double, close double, volume double"
    bars = t.bars(spark, SF)
    files.write_overwrite_partitioned(bars.coalesce(1), folder, "csv")
    wanted = [r[0] for r in bars.select(F.col("ticker").cast("string")).distinct().orderBy("ticker").limit(3).collect()]
    scanned = files.scan_ticker_files(spark, folder, schema)
    some = scanned.where(F.col("ticker").isin(wanted))
    assert some.count() == bars.where(F.col("ticker").isin([int(x) for x in wanted])).count()
    some.collect()
    opened = some._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numFiles").value()
    of_wanted = [f for f in scanned.inputFiles() if any(f"ticker={x}/" in f for x in wanted)]
    assert opened == len(of_wanted) < len(scanned.inputFiles())


def test_stream_gives_the_price_of_the_batch(spark, tmp_path):
    """Three micro-batches with late, repeated, tied and unusable ticks."""
    at = [DAY + dt.timedelta(hours=h) for h in range(24)]
    batches = [
        [("x", at[9], 1, 10.0), ("x", at[11], 2, 11.0), ("y", at[9], 3, 5.0), (None, at[9], 4, 1.0), ("z", None, 5, 1.0)],
        [("x", at[11], 2, 11.0), ("x", at[10], 6, 99.0), ("y", at[9], 7, 6.0), ("y", at[8], 8, 4.0)],
        [("x", at[12], 9, 12.5), ("x", at[11], 10, 13.0), ("y", at[9], 3, 5.0)],
    ]
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for batch in batches:
        spark.createDataFrame(batch, intraday.TICK_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        intraday.land_ticks(spark, source, target, mark, files_per_batch=1).awaitTermination()
    index = spark.createDataFrame(
        [(n, (DAY - dt.timedelta(days=1)).date(), 1.0) for n in "xyz"], "index_name string, date date, close double")
    everything = spark.createDataFrame([r for b in batches for r in b], intraday.TICK_SCHEMA)

    def prices(ticks):
        return sorted(tuple(r) for r in outlook.latest_price_with_fallback(index, ticks, DAY.date()).collect())

    landed = intraday.landed_ticks(spark, target)
    assert prices(landed) == prices(everything) == [
        ("x", "2024-05-02 12:00:00", 12.5, True), ("y", "2024-05-02 09:00:00", 6.0, True), ("z", "2024-05-01", 1.0, False)]
    assert landed.count() < everything.count()


def test_latest_ticks_of_the_tables(spark):
    index, ticks = t.index_bars(spark, SF), t.intraday(spark, SF)
    as_of = index.agg(F.max("date")).first()[0]

    def prices(part):
        return sorted(tuple(r) for r in outlook.latest_price_with_fallback(index, part, as_of).collect())

    assert prices(intraday.latest_ticks(ticks)) == prices(ticks)

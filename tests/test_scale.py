"""What keeps jobs in bounds on large tables: joins that aren't broadcast, files per ticker."""

import datetime as dt
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tickerloom import session
from tickerloom.operators import logistic, metrics, models, recursive
from tickerloom.plans import inputs
from tickerloom.sources import files, tables

LINES = """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,
l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"""


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Four suppliers with a line on each of 300 days."""
    folder, day = str(tmp_path_factory.mktemp("star")), dt.datetime(1995, 1, 1)
    lines = [
        (i, 1, s, 1, 2.0, 100.0 + (s * 37 + i * 11) % 53, 0.0, 0.0, "ARN"[i % 3], "OF"[i % 2], day + dt.timedelta(days=i))
        for s in (1, 2, 3, 4) for i in range(300)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{folder}/lineitem.parquet")
    suppliers = [(s, f"S{s}", 1, float(s - 2)) for s in (1, 2, 3, 4)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(
        f"{folder}/supplier.parquet")
    return folder


def test_performance_is_merged_with_its_labels(spark, star):
    """A broadcast of the labels, as long as the bars, went through the driver."""
    found = inputs.performance(spark, star)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [ticker" in plan
    rows = {(r.ticker, r.model_version, r.label_type, r.window): r for r in found.collect()}
    # three models of two labels and windows, of which the third lacks the supplier in debt, and the stacker for gains
    assert len(rows) == 4 * (2 * 4 + 2) + 3 * 4
    assert all(r.test_accuracy is not None and r.train_accuracy is not None and r.threshold is not None for r in rows.values())
    truth = inputs.labelled(spark, star).select("ticker", "date", F.col("Median Gain 5dd").alias("label"), F.col("Threshold Median Gain 5dd").alias("threshold"))
    forecasts = inputs.forecasts(spark, star).where("model_version = 1 AND label_type = 'median_gain' AND window = 5")
    splits = inputs.splits_of(spark, star)
    split = F.when(F.col("date").between(splits["test_start"], splits["test_end"]), "test").when(
        F.col("date").between(splits["train_start"], splits["val_end"]), "train")
    plain = forecasts.join(truth, ["ticker", "date"]).where("label IS NOT NULL").select(
        "ticker", "date", "p", F.col("label").alias("y_true"), "threshold", split.alias("split"),
        F.when(F.col("p") >= 0.9, "High Gain").otherwise("Low Gain").alias("y_pred")).where("split IS NOT NULL")
    for r in metrics.performance_by_ticker(plain, "High Gain", "Low Gain").collect():
        other = rows[r.ticker, 1, "median_gain", 5]
        assert all(abs(r[c] - other[c]) < 1e-12 for c in r.asDict() if c != "ticker")


def test_a_ticker_is_one_file(spark, tmp_path):
    """Years of a ticker used to lie in as many files."""
    rows = spark.range(4000).select((F.col("id") % 8).alias("ticker"), F.date_add(F.lit(dt.date(2015, 1, 1)), F.col("id").cast("int")).alias("date"))
    for write in (files.write_overwrite_partitioned, files.refresh_tickers):
        folder = str(tmp_path / write.__name__)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if each partition were large
        try:
            write(rows.repartition(5), folder)
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert len(list(Path(folder).rglob("*.parquet"))) == 8
        assert spark.read.parquet(folder).select("ticker", "date").exceptAll(rows.select(F.col("ticker").cast("int"), "date")).isEmpty()
        assert spark.read.parquet(folder).count() == 4000


def test_products_are_added_up_per_task():
    """Every batch used to send the products of each of its groups."""
    rng = np.random.default_rng(1)
    x, batches = rng.normal(size=(40, 3)), []
    for first in range(0, 40, 4):
        batches.append(pa.RecordBatch.from_pydict({
            "group": ["a", "a", "b", "b"], "fold": ["train"] * 4, "label": [0.0, 1.0, 0.0, 0.0],
            "x": pa.array(x[first:first + 4].tolist(), pa.list_(pa.float64()))}))
    rows = pa.Table.from_batches(models._products(iter(batches), 3)).to_pylist()
    assert sorted((r["group"], r["fold"], r["label"]) for r in rows) == [("a", "train", 0.0), ("a", "train", 1.0), ("b", "train", 0.0)]
    ones, at = np.column_stack((np.ones(40), x)), np.arange(40) % 4
    for r in rows:
        mine = ones[at >= 2] if r["group"] == "b" else ones[at == r["label"]]
        assert np.allclose(np.reshape(r["products"], (4, 4)), mine.T @ mine)
    assert list(models._products(iter([]), 3)) == []


def test_batches_of_series_are_bounded(spark, star, monkeypatch):
    """A batch used to take 10,000 tickers; tickers in small batches get the same series."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    bars, before = inputs.t.bars(spark, star), spark.conf.get(key)
    try:
        spark.conf.set(key, "500000000")
        whole = {(r.ticker, r.date): r for r in recursive.with_recursive_series(bars, ["ema13", "atr_stop", "zigzag"]).collect()}
        assert spark.conf.get(key).rstrip("b") == str(recursive.BATCH_BYTES)
        monkeypatch.setattr(recursive, "BATCH_BYTES", 1)
        parted = recursive.with_recursive_series(bars, ["ema13", "atr_stop", "zigzag"]).coalesce(1).collect()
        assert spark.conf.get(key).rstrip("b") == "1"
        assert len(parted) == len(whole) == 1200 and all(whole[r.ticker, r.date] == r for r in parted)
        recursive.small_batches(spark)
        spark.conf.set(key, "7")
        monkeypatch.setattr(recursive, "BATCH_BYTES", 100)
        recursive.small_batches(spark)
        assert spark.conf.get(key).rstrip("b") == "7"  # a lower limit stays
    finally:
        spark.conf.set(key, before)


def test_tasks_are_small(spark, star, monkeypatch):
    """64 MB of packed bars were over a gigabyte in one task's sorts; partitions now grow with the table."""
    size, joined, number = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                            "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {k: spark.conf.get(k, None) for k in (size, joined, number)}
    try:
        spark.conf.set(size, "128MB")
        spark.conf.set(joined, "1g")
        spark.conf.unset(number)
        tables.table(spark, star, "lineitem")
        assert [int(spark.conf.get(k)) for k in (size, joined)] == [session.READ_BYTES, session.JOINED_BYTES]
        assert spark.conf.get(number, None) is None  # a small table
        monkeypatch.setattr(session, "INPUT_BYTES", 100)
        bars = tables.bars(spark, star)
        most = int(spark.conf.get(number))
        assert most > int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(size, "1000b")
        assert bars.count() == 1200 and tables.table(spark, star, "supplier").count() == 4
        assert spark.conf.get(size) == "1000b" and int(spark.conf.get(number)) == most  # a lower limit, a larger number stay
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_bars_of_a_task_fit_the_limit(spark, tmp_path):
    """Some ten megabytes of packed bars are not joined to one task: a sort of 16 MB took half a gigabyte."""
    joined, first = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = {k: spark.conf.get(k, None) for k in (joined, first)}
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") % 1000).cast("int"))
    spark.range(200_000).select(
        (F.col("id") / 1000).cast("long").alias("l_suppkey"), day.alias("l_shipdate"), F.rand(1).alias("l_extendedprice"),
        (F.rand(2) + 1).alias("l_quantity"), F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_partkey"),
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    try:
        spark.conf.set(joined, "1g")
        spark.conf.set(first, "false")
        bars = tables.bars(spark, str(tmp_path))
        assert bars.rdd.getNumPartitions() > 1 and bars.count() == 200_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_candidates_of_the_stacker_share_passes(spark, monkeypatch):
    """Each candidate used to be a Spark ML fit of its own, a job per step."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3)) * [1, 4, 0.1]
    y = (rng.random(500) < 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1])))).astype(float)
    fold = np.where(np.arange(500) % 4 == 0, "val", "train")
    rows = spark.createDataFrame([(*map(float, a), float(b), str(f)) for a, b, f in zip(x, y, fold)], "a double, b double, c double, label double, fold string")
    fits, passes, of, passed = [], [], models._logistic, logistic._passed
    monkeypatch.setattr(models, "_logistic", lambda *a: fits.append(a) or of(*a))
    monkeypatch.setattr(logistic, "_passed", lambda *a: passes.append(a) or passed(*a))
    models.hyperparam_search(rows, ["a", "b", "c"], models.logistic_proposer(models.Search()), 4, 1500)
    assert len(fits) == 1 and 0 < len(passes) < 40


def test_joint_fits_are_optimal():
    """Their subgradients vanish, whatever the penalty, also for collinear, constant and separable columns."""
    rng = np.random.default_rng(4)
    plain = rng.normal(size=(300, 2)) * [1, 30]
    y = (rng.random(300) < 1 / (1 + np.exp(-plain[:, 0]))).astype(float)
    x = np.column_stack((plain, plain[:, 0], np.full(300, 2.0), 2 * y - 1))
    for data in (x[:, :2], x[:, :4], x):
        weight, total = np.where(y == 1, 150 / y.sum(), 150 / (300 - y.sum())), 300.0
        for c in (1e-4, 1e-2, 1.0, 1e3):
            for l1_ratio in (0.0, 0.5, 1.0):
                fit = logistic._Fit({"c": c, "l1_ratio": l1_ratio}, 300, np.zeros(data.shape[1] + 1), 1500)
                n = 0
                while not fit.done:
                    fit.tell(logistic.loss_parts(data, y, weight, np.array([fit.trial]))[0] / total)
                    n += 1
                w, p = fit.theta[1:], 1 / (1 + np.exp(-(fit.theta[0] + data @ fit.theta[1:])))
                slope = (weight * (p - y)) @ data / total + fit.ridge * w
                assert n < 40 and abs(weight @ (p - y)) / total < 1e-5
                assert (np.abs(slope + fit.lasso * np.sign(w))[w != 0] < 1e-5).all() and (np.abs(slope)[w == 0] < fit.lasso + 1e-5).all()


def test_joint_fits_equal_spark_ml(spark):
    """Spark ML's fit of a candidate comes to the same weights when it may go on for long enough."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3)) * [1, 3, 0.2]
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1])))).astype(float)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, label double")
    weights = {1.0: 200 / y.sum(), 0.0: 200 / (400 - y.sum())}
    candidates = [{"c": c, "l1_ratio": l1} for c in (0.02, 5.0) for l1 in (0.0, 0.4)]
    thetas = logistic.fit_together(rows, weights, 400.0, 3, candidates, 400, 1500)
    ready = models.balanced(rows.withColumn("vector", array_to_vector("x")), {1.0: int(y.sum()), 0.0: int(400 - y.sum())})
    for theta, params in zip(thetas, candidates):
        plain = models._logistic(params, 400, 1500).setTol(1e-13).fit(ready)
        assert np.allclose(theta, [plain.intercept, *plain.coefficients], atol=1e-4)

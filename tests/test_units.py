"""Hand-made frames, brute force and properties."""

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickerloom.constants import FEATURES, FUNDAMENTALS
from tickerloom.functions import scalar as s
from tickerloom.functions import quantiles
from tickerloom.functions.naming import FEATURE_COLUMNS, camel_label, combined_columns, label_config
from tickerloom.functions.quantiles import describe, exact_quantiles
from tickerloom.functions.series import forward_quantile
from tickerloom.operators import cleaning, labels, metrics, models, outlook, recommend, scoring, universe
from tickerloom.operators.indicators import INDICATORS, indicator, with_indicators
from tickerloom.operators.recursive import turning_points, zigzag
from tickerloom.session import through_table
from tickerloom.sources import files, tables
from tickerloom.streaming.landing import land_snapshots, landed_flow

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


def days(n):
    return [DAY + dt.timedelta(days=i) for i in range(n)]


def bars_of(spark, closes, ticker="A"):
    rows = [(ticker, d, float(c), c + 1.0, c - 1.0, float(c), 10.0) for d, c in zip(days(len(closes)), closes)]
    return spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")


def test_golden_fundamental_scores(spark):
    rows = [
        (5.9651, 16.357422, None, 1.080227, 0.18826, 0.073649995, 0.06747, 0.1551, 128.721, 0.99, 0.886, 785965318144.0,
         1052858187776.0, 0.111, -0.032, 7889452.0, 4733600.0, 2473062039552.0, 670.0),
        (5.7346325, None, None, 9272.728, 0.09154, 0.039389998, 0.05799, 0.09937, 65.778, 2.189, 1.623, -77547640.0,
         170782544.0, 0.018, 1.11, 29832534.0, 12628300.0, 5010933415936.0, 306.0),
        (15.667074, None, None, 0.8130701, 0.05207, 0.02388, 0.07733, 0.17374, 88.312, 0.296, 0.098, 109774102528.0,
         9486842880.0, 0.636, 9.164, 73300340.0, 4634000.0, 101055922176.0, 128.0),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in FUNDAMENTALS))
    got = universe.fundamental_score(df).select("avg_value_traded", "fundamental_score").collect()
    expected = [(5285932840.0, 439.7331373386536), (9128755404.0, 374.20344885386424), (9382443520.0, 605.9799888920368)]
    for row, (traded, score) in zip(got, expected):
        assert row[0] == traded and row[1] == pytest.approx(score, abs=1e-9)


def test_golden_outlook(spark):
    vix = spark.range(1).select(F.lit(16.7).alias("value")).select(outlook.classify_vix().alias("c")).select("c.*").first()
    assert (vix.tier, vix.sentiment) == ("Normal", "Neutral")
    fx = spark.range(1).select(F.lit(0.113).alias("change_pct")).select(outlook.classify_fx().alias("c")).select("c.*").first()
    assert fx.description == "Rupiah mildly weaker (+0.11% vs prev close) — minor headwind for IDX."
    moves = spark.createDataFrame([("S&P 500", 0.3727), ("Nikkei 225", 2.6588)], "index_name string, change_pct double")
    got = [r.tier for r in moves.select(outlook.classify_index().alias("c")).select("c.*").collect()]
    assert got == ["Gain", "Strong Rally"]
    named = spark.createDataFrame(
        [(0, "VIX", "Neutral"), (1, "USD/IDR", "Slightly Bearish"), (2, "S&P 500", "Slightly Bullish"), (3, "Nikkei 225", "Bullish")],
        "position int, name string, sentiment string")
    whole = outlook.overall_outlook(named).first()
    assert whole.composite_score == 0.25 and whole.outlook == "Neutral-to-Bullish"
    assert whole.rationale == (
        "VIX is Neutral (score +0.0), USD/IDR is Slightly Bearish (score -0.5), S&P 500 is Slightly Bullish (score +0.5), "
        "Nikkei 225 is Bullish (score +1.0). Composite score: +0.25 → Overall outlook: Neutral-to-Bullish.")


def test_names():
    assert len(FEATURES) == len(FEATURE_COLUMNS) == 76
    assert camel_label("median_gain") == "medianGain"
    with pytest.raises(ValueError):
        label_config("mean_gain", 5)
    info = combined_columns(("median_gain", "median_loss"), (5,))
    assert info["feature_columns"][:3] == [
        "Forecast High Gain 5dd - V1", "Forecast High Loss 5dd - V1", "Forecast High Gain 5dd - V2"]


def test_scalar_edges(spark):
    df = spark.createDataFrame([(0.2,), (1.0,), (1.2,)], "x double")
    assert [r[0] for r in df.select(s.score_bin("x")).collect()] == [0, 4, 5]
    assert [r[0] for r in df.select(s.score_bucket("x")).collect()] == ["0.2 <= x < 0.4", None, None]
    text = spark.createDataFrame([("02 Mei 2024",), ("17 Des 2023",), ("09 Jan 2024",)], "t string")
    assert [r[0] for r in text.select(s.parse_local_date("t")).collect()] == [
        dt.date(2024, 5, 2), dt.date(2023, 12, 17), dt.date(2024, 1, 9)]
    odd = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",)], "t string")
    assert [r[0] for r in odd.select(s.num_coerce("t", 9)).collect()] == [1.5, 9.0, 9.0, 9.0]


@pytest.mark.parametrize("split, small", [(1024, 4096), (4, 3), (16, 50)])
def test_exact_quantiles_against_numpy(spark, split, small):
    """A third of all rows in one value, negative values, a hot group, and values of very different sizes."""
    rng = np.random.default_rng(3)
    values = np.where(rng.random(6000) < 0.34, 1.0, rng.normal(size=6000).round(3) * 5)
    values[:40] = [sign * 10.0 ** e for e in range(-290, 300, 30) for sign in (1, -1)]
    group = np.where(rng.random(6000) < 0.9, "big", "small")
    df = spark.createDataFrame(pd.DataFrame({"g": group, "v": values})).repartition(7)
    probs = {"a": 0.25, "b": 0.5, "c": 0.9, "d": 1.0, "e": 0.001, "f": 0.0, "h": 0.999}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, split, small).collect()}
    for g in ("big", "small"):
        expected = np.quantile(values[group == g], list(probs.values()))
        assert np.allclose([got[g][name] for name in probs], expected)


def test_describe_against_numpy(spark):
    rng = np.random.default_rng(4)
    values = rng.normal(size=9000).round(4)
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(9000) % 2, "v": values})).repartition(5)
    whole = describe(df, [], "v").first()
    assert whole["count"] == 9000 and np.allclose(
        [whole["mean"], whole["std"], whole["min"], whole["q25"], whole["q50"], whole["q75"], whole["max"]],
        [values.mean(), values.std(ddof=1), values.min(), *np.quantile(values, [0.25, 0.5, 0.75]), values.max()])
    assert {r.g: r.q50 for r in describe(df, ["g"], "v").collect()} == pytest.approx({k: np.median(values[k::2]) for k in (0, 1)})
    assert describe(df.limit(0), [], "v").count() == describe(df.limit(0), ["g"], "v").count() == 0
    odd = spark.createDataFrame([(None, 1.0), ("a", None), ("b", float("inf")), ("b", float("-inf")), ("b", 3.0)], "g string, v double")
    assert {r.g: r.q50 for r in describe(odd, ["g"], "v").collect()} == {"b": 3.0}


def test_quantile_plan_has_no_nested_loop(spark):
    """Neither the rounds nor the last step join without a key or deal out ranges of values."""
    data = spark.range(1000).selectExpr("0 AS g", "cast(id AS double) AS __v")
    data = through_table(data, "values")
    groups = through_table(data.groupBy("g").agg(
        F.count("*").alias("__n"), F.array(F.struct(F.min("__v").alias("low"), F.max("__v").alias("high"), F.lit(0).cast("long").alias("before"),
                                                    F.count("*").alias("rows"))).cast(quantiles.CELLS).alias("__cells")), "groups")
    plan = quantiles._selected(data, groups, ["g"], {"q": 0.5}, 8, 4)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "rangepartitioning" not in plan


def test_threshold_sweep_against_brute_force(spark):
    rng = np.random.default_rng(5)
    score = 0.9 * np.concatenate([rng.random(300), np.arange(0, 1, 0.00075)[rng.integers(0, 1334, 200)]])
    profit = np.where(rng.random(500) < 0.34, 0.0, rng.normal(size=500))
    df = spark.createDataFrame(pd.DataFrame({"score": score, "profit": profit}))
    got = scoring.threshold_sweep(df, "profit").toPandas().sort_values("threshold")
    assert np.allclose(got["threshold"], np.arange(0, 1, 0.00075))
    for row in got.itertuples():
        rows = profit[score >= row.threshold]
        if not len(rows):
            assert row.rows == 0 and np.isnan([row.mean, row.max, row.min, row.q25, row.q50, row.q75]).all()
            continue
        expected = [len(rows), rows.mean(), rows.max(), rows.min(), *np.quantile(rows, [0.25, 0.5, 0.75])]
        assert np.allclose([row.rows, row.mean, row.max, row.min, row.q25, row.q50, row.q75], expected)


def test_forward_quantile_against_numpy(spark):
    closes = [5.0, 1.0, None, 4.0, 2.0, 8.0, 3.0, 9.0, 7.0, 6.0, 5.5, 2.5]
    df = spark.createDataFrame([("A", d, c) for d, c in zip(days(len(closes)), closes)], "ticker string, date date, close double")
    for window, q in ((1, 0.5), (3, 0.5), (4, 0.3), (5, 0.9)):
        found = df.select("date", forward_quantile("close", window, q).alias("v"))
        ahead = [closes[i + 1:i + 1 + window] for i in range(len(closes))]
        want = [np.quantile(a, q) if len(a) == window and None not in a else None for a in ahead]
        assert [r.v for r in found.orderBy("date").collect()] == [pytest.approx(w) if w is not None else None for w in want]
        plan = found._jdf.queryExecution().toString()
        assert "percentile" not in plan.lower()


def test_labels_look_forward_only(spark):
    closes = [10.0, 11, 9, 12, 13, 14, 8, 7, 15, 16, 17, 18, 11, 12]
    full = labels.forward_return(bars_of(spark, closes), (5,)).orderBy("date").toPandas()["forward_5"].to_numpy()
    for i in range(len(closes) - 5):
        ahead = np.quantile(closes[i + 1:i + 6], 0.4)
        assert full[i] == pytest.approx(100 * (ahead - closes[i]) / closes[i])
    assert np.isnan(full[-5:]).all()


def test_splits_partition_the_dates(spark):
    rows = bars_of(spark, np.linspace(10, 20, 60).tolist()).withColumn("label", F.lit("x"))
    dates = labels.split_dates(labels.make_splits(rows, "label", 10, 5))
    parts = cleaning.split_masks(rows, dates).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in parts} == {"train": 45, "val": 5, "test": 10}
    assert labels.make_splits(rows, "label", 50, 10).count() == 0


def test_quality_gate_reasons(spark):
    bars = bars_of(spark, [5.0] * 10, "flat").unionByName(bars_of(spark, [1.0, 2, 3], "ok")).unionByName(
        bars_of(spark, [1.0, 2], "noflow"))
    flow = spark.createDataFrame([("flat",), ("ok",)], "ticker string")
    listed = spark.createDataFrame([("flat",), ("ok",), ("noflow",), ("absent",)], "ticker string")
    got = {r.ticker: r.reason for r in cleaning.quality_gate_full(listed, bars, flow).collect()}
    assert got == {"flat": "no price variation", "ok": None, "noflow": "no flow data", "absent": "no price bars"}


def test_features_do_not_look_ahead(spark):
    bars = tables.bars(spark, SF).where("ticker = 3")
    cut = bars.where("date < DATE '1999-01-01'")
    names = [n for n in INDICATORS if n != "zigzag"]
    whole, wanted = with_indicators(bars, names)
    part, _ = with_indicators(cut, names)
    a = whole.where("date < DATE '1999-01-01'").select("date", *wanted).orderBy("date").toPandas()
    b = part.select("date", *wanted).orderBy("date").toPandas()
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9)


def test_flag_sums(spark):
    bars = tables.bars(spark, SF)
    macd = indicator(bars, "macd").select(
        F.min(F.col("macd_near_0") + F.col("macd_non_near_0_negative") + F.col("macd_non_near_0_positive"))).first()[0]
    adx = indicator(bars, "adx").select(
        F.min(F.col("weak_plus_directional_index") + F.col("strong_plus_directional_index"))).first()[0]
    assert macd >= 1 and adx == 1


def brute_turns(close, reversal):
    """The same turns from running extremes of the whole rest of the series."""
    moved = np.flatnonzero(np.abs(close - close[0]) >= reversal * close[0])
    if not len(moved):
        return []
    points = [(0, -1 if close[moved[0]] > close[0] else 1)]
    while True:
        row, side = points[-1][0], -points[-1][1]
        heights = close[row:] * side
        best = np.maximum.accumulate(heights)
        left = np.flatnonzero(best - heights >= reversal * np.abs(best))
        if not len(left):
            return points
        top = np.flatnonzero(heights[:left[0]] == best[left[0]])[-1]
        points.append((row + int(top), side))


def test_zigzag_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(30):
        close = 100 * np.exp(np.cumsum(rng.normal(scale=0.02, size=120)))
        assert turning_points(close, 0.05) == brute_turns(close, 0.05)


def test_zigzag_reaches_the_last_bar():
    class Bars:
        close = np.array([100.0, 104, 106, 110, 103, 100, 99, 108])
    made = zigzag(Bars)
    assert np.isnan(made["zigzag"][:3]).all() and made["zigzag"][-1] == 108
    assert made["zigzag_point"].tolist() == [0, 0, 0, 1, 0, 0, -1, 0]


def test_gini_ties_and_single_class(spark):
    rows = [("A", "u", 0.5), ("A", "d", 0.5), ("A", "u", 0.9), ("A", "d", 0.1), ("B", "u", 0.3)]
    df = spark.createDataFrame(rows, "ticker string, y_true string, p double")
    got = {r.ticker: r.gini for r in metrics.gini(df, ["ticker"], "u").collect()}
    # of the four pairs of a hit and a miss three are right and one is a tie
    assert got["A"] == pytest.approx(2 * 3.5 / 4 - 1)
    assert got["B"] == 0.0


def test_single_date_and_unseen_bin_fail(spark):
    scores = spark.createDataFrame([("A", DAY, 0.3), ("B", DAY + dt.timedelta(days=1), 0.4)], "ticker string, date date, score double")
    with pytest.raises(PySparkException):
        recommend.assert_single_date(scores).collect()
    targets = spark.createDataFrame([(0, -1.0, 2.0)], "bin int, buy_pct double, sell_pct double")
    with pytest.raises(PySparkException):
        recommend.attach_bin_targets(scores.withColumn("bin", s.score_bin("score")), targets).collect()


def training_rows(spark, groups=("a", "b"), n=240):
    """Two features, the first one telling, with folds; group c has one class."""
    rng = np.random.default_rng(0)
    rows = []
    for g in groups:
        for i in range(n):
            label = float(rng.random() < 0.4) if g != "c" else 0.0
            x = rng.normal(loc=2 * label if g == "a" else -2 * label), rng.normal()
            rows.append((g, DAY + dt.timedelta(days=i), *map(float, x), "u" if label else "d", label, ("train", "train", "val", "test")[i % 4]))
    return spark.createDataFrame(rows, "ticker string, date date, x1 double, x2 double, y_true string, label double, fold string")


def test_naive_bayes_per_ticker(spark):
    rows = training_rows(spark, ("a", "b", "c"))
    fitted, failed = models.train(1, rows, ["x1", "x2"])
    assert sorted(r.ticker for r in fitted.collect()) == ["a", "b"]
    assert [tuple(r) for r in failed.collect()] == [("c", "the train rows hold a single class")]
    made = models.forecast_version(1, fitted, rows, ["x1", "x2"]).join(rows, ["ticker", "date"]).toPandas()
    one = made[made.ticker == "a"]
    known = one[one.fold != "test"]
    odds = np.log((known.label == 1).sum() / (known.label == 0).sum())
    for c in ("x1", "x2"):
        v = {y: known[c][known.label == y].var() for y in (0, 1)}
        n = {y: (known.label == y).sum() for y in (0, 1)}
        more = models.SMOOTH * (v[0] * n[0] + v[1] * n[1]) / (n[0] + n[1]) + models.FLOOR
        for y, sign in ((1, 1), (0, -1)):
            m, s2 = known[c][known.label == y].mean(), v[y] + more
            odds = odds - sign * ((one[c] - m) ** 2 / (2 * s2) + np.log(s2) / 2)
    assert np.allclose(one.p, 1 / (1 + np.exp(-odds)), atol=1e-9)


@pytest.mark.parametrize("select_on", ["val", "test"])
def test_discriminant_per_group(spark, select_on, monkeypatch):
    """Groups whose classes lie on opposite sides, all in the same passes, also when weights need several."""
    monkeypatch.setattr(models, "BROADCAST_NUMBERS", 1)
    rows = training_rows(spark, ("a", "b", "c"))
    industries = spark.createDataFrame([("a", "up"), ("b", "down"), ("c", "flat")], "ticker string, industry string")
    search = models.Search(iterations=4, restarts=3, select_on=select_on)
    fitted, made, failed = models.train_router(2, rows, ["x1", "x2"], "u", "d", industries, search)
    assert sorted(r.industry for r in fitted.collect()) == ["down", "up"]
    assert [tuple(r) for r in failed.collect()] == [("flat", "the train rows hold a single class")]
    judged = made.where("split = 'test'").toPandas()
    for g in ("a", "b"):
        assert (judged.y_true == judged.y_pred)[judged.ticker == g].mean() > 0.75


def test_validation_metric_against_brute_force(spark):
    rng = np.random.default_rng(4)
    p, y = rng.integers(0, 20, 300) / 20, rng.integers(0, 2, 300)
    n = rng.integers(1, 4, 300)
    df = spark.createDataFrame(pd.DataFrame({"group": "g", "candidate": 0, "p": p, "y_true": y.astype(float), "n": n}))
    pos, neg = np.repeat(p[y == 1], n[y == 1]), np.repeat(p[y == 0], n[y == 0])
    area = ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))
    assert models._areas(df, "group").first()["metric"] == pytest.approx(area)
    single = models._areas(df.where("y_true = 1"), "group").first()
    assert single["auc"] is None and single["metric"] == pytest.approx((pos > 0.5).mean())


def test_search_needs_two_classes(spark):
    rows = spark.createDataFrame([(1.0, 1.0, "train"), (2.0, 1.0, "train"), (3.0, 0.0, "val")], "x double, label double, fold string")
    with pytest.raises(ValueError):
        models.hyperparam_search(rows, ["x"], models.logistic_proposer(models.Search()), 1, 5)


def searched(seed, batch, iterations=30):
    """The candidates that a search of a known surface tries, and the best score among them."""
    proposer, tried = models.Proposer(models.LOGISTIC_SPACE, seed, logarithmic=("c",)), []
    while len(tried) < iterations:
        for point, params in proposer.ask(min(batch, iterations - len(tried))):
            score = -((np.log10(params["c"]) - 1.3) / 7) ** 2 - (params["l1_ratio"] - 0.27) ** 2
            proposer.tell(point, score)
            tried.append((params, score))
    return tried, max(score for _, score in tried)


def test_search_learns_from_its_results():
    """On a known surface it comes nearer to the top than as many random draws, and again in the same way."""
    better = []
    for seed in range(10):
        rng = np.random.default_rng(seed)
        draws = max(-((7 * a - 4 - 1.3) / 7) ** 2 - (b - 0.27) ** 2 for a, b in rng.random((30, 2)))
        tried, best = searched(seed, 4)
        better.append(best > draws)
        assert best > -1e-3 and searched(seed, 4)[0] == tried
        assert all(1e-4 <= p["c"] <= 1e3 and 0 <= p["l1_ratio"] <= 1 for p, _ in tried)
    assert sum(better) >= 9


def test_stem_files_and_text_list(spark, tmp_path):
    for name in ("BBCA", "BBRI"):
        (tmp_path / f"{name}.csv").write_text("date,close\n2024-01-02,10.5\n")
    got = files.scan_ticker_files(spark, str(tmp_path), "date date, close double")
    assert sorted(r.ticker for r in got.collect()) == ["BBCA", "BBRI"]


def test_streaming_landing_takes_each_file_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    (tmp_path / "in").mkdir()
    header = "Stock Code,Last Trading Date,Foreign Sell,Foreign Buy,Non Regular Volume,Non Regular Value,Non Regular Frequency\n"
    (tmp_path / "in" / "20240502.csv").write_text(header + "BBCA,02 Mei 2024,1,2,3,4,5\n")
    land_snapshots(spark, source, target, mark).awaitTermination()
    (tmp_path / "in" / "20240503.csv").write_text(header + "BBCA,02 Mei 2024,9,9,9,9,9\nBBCA,03 Mei 2024,1,2,3,4,5\n")
    land_snapshots(spark, source, target, mark).awaitTermination()
    got = {r.date: r.foreign_buy for r in landed_flow(spark, target).collect()}
    assert got == {dt.date(2024, 5, 2): 2.0, dt.date(2024, 5, 3): 2.0}


def test_outlook_json_is_nested(spark, tmp_path):
    doc = spark.createDataFrame([(DAY, 1.5)], "date date, value double").select(F.struct("date", "value").alias("vix"))
    files.write_json(doc, str(tmp_path / "o"))
    text = spark.read.text(str(tmp_path / "o")).first()[0]
    assert json.loads(text) == {"vix": {"date": "2024-01-01", "value": 1.5}}


@pytest.mark.parametrize("name", ["train_per_industry", "train_market"])
def test_trained_models_tell_classes_apart(spark, name):
    found = entry.queries()[name](spark, SF).toPandas()
    assert len(found) and found.train_gini.mean() > 0.1


def test_stacker_is_at_its_optimum(spark):
    """The gradient of the penalised loss is zero within tolerance where a weight is not zero."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2]
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] - 0.3 * x[:, 1])))).astype(float)
    fold = np.where(np.arange(400) % 5 == 0, "val", "train")
    rows = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y, "fold": fold}))
    model, params, metric = models.hyperparam_search(
        rows, ["a", "b", "c"], models.logistic_proposer(models.Search()), 3, 1500)
    assert 0.5 < metric <= 1
    last, scaled = model.stages[-1], model.transform(rows).select("vector", "label").toPandas()
    z, w = np.array([v.toArray() for v in scaled.vector]), last.coefficients.toArray()
    weight = np.where(scaled.label == 1, 200 / scaled.label.sum(), 200 / (400 - scaled.label.sum()))
    p = 1 / (1 + np.exp(-(z @ w + last.intercept)))
    strength = 1 / (params["c"] * 400)
    slope = (weight * (p - scaled.label)) @ z / weight.sum() + strength * (1 - params["l1_ratio"]) * w
    limit = strength * params["l1_ratio"]
    assert (np.abs(slope + limit * np.sign(w))[w != 0] < 2e-3).all() and (np.abs(slope)[w == 0] < limit + 2e-3).all()


def test_working_folder_and_discard(spark):
    from tickerloom.session import discard

    table = through_table(spark.range(10), "numbers")
    names = table.inputFiles()
    root = spark.conf.get("spark.checkpoint.dir")
    assert names and all(f"{root}/{spark.sparkContext.applicationId}/numbers-" in name for name in names)
    discard(table)
    with pytest.raises(PySparkException):
        spark.read.parquet(names[0]).count()

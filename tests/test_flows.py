"""The end-to-end flows on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import models
from tickerloom.plans import catalog_models, inputs, pipeline
from tickerloom.session import through_table
from tickerloom.sources import tables as t

SF = "/root/testdata/sf0.001"
SETTINGS = pipeline.Settings(test_length=300, val_length=200, search=models.Search(iterations=2, restarts=2, logistic_steps=50), buckets=4)


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("flow"))
    bars, flow = t.bars(spark, SF), t.flow(spark, SF)
    first = pipeline.develop(spark, bars, flow, t.industry(spark, SF), folder, settings=SETTINGS)
    index = t.index_bars(spark, SF)
    as_of = index.agg(F.max("date")).first()[0]
    second = pipeline.daily(
        spark, bars, flow, folder, index, t.intraday(spark, SF), inputs.ROLES, t.market_index(bars), as_of, SETTINGS,
        one_date=False)
    return first, second


def test_develop(made):
    first, _ = made
    assert set(first) == {"universe", "labels", "forecasts", "performance", "failures", "combined_5", "combined_10", "scores_5",
                          "scores_10", "simulation_5", "simulation_10"}
    combos = first["forecasts"].select("model_version", "label_type", "window").distinct().count()
    assert combos >= 10
    versions = {(r[0], r[1]) for r in first["performance"].select("model_version", "window").distinct().collect()}
    assert {(4, 5), (4, 10)} <= versions and {v for v, _ in versions} == {1, 2, 3, 4}
    assert len(first["combined_5"].columns) == 4 + 6 and len(first["combined_10"].columns) == 4 + 12
    for w in (5, 10):
        scores = first[f"scores_{w}"]
        assert scores.count() > 0 and scores.where("score NOT BETWEEN 0 AND 1").count() == 0
        assert first[f"simulation_{w}"].where("profit < loss").count() == 0
    p = first["forecasts"].agg(F.min("p"), F.max("p")).first()
    assert 0 <= p[0] <= p[1] <= 1


def test_only_tickers_that_meet_the_gini_are_forecast(made):
    first, _ = made
    perf = first["performance"].where("model_version < 4 AND test_gini < 0")
    assert first["forecasts"].join(perf, ["ticker", "model_version", "label_type", "window"], "left_semi").count() == 0


def test_failures_name_a_reason(made):
    first, second = made
    for table in (first["failures"], second["failures"]):
        assert table.columns == ["model_version", "label_type", "window", "identifier", "reason", "step"]
        assert table.where("reason IS NULL OR identifier IS NULL").count() == 0
    trained = first["performance"].where("model_version = 1 AND label_type = 'median_gain' AND window = 5").count()
    failed = first["failures"].where("model_version = 1 AND label_type = 'median_gain' AND window = 5 AND step = 'train'").count()
    assert trained + failed >= first["labels"].select("ticker").distinct().count()


def test_daily_repeats_the_forecasts_of_development(made):
    first, second = made
    assert set(second) == {"labels", "forecasts", "combined_5", "combined_10", "scores_5", "scores_10", "simulation_5",
                           "simulation_10", "recommendations_5", "recommendations_10", "records", "outlook", "failures"}
    keys = ["ticker", "date", "model_version", "label_type", "window"]
    both = first["forecasts"].join(second["forecasts"].withColumnRenamed("p", "again"), keys)
    assert both.count() == first["forecasts"].count() == second["forecasts"].count()
    assert both.agg(F.max(F.abs(F.col("p") - F.col("again")))).first()[0] < 1e-9


def test_daily_recommends_and_looks_out(made):
    _, second = made
    for w in (5, 10):
        advice = second[f"recommendations_{w}"]
        assert advice.count() == second[f"scores_{w}"].select("ticker").distinct().count() > 0
    assert second["records"].count() == sum(second[f"recommendations_{w}"].count() for w in (5, 10))
    document = second["outlook"].first()
    assert document["overall_outlook"]["outlook"] and document["micro_outlook_5dd"]["count"] >= 0
    assert {"vix", "usdidr", "sp500", "nikkei", "micro_outlook_10dd"} <= set(second["outlook"].columns)


def test_universe_from_fundamentals(spark):
    industries = t.industry(spark, SF)
    chosen = pipeline.choose_universe(t.fundamentals(spark, SF), industries)
    assert chosen.columns == ["ticker", "industry"]
    assert 0 < chosen.count() < pipeline.choose_universe(None, industries).count()


def test_untrainable_labels_are_failures(spark, tmp_path_factory):
    """One ticker whose labels never split into two classes: every version fails with a reason, nothing breaks."""
    rows = spark.createDataFrame(
        [("a", "u", 0.0, f) for f in ("train", "train", "val", "test")], "ticker string, y_true string, label double, fold string",
    ).selectExpr("ticker", "date_add(DATE '2024-01-01', cast(monotonically_increasing_id() % 1000 AS int)) AS date", "1.0 AS x", "*").drop("ticker").selectExpr("'a' AS ticker", "date", "x", "y_true", "label", "fold")
    industries = spark.createDataFrame([("a", "i")], "ticker string, industry string")
    for version in (1, 2, 3, 4):
        _, made, failed = models.train_router(version, rows, ["x"], "u", "d", industries, models.Search(iterations=1, restarts=1))
        assert made.count() == 0 and failed.count() == 1


def test_routed_forecasts(spark, monkeypatch):
    """Version 1 is forecast as by the query of version 1; the flag names the tickers of all versions."""
    monkeypatch.setattr(catalog_models, "SEARCH", models.Search(iterations=2, restarts=1))
    routed = through_table(catalog_models.forecast_routed(spark, SF), "routed-test")
    alone = catalog_models.forecast(spark, SF)
    mine = routed.where("model_version = 1").select(alone.columns)
    assert mine.exceptAll(alone).isEmpty() and alone.exceptAll(mine).isEmpty()
    per_ticker = {r[0]: (set(r[1]), r[2]) for r in routed.groupBy("ticker").agg(
        F.collect_set("model_version"), F.bool_and("in_all_versions")).collect()}
    assert per_ticker and all(flag == (versions == {1, 2, 3}) for versions, flag in per_ticker.values())
    assert routed.where("p NOT BETWEEN 0 AND 1").count() == 0

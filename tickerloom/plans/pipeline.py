"""The two end-to-end flows: model development and the daily run.

Stages are lazy functions; results are written below ``folder`` where several later stages read them: features, labels,
training rows, forecasts, stacked forecasts and scores. Both flows return every table they made. What can't be trained or
forecast is a row of the failures table, not an error, and empty results stay empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.constants import LABEL_WINDOWS, LABELS, MARKET, TEST_LENGTH, VAL_LENGTH
from tickerloom.functions.naming import FEATURE_COLUMNS, camel_label, combined_columns, label_config
from tickerloom.operators import cleaning, features, forecasts, labels, metrics, models, outlook, recommend, scoring, universe
from tickerloom.sources import files

BASE_VERSIONS = (1, 2, 3)
COLUMNS = list(FEATURE_COLUMNS.values())
FAILURES = "model_version int, label_type string, window int, identifier string, reason string, step string"


@dataclass(frozen=True)
class Settings:
    """What both flows share.

    Forecasts are made for tickers whose test Gini is at least ``min_test_gini``. With ``buckets`` the feature and label
    tables are bucketed by ticker, which saves the later shuffles by ticker.
    """

    label_types: tuple[str, ...] = tuple(LABELS)
    windows: tuple[int, ...] = LABEL_WINDOWS
    test_length: int = TEST_LENGTH
    val_length: int = VAL_LENGTH
    min_test_gini: float = 0.0
    search: models.Search = field(default_factory=models.Search)
    buckets: int | None = None

    def combos(self):
        return [(label, w) for label in self.label_types for w in self.windows]


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _by_ticker(df: DataFrame, path: str, buckets: int | None) -> DataFrame:
    """As ``_stored``, bucketed by ticker where a number of buckets is given."""
    return files.write_bucketed(df, path, buckets) if buckets else _stored(df, path)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _tagged(df: DataFrame, version: int, label: str, window: int) -> DataFrame:
    return df.withColumns({"model_version": F.lit(version), "label_type": F.lit(label), "window": F.lit(window)})


def choose_universe(fundamentals: DataFrame | None, industries: DataFrame) -> DataFrame:
    """(ticker, industry) of the best-scored liquid tickers; without fundamentals all tickers of the industry table."""
    if fundamentals is None:
        return industries.select("ticker", "industry")
    return universe.select_universe(universe.fundamental_score(fundamentals), industries).select("ticker", "industry")


def prepare(bars, flow, chosen, folder: str, settings: Settings) -> DataFrame:
    """Quality gates, features and labels of the chosen tickers; returns the stored label table."""
    listed = cleaning.selected_universe(chosen, bars)
    verdict = _stored(cleaning.quality_gate_full(listed, bars, flow), f"{folder}/verdict")
    table = _by_ticker(features.feature_table(cleaning.passed(bars, verdict), flow), f"{folder}/features", settings.buckets)
    table = cleaning.passed(table, cleaning.quality_gate_recent(table))
    labelled = labels.with_labels(table, settings.label_types, settings.windows, settings.test_length)
    return _by_ticker(labelled, f"{folder}/labels", settings.buckets)


def _meeting(performance: DataFrame, minimum: float) -> DataFrame:
    """Tickers whose test Gini reaches the minimum."""
    return metrics.tickers_meeting_gini(performance, minimum).select("ticker")


def _stack_inputs(label_table, whole, label_types, window, windows):
    """Stacked forecasts of all windows up to ``window`` under plain column names, and those names.

    Tickers that lack a forecast of any version, label or window drop out.
    """
    used = tuple(w for w in windows if w <= window)
    available = forecasts.ticker_availability(whole, label_types, used, BASE_VERSIONS)
    wide = forecasts.combine_forecasts(
        whole.join(available, "ticker", "left_semi"), label_table, label_types, used, BASE_VERSIONS)
    plain = {c: f"f{i}" for i, c in enumerate(combined_columns(label_types, used, BASE_VERSIONS)["feature_columns"])}
    return wide.withColumnsRenamed(plain), list(plain.values())


def _missing(made: DataFrame, tickers: DataFrame, version, label, window) -> DataFrame:
    """Failure rows of the tickers that should have been forecast and have no model."""
    lost = tickers.select("ticker").distinct().join(made.select("ticker").distinct(), "ticker", "left_anti")
    return _tagged(lost, version, label, window).select(
        "model_version", "label_type", "window", F.col("ticker").cast("string").alias("identifier"),
        F.lit("no model for its forecasts").alias("reason"), F.lit("forecast").alias("step"))


def _forecast_all(spark, label_table, industries, folder, out, settings, performance) -> tuple[DataFrame, list[DataFrame]]:
    """Forecasts of every stored base model for every row of the tickers that meet the Gini, and failures."""
    made, failed = [], []
    for version in BASE_VERSIONS:
        for label, w in settings.combos():
            kind = camel_label(label)
            mine = performance.where(
                (F.col("model_version") == version) & (F.col("label_type") == label) & (F.col("window") == w))
            rows = label_table.join(_meeting(mine, settings.min_test_gini), "ticker", "left_semi")
            stored = models.load_models(spark, version, models.model_path(f"{folder}/models", version, kind, w))
            p = models.forecast_version(version, stored, rows, COLUMNS, industries)
            path = f"{out}/forecast/v{version}-{kind}-{w}dd"
            made.append(_stored(_tagged(p, version, label, w), path))
            failed.append(_missing(made[-1], rows, version, label, w))
    return _union(made), failed


def _score(wide, stacker, performance, splits, names, path) -> DataFrame:
    """Stored scores of test and forecast rows."""
    p = models.forecast(stacker, wide).join(
        wide.select("ticker", "date", F.col(names["target"]).alias("y_true")), ["ticker", "date"])
    prepared = _stored(scoring.score_prepare(p, performance, splits), f"{path}-inputs")
    model = scoring.score_train(prepared, names["positive"])
    return _stored(scoring.score_infer(prepared, model), path)


def _simulated(scores, bars, splits, window, path) -> DataFrame:
    tested = cleaning.split_masks(scores.drop("split"), splits).where("split = 'test'").select("ticker", "date", "score")
    return _stored(scoring.trading_simulation(tested, bars, window), path)


def _failures(spark, parts: list[DataFrame], path: str) -> DataFrame:
    empty = spark.createDataFrame([], FAILURES)
    return _stored(reduce(DataFrame.unionByName, parts, empty), path)


def _failed(reasons: DataFrame, version, label, window, step: str) -> DataFrame:
    return _tagged(reasons, version, label, window).select(
        "model_version", "label_type", "window", "identifier", "reason", F.lit(step).alias("step"))


def develop(spark: SparkSession, bars, flow, industries, folder: str, fundamentals=None,
            settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Train all versions, forecast, stack, score and simulate per window; everything below ``folder``."""
    chosen = _stored(choose_universe(fundamentals, industries), f"{folder}/universe")
    label_table = prepare(bars, flow, chosen, folder, settings)
    split_of = {}
    for w in settings.windows:
        splits = _stored(labels.make_splits(
            label_table, label_config(settings.label_types[0], w)["target"], settings.test_length, settings.val_length),
            f"{folder}/splits/{w}dd")
        split_of[w] = labels.split_dates(splits)
    performance, failed = [], []
    for label, w in settings.combos():
        names, kind = label_config(label, w), camel_label(label)
        rows = _stored(models.split_train_test(label_table, split_of[w], COLUMNS, names["target"], names["positive"]),
                       f"{folder}/training/{kind}-{w}dd")
        limit = label_table.select("ticker", "date", F.col(names["threshold"]).alias("threshold"))
        for version in BASE_VERSIONS:
            fitted, judged, reasons = models.train_router(
                version, rows, COLUMNS, names["positive"], names["negative"], chosen, settings.search)
            models.save_models(fitted, models.model_path(f"{folder}/models", version, kind, w))
            failed.append(_failed(reasons, version, label, w, "train"))
            perf = metrics.performance_by_ticker(
                judged.join(limit, ["ticker", "date"]), names["positive"], names["negative"])
            performance.append(_stored(_tagged(perf, version, label, w), f"{folder}/performance/v{version}-{kind}-{w}dd"))
    whole_performance = _union(performance)
    whole, lost = _forecast_all(spark, label_table, chosen, folder, folder, settings, whole_performance)
    failed += lost

    out = {"universe": chosen, "labels": label_table, "forecasts": whole}
    stacked = []
    for w in settings.windows:
        names = label_config("median_gain", w)
        wide, inputs = _stack_inputs(label_table, whole, settings.label_types, w, settings.windows)
        wide = _stored(wide, f"{folder}/combined/{w}dd")
        rows = _stored(models.split_train_test(
            wide, split_of[w], inputs, names["target"], names["positive"]), f"{folder}/training/stacked-{w}dd")
        stacker, judged, reasons = models.train_router(4, rows, inputs, names["positive"], names["negative"], search=settings.search)
        failed.append(_failed(reasons, 4, "median_gain", w, "train"))
        out[f"combined_{w}"] = wide
        if stacker is None:
            continue
        models.save_models(stacker, models.model_path(f"{folder}/models", 4, "medianGain", w))
        limit = wide.select("ticker", "date", F.col(names["threshold"]).alias("threshold"))
        perf = metrics.performance_by_ticker(judged.join(limit, ["ticker", "date"]), names["positive"], names["negative"])
        stacked.append(_stored(_tagged(perf, 4, "median_gain", w), f"{folder}/performance/v4-medianGain-{w}dd"))
        out[f"scores_{w}"] = _score(wide, stacker, stacked[-1], split_of[w], names, f"{folder}/scores/{w}dd")
        out[f"simulation_{w}"] = _simulated(out[f"scores_{w}"], bars, split_of[w], w, f"{folder}/simulation/{w}dd")
    out["performance"] = _stored(_union(performance + stacked), f"{folder}/performance-all")
    out["failures"] = _failures(spark, failed, f"{folder}/failures")
    return out


def daily(spark: SparkSession, bars, flow, folder: str, index_bars, intraday, roles: dict[str, str], market_index,
          as_of, settings: Settings = Settings(), one_date: bool = True, out: str | None = None) -> dict[str, DataFrame]:
    """Fresh features, forecasts, scores, simulation, recommendations and the outlook with what ``develop`` stored.

    ``roles`` names the indices of the macro outlook, ``market_index`` holds the index of the micro outlook. ``one_date``
    fails the run when the latest scores are not all of one date; turn it off where tickers trade on different days.
    """
    out_folder = out or f"{folder}/daily"
    chosen, performance = spark.read.parquet(f"{folder}/universe"), spark.read.parquet(f"{folder}/performance-all")
    label_table = prepare(bars, flow, chosen, out_folder, settings)
    whole, failed = _forecast_all(spark, label_table, chosen, folder, out_folder, settings, performance)
    made = {"labels": label_table, "forecasts": whole}
    micro, advice = {}, []
    for w in settings.windows:
        names = label_config("median_gain", w)
        splits = labels.split_dates(spark.read.parquet(f"{folder}/splits/{w}dd"))
        stacker = models.load_models(spark, 4, models.model_path(f"{folder}/models", 4, "medianGain", w))
        wide, _ = _stack_inputs(label_table, whole, settings.label_types, w, settings.windows)
        made[f"combined_{w}"] = wide = _stored(wide, f"{out_folder}/combined/{w}dd")
        if stacker is None:
            why = spark.createDataFrame([(MARKET, "no stacker was fitted")], "identifier string, reason string")
            failed.append(_failed(why, 4, "median_gain", w, "forecast"))
            continue
        mine = performance.where((F.col("model_version") == 4) & (F.col("window") == w))
        scores = made[f"scores_{w}"] = _score(wide, stacker, mine, splits, names, f"{out_folder}/scores/{w}dd")
        simulation = made[f"simulation_{w}"] = _simulated(scores, bars, splits, w, f"{out_folder}/simulation/{w}dd")
        advised = recommend.daily_recommendation(
            scores.select("ticker", "date", "score"), bars, scoring.bin_buy_sell_pct(simulation), strict=False, one_date=one_date)
        made[f"recommendations_{w}"] = _stored(advised, f"{out_folder}/recommendations/{w}dd")
        advice.append(recommend.recommendation_records(made[f"recommendations_{w}"], f"{w}dd"))
        micro[w] = outlook.micro_outlook(market_index, scores.select("ticker", "date", "score"), w)
    if advice:
        made["records"] = _stored(_union(advice), f"{out_folder}/records")
    indicators = _stored(outlook.macro_indicators(index_bars, intraday, roles, as_of), f"{out_folder}/indicators")
    overall = outlook.overall_outlook(indicators.select("position", "name", "sentiment"))
    document = outlook.outlook_document(indicators, overall, micro, str(as_of))
    files.write_json(document, f"{out_folder}/outlook")
    made["outlook"] = files.read_json(spark, f"{out_folder}/outlook", document.schema)
    made["failures"] = _failures(spark, failed, f"{out_folder}/failures")
    return made

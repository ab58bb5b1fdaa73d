"""Inputs shared by the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.constants import LABEL_WINDOWS, LABELS
from tickerloom.functions.naming import label_config
from tickerloom.functions.series import by_ticker
from tickerloom.operators.cleaning import split_masks
from tickerloom.operators.labels import make_splits, with_labels
from tickerloom.operators.metrics import performance_by_ticker
from tickerloom.session import join_as_they_lie
from tickerloom.sources import tables as t

VERSIONS = (1, 2, 3)  # versions that forecast from features
STACKER = 4
ROLES = {"vix": "view", "usdidr": "click", "sp500": "purchase", "nikkei": "signup"}


def labelled(spark, sf_dir, label_types=tuple(LABELS), windows=LABEL_WINDOWS) -> DataFrame:
    return with_labels(t.bars(spark, sf_dir).select("ticker", "date", "close"), label_types, windows)


def splits_of(spark, sf_dir, window: int = 5) -> dict:
    """The six split dates of a window as parts of one scalar subquery, so building a plan starts no job.

    A row has labels of all classes as soon as ``window`` rows of its ticker follow it.
    """
    dates = t.bars(spark, sf_dir).select("ticker", "date", F.lead("date", window).over(by_ticker()).alias("later"))
    splits = make_splits(dates, "later")
    row = splits.select(F.struct(*splits.columns).alias("row")).scalar()
    return {name: row[name] for name in splits.columns}


def solvent(spark, sf_dir) -> DataFrame:
    """Tickers whose supplier has no debt: those the market model covers."""
    return t.table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").alias("ticker"))


def forecasts(spark, sf_dir, versions=VERSIONS) -> DataFrame:
    return t.forecasts(t.bars(spark, sf_dir), solvent(spark, sf_dir), tuple(LABELS), LABEL_WINDOWS, versions)


def predictions(spark, sf_dir) -> DataFrame:
    """Labelled rows with a prediction: y_true, y_pred, p, split (train or test), threshold."""
    names = label_config("median_gain", 5)
    rows = labelled(spark, sf_dir, ("median_gain",), (5,)).where(F.col(names["target"]).isNotNull())
    parts = split_masks(rows, splits_of(spark, sf_dir, 5))
    score = t.score_of(31, 17)
    return parts.select(
        "ticker", "date", F.col(names["target"]).alias("y_true"),
        F.when(score >= 0.9, names["positive"]).otherwise(names["negative"]).alias("y_pred"),
        score.alias("p"),
        F.when(F.col("split") == "test", "test").when(F.col("train_val"), "train").alias("split"),
        F.col(names["threshold"]).alias("threshold"),
    ).where("split IS NOT NULL")


def performance(spark, sf_dir) -> DataFrame:
    """Performance of every forecast of versions 1 to 4: one row per model, label, window and ticker.

    The four labels are stacked on the labelled row, so forecasts are joined and aggregated
    once for all of them. The join is merged: sizes of files tell nothing of the rows made from
    them, and a side as long as the bars must not be broadcast. Both sides lie together by ticker
    and are joined as they lie; the fourteen forecasts of a bar part after that, so that neither
    the join nor the aggregates over the forecasts of a ticker shuffle them. Both classes are renamed
    to positive and negative.
    """
    join_as_they_lie(spark)
    stacked = []
    for w in LABEL_WINDOWS:
        splits = splits_of(spark, sf_dir, w)
        d = F.col("date")
        split = F.when(d.between(F.lit(splits["test_start"]), F.lit(splits["test_end"])), "test").when(
            d.between(F.lit(splits["train_start"]), F.lit(splits["val_end"])), "train")
        for label in LABELS:
            names = label_config(label, w)
            truth = F.when(F.col(names["target"]) == names["positive"], "positive").when(
                F.col(names["target"]) == names["negative"], "negative")
            stacked.append(F.struct(
                F.lit(label).alias("label_type"), F.lit(w).alias("window"), truth.alias("y_true"),
                F.col(names["threshold"]).alias("threshold"), split.alias("split")))
    truth = labelled(spark, sf_dir).select("ticker", "date", F.array(*stacked).alias("labels"))
    packed = t.packed_forecasts(
        t.bars(spark, sf_dir), solvent(spark, sf_dir), tuple(LABELS), LABEL_WINDOWS, (*VERSIONS, STACKER))
    joined = packed.join(truth.hint("merge"), ["ticker", "date"]).select(
        "ticker", "date", "labels", F.explode("forecasts").alias("f")).select("ticker", "date", "labels", "f.*")
    mine = F.filter("labels", lambda x: (x["label_type"] == F.col("label_type")) & (x["window"] == F.col("window")))
    rows = joined.withColumn("label", F.get(mine, F.lit(0))).select(
        "ticker", "date", "model_version", "label_type", "window", "p", "label.y_true", "label.threshold", "label.split",
        F.when(F.col("p") >= 0.9, "positive").otherwise("negative").alias("y_pred"),
    ).where("y_true IS NOT NULL AND split IS NOT NULL")
    return performance_by_ticker(
        rows, "positive", "negative", ("ticker", "model_version", "label_type", "window"))


def gain_performance(spark, sf_dir) -> DataFrame:
    """Performance of the plain predictions: one row per ticker."""
    names = label_config("median_gain", 5)
    return performance_by_ticker(predictions(spark, sf_dir), names["positive"], names["negative"])


def test_scores(spark, sf_dir) -> DataFrame:
    rows = split_masks(t.scores(t.bars(spark, sf_dir)), splits_of(spark, sf_dir, 5))
    return rows.where("split = 'test'").select("ticker", "date", "score")

"""Forward-return labels and the date splits built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.constants import LABEL_QUANTILE, LABEL_WINDOWS, LABELS, TEST_LENGTH, VAL_LENGTH
from tickerloom.functions.naming import label_config
from tickerloom.functions.scalar import pct_change_to
from tickerloom.functions.series import by_ticker, forward_quantile


def forward_return(df: DataFrame, windows=LABEL_WINDOWS, column: str = "close",
                   quantile: float = LABEL_QUANTILE) -> DataFrame:
    """``forward_{w}``: percent move to the lower-median of the next ``w`` closes."""
    ahead = {f"_ahead_{w}": forward_quantile(column, w, quantile) for w in windows}
    moves = {f"forward_{w}": pct_change_to(f"_ahead_{w}", column) for w in windows}
    return df.withColumns(ahead).withColumns(moves).drop(*ahead)


def with_labels(df: DataFrame, label_types=tuple(LABELS), windows=LABEL_WINDOWS, test_length: int = TEST_LENGTH,
                keep_returns: bool = False) -> DataFrame:
    """All labels and their thresholds; ``df`` needs ticker, date and close.

    The threshold of a ticker is a quantile of its latest ``test_length`` labelled returns,
    that is of the rows ``w+1 .. w+test_length`` counted from the newest. It is a window
    aggregate over the same partitioning as the returns, so no row is shuffled again.
    """
    whole = Window.partitionBy("ticker")
    out = forward_return(df, windows).withColumn(
        "_age", F.count("*").over(whole) - F.row_number().over(by_ticker()) + 1)
    thresholds, classes = {}, {}
    for w in windows:
        recent = F.when(F.col("_age").between(w + 1, w + test_length), F.col(f"forward_{w}"))
        for label in label_types:
            names, spec = label_config(label, w), LABELS[label]
            thresholds[names["threshold"]] = F.percentile(recent, spec["threshold_q"]).over(whole)
            value, limit = F.col(f"forward_{w}"), F.col(names["threshold"])
            hit = value >= limit if label == "median_gain" else value <= limit
            classes[names["target"]] = F.when(
                value.isNotNull(), F.when(hit, names["positive"]).otherwise(names["negative"]))
    out = out.withColumns(thresholds).withColumns(classes).drop("_age")
    return out if keep_returns else out.drop(*[f"forward_{w}" for w in windows])


def label_threshold(df: DataFrame, label_type: str, window: int, test_length: int = TEST_LENGTH) -> DataFrame:
    """One threshold per ticker."""
    name = label_config(label_type, window)["threshold"]
    labelled = with_labels(df.select("ticker", "date", "close"), (label_type,), (window,), test_length)
    return labelled.groupBy("ticker").agg(F.max(name).alias("threshold"))


def make_splits(df: DataFrame, label_column: str, test_length: int = TEST_LENGTH,
                val_length: int = VAL_LENGTH) -> DataFrame:
    """One row of train, val and test bounds over the labelled dates of all tickers.

    The ranking runs on distinct dates only, whose number the calendar bounds. No row when
    there are not more dates than both hold-out periods take.
    """
    dates = df.where(F.col(label_column).isNotNull()).select("date").distinct()
    ranked = dates.withColumn("age", F.row_number().over(Window.orderBy(F.desc("date"))))
    held_out = test_length + val_length
    part = F.when(F.col("age") <= test_length, "test").when(F.col("age") <= held_out, "val").otherwise("train")
    bounds = [
        bound(F.when(F.col("part") == name, F.col("date"))).alias(f"{name}_{edge}")
        for name in ("train", "val", "test") for edge, bound in (("start", F.min), ("end", F.max))
    ]
    return ranked.withColumn("part", part).agg(*bounds).where(F.col("train_start").isNotNull())


def split_dates(splits: DataFrame) -> dict:
    """The single split row as six dates; raises when there were too few dates to split."""
    row = splits.first()
    if row is None:
        raise ValueError("not enough labelled dates for the validation and test periods")
    return row.asDict()


def split_document(splits: DataFrame) -> DataFrame:
    """The split row as the nested train/val/test document."""
    return splits.select(*[
        F.struct(
            F.col(f"{name}_start").alias("start_date"), F.col(f"{name}_end").alias("end_date")
        ).alias(name)
        for name in ("train", "val", "test")
    ])


def split_row(document: DataFrame) -> DataFrame:
    return document.select(*[
        F.col(f"{name}.{edge}_date").alias(f"{name}_{edge}")
        for name in ("train", "val", "test") for edge in ("start", "end")
    ])

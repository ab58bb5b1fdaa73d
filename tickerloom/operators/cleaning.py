"""Quality gates, splits by date and small filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.constants import LOOKBACK_DAYS, MIN_CLOSE_VARIANCE, RECENT_ROWS


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropna(subset=subset)


def _verdict(per_ticker: DataFrame, checks) -> DataFrame:
    reason = reduce(lambda out, check: out.when(*check), checks[1:], F.when(*checks[0]))
    return per_ticker.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull())


def quality_gate_full(universe: DataFrame, bars: DataFrame, flow: DataFrame,
                      min_variance: float = MIN_CLOSE_VARIANCE) -> DataFrame:
    """(ticker, bars, variance, passed, reason) for every ticker of the universe."""
    moves = bars.groupBy("ticker").agg(F.count("*").alias("bars"), F.var_pop("close").alias("variance"))
    flows = flow.groupBy("ticker").agg(F.count("*").alias("flows"))
    found = universe.select("ticker").distinct().join(moves, "ticker", "left").join(flows, "ticker", "left")
    return _verdict(found, [
        (F.col("bars").isNull(), F.lit("no price bars")),
        (F.col("flows").isNull(), F.lit("no flow data")),
        (F.col("variance") < min_variance, F.lit("no price variation")),
    ]).select("ticker", F.coalesce("bars", F.lit(0)).alias("bars"), "variance", "passed", "reason")


def quality_gate_recent(table: DataFrame, rows: int = RECENT_ROWS,
                        min_variance: float = MIN_CLOSE_VARIANCE) -> DataFrame:
    """The same verdict on the latest rows of the feature table."""
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    tail = table.select("ticker", "date", "close").withColumn("__n", F.row_number().over(newest)).where(
        F.col("__n") <= rows)
    moves = tail.groupBy("ticker").agg(F.count("*").alias("bars"), F.var_pop("close").alias("variance"))
    return _verdict(moves, [(F.col("variance") < min_variance, F.lit("no price variation"))])


def passed(df: DataFrame, verdict: DataFrame) -> DataFrame:
    return df.join(verdict.where("passed").select("ticker"), "ticker", "left_semi")


def run_summary(verdict: DataFrame) -> DataFrame:
    """Succeeded and failed tickers, rows, and failures per reason."""
    return verdict.groupBy(F.coalesce("reason", F.lit("succeeded")).alias("outcome")).agg(
        F.count("*").alias("tickers"), F.sum("bars").alias("total_rows"))


def split_masks(df: DataFrame, splits: dict) -> DataFrame:
    """Columns ``split`` (train, val, test, forecast or NULL) and ``train_val``.

    ``splits`` holds the six bounds as plain dates, so a filter on the result can reach the
    scan. ``train_val`` spans everything from the start of train to the end of val, dates
    between them included.
    """
    d = F.col("date")

    def within(start, end):
        return d.between(F.lit(splits[start]), F.lit(splits[end]))

    split = F.when(within("train_start", "train_end"), "train")
    split = split.when(within("val_start", "val_end"), "val").when(within("test_start", "test_end"), "test")
    split = split.when(d > F.lit(splits["test_end"]), "forecast")
    return df.withColumns({"split": split, "train_val": within("train_start", "val_end")})


def isin_filter(df: DataFrame, choices: dict[str, list]) -> DataFrame:
    """Rows whose every named column is among its choices."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isin(list(v)) for c, v in choices.items()]))


def lookback_filter(df: DataFrame, as_of, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows of the ``days`` calendar days up to ``as_of``."""
    day = F.lit(as_of).cast("date")
    return df.where((F.col("date") >= F.date_sub(day, days)) & (F.col("date") <= day))


def selected_universe(selected: DataFrame, having_data: DataFrame) -> DataFrame:
    """Selected tickers that have data."""
    return selected.select("ticker").distinct().join(having_data.select("ticker"), "ticker", "left_semi")

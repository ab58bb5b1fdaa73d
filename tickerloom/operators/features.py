"""Investor-flow features and the assembled feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.constants import FLOW_WINDOWS
from tickerloom.functions.naming import FEATURE_COLUMNS
from tickerloom.functions.scalar import inf_to_null, safe_divide
from tickerloom.functions.series import rows
from tickerloom.operators.feature_arrays import with_features
from tickerloom.operators.indicators import INDICATORS, Layer

def by_flow():
    """Joined rows of a ticker; rows without flow form their own, unused series."""
    return Window.partitionBy("ticker", "has_flow").orderBy("date")


def join_bars_flow(bars: DataFrame, flow: DataFrame) -> DataFrame:
    """Bars of the days that also have flow."""
    return bars.join(flow, ["ticker", "date"], "inner")


def _flow_layers() -> list[Layer]:
    """Sums over 15, 60 and 90 rows as differences of running totals: each row is added once."""
    price = (F.col("open") + F.col("high") + F.col("low") + F.col("close")) / 4
    foreign = F.col("foreign_buy") - F.col("foreign_sell")
    domestic = F.col("volume") - (F.col("foreign_buy") + F.col("foreign_sell"))
    bases = {
        "_price": price, "_foreign": foreign, "_domestic": domestic,
        "_foreign_value": price * foreign, "_domestic_value": price * domestic,
    }
    so_far = rows(Window.unboundedPreceding, 0, by_flow())
    measures = ("_foreign", "_domestic", "_foreign_value", "_domestic_value")
    totals = {f"{m}_total": F.sum(m).over(so_far) for m in measures}
    totals["_rows_total"] = F.count("_foreign_value").over(so_far)
    before, sums, features = {}, {}, {}
    for n in FLOW_WINDOWS:
        for total in totals:
            before[f"{total}_{n}"] = F.lag(total, n).over(by_flow())
        full = F.col("_rows_total") - F.coalesce(f"_rows_total_{n}", F.lit(0)) == n
        for m in measures:
            earlier = F.coalesce(f"{m}_total_{n}", F.lit(0.0))
            sums[f"{m}_{n}"] = F.when(full, F.col(f"{m}_total") - earlier)
        for who in ("foreign", "domestic"):
            average = safe_divide(F.col(f"_{who}_value_{n}"), F.col(f"_{who}_{n}"))
            features[f"{who}_{n}_days_average_price_over_current_price"] = safe_divide(
                average - F.col("_price"), F.col("_price"))
        features[f"foreign_to_domestic_{n}_days_ownership"] = safe_divide(
            F.col(f"_foreign_{n}"), F.col(f"_foreign_{n}") + F.col(f"_domestic_{n}"))
    current = {f"_now_{name}": inf_to_null(c) for name, c in features.items()}
    lagged = {
        name: F.when(F.col("has_flow"), F.lag(f"_now_{name}", 1).over(by_flow())) for name in features
    }
    return [bases, totals, before, sums, current, lagged]


FLOW_FEATURES = [
    name for n in FLOW_WINDOWS for name in (
        f"foreign_to_domestic_{n}_days_ownership",
        f"foreign_{n}_days_average_price_over_current_price",
        f"domestic_{n}_days_average_price_over_current_price",
    )
]


def with_flow_features(joined: DataFrame) -> DataFrame:
    """Flow features, lagged by one joined row. Needs a boolean ``has_flow``."""
    for layer in _flow_layers():
        joined = joined.withColumns(layer)
    return joined


def flow_features(bars: DataFrame, flow: DataFrame) -> DataFrame:
    joined = join_bars_flow(bars, flow).withColumn("has_flow", F.lit(True))
    return with_flow_features(joined).select("ticker", "date", *FLOW_FEATURES)


def assemble(bars: DataFrame, flow: DataFrame, indicators=tuple(INDICATORS)) -> DataFrame:
    """Bars with every feature, incomplete rows included.

    The flow is attached by one left join; all features are made in one pass over the bars of each ticker
    (``feature_arrays``), with the numbers of the window layers.
    """
    attached = bars.join(
        flow.select("ticker", "date", "foreign_buy", "foreign_sell", F.lit(True).alias("has_flow")),
        ["ticker", "date"], "left",
    ).withColumn("has_flow", F.coalesce("has_flow", F.lit(False)))
    df, made = with_features(attached, indicators)
    return df.select(*bars.columns, *sorted(made))


def feature_table(bars: DataFrame, flow: DataFrame, indicators=tuple(INDICATORS)) -> DataFrame:
    """Complete rows only; features carry their published names."""
    df = assemble(bars, flow, indicators).dropna()
    return df.withColumnsRenamed(FEATURE_COLUMNS)


def feature_list(table: DataFrame, base: DataFrame) -> list[str]:
    """Sorted names of the columns that ``table`` adds to ``base``."""
    return sorted(set(table.columns) - set(base.columns))


def missing_features(df: DataFrame, wanted) -> list[str]:
    present = set(df.columns)
    return [c for c in wanted if c not in present]

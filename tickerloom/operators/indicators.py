"""Technical indicators as layers of window expressions.

Each indicator is a list of layers; a layer may use the columns of earlier ones. Layers of
all wanted indicators are merged before they are applied, so any number of indicators costs
one Exchange, one Sort and a handful of Window nodes. The last layer holds the features.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions.scalar import inf_to_null, safe_divide
from tickerloom.functions.series import (
    by_ticker, crossover_flag, gated, lag_diff, pct_change, rolling_mean, rolling_sum, rows,
    share_flag, sign_change_flag, trend_layers,
)
from tickerloom.operators.recursive import with_recursive_series

BAR = ("open", "high", "low", "close", "volume")
Layer = dict[str, Column]


@dataclass(frozen=True)
class Indicator:
    layers: Callable[[], list[Layer]]
    series: tuple[str, ...] = field(default=())
    base: tuple[str, ...] = field(default=())  # columns that must be known for a row to exist


def flag(condition: Column) -> Column:
    return condition.cast("int")


def _atr_stop():
    stop, close = F.col("atr_stop"), F.col("close")
    return [{"atr_bullish": flag(stop >= close), "atr_bearish": flag(stop < close)}]


def _aroon():
    n = 25
    frame = rows(-n, 0)

    def since(best):
        # the earliest of equal extremes counts
        return F.when(F.col("_rn") > n, 100 * (n - (F.col("_rn") + best["age"])) / n)

    high = F.max(F.struct(F.col("high").alias("v"), (-F.col("_rn")).alias("age"))).over(frame)
    low = F.max(F.struct((-F.col("low")).alias("v"), (-F.col("_rn")).alias("age"))).over(frame)
    up, down = F.col("_aroon_up"), F.col("_aroon_down")
    return [
        {"_aroon_up": since(high), "_aroon_down": since(low)},
        {
            "aroon_change_position": crossover_flag(up >= down),
            "aroon_up_trend": flag(up >= 70),
            "aroon_down_trend": flag(down >= 70),
        },
    ]


def _adx():
    plus, minus = F.col("plus_di"), F.col("minus_di")
    return [{
        "weak_plus_directional_index": flag(plus <= 25),
        "strong_plus_directional_index": flag(plus > 25),
        "weak_minus_directional_index": flag(minus <= 25),
        "strong_minus_directional_index": flag(minus > 25),
    }]


def merge(*stacks: list[Layer]) -> list[Layer]:
    """Stacks side by side, aligned at their last layers."""
    depth = max(map(len, stacks))
    out: list[Layer] = [{} for _ in range(depth)]
    for stack in stacks:
        for level, layer in enumerate(stack, start=depth - len(stack)):
            out[level].update(layer)
    return out


def _elder_ray():
    bull, bear = F.col("_bull"), F.col("_bear")
    shares = {
        "bull_power_80_pct_positives": share_flag(F.col("__bull_place"), bull > 0, 10, 8),
        "bear_power_80_pct_negatives": share_flag(F.col("__bear_place"), bear < 0, 10, 8),
    }
    return [
        {"_bull": F.col("high") - F.col("ema13"), "_bear": F.col("low") - F.col("ema13")},
        *merge(
            trend_layers("_bull", 10, up="bull_power_up_trend"),
            trend_layers("_bear", 10, down="bear_power_trend"),
            [shares],
        ),
    ]


def _macd():
    h, limit = F.col("macd_histogram"), F.col("macd_limit")
    return [{
        "macd_near_0": flag(F.abs(h) < limit),
        "macd_non_near_0_negative": flag(h <= -limit),
        "macd_non_near_0_positive": flag(h >= limit),
    }]


def _channel(name: str, bounds: Layer, width: Column) -> list[Layer]:
    """Features shared by the three price channels; ``bounds`` adds ``_{name}_upper/_lower``."""
    upper, lower, close = F.col(f"_{name}_upper"), F.col(f"_{name}_lower"), F.col("close")
    *lead, flags = trend_layers(
        f"_{name}_width", 5, f"width_{name}_increasing", f"width_{name}_decreasing", from_first_value=False)
    # the trend is taken over all rows, then the rows without a band are dropped
    flags = {k: F.when(upper.isNotNull(), v) for k, v in flags.items()}
    return [
        bounds,
        {f"_{name}_width": width},
        *lead,
        {
            f"{name}_percent_b": safe_divide(close - lower, upper - lower),
            f"{name}_overbought": flag(upper <= close),
            f"{name}_oversold": flag(lower >= close),
            **flags,
        },
    ]


def _keltner():
    center, reach = F.col("ema20"), 2 * F.col("atr10")
    bounds = {"_keltner_upper": center + reach, "_keltner_lower": center - reach}
    return _channel("keltner", bounds, safe_divide(F.col("_keltner_upper") - F.col("_keltner_lower"), center))


def _donchian():
    n, frame = 20, rows(-20, -1)
    bounds = {
        "_donchian_upper": gated(F.max("high"), F.col("high"), n, frame),
        "_donchian_lower": gated(F.min("low"), F.col("low"), n, frame),
    }
    upper, lower = F.col("_donchian_upper"), F.col("_donchian_lower")
    return _channel("donchian", bounds, safe_divide(upper - lower, (upper + lower) / 2))


def _bollinger():
    n, frame, close = 20, rows(-19, 0), F.col("close")
    reach = 2 * gated(F.stddev_pop(close), close, n, frame)
    mean = rolling_mean(close, n)
    bounds = {"_sma20": mean, "_bollinger_upper": mean + reach, "_bollinger_lower": mean - reach}
    width = safe_divide(F.col("_bollinger_upper") - F.col("_bollinger_lower"), F.col("_sma20"))
    return _channel("bollinger", bounds, width)


def _rsi():
    r = F.col("rsi14")
    return [{
        "rsi_value": r,
        "rsi_up_trend": flag(r >= 65),
        "rsi_down_trend": flag(r <= 35),
        "rsi_rate_of_change_5": lag_diff(r, 5),
        "rsi_rate_of_change_10": lag_diff(r, 10),
    }]


def _rsi_multi():
    return [{"rsi_7": F.col("rsi7"), "rsi_21": F.col("rsi21")}]


def _stochastic():
    frame, close, value = rows(-13, 0), F.col("close"), F.col("_stochastic")
    low, high = F.col("_low14"), F.col("_high14")
    k = F.when(high == low, 0.0).otherwise(100 * safe_divide(close - low, high - low))
    return [
        {"_low14": gated(F.min("low"), close, 14, frame), "_high14": gated(F.max("high"), close, 14, frame)},
        {"_k": F.when(low.isNotNull(), k)},
        {"_stochastic": rolling_mean("_k", 3)},
        {
            "stochastic_k_value": value,
            "stochastic_oscillator_overbought": (value >= 80).cast("double"),
            "stochastic_oscillator_oversold": (value <= 20).cast("double"),
        },
    ]


def _cumulative(c: Column) -> Column:
    return F.sum(c).over(rows(Window.unboundedPreceding, 0))


def _obv():
    close = F.col("close")
    step = F.coalesce(F.signum(close - F.lag(close).over(by_ticker())) * F.col("volume"), F.lit(0.0))
    obv = F.col("_obv")
    ratio = {"obv_to_ma20_ratio": inf_to_null(safe_divide(obv, F.col("_obv_mean")))}
    return [
        {"_obv_step": step},
        {"_obv": _cumulative(F.col("_obv_step"))},
        *merge(
            trend_layers("_obv", 5, "on_balance_volume_increasing", "on_balance_volume_decreasing"),
            [{"_obv_mean": rolling_mean(obv, 20)}, ratio],
        ),
    ]


def _money_flow() -> Column:
    high, low, close = F.col("high"), F.col("low"), F.col("close")
    share = F.when(high == low, 0.0).otherwise(safe_divide((close - low) - (high - close), high - low))
    return share * F.col("volume")


def _adl():
    return [
        {"_adl": _cumulative(_money_flow())},
        *trend_layers("_adl", 5, "accumulation_distribution_line_increasing",
                      "accumulation_distribution_line_decreasing"),
    ]


def _cmf():
    cmf = F.col("_cmf")
    return [
        {"_money_flow": _money_flow()},
        {"_cmf": safe_divide(rolling_sum("_money_flow", 20), rolling_sum("volume", 20))},
        {
            "positive_cmf": flag(cmf > 0),
            "strong_positive_cmf": flag(cmf >= 0.25),
            "negative_cmf": flag(cmf <= 0),
            "strong_negative_cmf": flag(cmf <= -0.25),
            "crossover_cmf": sign_change_flag(cmf),
        },
    ]


def _mfi():
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    before, money = F.lag(typical).over(by_ticker()), typical * F.col("volume")
    rose, fell = F.col("_rose"), F.col("_fell")
    mfi = F.col("_mfi")
    up, down = F.col("_rose14"), F.col("_fell14")
    values = {"mfi_value": mfi, "mfi_overbought": flag(mfi >= 80), "mfi_oversold": flag(mfi <= 20)}
    return [
        {"_typical_before": before},
        {
            "_rose": F.when(typical > F.col("_typical_before"), money).when(F.col("_typical_before").isNotNull(), 0.0),
            "_fell": F.when(typical < F.col("_typical_before"), money).when(F.col("_typical_before").isNotNull(), 0.0),
        },
        {"_rose14": rolling_sum("_rose", 14), "_fell14": rolling_sum("_fell", 14)},
        {"_mfi": F.when(down == 0, 100.0).otherwise(100 - 100 / (1 + safe_divide(up, down)))},
        *merge(trend_layers("_mfi", 5, "mfi_increasing", "mfi_decreasing"), [values]),
    ]


def _fisher():
    f = F.col("fisher")
    return [{
        "fisher_up_trend": flag(f >= 2),
        "fisher_down_trend": flag(f <= -2),
        "fisher_reversal": crossover_flag(f >= F.col("fisher_trigger")),
    }]


def _zigzag():
    known, point = F.col("zigzag").isNotNull(), F.col("zigzag_point")
    points = {"zig_zag_high": F.when(known, flag(point > 0)), "zig_zag_low": F.when(known, flag(point < 0))}
    return merge(trend_layers("zigzag", 5, "zig_zag_increasing", "zig_zag_decreasing"), [points])


def _momentum():
    volume = F.col("volume")
    return [
        {"_volume_mean": rolling_mean(volume, 20)},
        {
            **{f"price_momentum_{n}d": pct_change("close", n) for n in (5, 10, 20)},
            "volume_ratio_20d": inf_to_null(safe_divide(volume, F.col("_volume_mean"))),
        },
    ]


INDICATORS = {
    "atr_stop": Indicator(_atr_stop, ("atr_stop",), ("atr_stop",)),
    "aroon": Indicator(_aroon, (), ("_aroon_up",)),
    "adx": Indicator(_adx, ("directional",), ("plus_di", "minus_di")),
    "elder_ray": Indicator(_elder_ray, ("ema13",), ("_bull", "_bear")),
    "macd": Indicator(_macd, ("macd",), ("macd_histogram",)),
    "keltner": Indicator(_keltner, ("ema20", "atr10"), ("_keltner_upper", "_keltner_width")),
    "donchian": Indicator(_donchian, (), ("_donchian_upper", "_donchian_width")),
    "bollinger": Indicator(_bollinger, (), ("_bollinger_upper", "_bollinger_width")),
    "rsi": Indicator(_rsi, ("rsi14",), ("rsi14",)),
    "rsi_multi": Indicator(_rsi_multi, ("rsi7", "rsi21"), ("rsi7",)),
    "stochastic": Indicator(_stochastic, (), ("_stochastic",)),
    "obv": Indicator(_obv, (), ("_obv",)),
    "adl": Indicator(_adl, (), ("_adl",)),
    "cmf": Indicator(_cmf, (), ("_cmf",)),
    "mfi": Indicator(_mfi, (), ("_mfi",)),
    "fisher": Indicator(_fisher, ("fisher",), ("fisher", "fisher_trigger")),
    "zigzag": Indicator(_zigzag, ("zigzag",), ("zigzag",)),
    "momentum": Indicator(_momentum, (), ()),
}


def with_indicators(bars: DataFrame, names) -> tuple[DataFrame, list[str]]:
    """``bars`` with working and feature columns of the named indicators; feature names."""
    chosen = [INDICATORS[n] for n in names]
    df = with_recursive_series(bars, [s for i in chosen for s in i.series])
    df = df.withColumn("_rn", F.row_number().over(by_ticker()))
    stacks = [i.layers() for i in chosen]
    for level in range(max(map(len, stacks))):
        layer = {k: v for stack in stacks if level < len(stack) for k, v in stack[level].items()}
        df = df.withColumns(layer)
    return df, [c for stack in stacks for c in stack[-1]]


def indicator(bars: DataFrame, name: str) -> DataFrame:
    """Features of one indicator on the rows where its base series is known."""
    df, features = with_indicators(bars, [name])
    base = list(INDICATORS[name].base)
    return (df.dropna(subset=base) if base else df).select("ticker", "date", *features)

"""All features of many tickers at once, as arrays.

The layers of ``indicators`` and ``features`` say the same as window expressions. Spark evaluates a moving frame anew for each
of its rows, value by value, which costs a quarter of a millisecond per bar when all 76 features are wanted. Here the bars of
some hundred tickers lie in one array each, in date order, and a frame is a handful of shifted additions. Sums run from the
oldest to the newest value, as in a window, so both ways give the same numbers.

Missing values are NaN in the arrays and NULL in the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from tickerloom.constants import FLOW_WINDOWS
from tickerloom.functions.series import SLOPE_NOISE
from tickerloom.operators.indicators import INDICATORS
from tickerloom.operators.recursive import PRICES, series_of, small_batches

#: Rows whose features are made at a time, all bars of a ticker together; and rows of a batch that goes back to Spark.
CHUNK_ROWS, OUT_ROWS = 65_536, 8_192
#: Bytes of a generated method above which the JVM never compiles it; expressions of 76 columns in one are far above.
METHOD_BYTES = 8_000


class Runs:
    """Rows of several tickers one after the other; frames end where a ticker does."""

    def __init__(self, starts: np.ndarray, rows: int):
        self.rows, self.ends = rows, np.append(starts[1:], rows)
        self.starts, self.place = starts, np.arange(rows) - np.repeat(starts, self.ends - starts)
        self._early: dict[int, np.ndarray] = {}

    def lag(self, x: np.ndarray, k: int, missing=np.nan) -> np.ndarray:
        """The value ``k`` rows before."""
        if k == 0:
            return x
        if k not in self._early:
            self._early[k] = np.flatnonzero(self.place < k)
        out = np.empty_like(x)
        out[k:] = x[:-k]
        out[self._early[k]] = missing
        return out

    def running(self, x: np.ndarray) -> np.ndarray:
        """Sum of the known values so far, unknown before the first."""
        known, out = x == x, np.empty(self.rows)
        filled = np.where(known, x, 0.0)
        for first, end in zip(self.starts.tolist(), self.ends.tolist()):
            np.cumsum(filled[first:end], out=out[first:end])
        return np.where(self.counted(known) > 0, out, np.nan)

    def counted(self, known: np.ndarray) -> np.ndarray:
        """Number of true values so far."""
        total = np.cumsum(known)
        return total - np.repeat(np.append(0, total)[self.starts], self.ends - self.starts)

    def known(self, x: np.ndarray, oldest: int, newest: int) -> np.ndarray:
        """Number of known values from ``oldest`` to ``newest`` rows before."""
        so_far = self.counted(x == x)
        return self.lag(so_far, newest, 0) - self.lag(so_far, oldest + 1, 0)

    def added(self, x: np.ndarray, oldest: int, newest: int) -> np.ndarray:
        """Sum of the known values of a frame; 0 where there are none."""
        filled, total = np.where(x == x, x, 0.0), np.zeros(self.rows)
        for k in range(oldest, newest - 1, -1):
            total += self.lag(filled, k, 0.0)
        return total

    def largest(self, x: np.ndarray, oldest: int, newest: int) -> np.ndarray:
        """Largest known value of a frame."""
        filled, best = np.where(x == x, x, -np.inf), np.full(self.rows, -np.inf)
        for k in range(oldest, newest - 1, -1):
            np.maximum(best, self.lag(filled, k, -np.inf), out=best)
        return np.where(self.known(x, oldest, newest) > 0, best, np.nan)

    def smallest(self, x: np.ndarray, oldest: int, newest: int) -> np.ndarray:
        return -self.largest(-x, oldest, newest)

    def sum(self, x: np.ndarray, n: int) -> np.ndarray:
        """Sum of the last ``n`` values, all of them known."""
        return np.where(self.known(x, n - 1, 0) == n, self.added(x, n - 1, 0), np.nan)

    def mean(self, x: np.ndarray, n: int) -> np.ndarray:
        return self.sum(x, n) / n

    def deviation(self, x: np.ndarray, n: int) -> np.ndarray:
        """Standard deviation of the last ``n`` values, all of them known; each moves the mean as in Spark."""
        mean, squares = np.zeros(self.rows), np.zeros(self.rows)
        for count, k in enumerate(range(n - 1, -1, -1), start=1):
            gap = self.lag(x, k) - mean
            share = gap / count
            mean += share
            squares += gap * (gap - share)
        return np.sqrt(squares / n)

    def since_largest(self, x: np.ndarray, n: int) -> np.ndarray:
        """Rows since the largest of the last ``n + 1`` values; the earliest of equal ones counts."""
        filled, best, age = np.where(x == x, x, -np.inf), np.full(self.rows, -np.inf), np.full(self.rows, n)
        for k in range(n, -1, -1):
            value = self.lag(filled, k, -np.inf)
            age[value > best] = k
            np.maximum(best, value, out=best)
        return age

    def before(self, x: np.ndarray) -> np.ndarray:
        """The last known value before a row."""
        at = self.lag(np.maximum.accumulate(np.where(x == x, np.arange(self.rows), -1)), 1, -1)
        return np.where(at >= np.arange(self.rows) - self.place, x[at], np.nan) if self.rows else x


def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unknown where ``b`` is 0."""
    return np.divide(a, b, out=np.full(len(b), np.nan), where=b != 0)


def finite(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < np.inf, x, np.nan)


def flag(hit: np.ndarray, *needed: np.ndarray) -> pa.Array:
    """1 or 0; unknown where one of ``needed`` is."""
    unknown = np.zeros(len(hit), dtype=bool)
    for x in needed:
        unknown |= x != x
    return pa.array(hit.astype(np.int32), mask=unknown)


def number(hit: np.ndarray, known: np.ndarray) -> np.ndarray:
    return np.where(known, hit.astype(np.float64), np.nan)


def crossed(runs: Runs, left: np.ndarray, right: np.ndarray) -> pa.Array:
    """1 where ``left >= right`` differs from the row before."""
    state = number(left >= right, (left == left) & (right == right))
    before = runs.lag(state, 1)
    return flag(state != before, state, before)


def trend(runs: Runs, y: np.ndarray, n: int, up: str | None = None, down: str | None = None, from_first_value: bool = True) -> dict:
    """Flags of the slope over the previous ``n`` rows; see ``series.trend_layers``."""
    k = runs.place + 1.0
    known, total, moment = runs.known(y, n, 1), runs.added(y, n, 1), runs.added(y * k, n, 1)
    high, low = runs.largest(y, n, 1), runs.smallest(y, n, 1)
    slope = moment - (k - (known + 1) / 2) * total
    noise = SLOPE_NOISE * n * k * np.maximum(np.abs(high), np.abs(low))
    placed = (runs.counted(y == y) if from_first_value else runs.place + 1) > n
    out = {}
    if up:
        out[up] = number((high > low) & (slope > noise), placed)
    if down:
        out[down] = number((high > low) & (slope < -noise), placed)
    return out


def _atr_stop(b, runs):
    stop = b["atr_stop"]
    return {"atr_bullish": flag(stop >= b["close"], stop, b["close"]), "atr_bearish": flag(stop < b["close"], stop, b["close"])}


def _aroon(b, runs):
    n = 25
    up, down = (np.where(runs.place >= n, 100 * (n - runs.since_largest(x, n)) / n, np.nan) for x in (b["high"], -b["low"]))
    return {
        "aroon_change_position": crossed(runs, up, down),
        "aroon_up_trend": flag(up >= 70, up),
        "aroon_down_trend": flag(down >= 70, down),
    }


def _adx(b, runs):
    plus, minus = b["plus_di"], b["minus_di"]
    return {
        "weak_plus_directional_index": flag(plus <= 25, plus),
        "strong_plus_directional_index": flag(plus > 25, plus),
        "weak_minus_directional_index": flag(minus <= 25, minus),
        "strong_minus_directional_index": flag(minus > 25, minus),
    }


def _elder_ray(b, runs):
    bull, bear = b["high"] - b["ema13"], b["low"] - b["ema13"]

    def share(x, hit):
        return number(runs.added(hit.astype(np.float64), 10, 1) >= 8, runs.counted(x == x) > 10)

    return {
        **trend(runs, bull, 10, up="bull_power_up_trend"),
        **trend(runs, bear, 10, down="bear_power_trend"),
        "bull_power_80_pct_positives": share(bull, bull > 0),
        "bear_power_80_pct_negatives": share(bear, bear < 0),
    }


def _macd(b, runs):
    h, limit = b["macd_histogram"], b["macd_limit"]
    return {
        "macd_near_0": flag(np.abs(h) < limit, h, limit),
        "macd_non_near_0_negative": flag(h <= -limit, h, limit),
        "macd_non_near_0_positive": flag(h >= limit, h, limit),
    }


def _channel(name, b, runs, upper, lower, center):
    close = b["close"]
    flags = trend(runs, over(upper - lower, center), 5, f"width_{name}_increasing", f"width_{name}_decreasing", from_first_value=False)
    return {
        f"{name}_percent_b": over(close - lower, upper - lower),
        f"{name}_overbought": flag(upper <= close, upper, close),
        f"{name}_oversold": flag(lower >= close, lower, close),
        **{k: np.where(upper == upper, v, np.nan) for k, v in flags.items()},
    }


def _keltner(b, runs):
    center, reach = b["ema20"], 2 * b["atr10"]
    return _channel("keltner", b, runs, center + reach, center - reach, center)


def _donchian(b, runs):
    upper, lower = (
        np.where(runs.known(x, 20, 1) == 20, best(x, 20, 1), np.nan)
        for x, best in ((b["high"], runs.largest), (b["low"], runs.smallest)))
    return _channel("donchian", b, runs, upper, lower, (upper + lower) / 2)


def _bollinger(b, runs):
    mean = runs.mean(b["close"], 20)
    reach = np.where(mean == mean, 2 * runs.deviation(b["close"], 20), np.nan)
    return _channel("bollinger", b, runs, mean + reach, mean - reach, mean)


def _rsi(b, runs):
    r = b["rsi14"]
    return {
        "rsi_value": r,
        "rsi_up_trend": flag(r >= 65, r),
        "rsi_down_trend": flag(r <= 35, r),
        "rsi_rate_of_change_5": r - runs.lag(r, 5),
        "rsi_rate_of_change_10": r - runs.lag(r, 10),
    }


def _rsi_multi(b, runs):
    return {"rsi_7": b["rsi7"], "rsi_21": b["rsi21"]}


def _stochastic(b, runs):
    close, whole = b["close"], runs.known(b["close"], 13, 0) == 14
    low, high = np.where(whole, runs.smallest(b["low"], 13, 0), np.nan), np.where(whole, runs.largest(b["high"], 13, 0), np.nan)
    k = np.where(high == low, 0.0, 100 * over(close - low, high - low))
    value = runs.mean(np.where(low == low, k, np.nan), 3)
    return {
        "stochastic_k_value": value,
        "stochastic_oscillator_overbought": number(value >= 80, value == value),
        "stochastic_oscillator_oversold": number(value <= 20, value == value),
    }


def _obv(b, runs):
    step = np.sign(b["close"] - runs.lag(b["close"], 1)) * b["volume"]
    obv = runs.running(np.where(step == step, step, 0.0))
    return {
        **trend(runs, obv, 5, "on_balance_volume_increasing", "on_balance_volume_decreasing"),
        "obv_to_ma20_ratio": finite(over(obv, runs.mean(obv, 20))),
    }


def _money_flow(b):
    high, low, close = b["high"], b["low"], b["close"]
    return np.where(high == low, 0.0, over((close - low) - (high - close), high - low)) * b["volume"]


def _adl(b, runs):
    return trend(runs, runs.running(_money_flow(b)), 5, "accumulation_distribution_line_increasing",
                 "accumulation_distribution_line_decreasing")


def _cmf(b, runs):
    cmf = over(runs.sum(_money_flow(b), 20), runs.sum(b["volume"], 20))
    before = runs.before(cmf)
    return {
        "positive_cmf": flag(cmf > 0, cmf),
        "strong_positive_cmf": flag(cmf >= 0.25, cmf),
        "negative_cmf": flag(cmf <= 0, cmf),
        "strong_negative_cmf": flag(cmf <= -0.25, cmf),
        "crossover_cmf": flag(cmf * before <= 0, cmf, before),
    }


def _mfi(b, runs):
    typical = (b["high"] + b["low"] + b["close"]) / 3
    before, money = runs.lag(typical, 1), typical * b["volume"]
    still = np.where(before == before, 0.0, np.nan)
    up, down = runs.sum(np.where(typical > before, money, still), 14), runs.sum(np.where(typical < before, money, still), 14)
    mfi = np.where(down == 0, 100.0, 100 - 100 / (1 + over(up, down)))
    return {
        **trend(runs, mfi, 5, "mfi_increasing", "mfi_decreasing"),
        "mfi_value": mfi, "mfi_overbought": flag(mfi >= 80, mfi), "mfi_oversold": flag(mfi <= 20, mfi),
    }


def _fisher(b, runs):
    f = b["fisher"]
    return {
        "fisher_up_trend": flag(f >= 2, f),
        "fisher_down_trend": flag(f <= -2, f),
        "fisher_reversal": crossed(runs, f, b["fisher_trigger"]),
    }


def _zigzag(b, runs):
    line, point = b["zigzag"], b["zigzag_point"]
    return {
        **trend(runs, line, 5, "zig_zag_increasing", "zig_zag_decreasing"),
        "zig_zag_high": flag(point > 0, line, point), "zig_zag_low": flag(point < 0, line, point),
    }


def _momentum(b, runs):
    return {
        **{f"price_momentum_{n}d": over(b["close"], runs.lag(b["close"], n)) - 1 for n in (5, 10, 20)},
        "volume_ratio_20d": finite(over(b["volume"], runs.mean(b["volume"], 20))),
    }


ARRAYS = {
    "atr_stop": _atr_stop, "aroon": _aroon, "adx": _adx, "elder_ray": _elder_ray, "macd": _macd, "keltner": _keltner,
    "donchian": _donchian, "bollinger": _bollinger, "rsi": _rsi, "rsi_multi": _rsi_multi, "stochastic": _stochastic, "obv": _obv,
    "adl": _adl, "cmf": _cmf, "mfi": _mfi, "fisher": _fisher, "zigzag": _zigzag, "momentum": _momentum,
}


def _flow(b, runs, has_flow):
    """Flow features of the rows with flow, which form a series of their own, one of its rows later."""
    at = np.flatnonzero(has_flow)
    seen = np.append(0, np.cumsum(has_flow))
    starts = seen[runs.starts]
    joined = Runs(starts[seen[runs.ends] > starts], len(at))
    open, high, low, close, volume, bought, sold = (b[c][at] for c in (*PRICES, "foreign_buy", "foreign_sell"))
    price, foreign, domestic = (open + high + low + close) / 4, bought - sold, volume - (bought + sold)
    measures = {"foreign": foreign, "domestic": domestic, "foreign_value": price * foreign, "domestic_value": price * domestic}
    totals = {name: joined.running(x) for name, x in measures.items()}
    known = joined.counted(measures["foreign_value"] == measures["foreign_value"])
    made = {}
    for n in FLOW_WINDOWS:
        full, sums = known - joined.lag(known, n, 0) == n, {}
        for name, total in totals.items():
            earlier = joined.lag(total, n)
            sums[name] = np.where(full, total - np.where(earlier == earlier, earlier, 0.0), np.nan)
        for who in ("foreign", "domestic"):
            made[f"{who}_{n}_days_average_price_over_current_price"] = over(over(sums[f"{who}_value"], sums[who]) - price, price)
        made[f"foreign_to_domestic_{n}_days_ownership"] = over(sums["foreign"], sums["foreign"] + sums["domestic"])
    out = {}
    for name, x in made.items():
        out[name] = np.full(runs.rows, np.nan)
        out[name][at] = joined.lag(finite(x), 1)
    return out


def features_of(table: pa.Table, starts: np.ndarray, names) -> dict[str, pa.Array]:
    """Features of the named indicators and of the flow, by name; a ticker begins at each of ``starts``."""
    runs, columns = Runs(starts, table.num_rows), (*PRICES, "foreign_buy", "foreign_sell")
    b = {c: table.column(c).cast(pa.float64(), safe=False).to_numpy().astype(np.float64) for c in columns}
    b |= series_of([s for n in names for s in INDICATORS[n].series], [b[p] for p in PRICES], starts, runs.ends)
    with np.errstate(all="ignore"):
        found = [ARRAYS[n](b, runs) for n in names]
        found.append(_flow(b, runs, table.column("has_flow").to_numpy().astype(bool)))
    return {
        name: x if isinstance(x, pa.Array) else pa.array(x, from_pandas=True) for part in found for name, x in sorted(part.items())}


def _starts(ticker: pa.ChunkedArray) -> np.ndarray:
    """Rows at which another ticker begins; those without one are together."""
    if len(ticker) == 0:
        return np.empty(0, dtype=np.int64)
    one, next_ = ticker.slice(0, len(ticker) - 1), ticker.slice(1)
    other = pc.or_(pc.fill_null(pc.not_equal(one, next_), False), pc.not_equal(pc.is_null(one), pc.is_null(next_)))
    return np.append(0, np.flatnonzero(other.to_numpy()) + 1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole tickers and where these begin; ``batches`` come sorted by ticker."""
    held, rows, wanted = [], 0, CHUNK_ROWS
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= wanted:
            table = pa.Table.from_batches(held)
            starts = _starts(table.column("ticker"))
            last = int(starts[-1])
            if last:
                yield table.slice(0, last), starts[:-1]
            held, rows = table.slice(last).to_batches(), rows - last
            wanted = max(CHUNK_ROWS, 2 * rows)  # a long ticker is looked at again when it has doubled
    if rows:
        table = pa.Table.from_batches(held)
        yield table, _starts(table.column("ticker"))


def compiled_methods(spark: SparkSession) -> None:
    """Lower the session's limit of a generated method to what the JVM compiles; above it Spark splits the expressions."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > METHOD_BYTES:
        spark.conf.set(key, str(METHOD_BYTES))


def with_features(attached: DataFrame, names) -> tuple[DataFrame, list[str]]:
    """``attached`` (bars, foreign_buy, foreign_sell, has_flow) with all features, and their names.

    One exchange and one sort bring the bars of a ticker together in date order; rows of one date follow their values.
    """
    small_batches(attached.sparkSession)
    compiled_methods(attached.sparkSession)
    names = tuple(names)
    order = ["ticker", "date", *PRICES, "foreign_buy", "foreign_sell", "has_flow"]
    nothing = pa.table({c: pa.array([], pa.bool_() if c == "has_flow" else pa.float64()) for c in order[2:]})
    made = {name: x.type for name, x in features_of(nothing, np.empty(0, dtype=np.int64), names).items()}
    schema = T.StructType(attached.schema.fields + [T.StructField(name, from_arrow_type(kind)) for name, kind in made.items()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _chunks(batches):
            found = features_of(table, starts, names)
            whole = pa.Table.from_arrays(table.columns + list(found.values()), table.column_names + list(found))
            yield from whole.combine_chunks().to_batches(max_chunksize=OUT_ROWS)

    return attached.repartition("ticker").sortWithinPartitions(*order).mapInArrow(add, schema), list(made)

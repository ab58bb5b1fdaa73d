"""Series in which each row depends on its own previous value.

Spark window frames cannot refer to their own output, so these run over the prices of a ticker as arrays (bounded by
the calendar), all wanted series in one pass. Only the five price arrays cross to Python, as numbers; every other column
stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def seeded_average(x: np.ndarray, n: int, alpha: float, start: int = 0) -> np.ndarray:
    """Exponential averages seeded with the plain mean of the first ``n`` values, a row of ``x`` for each ticker."""
    out = np.full(x.shape, np.nan)
    first = start + n - 1
    if first < x.shape[1]:
        tail = x[:, first:].copy()
        tail[:, 0] = x[:, start:start + n].mean(axis=1)
        out[:, first:] = averaged(tail, alpha)
    return out


def averaged(x: np.ndarray, alpha: float) -> np.ndarray:
    """pandas' ``ewm(alpha, adjust=False).mean()`` of every row, to the last bit: one step serves all rows."""
    new = 1 / (1 + (1 - alpha) / alpha)
    old, steps = 1 - new, np.array(x.T, order="C")
    whole, part, other = old + new, np.empty(len(x)), np.empty(len(x))
    with np.errstate(all="ignore"):
        for average, value in zip(steps, steps[1:]):
            np.multiply(average, old, out=part)
            np.multiply(value, new, out=other)
            np.add(part, other, out=part)
            np.divide(part, whole, out=part)
            np.copyto(value, part, where=value != average)
    out = steps.T
    for row in np.flatnonzero(np.isnan(x).any(axis=1)):  # a gap makes the next value weigh more
        out[row] = pd.Series(x[row]).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    return out


def ema(x, n, start=0):
    return seeded_average(x, n, 2.0 / (n + 1), start)


def wilder(x, n, start=0):
    return seeded_average(x, n, 1.0 / n, start)


def moves(x):
    return np.diff(x, axis=1, prepend=np.nan)


def true_range(b):
    tr = np.full(b.close.shape, np.nan)
    prev = b.close[:, :-1]
    tr[:, 1:] = np.maximum.reduce([b.high[:, 1:] - b.low[:, 1:], abs(b.high[:, 1:] - prev), abs(b.low[:, 1:] - prev)])
    return tr


class Bars:
    """Prices of some tickers: a row of each array for a ticker, in date order, filled up behind its last bar."""

    def __init__(self, open, high, low, close, volume, lengths):
        self.open, self.high, self.low, self.close, self.volume, self.lengths = open, high, low, close, volume, lengths

    def each(self):
        """Row and number of bars of each ticker."""
        return enumerate(self.lengths.tolist())


PRICES = ("open", "high", "low", "close", "volume")


def ema_close(n):
    return lambda b: {f"ema{n}": ema(b.close, n)}


def atr(n):
    return lambda b: {f"atr{n}": wilder(true_range(b), n, 1)}


def rsi(n):
    def series(b):
        move = moves(b.close)
        gain = wilder(np.where(move > 0, move, 0.0), n, 1)
        loss = wilder(np.where(move < 0, -move, 0.0), n, 1)
        ratio = np.divide(gain, loss, out=np.zeros_like(gain), where=loss > 0)
        value = np.where(loss > 0, 100 - 100 / (1 + ratio), 100.0)
        return {f"rsi{n}": np.where(np.isnan(gain), np.nan, value)}

    return series


def directional(b):
    up = moves(b.high)
    down = -moves(b.low)
    plus = wilder(np.where((up > down) & (up > 0), up, 0.0), 14, 1)
    minus = wilder(np.where((down > up) & (down > 0), down, 0.0), 14, 1)
    span = wilder(true_range(b), 14, 1)
    span = np.where(span > 0, span, np.nan)
    return {"plus_di": 100 * plus / span, "minus_di": 100 * minus / span}


def macd(b):
    line = ema(b.close, 12) - ema(b.close, 26)
    histogram = line - ema(line, 9, 25)
    limit = np.full(histogram.shape, np.nan)
    for row, n in b.each():
        limit[row, :n] = pd.Series(np.abs(histogram[row, :n])).rolling(50, min_periods=1).median().to_numpy()
    return {"macd_histogram": histogram, "macd_limit": limit}


def atr_stop(b, n=21, multiple=3.0):
    """Trailing stop: a band that only tightens, swapped when the close crosses it."""
    bands = multiple * wilder(true_range(b), n, 1)
    stops = np.full(b.close.shape, np.nan)
    for row, end in b.each():
        if end > n:
            stops[row, n:end] = _stop(b.close[row, :end].tolist(), bands[row, :end].tolist(), n)
    return {"atr_stop": stops}


def _stop(close, width, n):
    """Stops of one ticker from its row ``n`` on."""
    stop = []
    rising = close[n] >= close[n - 1]
    upper, lower = close[n] + width[n], close[n] - width[n]
    for i in range(n, len(close)):
        before, above, below = close[i - 1], close[i] + width[i], close[i] - width[i]
        upper = above if above < upper or before > upper else upper
        lower = below if below > lower or before < lower else lower
        rising = close[i] > (lower if rising else upper)
        stop.append(lower if rising else upper)
    return stop


def fisher(b, n=10):
    middle = (b.high + b.low) / 2
    low, high = middle.copy(), middle.copy()
    for k in range(1, min(n, middle.shape[1])):
        np.fmin(low[:, k:], middle[:, :-k], out=low[:, k:])
        np.fmax(high[:, k:], middle[:, :-k], out=high[:, k:])
    span = high - low
    place = np.divide(middle - low, span, out=np.zeros(low.shape), where=span > 0) - 0.5
    out = np.zeros(low.shape[::-1])
    x, value = np.zeros(len(low)), np.zeros(len(low))
    for i, (at, wide) in enumerate(zip(place.T[1:], (span > 0).T[1:]), start=1):
        x = np.where(wide, 0.66 * at + 0.67 * x, 0.0)
        x = np.where(x > 0.99, 0.999, np.where(x < -0.99, -0.999, x))
        value = 0.5 * np.log((1 + x) / (1 - x)) + 0.5 * value
        out[i] = value
    trigger = np.full(low.shape, np.nan)
    trigger[:, 1:] = out.T[:, :-1]
    return {"fisher": np.where(np.isnan(trigger), np.nan, out.T), "fisher_trigger": trigger}


def next_turn(close, row, side, reversal):
    """Row of the next extreme on ``side`` that is left by ``reversal``, or None."""
    best = row
    for i in range(row + 1, len(close)):
        if (close[i] - close[best]) * side >= 0:
            best = i
        elif abs(close[i] - close[best]) >= reversal * close[best]:
            return best
    return None


def turning_points(close, reversal):
    """Alternating extremes as (row, +1 high / -1 low); the first bar starts the first line."""
    moved = np.flatnonzero(np.abs(close - close[0]) >= reversal * close[0])
    if not len(moved):
        return []
    points = [(0, -1 if close[moved[0]] > close[0] else 1)]
    prices = close.tolist()
    while (row := next_turn(prices, points[-1][0], -points[-1][1], reversal)) is not None:
        points.append((row, -points[-1][1]))
    return points


def zigzag(b, reversal=0.05):
    """Lines between turning points, the last one drawn to the latest close.

    The line up to the second point is not yet confirmed and stays missing. Later bars can
    move the last point, so this series repaints.
    """
    line = np.full(len(b.close), np.nan)
    point = np.zeros(len(b.close))
    if not len(line):
        return {"zigzag": line, "zigzag_point": point}
    points = turning_points(b.close, reversal)
    corners = [row for row, _ in points[1:]] + [len(line) - 1]
    line[corners[0]:] = np.interp(np.arange(corners[0], len(line)), corners, b.close[corners])
    for row, side in points[1:]:
        point[row] = side
    return {"zigzag": line, "zigzag_point": point}


def zigzags(b):
    made = {c: np.full(b.close.shape, np.nan) for c in ("zigzag", "zigzag_point")}
    for row, n in b.each():
        one = zigzag(Bars(*[None] * 3, b.close[row, :n], None, None))
        for c, x in one.items():
            made[c][row, :n] = x
    return made


SERIES = {
    "ema13": (ema_close(13), ["ema13"]),
    "ema20": (ema_close(20), ["ema20"]),
    "atr10": (atr(10), ["atr10"]),
    "rsi7": (rsi(7), ["rsi7"]),
    "rsi14": (rsi(14), ["rsi14"]),
    "rsi21": (rsi(21), ["rsi21"]),
    "directional": (directional, ["plus_di", "minus_di"]),
    "macd": (macd, ["macd_histogram", "macd_limit"]),
    "atr_stop": (atr_stop, ["atr_stop"]),
    "fisher": (fisher, ["fisher", "fisher_trigger"]),
    "zigzag": (zigzags, ["zigzag", "zigzag_point"]),
}
REPAINTS = {"zigzag"}
#: Bytes of prices that one Arrow batch may hold: some hundred tickers. The series made of them take three times as many.
BATCH_BYTES = 8_000_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit of an Arrow batch to ``BATCH_BYTES``; a lower one stays.

    By Spark's own a batch takes up to 10,000 tickers, whose prices and series a Python worker would hold at once.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def series_of(wanted, prices: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Columns of the wanted series; ``prices`` hold the rows of one ticker after the other.

    Tickers of like length, none twice as long as another, take their steps together.
    """
    chosen = [SERIES[name] for name in dict.fromkeys(wanted)]
    made = {c: np.empty(len(prices[0])) for _, columns in chosen for c in columns}
    lengths = ends - starts
    size = np.frexp(lengths)[1]
    for one in np.unique(size[lengths > 0]).tolist():
        mine = np.flatnonzero(size == one)
        step = np.arange(lengths[mine].max())
        inside = step < lengths[mine, None]
        at = np.where(inside, starts[mine, None] + step, 0)
        data = Bars(*[np.where(inside, p[at], 0.0) for p in prices], lengths[mine])
        with np.errstate(all="ignore"):
            for function, _ in chosen:
                for c, x in function(data).items():
                    made[c][at[inside]] = x[inside]
    return made


def with_recursive_series(bars: DataFrame, wanted) -> DataFrame:
    """``bars`` with the columns of the wanted series; unknown values are NULL."""
    wanted = list(dict.fromkeys(wanted))
    if not wanted:
        return bars
    columns = [c for name in wanted for c in SERIES[name][1]]
    small_batches(bars.sparkSession)

    @F.arrow_udf(f"struct<{','.join(f'{c}:array<double>' for c in columns)}>")
    def series(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for prices in batches:
            offsets = prices[0].offsets
            values = [p.flatten().to_numpy(zero_copy_only=False) for p in prices]
            edges = offsets.to_numpy() - offsets[0].as_py()
            made = series_of(wanted, values, edges[:-1], edges[1:])
            ends = pa.array(edges.astype(np.int32))
            yield pa.StructArray.from_arrays([
                pa.ListArray.from_arrays(ends, pa.array(made[c], from_pandas=True)) for c in columns], columns)

    rest = [c for c in bars.columns if c != "ticker"]
    whole = F.array_sort(F.collect_list(F.struct("date", *[c for c in rest if c != "date"])))
    packed = bars.groupBy("ticker").agg(whole.alias("__rows"))
    prices = [F.col(f"__rows.{p}").cast("array<double>") for p in PRICES]
    zipped = packed.select("ticker", "__rows", series(*prices).alias("__made")).select("ticker", F.explode(
        F.arrays_zip("__rows", *[F.col(f"__made.{c}").alias(c) for c in columns])).alias("__r"))
    return zipped.select("ticker", *[F.col(f"__r.__rows.{c}").alias(c) for c in rest], *[F.col(f"__r.{c}").alias(c) for c in columns]) \
        .select(*bars.columns, *columns)

"""Expressions over the rows of one ticker in date order.

All helpers use the same window specification, so Spark plans one Exchange and one Sort
for any number of them. A ticker has one row per trading date, so the rows of one window
partition are bounded by the calendar (about 250 a year), however large the table is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

SLOPE_NOISE = 1e-13  # relative size of the rounding errors in the sums of a frame


def by_ticker() -> WindowSpec:
    """Rows of a ticker in date order (built on use: a window needs a running session)."""
    return Window.partitionBy("ticker").orderBy("date")


def rows(a: int, b: int, w: WindowSpec | None = None) -> WindowSpec:
    return (w or by_ticker()).rowsBetween(a, b)


def gated(agg: Column, value: Column, n: int, frame) -> Column:
    """``agg`` over ``frame``, only where the frame holds ``n`` values."""
    return F.when(F.count(value).over(frame) == n, agg.over(frame))


def rolling_sum(c, n: int, w=None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return gated(F.sum(c), c, n, rows(-(n - 1), 0, w))


def rolling_mean(c, n: int, w=None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return gated(F.avg(c), c, n, rows(-(n - 1), 0, w))


def rolling_median(c, n: int, w=None) -> Column:
    """Median of up to ``n`` trailing values.

    Early rows see all values so far, which is what an expanding median would give.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.percentile(c, 0.5).over(rows(-(n - 1), 0, w))


def forward_quantile(c, window: int, q: float, w=None) -> Column:
    """Interpolated quantile of the next ``window`` values; NULL unless all exist.

    The values are sorted in the row itself: offsets need no aggregate over a sliding frame. Missing values sort first.
    """
    c = F.col(c) if isinstance(c, str) else c
    ahead = F.sort_array(F.array(*[F.lead(c, i).over(w or by_ticker()) for i in range(1, window + 1)]).cast("array<double>"))
    at = (window - 1) * q
    low, high = math.floor(at), math.ceil(at)
    value = ahead[low] if low == high else ahead[low] * (high - at) + ahead[high] * (at - low)
    return F.when(ahead[0].isNotNull(), value)


def forward_max(c, window: int, w=None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return gated(F.max(c), c, window, rows(1, window, w))


def forward_min(c, window: int, w=None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return gated(F.min(c), c, window, rows(1, window, w))


def pct_change(c, n: int, w=None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.try_divide(c, F.lag(c, n).over(w or by_ticker())) - 1


def lag_diff(c, n: int, w=None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c - F.lag(c, n).over(w or by_ticker())


def position(c, w=None, from_first_value: bool = True) -> Column:
    """1-based place of a row, counted from the first known value or from the first row."""
    c = F.col(c) if isinstance(c, str) else c
    if from_first_value:
        return F.count(c).over(rows(Window.unboundedPreceding, 0, w))
    return F.row_number().over(w or by_ticker())


def trend_layers(name: str, n: int, up: str | None = None, down: str | None = None, w=None,
                 from_first_value: bool = True, order: str = "_rn") -> list[dict[str, Column]]:
    """Flags of the least-squares slope of column ``name`` over the previous ``n`` rows.

    Two layers, applied one after the other: frame sums, then flags. ``order`` holds the row
    number. Only the sign of the slope matters, which is that of
    ``sum(k*y) - mean(k)*sum(y)``. Missing values may only lead the series, so the ``m`` known
    values are the latest ones and ``mean(k)`` is ``row - (m+1)/2``. A flat frame or one with
    a single value has slope 0, and so has one whose slope is only rounding noise of the
    sums. The first ``n`` rows of the series have no flag.
    """
    frame, y, k = rows(-n, -1, w), F.col(name), F.col(order)
    c = {part: f"_{name}_{part}" for part in ("place", "known", "sum", "moment", "high", "low")}
    sums = {
        c["place"]: position(name, w, from_first_value),
        c["known"]: F.count(y).over(frame),
        c["sum"]: F.sum(y).over(frame),
        c["moment"]: F.sum(y * k).over(frame),
        c["high"]: F.max(y).over(frame),
        c["low"]: F.min(y).over(frame),
    }
    slope = F.col(c["moment"]) - (k - (F.col(c["known"]) + 1) / 2) * F.col(c["sum"])
    noise = SLOPE_NOISE * n * k * F.greatest(F.abs(c["high"]), F.abs(c["low"]))
    moving = F.col(c["high"]) > F.col(c["low"])  # NULL when nothing is known yet

    def flag(condition):
        hit = F.when(moving, condition.cast("double")).otherwise(0.0)
        return F.when(F.col(c["place"]) > n, hit)

    flags = {}
    if up:
        flags[up] = flag(slope > noise)
    if down:
        flags[down] = flag(slope < -noise)
    return [sums, flags]


def share_flag(place: Column, hit: Column, n: int, at_least: int, w=None) -> Column:
    """1.0 where at least ``at_least`` of the previous ``n`` rows meet ``hit``."""
    hits = F.sum(F.when(hit, 1).otherwise(0)).over(rows(-n, -1, w))
    return F.when(place > n, (hits >= at_least).cast("double"))


def crossover_flag(state: Column, w=None) -> Column:
    """1 where a state differs from the row before; NULL on the first row."""
    return (state != F.lag(state).over(w or by_ticker())).cast("int")


def sign_change_flag(c, w=None) -> Column:
    """1 where the product with the previous known value is not positive."""
    c = F.col(c) if isinstance(c, str) else c
    before = F.last(c, ignorenulls=True).over(rows(Window.unboundedPreceding, -1, w))
    return (c * before <= 0).cast("int")

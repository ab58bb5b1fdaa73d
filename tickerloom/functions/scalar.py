"""Row-level expressions. Missing values are NULL throughout, never NaN."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom.constants import LOCAL_MONTHS, SCORE_EDGES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num_coerce(c, fallback: float = 0.0) -> Column:
    """Number if the value reads as one, else ``fallback``."""
    value = _col(c).try_cast("double")
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(float(fallback)))


def clip(c, lower: float | None = None, upper: float | None = None) -> Column:
    """Clamp; NULL stays NULL (plain least/greatest would replace it by the bound)."""
    value = out = _col(c)
    if upper is not None:
        out = F.least(out, F.lit(float(upper)))
    if lower is not None:
        out = F.greatest(out, F.lit(float(lower)))
    return F.when(value.isNotNull(), out)


def safe_divide(numerator, denominator) -> Column:
    """NULL instead of an error where the denominator is zero."""
    return F.try_divide(_col(numerator), _col(denominator))


def inf_to_null(c) -> Column:
    value = _col(c)
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def clean_float(c) -> Column:
    """Missing, NaN or unreadable -> 0.0, for records handed to a client."""
    return num_coerce(c, 0.0)


def parse_local_date(c) -> Column:
    """``02 Mei 2024`` -> date."""
    text = reduce(lambda e, pair: F.replace(e, F.lit(pair[0]), F.lit(pair[1])), LOCAL_MONTHS, _col(c))
    return F.to_date(text, "dd MMM yyyy")


def to_local_date(c) -> Column:
    """Inverse of :func:`parse_local_date`."""
    text = F.date_format(_col(c), "dd MMM yyyy")
    return reduce(lambda e, pair: F.replace(e, F.lit(pair[1]), F.lit(pair[0])), LOCAL_MONTHS, text)


def iso_date(c) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def score_bin(c) -> Column:
    """0-based bin whose upper edge includes the score; past the last edge one more bin."""
    value = _col(c)
    out = F.when(value <= SCORE_EDGES[0], 0)
    for i, edge in enumerate(SCORE_EDGES[1:], start=1):
        out = out.when(value <= edge, i)
    return out.otherwise(len(SCORE_EDGES))


def score_bucket(c) -> Column:
    """Lower-inclusive bucket label; a score of 1 or more falls out as NULL."""
    value = _col(c)
    edges = (0.0,) + SCORE_EDGES
    names = [str(e) for e in edges[:-1]] + ["1"]
    out = None
    for lo, hi, lo_name, hi_name in zip(edges, edges[1:], names, names[1:]):
        hit = (value >= lo) & (value < hi)
        label = F.lit(f"{lo_name} <= x < {hi_name}")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def target_buy_price(close, buy_pct) -> Column:
    return F.floor(_col(close) * (100 - F.abs(_col(buy_pct))) / 100).cast("double")


def target_sell_price(close, sell_pct) -> Column:
    return F.ceil(_col(close) * (100 + F.abs(_col(sell_pct))) / 100).cast("double")


def camel_to_title(c) -> Column:
    """``medianGain`` -> ``Median Gain``."""
    return F.initcap(F.regexp_replace(_col(c), "([A-Z])", " $1"))


def pct_change_to(new, old) -> Column:
    """Percentage move from ``old`` to ``new``."""
    return 100 * (_col(new) - _col(old)) / _col(old)


def tiers(value, table, *format_args, inclusive: bool = True) -> Column:
    """Struct (tier, sentiment, description) of the first tier whose upper bound holds."""
    value = _col(value)
    out = None
    for bound, tier, sentiment, text in table:
        description = F.format_string(text, *format_args) if format_args else F.lit(text)
        row = F.struct(
            F.lit(tier).alias("tier"), F.lit(sentiment).alias("sentiment"), description.alias("description")
        )
        if bound is None:
            return row if out is None else out.otherwise(row)
        hit = value <= bound if inclusive else value < bound
        out = F.when(hit, row) if out is None else out.when(hit, row)
    return out

"""Registered queries: one name per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` places, so that summation order does not show.

    Rounding first to four places more puts noisy halves back on the half.
    """
    return df.select(*[
        F.round(F.round(F.col(f"`{name}`"), digits + 4), digits).alias(name) if kind == "double" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])

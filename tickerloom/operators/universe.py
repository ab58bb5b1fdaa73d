"""Fundamental scores and the selection of tickers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.constants import LIQUIDITY_PENALTY, LIQUIDITY_QUANTILE, MIN_VALUE_TRADED, UNIVERSE_SIZE
from tickerloom.functions.quantiles import exact_quantiles
from tickerloom.functions.scalar import clip, num_coerce, safe_divide


def _percent(name: str, upper: float) -> Column:
    return clip(num_coerce(name, -1) * 100, -50, upper)


def _inverse(name: str, weight: float, floor: float, cap: float) -> Column:
    return clip(weight / clip(num_coerce(name, 999), lower=floor), upper=cap)


def profitability() -> Column:
    return (_percent("returnOnEquity", 80) + _percent("returnOnAssets", 80)
            + _percent("profitMargins", 70) + _percent("operatingMargins", 70))


def growth() -> Column:
    return _percent("revenueGrowth", 150) + _percent("earningsGrowth", 150)


def valuation() -> Column:
    return (_inverse("pegRatio", 50, 0.1, 100) + _inverse("forwardPE", 200, 1, 75)
            + _inverse("trailingPE", 200, 1, 75) + _inverse("priceToBook", 25, 0.1, 50))


def health() -> Column:
    return (clip(num_coerce("currentRatio") * 20, upper=50) + clip(num_coerce("quickRatio") * 25, upper=50)
            + clip(200 - num_coerce("debtToEquity", 999), -50, 100))


def cashflow() -> Column:
    cap = num_coerce("marketCap")

    def cash_yield(name):
        share = F.when(cap > 0, safe_divide(num_coerce(name), cap) * 100)
        return clip(F.coalesce(share, F.lit(-50.0)) * 10, -50, 100)

    return cash_yield("freeCashflow") + cash_yield("operatingCashflow")


def value_traded() -> Column:
    return num_coerce("averageVolume") * num_coerce("regularMarketPrice")


def liquidity() -> Column:
    scale = F.log10(clip(value_traded(), lower=1)) - F.log10(F.lit(MIN_VALUE_TRADED))
    return clip(scale * 50, -100, 200)


def liquidity_gate() -> Column:
    return F.when(value_traded() < MIN_VALUE_TRADED, LIQUIDITY_PENALTY).otherwise(0.0)


PARTS = {
    "profitability": profitability, "growth": growth, "valuation": valuation, "health": health,
    "cashflow": cashflow, "liquidity": liquidity,
}


def fundamental_score(df: DataFrame) -> DataFrame:
    """Adds ``avg_value_traded`` and ``fundamental_score``; a projection, nothing is shuffled."""
    total = sum((part() for name, part in PARTS.items()), F.lit(0.0)) + liquidity_gate()
    return df.withColumns({"avg_value_traded": value_traded(), "fundamental_score": total})


def liquidity_cutoff(scored: DataFrame, quantile: float = LIQUIDITY_QUANTILE) -> DataFrame:
    """Tickers whose traded value reaches the market-wide quantile."""
    cutoff = exact_quantiles(scored, [], "avg_value_traded", {"cutoff": quantile})
    return scored.where(F.col("avg_value_traded") >= cutoff.scalar())


def join_industry(selected: DataFrame, industries: DataFrame | None) -> DataFrame:
    """Adds the industry; without an industry table every ticker is ``Unknown``."""
    if industries is None:
        return selected.withColumn("industry", F.lit("Unknown"))
    return industries.join(selected, "ticker")


def select_universe(scored: DataFrame, industries: DataFrame | None, size: int = UNIVERSE_SIZE) -> DataFrame:
    """The best-scored liquid tickers; ties go to the smaller ticker."""
    best = liquidity_cutoff(scored).orderBy(F.desc("fundamental_score"), "ticker").limit(size)
    return join_industry(best, industries)


def industry_counts(selected: DataFrame) -> DataFrame:
    return selected.groupBy("industry").agg(F.count("*").alias("tickers")).orderBy(F.desc("tickers"), "industry")

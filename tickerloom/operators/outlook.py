"""Macro and micro market outlook."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.constants import (
    FX_TIERS, INDEX_TIERS, LABEL_QUANTILE, LOOKBACK_DAYS, OUTLOOK_TIERS, SENTIMENT_SCORES, SMA_ROWS, VIX_TIERS,
)
from tickerloom.functions.quantiles import describe
from tickerloom.functions.scalar import pct_change_to, tiers
from tickerloom.functions.series import forward_quantile
from tickerloom.operators.cleaning import lookback_filter

def by_index():
    return Window.partitionBy("index_name").orderBy("date")


def latest_and_previous(index_bars: DataFrame) -> DataFrame:
    """Last date, last and previous close, mean of the last 20 closes and number of rows.

    An index has one close per day, so its window is bounded by the calendar.
    """
    age = F.row_number().over(Window.partitionBy("index_name").orderBy(F.desc("date")))
    return index_bars.withColumn("age", age).groupBy("index_name").agg(
        F.max("date").alias("date"),
        F.max(F.when(F.col("age") == 1, F.col("close"))).alias("close"),
        F.max(F.when(F.col("age") == 2, F.col("close"))).alias("previous"),
        F.avg(F.when(F.col("age") <= SMA_ROWS, F.col("close"))).alias("sma20"),
        F.count("*").alias("days"),
    )


def latest_price_with_fallback(index_bars: DataFrame, intraday: DataFrame, as_of) -> DataFrame:
    """Latest tick of the ``as_of`` day, else the last daily close."""
    today = intraday.where(F.to_date("ts") == F.lit(as_of).cast("date"))
    tick = today.groupBy("index_name").agg(
        F.max_by("price", F.struct("ts", "event_id")).alias("live_price"), F.max("ts").alias("live_ts"))
    daily = index_bars.groupBy("index_name").agg(
        F.max_by("close", "date").alias("close"), F.max("date").alias("date"))
    return daily.join(tick, "index_name", "left").select(
        "index_name",
        F.coalesce(F.date_format("live_ts", "yyyy-MM-dd HH:mm:ss"), F.date_format("date", "yyyy-MM-dd")).alias("timestamp"),
        F.coalesce("live_price", "close").alias("value"),
        F.col("live_price").isNotNull().alias("is_live"),
    )


def percentile_rank(index_bars: DataFrame, values: DataFrame) -> DataFrame:
    """Percent of daily closes below the given value of each index, two places."""
    joined = index_bars.join(values.select("index_name", "value"), "index_name")
    below = F.count_if(F.col("close") < F.col("value"))
    return joined.groupBy("index_name").agg(F.bround(below / F.count("*") * 100, 2).alias("percentile_rank"))


def change_pct(value, previous) -> Column:
    return F.bround(pct_change_to(value, previous), 4)


def classify_vix(value="value") -> Column:
    return tiers(value, VIX_TIERS, inclusive=False)


def classify_fx(change="change_pct") -> Column:
    return tiers(change, FX_TIERS, F.col(change))


def classify_index(name="index_name", change="change_pct") -> Column:
    return tiers(change, INDEX_TIERS, F.col(name), F.col(change))


def sentiment_score(sentiment) -> Column:
    """Number of a sentiment; an unknown one counts as 0."""
    scores = F.create_map(*[F.lit(x) for pair in SENTIMENT_SCORES.items() for x in pair])
    return F.coalesce(F.try_element_at(scores, F.col(sentiment)), F.lit(0.0))


def outlook_tier(composite) -> Column:
    out = None
    for bound, name in OUTLOOK_TIERS:
        if bound is None:
            return out.otherwise(name)
        hit = F.col(composite) >= bound
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def overall_outlook(sentiments: DataFrame) -> DataFrame:
    """Composite of (position, name, sentiment) rows, one per indicator."""
    scored = sentiments.withColumn("score", sentiment_score("sentiment"))
    text = F.format_string("%s is %s (score %+.1f)", "name", "sentiment", "score")
    merged = scored.agg(
        F.avg("score").alias("composite"),
        F.sort_array(F.collect_list(F.struct("position", text.alias("text")))).alias("parts"),
    ).withColumn("outlook", outlook_tier("composite"))
    rationale = F.concat(
        F.array_join(F.col("parts.text"), ", "),
        F.format_string(". Composite score: %+.2f → Overall outlook: ", "composite"), "outlook", F.lit("."),
    )
    return merged.select(F.bround("composite", 2).alias("composite_score"), "outlook", rationale.alias("rationale"))


ROLES = {  # role in the document -> display name, in document order
    "vix": "VIX", "usdidr": "USD/IDR", "sp500": "S&P 500", "nikkei": "Nikkei 225",
}


def macro_indicators(index_bars: DataFrame, intraday: DataFrame, roles: dict[str, str], as_of,
                     days: int = LOOKBACK_DAYS) -> DataFrame:
    """One row per role: value, rank, change and classification.

    ``roles`` maps a role to its index; the nikkei role uses intraday ticks where there are any.
    """
    history = lookback_filter(index_bars, as_of, days)
    stats = latest_and_previous(history)
    live = latest_price_with_fallback(history, intraday, as_of)
    role = F.create_map(*[F.lit(x) for r, index in roles.items() for x in (index, r)])
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    position = F.create_map(*[F.lit(x) for i, r in enumerate(ROLES) for x in (r, i)])
    rows = stats.join(live, "index_name").withColumn("role", F.try_element_at(role, F.col("index_name")))
    rows = rows.where("role IS NOT NULL").withColumns({
        "name": names[F.col("role")],
        "position": position[F.col("role")],
        "value": F.when(F.col("role") == "nikkei", F.col("value")).otherwise(F.col("close")),
        "is_live": (F.col("role") == "nikkei") & F.col("is_live"),
        "timestamp": F.when(F.col("role") == "nikkei", F.col("timestamp")).otherwise(F.date_format("date", "yyyy-MM-dd")),
    })
    rows = rows.withColumns({
        "change_pct": change_pct("value", "previous"), "vs_sma_20_pct": change_pct("value", "sma20")})
    label = (
        F.when(F.col("role") == "vix", classify_vix())
        .when(F.col("role") == "usdidr", classify_fx())
        .otherwise(classify_index("name"))
    )
    rows = rows.withColumn("c", label).join(percentile_rank(history, rows), "index_name")
    return rows.select(
        "position", "role", "name", "index_name", "timestamp", "value", "is_live", "percentile_rank",
        F.when(F.col("role") != "vix", F.col("change_pct")).alias("change_pct"),
        F.when(F.col("role") == "usdidr", F.col("vs_sma_20_pct")).alias("vs_sma_20_pct"),
        "c.tier", "c.sentiment", "c.description",
    )


def avg_score_by_date(scores: DataFrame) -> DataFrame:
    return scores.groupBy("date").agg(F.avg("score").alias("avg_score"))


def index_returns(index_bars: DataFrame, window: int) -> DataFrame:
    """Percent move of each index to the lower-median of its next closes."""
    ahead = forward_quantile("close", window, LABEL_QUANTILE, by_index())
    return index_bars.withColumn("ahead", ahead).select(
        "index_name", "date", pct_change_to("ahead", "close").alias("median_gain"))


def join_index_score(index_bars: DataFrame, scores: DataFrame, window: int) -> DataFrame:
    """Known index returns with the average score of the day."""
    known = index_returns(index_bars, window).dropna(subset=["median_gain"])
    return known.join(avg_score_by_date(scores), "date")


def micro_outlook(index_bars: DataFrame, scores: DataFrame, window: int) -> DataFrame:
    """Index returns of the days whose average score reached the latest one, described."""
    averages = avg_score_by_date(scores)
    latest = averages.agg(F.max_by("avg_score", "date").alias("latest"))
    joined = join_index_score(index_bars, scores, window)
    return describe(joined.where(F.col("avg_score") >= latest.scalar()), [], "median_gain")


def outlook_document(indicators: DataFrame, overall: DataFrame, micro: dict[int, DataFrame], as_of: str | Column) -> DataFrame:
    """The nested document as one row.

    Every input is a handful of rows, so it is assembled by one aggregate and scalar lookups.
    """
    def part(role, *columns):
        fields = F.struct(*[F.col(c) for c in columns], F.struct(
            *[c for c in ("change_pct", "vs_sma_20_pct", "tier", "sentiment", "description")]).alias("classification"))
        return F.max(F.when(F.col("role") == role, fields)).alias(role)

    body = indicators.agg(*[part(r, "timestamp", "value", "is_live", "percentile_rank") for r in ROLES])
    whole = overall.select(F.struct("*").alias("doc"))
    columns = [F.lit(as_of).alias("timestamp"), *ROLES, whole.scalar().alias("overall_outlook")]
    for window, stats in micro.items():
        columns.append(stats.select(F.struct("*").alias("doc")).scalar().alias(f"micro_outlook_{window}dd"))
    return body.select(*columns)

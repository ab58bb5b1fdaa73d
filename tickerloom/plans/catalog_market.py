"""Universe, outlook and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.operators import metrics, outlook, recommend, scoring, universe
from tickerloom.plans import inputs
from tickerloom.plans.registry import QUERIES, query, rounded
from tickerloom.session import shared_folder, through_table
from tickerloom.sources import files
from tickerloom.sources import tables as t


def _part(name):
    def run(spark, sf):
        return rounded(t.fundamentals(spark, sf).select("ticker", universe.PARTS[name]().alias("score")))

    QUERIES[f"score_{name}"] = run


for _name in universe.PARTS:
    _part(_name)


@query
def fundamental_score(spark, sf):
    scored = universe.fundamental_score(t.fundamentals(spark, sf))
    return rounded(scored.select("ticker", "avg_value_traded", "fundamental_score"), 4)


@query
def select_universe(spark, sf):
    scored = universe.fundamental_score(t.fundamentals(spark, sf)).select(
        "ticker", "avg_value_traded", "fundamental_score")
    return rounded(universe.select_universe(scored, t.industry(spark, sf)), 4)


@query
def classify_vix(spark, sf):
    rows = t.index_bars(spark, sf).withColumn("c", outlook.classify_vix("close"))
    return rows.select("index_name", "date", "c.*")


def _daily_moves(spark, sf):
    index = t.index_bars(spark, sf)
    moves = index.withColumn("before", F.lag("close").over(outlook.by_index()))
    change = F.bround(outlook.pct_change_to("close", "before"), 4)
    return moves.withColumn("change_pct", change).where("change_pct IS NOT NULL")


@query
def classify_fx(spark, sf):
    return _daily_moves(spark, sf).withColumn("c", outlook.classify_fx()).select("index_name", "date", "change_pct", "c.*")


@query
def classify_index(spark, sf):
    return _daily_moves(spark, sf).withColumn("c", outlook.classify_index()).select(
        "index_name", "date", "change_pct", "c.*")


def _as_of(index):
    """Newest date of the index table, as a scalar subquery."""
    return index.agg(F.max("date")).scalar()


def _indicators(spark, sf):
    index = t.index_bars(spark, sf)
    return outlook.macro_indicators(index, t.intraday(spark, sf), inputs.ROLES, _as_of(index))


@query
def overall_outlook(spark, sf):
    return outlook.overall_outlook(_indicators(spark, sf).select("position", "name", "sentiment"))


@query
def latest_price_with_fallback(spark, sf):
    index = t.index_bars(spark, sf)
    return outlook.latest_price_with_fallback(index, t.intraday(spark, sf), _as_of(index))


@query
def macro_outlook(spark, sf):
    return rounded(_indicators(spark, sf).drop("index_name"))


@query
def micro_outlook(spark, sf):
    bars = t.bars(spark, sf)
    index, scores = t.market_index(bars), t.scores(bars)
    parts = [outlook.micro_outlook(index, scores, n).withColumn("window", F.lit(n)) for n in (5, 10)]
    return rounded(parts[0].unionByName(parts[1]))


@query
def json_sink_outlook(spark, sf):
    """The nested document through a JSON file and back, flattened."""
    index, bars = t.index_bars(spark, sf), t.bars(spark, sf)
    as_of = _as_of(index)
    rows = outlook.macro_indicators(index, t.intraday(spark, sf), inputs.ROLES, as_of)
    overall = outlook.overall_outlook(rows.select("position", "name", "sentiment"))
    micro = {n: outlook.micro_outlook(t.market_index(bars), t.scores(bars), n) for n in (5, 10)}
    document = outlook.outlook_document(rows, overall, micro, as_of.cast("string"))
    path = shared_folder(spark, "outlook")
    files.write_json(document, path)
    back = files.read_json(spark, path, document.schema)
    return rounded(back.select(
        "timestamp",
        *[F.col(f"{r}.{c}").alias(f"{r}_{c}") for r in outlook.ROLES for c in ("value", "percentile_rank")],
        *[F.col(f"{r}.classification.tier").alias(f"{r}_tier") for r in outlook.ROLES],
        "overall_outlook.composite_score", "overall_outlook.outlook",
        *[F.col(f"micro_outlook_{n}dd.{c}").alias(f"micro_{n}_{c}") for n in (5, 10) for c in ("count", "mean")],
    ))


def _recommendations(spark, sf):
    """The latest score of every ticker; tickers trade on different days here."""
    bars = t.bars(spark, sf)
    simulated = through_table(scoring.trading_simulation(inputs.test_scores(spark, sf), bars, 5), "simulation")
    targets = scoring.bin_buy_sell_pct(simulated)
    return recommend.daily_recommendation(t.scores(bars), bars, targets, one_date=False)


@query
def daily_recommendation(spark, sf):
    return rounded(_recommendations(spark, sf))


@query
def recommendation_records(spark, sf):
    return recommend.recommendation_records(_recommendations(spark, sf), "5dd")


@query
def performance_overview(spark, sf):
    columns = [f"{side}_{m}" for side in ("train", "test") for m in metrics.METRICS]
    return rounded(metrics.performance_overview(through_table(inputs.performance(spark, sf), "performance"), columns))

"""Scores, the trading simulation and its statistics."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.constants import BUY_QUANTILE, SELL_QUANTILE, SWEEP_COUNT, SWEEP_STEP
from tickerloom.functions.quantiles import exact_quantiles
from tickerloom.functions.scalar import pct_change_to, score_bin, score_bucket
from tickerloom.functions.series import forward_max, forward_min
from tickerloom.operators.cleaning import split_masks
from tickerloom.session import through_table


def score_prepare(forecasts: DataFrame, performance: DataFrame, splits: dict) -> DataFrame:
    """Forecasts with their split and the Gini that belongs to it.

    Train rows carry the train Gini; test and forecast rows the test Gini. A Gini that could
    not be computed, for want of rows, counts as 0 like that of a single class.
    """
    parts = split_masks(forecasts, splits).where(F.col("split").isin("train", "test", "forecast"))
    known = performance.select("ticker", "train_gini", "test_gini")
    joined = parts.join(known, "ticker")
    gini = F.when(F.col("split") == "train", F.col("train_gini")).otherwise(F.col("test_gini"))
    return joined.withColumn("gini", F.coalesce(gini, F.lit(0.0))).drop("train_gini", "test_gini", "train_val")


def score_train(prepared: DataFrame, positive: str, inputs=("p", "gini"), target: str = "y_true"):
    """Plain L2 logistic model (C = 1) of the positive class on the train rows."""
    rows = prepared.where((F.col("split") == "train") & F.col(target).isNotNull()).select(
        *inputs, (F.col(target) == positive).cast("double").alias("label"))
    count = rows.count()
    if not count:
        raise ValueError("no labelled train rows to score on")
    model = LogisticRegression(regParam=1.0 / count, elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-12)
    return model.fit(VectorAssembler(inputCols=list(inputs), outputCol="features").transform(rows))


def score_infer(prepared: DataFrame, model, inputs=("p", "gini")) -> DataFrame:
    """P(positive class) for test and forecast rows."""
    rows = prepared.where(F.col("split").isin("test", "forecast"))
    made = model.transform(VectorAssembler(inputCols=list(inputs), outputCol="features").transform(rows))
    return made.select("ticker", "date", "split", vector_to_array("probability")[1].alias("score"))


def score_with(prepared: DataFrame, intercept: float, weights: dict[str, float]) -> DataFrame:
    """The same scores from known coefficients, as a plain projection."""
    z = F.lit(float(intercept))
    for name, weight in weights.items():
        z = z + F.col(name) * weight
    rows = prepared.where(F.col("split").isin("test", "forecast"))
    return rows.select("ticker", "date", "split", (1 / (1 + F.exp(-z))).alias("score"))


def score_test_rows(scores: DataFrame, performance: DataFrame, splits: dict) -> DataFrame:
    rows = split_masks(scores, splits).where("split = 'test'")
    return rows.join(performance.select("ticker", "test_gini"), "ticker").select(
        "ticker", "date", "score", "test_gini")


def forward_extremes(bars: DataFrame, window: int) -> DataFrame:
    """Highest and lowest of the next ``window`` closes."""
    return bars.select(
        "ticker", "date", "close",
        forward_max("close", window).alias("max_close"), forward_min("close", window).alias("min_close"))


def trading_simulation(scores: DataFrame, bars: DataFrame, window: int) -> DataFrame:
    """Best and worst percent move within ``window`` rows of each scored day."""
    joined = scores.join(forward_extremes(bars, window), ["ticker", "date"])
    return joined.withColumns({
        "profit": pct_change_to("max_close", "close"), "loss": pct_change_to("min_close", "close"),
    })


def bin_buy_sell_pct(simulation: DataFrame) -> DataFrame:
    """Per score bin: lower quartile of the loss and median of the profit."""
    both = F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).cast("double").alias("move")) for side in ("loss", "profit")])
    moves = simulation.select(score_bin("score").alias("bin"), F.explode(both).alias("m")).select("bin", "m.*")
    found = exact_quantiles(moves, ["bin", "side"], "move", {"buy_pct": BUY_QUANTILE, "sell_pct": SELL_QUANTILE})
    sides = {"buy_pct": "loss", "sell_pct": "profit"}
    return found.groupBy("bin").agg(*[
        F.max(F.when(F.col("side") == side, F.col(name))).alias(name) for name, side in sides.items()
    ]).where(" AND ".join(f"{name} IS NOT NULL" for name in sides))


def score_distribution(simulation: DataFrame, metric: str) -> DataFrame:
    """Five-number summary of a metric per score bucket."""
    rows = simulation.withColumn("bucket", score_bucket("score")).where(F.col("bucket").isNotNull())
    counts = rows.groupBy("bucket").agg(F.count(metric).alias("rows"))
    five = exact_quantiles(rows, ["bucket"], metric, {"min": 0.0, "q25": 0.25, "median": 0.5, "q75": 0.75, "max": 1.0})
    return counts.join(five, "bucket")


SWEEP_QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


# ---- threshold sweep ---------------------------------------------------------------------


def sweep_step(score: str, step: float, count: int):
    """Number of the highest threshold ``k*step`` that the score reaches; NULL below 0."""
    s, k = F.col(score), F.floor(F.col(score) / step)
    # division can land one step off; the products decide
    k = F.when((k + 1) * step <= s, k + 1).when(k * step > s, k - 1).otherwise(k)
    return F.when(k >= 0, F.least(k, F.lit(count - 1)))


#: Rows of a range of values at most.
RANGE = 1 << 20


def value_cells(counts: DataFrame) -> DataFrame:
    """Stored counts (k, v, c) with ``cell``: rows of neighbouring values, the square root of a sixth of all rows to a cell.

    Ranges of values are dealt out and stored, as many as the rows need; the rows before each range are a prefix sum with
    one row per range.
    """
    counts = through_table(counts, "sweep-counts")
    n = counts.count()
    size = max(16, math.isqrt(max(1, n // (2 * len(SWEEP_QUARTILES)))))
    parts = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // RANGE))
    ranged = through_table(counts.repartitionByRange(parts, "v", "k").withColumn("part", F.spark_partition_id()), "sweep")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("v", "k")) - 1
    return through_table(
        ranged.join(before, "part").select("k", "v", "c", F.floor(place / size).cast("long").alias("cell")), "sweep-cells")


def threshold_sweep(simulation: DataFrame, metric: str, step: float = SWEEP_STEP, count: int = SWEEP_COUNT) -> DataFrame:
    """Mean, extremes and quartiles of ``metric`` over the rows with score >= k*step, for all ``count`` thresholds.

    A threshold that no row reaches has 0 rows and no statistics. A row belongs to every threshold up to its own step,
    so nothing is joined per threshold. Rows are reduced to (step, value) counts; mean and extremes are suffix sums over
    at most ``count`` steps. For the quartiles the n counts are parted into cells of neighbouring values; suffix sums over
    (step, cell) counts tell in which cell each threshold's rank lies, and only that cell is ranked for it. With cells of
    sqrt(n / 6) rows both the suffix sums (cells x ``count``) and the ranked rows (6 x ``count`` cells) grow with the square
    root of n. The result is exact.
    """
    rows = simulation.where(F.col(metric).isNotNull()).select(
        sweep_step("score", step, count).cast("int").alias("k"), F.col(metric).cast("double").alias("v"),
    ).where("k IS NOT NULL")
    rows = value_cells(rows.groupBy("k", "v").agg(F.count("*").alias("c")))

    later = Window.orderBy(F.desc("k"))  # one row per step
    steps = rows.groupBy("k").agg(
        F.sum("c").alias("n"), F.sum(F.col("v") * F.col("c")).alias("total"),
        F.max("v").alias("hi"), F.min("v").alias("lo"))
    grid = simulation.sparkSession.range(count).select(F.col("id").cast("int").alias("k"))
    summary = through_table(grid.join(steps, "k", "left").select(
        "k", F.coalesce(F.sum("n").over(later), F.lit(0)).alias("n"), F.sum("total").over(later).alias("total"),
        F.max("hi").over(later).alias("max"), F.min("lo").over(later).alias("min"),
    ), "sweep-steps")

    counts = rows.groupBy("cell", "k").agg(F.sum("c").alias("c"))
    known = counts.groupBy("cell").agg(F.max("k").alias("top"))
    # every threshold up to the highest step of a cell
    dense = known.select("cell", F.explode(F.sequence(F.lit(0), F.col("top"))).alias("k")).join(counts, ["cell", "k"], "left")
    reached = dense.select("cell", "k", F.sum(F.coalesce("c", F.lit(0))).over(
        Window.partitionBy("cell").orderBy(F.desc("k"))).alias("c"))
    per_step = (
        reached.withColumn("up_to", F.sum("c").over(Window.partitionBy("k").orderBy("cell")))
        .withColumn("before", F.col("up_to") - F.col("c"))
        .join(summary.select("k", "n"), "k")
    )

    def place(rank):
        """Rank inside this cell, NULL where the cell does not hold it."""
        return F.when((rank >= F.col("before")) & (rank < F.col("up_to")), rank - F.col("before"))

    def at(q, rounding):
        return place(rounding((F.col("n") - 1) * F.lit(q)))

    wanted = per_step.select("k", "cell", F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), at(q, F.floor).alias("low"), at(q, F.ceil).alias("high"))
        for name, q in SWEEP_QUARTILES.items()
    ])).alias("r")).select("k", "cell", "r.*").where("low IS NOT NULL OR high IS NOT NULL")

    inside = rows.withColumnRenamed("k", "row_k").join(wanted, "cell").where("row_k >= k")
    tied = inside.groupBy("k", "name", "cell", "low", "high", "v").agg(F.sum("c").alias("c"))
    ranked = tied.withColumn("last", F.sum("c").over(Window.partitionBy("k", "name", "cell").orderBy("v")))

    def hit(name, end):
        here = (F.col("name") == name) & (F.col(end) < F.col("last")) & (F.col(end) >= F.col("last") - F.col("c"))
        return F.max(F.when(here, F.col("v"))).alias(f"{name}_{end}")

    picked = ranked.groupBy("k").agg(*[hit(name, end) for name in SWEEP_QUARTILES for end in ("low", "high")])

    def between(name, q):
        position = (F.col("n") - 1) * F.lit(q)
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        return (low + (high - low) * (position - F.floor(position))).alias(name)

    return summary.join(picked, "k", "left").select(
        (F.col("k") * F.lit(step)).alias("threshold"), F.col("n").alias("rows"),
        F.try_divide("total", "n").alias("mean"), "max", "min",
        *[between(name, q) for name, q in SWEEP_QUARTILES.items()],
    )

"""Grouped classification metrics and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions.quantiles import describe, exact_quantiles

METRICS = ("accuracy", "precision_positive", "precision_negative", "recall_positive", "recall_negative", "gini")


def _share(hit, base):
    """Share of ``base`` rows that meet ``hit``; 0 where there are none."""
    return F.coalesce(F.try_divide(F.count_if(hit & base), F.count_if(base)), F.lit(0.0))


def classification_metrics(predictions: DataFrame, keys: list[str], positive: str, negative: str) -> DataFrame:
    """Accuracy, precision and recall of both classes per group, in one aggregation."""
    right = F.col("y_true") == F.col("y_pred")
    out = {"accuracy": F.avg(right.cast("double"))}
    for side, label in (("positive", positive), ("negative", negative)):
        out[f"precision_{side}"] = _share(right, F.col("y_pred") == label)
        out[f"recall_{side}"] = _share(right, F.col("y_true") == label)
    return predictions.groupBy(*keys).agg(*[c.alias(name) for name, c in out.items()])


def gini(predictions: DataFrame, keys: list[str], positive: str) -> DataFrame:
    """2*AUC - 1 per group, 0.0 where only one class occurs.

    Equal probabilities are counted together before the ranking, so each tie counts half
    and the window sees one row per distinct probability.
    """
    hit = F.col("y_true") == positive
    tied = predictions.groupBy(*keys, "p").agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
    lower = F.sum("neg").over(Window.partitionBy(*keys).orderBy("p")) - F.col("neg")
    wins = F.col("pos") * (lower + F.col("neg") / 2)
    sums = tied.withColumn("wins", wins).groupBy(*keys).agg(
        F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    auc = F.try_divide(F.col("wins"), F.col("pos") * F.col("neg"))
    return sums.select(*keys, F.coalesce(2 * auc - 1, F.lit(0.0)).alias("gini"))


def performance_by_ticker(predictions: DataFrame, positive: str, negative: str,
                          keys: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """``train_*`` and ``test_*`` metrics per ticker plus its first threshold.

    ``split`` must be ``train`` or ``test``. The predictions are read once: class counts per distinct probability are
    one aggregation, and accuracy, precision, recall and Gini of both sides all follow from that table.
    """
    true = {side: F.col("y_true") == label for side, label in (("p", positive), ("n", negative))}
    said = {side: F.col("y_pred") == label for side, label in (("p", positive), ("n", negative))}
    cells = {t + s: F.count_if(true[t] & said[s]) for t in true for s in said}
    first = F.min(F.struct("date", "threshold")) if "threshold" in predictions.columns else F.lit(None)
    tied = predictions.groupBy(*keys, "split", "p").agg(
        *[c.alias(name) for name, c in cells.items()], first.alias("first"))
    pos, neg = F.col("pp") + F.col("pn"), F.col("np") + F.col("nn")
    below = F.sum(neg).over(Window.partitionBy(*keys, "split").orderBy("p")) - neg
    sides = tied.withColumn("wins", pos * (below + neg / 2)).groupBy(*keys, "split").agg(
        *[F.sum(name).alias(name) for name in cells], F.sum("wins").alias("wins"), F.min("first").alias("first"))

    def share(hit, *other):
        return F.coalesce(F.try_divide(F.col(hit), sum((F.col(o) for o in other), F.col(hit))), F.lit(0.0))

    measures = dict(zip(METRICS, (
        F.try_divide(F.col("pp") + F.col("nn"), pos + neg), share("pp", "np"), share("nn", "pn"), share("pp", "pn"),
        share("nn", "np"), F.coalesce(2 * F.try_divide(F.col("wins"), pos * neg) - 1, F.lit(0.0)),
    )))
    out = sides.groupBy(*keys).agg(
        *[F.max(F.when(F.col("split") == side, value)).alias(f"{side}_{name}")
          for side in ("train", "test") for name, value in measures.items()],
        F.min("first").alias("first"),
    )
    found = out.select(*keys, *[f"{side}_{name}" for side in ("train", "test") for name in METRICS], "first")
    if "threshold" not in predictions.columns:
        return found.drop("first")
    return found.withColumn("threshold", F.col("first.threshold")).drop("first")


def first_threshold(df: DataFrame, keys: tuple[str, ...] = ("ticker",)) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by("threshold", "date").alias("threshold"))


def prefix_metric_columns(train: DataFrame, test: DataFrame, fixed: tuple[str, ...] = ("ticker", "threshold")) -> DataFrame:
    """``Train - m`` and ``Test - m`` side by side, matched on ticker and threshold."""
    def renamed(df, prefix):
        return df.withColumnsRenamed({c: f"{prefix} - {c}" for c in df.columns if c not in fixed})

    both = renamed(train, "Train").join(renamed(test, "Test"), list(fixed))
    measures = [c for c in both.columns if c not in fixed]
    return both.select("ticker", *measures, "threshold")


def select_best_restart(results: DataFrame) -> DataFrame:
    """The restart whose median Gini over tickers is highest; ties go to the first."""
    medians = exact_quantiles(results, ["restart"], "gini", {"median_gini": 0.5})
    return medians.agg(
        F.max_by("restart", F.struct("median_gini", -F.col("restart"))).alias("restart"),
        F.max("median_gini").alias("median_gini"),
    )


def tickers_meeting_gini(performance: DataFrame, minimum: float | None = None) -> DataFrame:
    """Distinct tickers with their best test Gini, best first."""
    kept = performance if minimum is None else performance.where(F.col("test_gini") >= minimum)
    return kept.groupBy("ticker").agg(F.max("test_gini").alias("test_gini")).orderBy(F.desc("test_gini"), "ticker")


def common_tickers(df: DataFrame, combo: list[str], expected: int) -> DataFrame:
    """Tickers present in all ``expected`` combinations (relational division)."""
    seen = df.select("ticker", *combo).distinct().groupBy("ticker").agg(F.count("*").alias("combos"))
    return seen.where(F.col("combos") == expected).select("ticker")


def performance_overview(performance: DataFrame, metrics, keys=("model_version", "label_type", "window")) -> DataFrame:
    """describe() of every metric per performance table, in long form."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    long = performance.select(*keys, F.explode(pairs).alias("m")).select(*keys, "m.*")
    return describe(long, [*keys, "metric"], "value")

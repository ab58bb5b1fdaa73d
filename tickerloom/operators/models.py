"""Training of the four model generations.

1  a Gaussian naive Bayes model per ticker: class means and variances from one aggregation
2  a regularised discriminant per industry, all industries in the same passes, or boosted trees (``Search.pooled``)
3  the same for the whole market
4  a robust-scaled elastic-net logistic model on the stacked forecasts (Spark ML)

Naive Bayes and discriminants are sums over rows, so any number of models is fitted by the same few aggregations, without
a loop over tickers or industries. Each model is one row of a table: an intercept, a weight and a squared weight per feature,
or its trees (``trees``).
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import RobustScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.constants import MARKET
from tickerloom.operators import trees
from tickerloom.operators.cleaning import split_masks
from tickerloom.operators.logistic import fit_together
from tickerloom.operators.search import Proposer, Search, balanced, class_counts, evaluator_of, with_retries
from tickerloom.session import through_table

# search spaces (fixed values)
DISCRIMINANT_SPACE = {"shrink": (0.0, 1.0), "ridge": (1e-3, 1.0)}
LOGISTIC_SPACE = {"c": (1e-4, 1e3), "l1_ratio": (0.0, 1.0)}
#: Share of the pooled variance, and a constant, that naive Bayes adds to a class variance.
SMOOTH, FLOOR = 0.1, 1e-4
#: Probabilities of one search are told apart to 1 / GRID.
GRID = 10_000
#: Most candidate weights that are broadcast at a time; more groups are scored in several passes.
BROADCAST_NUMBERS = 4_000_000
MODEL = "intercept double, linear array<double>, square array<double>, params string"


def _log_uniform(rng, low, high):
    return math.exp(rng.uniform(math.log(low), math.log(high)))


def discriminant_params(search: Search) -> list[dict]:
    """The candidates of all restarts, one restart after another."""
    found = []
    for restart in range(search.restarts):
        rng = random.Random(search.seed + restart)
        found += [
            {"shrink": rng.uniform(*DISCRIMINANT_SPACE["shrink"]), "ridge": _log_uniform(rng, *DISCRIMINANT_SPACE["ridge"])}
            for _ in range(search.iterations)
        ]
    return found


def logistic_proposer(search: Search) -> Proposer:
    return Proposer(LOGISTIC_SPACE, search.seed, logarithmic=("c",))


def split_train_test(df: DataFrame, splits: dict, features: list[str], target: str, positive: str) -> DataFrame:
    """Labelled rows as (ticker, date, features, y_true, label, fold).

    ``fold`` is train, val or test; dates between train and val train as well.
    """
    parts = split_masks(df, splits).where(F.col(target).isNotNull())
    fold = (
        F.when(F.col("split") == "test", "test")
        .when(F.col("split") == "val", "val")
        .when(F.col("train_val"), "train")
    )
    return parts.select(
        "ticker", "date", *features, F.col(target).alias("y_true"),
        (F.col(target) == positive).cast("double").alias("label"), fold.alias("fold"),
    ).where("fold IS NOT NULL")


def _array(features: list[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in features])


def _log_odds(intercept, linear, square, x) -> Column:
    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda total, v: total + v)

    return intercept + dot(linear, x) + dot(square, F.transform(x, lambda v: v * v))


def probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), log_odds))))


def forecast_by(models: DataFrame, df: DataFrame, features: list[str], key: str | None) -> DataFrame:
    """(ticker, date, p) of every row whose model exists. ``key`` is the column of both that names the model.

    Without a key there is one model, whose numbers become literals of the plan.
    """
    if "trees" in models.columns:
        return trees.forecast_trees(models, df, features, key)
    x = _array(features)
    if key is None:
        found = models.select("intercept", "linear", "square").first()
        if found is None:
            return df.select("ticker", "date", F.lit(None).cast("double").alias("p")).limit(0)
        parts = F.lit(found["intercept"]), F.array(*map(F.lit, found["linear"])), F.array(*map(F.lit, found["square"]))
        return df.select("ticker", "date", probability(_log_odds(*parts, x)).alias("p"))
    joined = df.select("ticker", "date", *([] if key == "ticker" else [key]), x.alias("x")).join(
        models.select(key, "intercept", "linear", "square"), key)
    parts = F.col("intercept"), F.col("linear"), F.col("square"), F.col("x")
    return joined.select("ticker", "date", probability(_log_odds(*parts)).alias("p"))


def failures_of(rows: DataFrame, key: str) -> DataFrame:
    """(identifier, reason) of the groups that can't be trained: no train rows, one train class, or no val rows."""
    counts = rows.groupBy(F.col(key).cast("string").alias("identifier")).agg(
        F.count_if(F.col("fold") == "train").alias("train"), F.count_if(F.col("fold") == "val").alias("val"),
        F.count_if((F.col("fold") == "train") & (F.col("label") == 1)).alias("positive"))
    reason = (
        F.when(F.col("train") == 0, "no train rows")
        .when((F.col("positive") == 0) | (F.col("positive") == F.col("train")), "the train rows hold a single class")
        .when(F.col("val") == 0, "no validation rows")
    )
    return counts.select("identifier", reason.alias("reason")).where("reason IS NOT NULL")


# ---- version 1: per ticker ---------------------------------------------------------------


def train_per_ticker(rows: DataFrame, features: list[str]) -> DataFrame:
    """One naive Bayes model per ticker from its train and val rows: (ticker, intercept, linear, square, params).

    Tickers whose train rows hold one class or that lack val rows are in ``failures_of``. There is nothing to search.
    """
    assembled = VectorAssembler(inputCols=features, outputCol="vector").transform(rows)
    known = F.col("fold").isin("train", "val")
    stats = assembled.where(known).groupBy("ticker", "label").agg(
        Summarizer.metrics("mean", "variance", "count").summary(F.col("vector")).alias("s"),
        F.count_if(F.col("fold") == "train").alias("train"), F.count_if(F.col("fold") == "val").alias("val"))
    sides = stats.select(
        "ticker", "label", "train", "val", F.col("s.count").cast("double").alias("n"),
        vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("var"))

    def side(name, label):
        return F.max(F.when(F.col("label") == label, F.col(name))).alias(f"{name}{int(label)}")

    both = sides.groupBy("ticker").agg(
        *[side(name, label) for name in ("n", "mean", "var", "train") for label in (0.0, 1.0)], F.sum("val").alias("val"),
    ).where("train0 > 0 AND train1 > 0 AND val > 0")
    pooled = F.zip_with("var0", "var1", lambda a, b: SMOOTH * (a * F.col("n0") + b * F.col("n1")) / (F.col("n0") + F.col("n1")) + FLOOR)
    wide = both.withColumn("extra", pooled).withColumns({
        f"v{i}": F.zip_with(f"var{i}", "extra", lambda a, b: a + b) for i in (0, 1)})

    def over(a, b):
        return F.zip_with(a, b, lambda p, q: p / q)

    def less(a, b):
        return F.zip_with(a, b, lambda p, q: p - q)

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda t, v: t + v)

    def half_inverse(v):
        return F.transform(v, lambda q: 0.5 / q)

    def quadratic(m, v):
        return total(F.zip_with(m, v, lambda p, q: p * p / (2 * q) + F.log(q) / 2))

    return wide.select(
        "ticker", (F.log(F.col("n1") / F.col("n0")) + quadratic("mean0", "v0") - quadratic("mean1", "v1")).alias("intercept"),
        less(over("mean1", "v1"), over("mean0", "v0")).alias("linear"), less(half_inverse("v0"), half_inverse("v1")).alias("square"),
        F.lit("{}").alias("params"),
    )


# ---- versions 2 and 3: per industry and market -------------------------------------------


def _products(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """One row of added products per group, fold and class of all batches."""
    sums: dict[tuple, np.ndarray] = {}
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        x = np.column_stack((np.ones(len(x)), x))
        frame = batch.select(["group", "fold", "label"]).to_pandas()
        for key, at in frame.groupby(["group", "fold", "label"]).indices.items():
            products = x[at].T @ x[at]
            sums[key] = sums[key] + products if key in sums else products
    for (group, fold, label), products in sums.items():
        yield pa.RecordBatch.from_arrays([
            pa.array([group], pa.string()), pa.array([fold], pa.string()), pa.array([label], pa.float64()),
            pa.array([products.ravel()], pa.list_(pa.float64()))], ["group", "fold", "label", "products"])


def _moments(rows: DataFrame, key: str, features: list[str]) -> DataFrame:
    """(group, fold, label, place, value): count, sums and products of standardised features, added up per task first.

    Groups are few, so a task holds one matrix for each of them, fold and class.
    """
    width = len(features)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _products(batches, width)

    slim = rows.select(F.col(key).cast("string").alias("group"), "fold", "label", "x")
    made = slim.mapInArrow(add, "group string, fold string, label double, products array<double>")
    return made.select("group", "fold", "label", F.posexplode("products").alias("place", "value")).groupBy(
        "group", "fold", "label", "place").agg(F.sum("value").alias("value"))


def _discriminants(products: np.ndarray, candidates: list[dict]) -> np.ndarray:
    """Intercept and weights of each candidate from the products (class x (1 + p) x (1 + p)) of one group.

    Both classes weigh the same, whatever their numbers.
    """
    mean, cov = [], []
    for m in products:
        mean.append(m[0, 1:] / m[0, 0])
        cov.append(m[1:, 1:] / m[0, 0] - np.outer(mean[-1], mean[-1]))
    within, gap, middle = (cov[0] + cov[1]) / 2, mean[1] - mean[0], (mean[0] + mean[1]) / 2
    found = []
    for c in candidates:
        s = (1 - c["shrink"]) * within + np.diag(c["shrink"] * np.diag(within) + c["ridge"])
        w = np.linalg.solve(s, gap)
        found.append(np.r_[-w @ middle, w])
    return np.array(found)


def _judged(rows: DataFrame, weights: dict[str, np.ndarray], width: int, *keep: str) -> DataFrame:
    """(group, keep, candidate, p, y_true, n): rows counted per probability of each candidate of their group.

    Weights are broadcast, at most ``BROADCAST_NUMBERS`` at a time.
    """
    per_pass = max(1, BROADCAST_NUMBERS // max(1, next(iter(weights.values())).size))
    names, parts = sorted(weights), []
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"group string, {''.join(f'{k} {types[k]}, ' for k in keep)}candidate int, p double, y_true double, n long"
    for first in range(0, len(names), per_pass):
        mine = {name: weights[name] for name in names[first:first + per_pass]}
        shared = rows.sparkSession.sparkContext.broadcast(mine)

        def score(batches, shared=shared):
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                frame = batch.select(["group", "label", *keep]).to_pandas()
                for key, at in frame.groupby(["group", *keep, "label"]).indices.items():
                    w = shared.value.get(key[0])
                    if w is None:
                        continue
                    z = np.clip(x[at] @ w[:, 1:].T + w[:, 0], -30, 30)
                    p = np.rint(GRID / (1 + np.exp(-z)))
                    counted = np.bincount((p + np.arange(len(w)) * (GRID + 1)).astype(np.int64).ravel())
                    cell = np.flatnonzero(counted)
                    n = counted[cell]
                    same = {"group": key[0], **dict(zip(keep, key[1:-1])), "y_true": key[-1]}
                    same = {k: pa.repeat(pa.scalar(v, batch.schema.field("label" if k == "y_true" else k).type), len(cell)) for k, v in same.items()}
                    yield pa.RecordBatch.from_pydict({
                        "group": same["group"], **{k: same[k] for k in keep},
                        "candidate": pa.array((cell // (GRID + 1)).astype(np.int32)), "p": (cell % (GRID + 1)) / GRID,
                        "y_true": same["y_true"], "n": n})

        parts.append(rows.select("group", "x", "label", *keep).mapInArrow(score, schema))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.groupBy("group", *keep, "candidate", "p", "y_true").agg(F.sum("n").alias("n"))


def _areas(judged: DataFrame, *keys: str) -> DataFrame:
    """Validation metric per group and candidate: AUC, or accuracy where one class occurs, from counted probabilities."""
    tied = judged.groupBy(*keys, "candidate", "p").agg(
        F.sum(F.when(F.col("y_true") == 1, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("y_true") == 0, F.col("n")).otherwise(0)).alias("neg"))
    below = F.sum("neg").over(Window.partitionBy(*keys, "candidate").orderBy("p")) - F.col("neg")
    right = F.when(F.col("p") > 0.5, F.col("pos")).otherwise(F.col("neg"))
    sums = tied.withColumns({"wins": F.col("pos") * (below + F.col("neg") / 2), "right": right}).groupBy(*keys, "candidate").agg(
        *[F.sum(c).alias(c) for c in ("wins", "pos", "neg", "right")])
    area = F.try_divide(F.col("wins"), F.col("pos") * F.col("neg"))
    return sums.select(*keys, "candidate", area.alias("auc"), F.coalesce(area, F.try_divide("right", F.col("pos") + F.col("neg"))).alias("metric"))


def train_grouped(rows: DataFrame, features: list[str], key: str, search: Search = Search()) -> DataFrame:
    """One regularised discriminant per group: (identifier, intercept, linear, square, params).

    Three passes whatever the number of groups and candidates: products of train and val rows, the candidates of all
    restarts scored on the val rows, and (``select_on="test"``) the winner of each restart scored on the test rows. The
    best is refitted on train and val. Per group the driver holds (features + 1)^2 sums, so groups are a small fixed
    dimension such as industries. Groups of ``failures_of`` have no model.
    """
    everything = VectorAssembler(inputCols=features, outputCol="vector").transform(rows.where("fold IN ('train', 'val')"))
    scale = everything.agg(Summarizer.metrics("mean", "std").summary(F.col("vector")).alias("s")).select("s.*").first()
    if scale is None or scale["mean"] is None:
        return rows.sparkSession.createDataFrame([], f"identifier string, {MODEL}")
    mean = np.array(scale["mean"].toArray())
    std = np.where(scale["std"].toArray() > 1e-12, scale["std"].toArray(), 1.0)
    x = F.array(*[(F.col(f"`{c}`").cast("double") - m) / s for c, m, s in zip(features, mean.tolist(), std.tolist())])
    ready = through_table(rows.select(F.col(key).cast("string").alias("group"), "ticker", "fold", "label", x.alias("x")), "standardised")
    width, sums = len(features) + 1, {}
    found = _moments(ready.where("fold <> 'test'"), "group", features).toArrow().to_pandas()
    for (group, fold, label), part in found.groupby(["group", "fold", "label"]):
        products = np.zeros(width * width)
        products[part["place"]] = part["value"]
        sums.setdefault(group, {})[fold, label] = products
    usable = {
        g: {k: v.reshape(width, width) for k, v in s.items()} for g, s in sums.items()
        if ("train", 0.0) in s and ("train", 1.0) in s and (("val", 0.0) in s or ("val", 1.0) in s)
    }
    candidates = discriminant_params(search)
    if not usable:
        return rows.sparkSession.createDataFrame([], f"identifier string, {MODEL}")
    tried = {g: _discriminants([s["train", 0.0], s["train", 1.0]], candidates) for g, s in usable.items()}
    metric = {(r["group"], r["candidate"]): r["metric"] for r in _areas(_judged(ready.where("fold = 'val'"), tried, width - 1), "group").collect()}
    n = search.iterations
    winners = {
        g: [max(range(r * n, (r + 1) * n), key=lambda c: metric.get((g, c), -1.0)) for r in range(search.restarts)] for g in tried}
    best = {g: max(w, key=lambda c: metric.get((g, c), -1.0)) for g, w in winners.items()}
    if search.select_on == "test" and search.restarts > 1:
        chosen = {g: tried[g][winners[g]] for g in winners}
        per_ticker = _areas(_judged(ready.where("fold = 'test'"), chosen, width - 1, "ticker"), "group", "ticker")
        scored = per_ticker.groupBy("group", "candidate").agg(
            F.median(F.coalesce(2 * F.col("auc") - 1, F.lit(0.0))).alias("gini")).collect()
        tests = {(r["group"], r["candidate"]): r["gini"] for r in scored}
        best = {g: w[max(range(len(w)), key=lambda i: tests.get((g, i), -2.0))] for g, w in winners.items()}
    made = []
    for g, s in usable.items():
        zero = np.zeros((width, width))
        both = [s.get(("train", y), zero) + s.get(("val", y), zero) for y in (0.0, 1.0)]
        w = _discriminants(both, [candidates[best[g]]])[0]
        linear = w[1:] / std
        made.append((g, float(w[0] - linear @ mean), linear.tolist(), [0.0] * len(linear), str(candidates[best[g]])))
    return rows.sparkSession.createDataFrame(made, f"identifier string, {MODEL}")


# ---- version 4: stacked forecasts --------------------------------------------------------


def _scaled(features) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="raw"),
        RobustScaler(inputCol="raw", outputCol="vector", withCentering=True)])


def _logistic(params, rows: int, steps: int) -> LogisticRegression:
    # the penalty of a C-parametrized model, spread over the weighted rows
    return LogisticRegression(
        labelCol="label", featuresCol="vector", weightCol="weight", maxIter=steps, standardization=False,
        elasticNetParam=params["l1_ratio"], regParam=1.0 / (params["c"] * rows))


def hyperparam_search(rows: DataFrame, features: list[str], proposer: Proposer, iterations: int, steps: int,
                      threads: int = 4) -> tuple[PipelineModel, dict, float]:
    """Best candidate on the val fold of ``iterations`` that ``proposer`` names, refitted on train and val.

    Scored by AUC, or accuracy when val holds one class; a single train class is an error. Scaling is fitted once per
    fold and its vectors are stored; candidates differ in the last stage only. ``threads`` of them are fitted together, each
    pass over the train rows serving all (``logistic``); a batch starts from the best model so far.
    """
    counts = class_counts(rows)
    if len(counts.get("train", {})) < 2:
        raise ValueError("the train rows hold a single class")
    if not counts.get("val"):
        raise ValueError("no validation rows")
    evaluator = evaluator_of(counts["val"])
    scaler = _scaled(features).fit(rows.where("fold = 'train'"))
    ready = through_table(
        scaler.transform(rows.where("fold <> 'test'")).select("fold", "label", vector_to_array("vector").alias("x")), "scaled")
    train, val, size = ready.where("fold = 'train'"), ready.where("fold = 'val'"), sum(counts["train"].values())
    weights = {label: size / (2.0 * n) for label, n in counts["train"].items()}

    def score_of(theta):
        margin = reduce(add, [F.lit(float(w)) * F.col("x")[i] for i, w in enumerate(theta[1:])], F.lit(float(theta[0])))
        return evaluator.evaluate(val.select(
            "label", margin.alias("rawPrediction"), (margin > 0).cast("double").alias("prediction")))

    candidates, scored, fitted = [], [], []
    with ThreadPoolExecutor(threads) as pool:
        while len(scored) < iterations:
            points, batch = zip(*proposer.ask(min(threads, iterations - len(scored))))
            start = fitted[int(np.argmax(scored))] if scored else None
            thetas = with_retries(lambda: fit_together(train, weights, size, len(features), batch, size, steps, start))
            for point, params, score in zip(points, batch, pool.map(lambda t: with_retries(lambda: score_of(t)), thetas)):
                proposer.tell(point, score)
                candidates.append(params)
                scored.append(score)
            fitted += thetas
    best = int(np.argmax(scored))
    both = {c: counts["train"].get(c, 0) + counts["val"].get(c, 0) for c in (0.0, 1.0)}
    everything = rows.where("fold IN ('train', 'val')")
    scaler = _scaled(features).fit(everything)
    last = with_retries(lambda: _logistic(candidates[best], sum(both.values()), steps).fit(
        balanced(scaler.transform(everything), both)))
    return PipelineModel(stages=[*scaler.stages, last]), candidates[best], scored[best]


def train_stacker(rows: DataFrame, features: list[str], search: Search = Search()) -> PipelineModel:
    return hyperparam_search(rows, features, logistic_proposer(search), search.iterations, search.logistic_steps, search.threads)[0]


def forecast(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Probability of the positive class for every row, from a stored pipeline."""
    return model.transform(df).select("ticker", "date", vector_to_array("probability")[1].alias("p"))


# ---- routing and storage -----------------------------------------------------------------

#: The column that names the model of a row, by version; none: one model for all.
KEYS = {1: "ticker", 2: "industry", 3: None}


#: Families of versions 2 and 3.
POOLED = {"discriminant": train_grouped, "trees": trees.train_trees}


def train(version: int, rows: DataFrame, features: list[str], industries: DataFrame | None = None,
          search: Search = Search()) -> tuple[DataFrame, DataFrame]:
    """(models, failures) of versions 1 to 3: a row per model, and (identifier, reason) for each that can't be trained."""
    pooled = POOLED[search.pooled]
    if version == 1:
        return through_table(train_per_ticker(rows, features), "ticker-models"), failures_of(rows, "ticker")
    if version == 2:
        tagged = rows.join(industries, "ticker")
        made = pooled(tagged, features, "industry", search).withColumnRenamed("identifier", "industry")
        return through_table(made, "industry-models"), failures_of(tagged, "industry")
    if version == 3:
        tagged = rows.withColumn("market", F.lit(MARKET))
        return through_table(pooled(tagged, features, "market", search), "market-model"), failures_of(tagged, "market")
    raise ValueError(f"unknown model version {version}")


def forecast_version(version: int, models: DataFrame, df: DataFrame, features: list[str],
                     industries: DataFrame | None = None) -> DataFrame:
    """(ticker, date, p) of versions 1 to 3."""
    tagged = df.join(industries, "ticker") if version == 2 else df
    return forecast_by(models, tagged, features, KEYS[version])


def judged(p: DataFrame, rows: DataFrame, positive: str, negative: str) -> DataFrame:
    """Forecasts of labelled rows with y_true, y_pred, p and split (val counts as train)."""
    return rows.select("ticker", "date", "y_true", "fold").join(p, ["ticker", "date"]).select(
        "ticker", "date", "y_true", F.when(F.col("p") > 0.5, positive).otherwise(negative).alias("y_pred"), "p",
        F.when(F.col("fold") == "test", "test").otherwise("train").alias("split"))


def train_router(version: int, rows: DataFrame, features: list[str], positive: str, negative: str,
                 industries: DataFrame | None = None, search: Search = Search()):
    """(models, forecasts of the labelled rows, failures) of one model version; failures are (identifier, reason)."""
    if version == 4:
        none = rows.sparkSession.createDataFrame([], "identifier string, reason string")
        try:
            model = train_stacker(rows, features, search)
        except ValueError as error:
            why = rows.sparkSession.createDataFrame([(MARKET, str(error))], none.schema)
            empty = rows.select("ticker", "date", F.lit(None).cast("double").alias("p")).limit(0)
            return None, judged(empty, rows, positive, negative), why
        return model, judged(forecast(model, rows), rows, positive, negative), none
    models, failures = train(version, rows, features, industries, search)
    p = forecast_version(version, models, rows.drop("y_true", "label", "fold"), features, industries)
    return models, judged(p, rows, positive, negative), failures


def model_path(folder: str, version: int, label: str, window: int) -> str:
    return f"{folder.rstrip('/')}/model_v{version}/{label}-{window}dd"


def save_models(models, path: str) -> None:
    """Versions 1 to 3 as one table each: thousands of small files would be slower to list. The stacker as a pipeline."""
    if isinstance(models, DataFrame):
        models.write.mode("overwrite").parquet(path)
    else:
        models.write().overwrite().save(path)


def load_models(spark, version: int, path: str):
    """What ``save_models`` stored, or None where nothing was fitted."""
    try:
        spark.read.text(f"{path}/metadata").limit(1).count() if version == 4 else None
        return PipelineModel.load(path) if version == 4 else spark.read.parquet(path)
    except AnalysisException:
        return None


def route_model(tickers: DataFrame, industries: DataFrame, version: int, label_types, windows) -> DataFrame:
    """Forecast tasks: ticker, model identifier, label and window.

    The label and window combinations are exploded on each row; nothing is cross joined.
    """
    if version == 1:
        routed = tickers.select("ticker", F.col("ticker").cast("string").alias("model_identifier"))
    elif version == 2:
        routed = tickers.select("ticker").join(industries, "ticker").select(
            "ticker", F.col("industry").alias("model_identifier"))
    else:
        routed = tickers.select("ticker", F.lit(MARKET).alias("model_identifier"))
    combos = F.array(*[
        F.struct(F.lit(label).alias("label_type"), F.lit(w).alias("window")) for label in label_types for w in windows
    ])
    return routed.select("*", F.explode(combos).alias("c")).select("ticker", "model_identifier", "c.*")

"""Mixing of sources to target weights with soft membership.

A classifier learnt from labelled rows gives every document a posterior over domains, averaged over its windows, so a
text that changes its domain in the middle belongs to both in part. Document rates r are then fitted so that the
expected tokens of each domain, sum of r x tokens x posterior, meet the targets: least squares in the totals, by
projected gradient, in as many dimensions as there are documents.

Gradient steps add up before they are projected: r = max(bound, 1 - posterior x y), where y is the sum of all steps and
has one number per domain. Of all rates that meet the targets this gives the ones nearest to 1 (weighted by tokens). A
step is the miss scaled by the Gram matrix of the rows that are not at their bound. One scan of the stored posteriors
tries all step lengths of an iteration and returns per length the totals, the Gram matrix and the value that the steps
have to raise; nothing is collected per document, and a lost executor costs only its own part of a scan. A very small
ridge keeps y finite where targets can't be met; the rates are then those of the least squares. The fit ends when every
domain is within ``TOLERANCE`` of its target (of all tokens, where the target is zero), or when the gradient of the
ridged problem is that small, which is when the rest can't be met. What is missed is returned and warned of.

Defined cases: a missing text is empty; a text too short to judge has the shares of the labelled rows as its
posterior, and no tokens give it no weight; without labelled rows there is one domain; a target for a domain that no
labelled text has, or none of the sample, is an error; a domain that has no target is wanted no tokens; a domain without
tokens can't be filled, the others are still met as well as they can be; equal rows have equal rates; a missing id is
hashed as missing; an empty table gives an empty result; extra columns stay apart in a struct.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import labelled_sample, numbered, text_udf, whole_text

#: Labelled texts and megabytes that the classifier may read.
SAMPLE_ROWS, SAMPLE_MEGABYTES = 4_000, 32
#: Hashed byte trigrams, and trigrams in a window.
BUCKETS, WINDOW = 1 << 14, 256
#: Without targets each domain's share of tokens is raised to this power, which evens the shares out.
TEMPERATURE = 0.7
#: Bytes that are looked at a time, a multiple of the window.
PIECE = WINDOW * 4096
#: Largest miss of a domain in parts of its target, and steps at most.
TOLERANCE, STEPS = 1e-6, 60
#: Lengths of a step that are tried in one scan, and the ridge in parts of all wanted tokens.
LENGTHS, RIDGE = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001), 1e-11


@dataclass(frozen=True)
class Domains:
    """Names, log prior and log likelihood of each hashed trigram (BUCKETS x domains)."""

    names: tuple[str, ...]
    prior: np.ndarray
    table: np.ndarray


def trigrams(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2654435761)
    return (code >> np.uint32(32 - 14)).astype(np.int64)


def fit(sample: list[tuple[str, str]]) -> Domains:
    """Naive Bayes over hashed trigrams."""
    names = tuple(sorted({str(d) for _, d in sample})) or ("all",)
    counts, rows = np.full((len(names), BUCKETS), 0.5), np.ones(len(names))
    for text, domain in sample:
        k = names.index(str(domain))
        rows[k] += 1
        counts[k] += np.bincount(trigrams(text), minlength=BUCKETS)
    table = np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)
    return Domains(names, np.log(rows / rows.sum()), np.ascontiguousarray(table))


def posterior(model: Domains, text: str) -> np.ndarray:
    """The mean posterior of the windows of a whole text."""
    grams, total, seen = trigrams(text), np.zeros(len(model.names)), 0
    for first in range(0, len(grams), PIECE):
        part = grams[first:first + PIECE]
        cuts = np.arange(0, len(part), WINDOW)
        score = np.add.reduceat(model.table[part], cuts, axis=0) + model.prior
        score = np.exp(score - score.max(axis=1, keepdims=True))
        size = np.minimum(WINDOW, len(part) - cuts)
        total += (score / score.sum(axis=1, keepdims=True) * size[:, None]).sum(axis=0)
        seen += len(part)
    return total / seen if seen else np.exp(model.prior)


def learnt(
    docs: DataFrame, labels: DataFrame, domain: str = "lang", rows: int = SAMPLE_ROWS, megabytes: int = SAMPLE_MEGABYTES,
) -> Domains:
    """The classifier of ``domain``, a column of ``docs`` that is trusted where a row has a label."""
    known = docs.select("doc_id", F.col(domain).cast("string").alias("domain")).join(
        labels.select("doc_id").distinct(), "doc_id", "left_semi")
    return fit(labelled_sample(docs, known, "domain", rows, megabytes))


def members(docs: DataFrame, model: Domains) -> DataFrame:
    """The stored rows of ``docs`` with ``tokens`` (words) and ``posterior`` (one number per domain)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers per domain

    @text_udf("struct<tokens:bigint,posterior:array<double>>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        domains = shared.value
        for texts in batches:
            tokens, found = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(domains.names)))
            for i, text in enumerate(texts):
                whole = text.as_py() or ""
                tokens[i], found[i] = len(whole.split()), posterior(domains, whole)
            ends = pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
            yield pa.StructArray.from_arrays([pa.array(tokens), lists], ["tokens", "posterior"])

    made = numbered(docs, "members", made=judge(whole_text()), doc_id=F.col("doc_id"))
    return made.select("row", "rid", "doc_id", "made.tokens", "made.posterior")


def _rates(posteriors: np.ndarray, steps: np.ndarray, at_least: float) -> np.ndarray:
    """The sum of all steps from 1, never below ``at_least``."""
    return np.maximum(at_least, 1.0 - posteriors @ steps)


def _matrix(batch, domains: int) -> np.ndarray:
    """The posteriors of a batch, row by row."""
    return batch.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)


def _tried(parts: DataFrame, steps: np.ndarray, at_least: float) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each row of ``steps`` the totals, the Gram matrix of rows not at their bound, and the value: one scan."""
    tries, domains = steps.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, t = _matrix(batch, domains), batch.column("tokens").to_numpy(zero_copy_only=False).astype(float)
            out = []
            for y in steps:
                free, rate = 1.0 - p @ y, _rates(p, y, at_least)
                inside = p[free >= at_least]
                gram = (inside * t[free >= at_least, None]).T @ inside
                value = t @ ((rate - 1) ** 2 / 2 + (p @ y) * rate)
                out += [*((rate * t) @ p), *gram.ravel(), value]
            yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], ["total"])

    found = parts.select("tokens", "posterior").mapInArrow(sums, "total array<double>")
    width = domains + domains * domains + 1
    # one row per place of the list, a few hundred
    places = found.select(F.posexplode("total").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x")).collect()
    flat = np.zeros(tries * width)
    for row in places:
        flat[row["place"]] = row["x"]
    return [(x[:domains], x[domains:-1].reshape(domains, domains), x[-1]) for x in flat.reshape(tries, width)]


@dataclass(frozen=True)
class Fit:
    """The sum of steps, wanted and reached totals, and the largest miss in parts of its target."""

    steps: np.ndarray
    wanted: np.ndarray
    reached: np.ndarray
    miss: float
    scans: int


def fit_rates(parts: DataFrame, domains: int, targets: np.ndarray | None, at_least: float, most: int = STEPS) -> Fit:
    """The rates of ``members`` as the sum of steps that they follow from.

    ``targets`` are relative weights; without them each domain's share to the power ``TEMPERATURE``. The total is the
    least at which no domain is wanted less than it has.
    """
    steps = np.zeros(domains)
    have, _, _ = _tried(parts, steps[None, :], 0.0)[0]
    tokens = have.sum()
    if tokens == 0:
        return Fit(steps, have, have, 0.0, 1)
    weights = (have / tokens) ** TEMPERATURE if targets is None else np.asarray(targets, float)
    weights = np.where(have > 0, weights, 0.0)
    if not weights.any():
        return Fit(steps, weights, have, 1.0, 1)
    wanted = weights * (have[weights > 0] / weights[weights > 0]).max()
    scale, ridge = np.where(wanted > 0, wanted, wanted.sum()), RIDGE * wanted.sum()
    # a target of a millionth part of all tokens is met to a millionth of that, as long as doubles tell it apart
    scale = np.maximum(scale, wanted.sum() * 1e-6)

    def value(found: tuple, y: np.ndarray) -> float:
        return found[2] - wanted @ y - ridge / 2 * (y @ y)

    now, scans = _tried(parts, steps[None, :], at_least)[0], 2
    for _ in range(most):
        missed = now[0] - wanted
        gradient = missed - ridge * steps
        if (np.abs(missed) <= TOLERANCE * scale).all() or (np.abs(gradient) <= TOLERANCE / 10 * scale).all():
            break
        direction = np.linalg.solve(now[1] + ridge * np.eye(domains), gradient)
        tries = steps + np.array(LENGTHS)[:, None] * direction
        found = _tried(parts, tries, at_least)
        scans += 1
        best = max(range(len(tries)), key=lambda k: value(found[k], tries[k]))
        if value(found[best], tries[best]) <= value(now, steps):
            break  # no length raises the value by what doubles can tell
        now, steps = found[best], tries[best]
    miss = float((np.abs(now[0] - wanted) / scale).max())
    if miss > 10 * TOLERANCE:
        warnings.warn(f"rates miss a target by {miss:.2g} of it after {scans} scans", stacklevel=2)
    return Fit(steps, wanted, now[0], miss, scans)


def asked_of(model: Domains, docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] | None, domain: str) -> np.ndarray | None:
    """Target weights in the order of the model's domains; an error for a domain that can't be told."""
    if targets is None:
        return None
    unknown = sorted(set(targets) - set(model.names))
    if unknown:
        known = docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi").select(F.col(domain).cast("string").alias("domain"))
        listed = known.where(F.col("domain").isin(unknown)).distinct().collect()  # at most as many as there are targets
        missing = sorted(set(unknown) - {r["domain"] for r in listed})
        raise ValueError(f"no labelled text has the target domain {', '.join(missing)}" if missing else
                         f"the sample has no text of the target domain {', '.join(unknown)}; raise its rows")
    if any(not w >= 0 for w in targets.values()) or not any(targets.values()):
        raise ValueError("target weights must not be negative, and not all zero")
    return np.array([targets.get(name, 0.0) for name in model.names])


def mixed(
    docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] | None = None, domain: str = "lang", at_least: float = 0.0,
) -> DataFrame:
    """Every row of ``docs`` (in ``row``) with doc_id, tokens, posterior, rate and copies, and the fit's totals.

    ``targets`` are relative token weights by domain. ``copies`` is the rate rounded up or down by a hash of the id, so
    its expected value is the rate. ``at_least`` = 1 keeps every document and repeats some. ``wanted`` and ``reached``
    are the totals of the domains, in the order of ``posterior``, and the same in every row.
    """
    spark: SparkSession = docs.sparkSession
    model = learnt(docs, labels, domain)
    asked = asked_of(model, docs, labels, targets, domain)
    parts, domains = members(docs, model), len(model.names)
    fitted = fit_rates(parts, domains, asked, at_least)
    shared = spark.sparkContext.broadcast(fitted.steps)  # a number per domain

    @text_udf("double")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            p = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)
            yield pa.array(_rates(p, shared.value, at_least))

    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    listed = lambda numbers: F.array(*[F.lit(float(x)) for x in numbers])
    return parts.withColumn("rate", rate("posterior")).withColumn(
        "copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int")).cast("int"),
    ).withColumns({"domains": F.array(*[F.lit(n) for n in model.names]), "wanted": listed(fitted.wanted), "reached": listed(fitted.reached)})


def remixed(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] | None = None, at_least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say."""
    rows = mixed(docs, labels, targets, at_least=at_least)
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")

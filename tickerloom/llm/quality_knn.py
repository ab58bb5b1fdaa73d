"""Quality by votes of the nearest labelled texts in a latent-semantic space.

A text is a vector of hashed terms: its byte trigrams (letter case kept), and the shapes of its repetitions and lines.
Terms are weighted by inverse document frequency, and the leading singular vectors of the labelled texts' matrix span the
latent space. The labelled vectors are broadcast. For every text the cosines with all of them are exact, computed in
blocks; the ``NEIGHBOURS`` nearest vote for their label with a weight that grows with the cosine.

The labelled texts are at most ``rows`` with together at most ``megabytes``, outside the held-out fold: documented
bounds on what is broadcast and on the cost per text. Every text is scored, whole.

Defined cases: a missing text is empty; a text without any term is at the origin, its cosines are 0 and the vote is the
share of label 1; without labels the score is 0.5; equal texts score alike; voters whose cosine ties with the last
neighbour's all vote; an empty table gives an empty result. Labels, lang, source and ids are no input of a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import labelled_sample, text_udf, whole_text

#: Labelled texts and megabytes of text that are voters.
SAMPLE_ROWS, SAMPLE_MEGABYTES = 3_000, 24
#: Hashed trigrams, and terms for shapes beside them.
BUCKETS, SHAPES = 1 << 13, 64
#: Dimensions of the latent space, voters per text, power of the cosine.
LATENT, NEIGHBOURS, POWER = 64, 15, 4
#: Cosines that differ by less are equal; of the last neighbour's equals all vote.
TIE = 1e-5
#: Texts in a block of cosines; bytes of one text that are hashed at a time.
BLOCK, PIECE = 256, 1 << 20


def _shapes(data: bytes) -> np.ndarray:
    """Terms for repetition and lines: which tenths hold repeated lines, repeated runs of words, frequent words, long lines."""
    words, found = data.split(), np.zeros(SHAPES, np.float32)
    lines = [line for line in data.split(b"\n") if line.strip()]
    if not words:
        return found
    runs = list(zip(words, words[1:], words[2:]))
    tops = Counter(words).most_common(1)[0][1]
    shares = (
        1 - len(set(lines)) / len(lines), 1 - len(set(runs)) / len(runs) if runs else 0, tops / len(words), len(set(words)) / len(words),
        min(1, len(words) / len(lines) / 100), min(1, len(words) / 50),
    )
    for i, share in enumerate(shares):
        found[10 * i + min(9, int(10 * share))] = 1
    return found


def terms(text: str) -> np.ndarray:
    """Counts of hashed byte trigrams, damped, and shapes."""
    data = text.encode("utf-8", "surrogatepass")
    counts = np.zeros(BUCKETS, np.int64)
    for first in range(0, max(1, len(data) - 2), PIECE):
        part = np.frombuffer(data[first:first + PIECE + 2], np.uint8).astype(np.uint32)
        code = (part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(2654435761)
        counts += np.bincount(code >> np.uint32(32 - 13), minlength=BUCKETS)
    # Shares of the text, so that length itself tells nothing, damped.
    return np.concatenate((np.sqrt(counts / max(1, counts.sum())).astype(np.float32), 0.2 * _shapes(data)))


@dataclass(frozen=True)
class Model:
    """Term weights times latent directions (terms x latent), labelled unit vectors, their labels, and the share of label 1."""

    project: np.ndarray
    voters: np.ndarray
    labels: np.ndarray
    share: float


def _unit(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, size, out=np.zeros_like(vectors), where=size > 1e-9)


def fit(sample: list[tuple[str, int]]) -> Model:
    """The latent space and the voters of labelled texts (label 1: good)."""
    labels = np.array([bool(y) for _, y in sample], np.float32)
    width = BUCKETS + SHAPES
    if not sample:
        return Model(np.zeros((width, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5)
    matrix = np.stack([terms(t) for t, _ in sample])
    weight = np.log((1 + len(matrix)) / (1 + (matrix > 0).sum(axis=0))).astype(np.float32) + 1
    matrix *= weight
    # Randomised range finder with two power steps; the seed fixes the directions.
    k = min(LATENT, *matrix.shape)
    base = matrix.T @ np.random.default_rng(5).standard_normal((len(matrix), min(k + 16, len(matrix)))).astype(np.float32)
    for _ in range(2):
        base = matrix.T @ (matrix @ np.linalg.qr(base)[0])
    base = np.linalg.qr(base)[0]
    directions = base @ np.linalg.svd(matrix @ base, full_matrices=False)[2].T[:, :k]
    project = np.ascontiguousarray(weight[:, None] * directions, np.float32)
    return Model(project, _unit(matrix @ directions).astype(np.float32), labels, float(labels.mean()))


def votes(model: Model, vectors: np.ndarray) -> np.ndarray:
    """The score of each latent vector (rows of unit length, or zero)."""
    if not len(model.voters):
        return np.full(len(vectors), model.share)
    cosine = vectors @ model.voters.T
    k = min(NEIGHBOURS, len(model.voters))
    last = -np.partition(-cosine, k - 1, axis=1)[:, k - 1:k]
    weight = np.where(cosine >= last - TIE, np.maximum(0, cosine), 0).astype(np.float64) ** POWER
    total = weight.sum(axis=1)
    vote = weight @ model.labels
    return np.clip(np.where(total > 1e-12, vote / np.maximum(total, 1e-12), model.share), 0.0, 1.0)


def scores(model: Model, texts: list[str]) -> np.ndarray:
    return votes(model, _unit(np.stack([terms(t) for t in texts]) @ model.project)) if texts else np.zeros(0)


def learnt(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, megabytes: int = SAMPLE_MEGABYTES) -> Model:
    """The model of the labelled texts of ``docs``; ``labels`` has doc_id and quality."""
    return fit(labelled_sample(docs, labels, "quality", rows, megabytes))


def quality(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score, 0 to 1, of a text column."""
    shared = spark.sparkContext.broadcast(model)  # about 3 MB, by the bounds above

    @text_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for texts in batches:
            parts = [scores(known, [t.as_py() or "" for t in texts[i:i + BLOCK]]) for i in range(0, len(texts), BLOCK)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)

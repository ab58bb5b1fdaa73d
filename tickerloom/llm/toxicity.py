"""Toxicity by compression distance.

One zstandard dictionary is trained, on windows of ordinary text. The toxic dictionary is not trained: it is that one
with a list of pieces of toxic texts before it. Every text is cut into
windows of ``WINDOW`` words, twice, the second time shifted by half a window. A window that the toxic dictionary makes
shorter than the ordinary one holds something that toxic texts hold. The gains of a text's windows are counted at a few
levels, and a logistic model with calibrated weights and a calibrated threshold turns them into a score.

A dictionary trained on windows of toxic text gave far worse results (figures in the README). Signs that are no pieces,
such as phrases, rare words or words that ordinary texts use too, are therefore not found.

The toxic dictionary holds the ordinary one, so that plain prose compresses alike with both and the gain is not noise,
and before it the pieces (word starts and whole words) that tell toxic texts from ordinary ones: those whose document
counts differ by more than chance among as many candidates as there are. Its nearer part, with the ordinary prose, is
the same in both dictionaries, so offsets cost the same.

Fitting uses at most ``rows`` labelled texts of together at most ``megabytes``, outside the held-out fold; both bounds are
arguments. It is cross-fitted at every size: the gains that calibrate are those of each half of the texts under dictionaries
of the other half, equal texts in the same half. The pieces in use come from both. Scoring reads every window of every text.

Defined cases: a missing text is empty; an empty text has no gain and the score of a text without any sign; long texts
are scored window by window; where no label, only one class or no piece is known the score is the share of label 1 (0 without
labels, below one half), so nothing is judged toxic for lack of data; repeated rows score alike; an empty table gives an empty result.
Labels, lang, source and ids are no input of a score.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import labelled_sample, text_udf, whole_text

#: Labelled texts and megabytes that the fit may read.
SAMPLE_ROWS, SAMPLE_MEGABYTES = 6_000, 48
WINDOW = 8
#: Bytes of the ordinary dictionary and of the toxic pieces.
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 4_096
#: The compressor enters every third byte of a dictionary first; the ordinary part has to begin at such a place.
ALIGN = 12
#: Bytes of the shortest and longest word start that can become a piece.
SHORTEST, LONGEST = 5, 12
#: How many times more frequent in toxic texts a piece has to be.
RATIO = 20
#: Bytes of gain at which windows are counted.
LEVELS = (1, 2, 3, 4, 6)
#: Numbers of pieces that are tried; the cross-fitted gains choose among them.
PIECES = (8, 16, 32, 64)


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split()


def windows(words: list[bytes]) -> Iterator[bytes]:
    """Windows of ``WINDOW`` words from the first word on, then from the middle of the first window on."""
    for first in (0, WINDOW // 2):
        for i in range(first, len(words), WINDOW):
            yield b" %b " % b" ".join(words[i:i + WINDOW])


def pieces_of(words: list[bytes]) -> set[bytes]:
    """Starts of the words of a text, from the blank before them on, and the words with both blanks."""
    found = set()
    for word in set(words):
        word = b" %b " % word
        found.update(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))
    return found


def surprise(toxic: int, ordinary: int, n_toxic: int, n_ordinary: int) -> float:
    """The log-likelihood ratio of two counts against equal shares."""
    share = (toxic + ordinary) / (n_toxic + n_ordinary)
    return 2 * sum(k * math.log(k / (n * share)) for k, n in ((toxic, n_toxic), (ordinary, n_ordinary)) if k)


def toxic_pieces(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """The pieces that tell toxic texts, the surest first; of a piece and its start only the surer one."""
    seen = Counter()
    for text in toxic:
        seen.update(pieces_of(words_of(text)))
    seen = {piece: n for piece, n in seen.items() if n > 2}
    other = Counter()
    for text in ordinary:
        other.update(piece for piece in pieces_of(words_of(text)) if piece in seen)
    limit = 2 * math.log(max(2, len(seen))) + 4
    sure = sorted(
        ((value, piece) for piece, n in seen.items()
         if n / len(toxic) > RATIO * (other[piece] + 0.5) / len(ordinary)
         and (value := surprise(n, other[piece], len(toxic), len(ordinary))) > limit),
        key=lambda x: (-x[0], -len(x[1]), x[1]),
    )
    chosen: list[bytes] = []
    for _, piece in sure:
        if not any(piece.startswith(c) or c.startswith(piece) for c in chosen):
            chosen.append(piece)
    return chosen


def trained(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary trained on the samples; of too few samples their ends."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Greedy matches of five bytes on, literals as they are: lengths then differ by matches alone."""
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=17, chain_log=17, search_log=1, min_match=5, target_length=1,
        strategy=zstandard.STRATEGY_FAST, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


def features_of(gains: list[int]) -> list[float]:
    """Counts of windows at each level, the largest gain, and how many gains there are for the text's length."""
    top = sorted(gains)[-2:]
    counts = [math.log1p(sum(g >= level for g in gains)) for level in LEVELS]
    rates = [100 * sum(g >= level for g in gains) / (len(gains) + 20) for level in LEVELS]
    return [*counts, *rates, max(0, top[-1]) if top else 0, max(0, sum(top) / 2) if top else 0]


@dataclass(frozen=True)
class Model:
    """Two dictionaries, the weights of the logistic model and its constant score where nothing could be learnt."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    constant: float | None = None


class Scorer:
    """A model with its compressors; made once in a task."""

    def __init__(self, model: Model):
        self.model = model
        if model.constant is None:
            self.plain, self.harsh = _compressor(model.ordinary).compress, _compressor(model.toxic).compress

    def features(self, text: str) -> list[float]:
        plain, harsh = self.plain, self.harsh
        return features_of([len(plain(w)) - len(harsh(w)) for w in windows(words_of(text))])

    def score(self, text: str) -> float:
        if self.model.constant is not None:
            return self.model.constant
        return _logistic(np.array([1.0, *self.features(text)]) @ np.array(self.model.weights)).item()


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _weights(features: np.ndarray, labels: np.ndarray, ridge: float = 0.002) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, and the best F0.5 score; its threshold becomes one half.

    F0.5 counts a clean text that is called toxic more than a toxic one that is missed. A cut that calls every text toxic is
    none; where there is no other, the value is negative.
    """
    x = np.column_stack((np.ones(len(features)), features))
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1
    x = x / scale
    w, hold = np.zeros(x.shape[1]), ridge * len(x) * np.r_[1e-6, np.ones(x.shape[1] - 1)]
    for _ in range(50):
        p = _logistic(x @ w)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(hold)
        step = np.linalg.solve(curve, x.T @ (labels - p) - hold * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    raw = x @ w
    order = np.argsort(-raw, kind="stable")
    hit = np.cumsum(labels[order])
    value = 1.25 * hit / (np.arange(1, len(raw) + 1) + 0.25 * labels.sum())
    value[:-1][raw[order][:-1] == raw[order][1:]] = -1  # equal scores can't be parted
    value[-1] = -1
    best = int(np.argmax(value))
    w[0] -= raw[order][best:best + 2].mean()
    return w / scale, float(value[best])


def halves_of(texts: list[str]) -> tuple[list[str], list[str]]:
    """Two halves by turns of the different texts; equal texts lie in the same one."""
    turn: dict[str, int] = {}
    for text in texts:
        turn.setdefault(text, len(turn) % 2)
    return tuple([t for t in texts if turn[t] == half] for half in (0, 1))


def with_pieces(base: bytes, pieces: list[bytes]) -> bytes:
    """The toxic dictionary: pieces, the surest next to the ordinary dictionary, before it."""
    extra = b"".join(reversed(pieces))[-TOXIC_BYTES:]
    return b"\n" * (-len(extra) % ALIGN) + extra + base


def fit(sample: list[tuple[str, int]]) -> Model:
    """A model from labelled texts (label 1: toxic)."""
    share = sum(bool(y) for _, y in sample) / len(sample) if sample else 0.0
    toxic, ordinary = [t for t, y in sample if y], [t for t, y in sample if not y]
    nothing = Model(b"", b"", (), min(share, 0.49))
    if len(toxic) < 4 or len(ordinary) < 4:
        return nothing
    pieces = toxic_pieces(toxic, ordinary)
    harsh_halves, plain_halves = halves_of(toxic), halves_of(ordinary)
    bases = [trained([w for t in half for w in windows(words_of(t))], ORDINARY_BYTES) for half in plain_halves]
    # of each half: its texts, the ordinary dictionary and the pieces of the other half, and the lengths without pieces
    folds, labels = [], []
    for mine, other in ((0, 1), (1, 0)):
        texts = harsh_halves[mine] + plain_halves[mine]
        labels += [1.0] * len(harsh_halves[mine]) + [0.0] * len(plain_halves[mine])
        found = toxic_pieces(harsh_halves[other], plain_halves[other]) if harsh_halves[other] and plain_halves[other] else []
        compress = _compressor(bases[other]).compress
        folds.append((texts, bases[other], found, [array("I", (len(compress(w)) for w in windows(words_of(t)))) for t in texts]))
    labels, best = np.array(labels), None
    for n in sorted({min(n, len(pieces)) for n in PIECES} | {len(pieces)}):
        features = []
        for texts, base, found, plain in folds:
            compress = _compressor(with_pieces(base, found[:n])).compress
            features += [features_of([a - len(compress(w)) for a, w in zip(lengths, windows(words_of(t)))])
                         for t, lengths in zip(texts, plain)]
        weights, value = _weights(np.array(features), labels)
        if value > (best[0] + 0.002 if best else 0):
            best = value, Model(bases[0], with_pieces(bases[0], pieces[:n]), tuple(weights.tolist()))
    return best[1] if best else nothing


def learnt(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, megabytes: int = SAMPLE_MEGABYTES,
) -> Model:
    """The model of the labelled texts of ``docs``; ``labels`` has doc_id and toxic."""
    return fit(labelled_sample(docs, labels, "toxic", rows, megabytes))


def toxicity(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score, 0 to 1, of a text column."""
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of at most 41 kB

    @text_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pa.array([scorer.score(t.as_py() or "") for t in texts], pa.float64())

    return score(text)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    score = toxicity(docs.sparkSession, learnt(docs, labels), whole_text())
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), score.alias("score"))
    return kept.where(F.col("score") < threshold).select("row.*")

"""Toxicity: held-out accuracy and odd rows."""

import numpy as np
import pandas as pd
import zstandard

import __spark_entry__ as entry
from tests.llm.helpers import ODD, area, clashing, empty, held_out, odd
from tickerloom.llm import toxicity

LARGE = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    found = entry.queries()["op3_toxicity"](spark, LARGE).toPandas()
    assert (found.held_out == found.doc_id.map(held_out)).all()
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.5)).all()
    known = found[found.held_out].merge(pd.read_parquet(f"{LARGE}/labels.parquet"), on="doc_id")
    assert area(known.score, known.toxic) > 0.85
    assert known.predicted[known.toxic == 0].mean() < 0.02
    assert known.predicted[known.toxic == 1].mean() > 0.6


SAMPLE = [(f"some plain words number {i} and more of them", 0) for i in range(40)] + [
    (f"some plain words number {i} and grobnik more of them", 1) for i in range(100, 120)]


def test_gain_and_constant_scores():
    scorer = toxicity.Scorer(toxicity.fit(SAMPLE))
    assert scorer.score("other words with grobnik in between here") > 0.5
    assert scorer.score("other words with nothing in between here") < 0.5
    assert 0 <= scorer.score("") < 0.5
    assert toxicity.Scorer(toxicity.fit([])).score("x") == 0
    assert toxicity.Scorer(toxicity.fit([("x", 1)] * 3)).score("x") < 0.5


def plain_score(model, text):
    """The score by its definition: every window compressed with a dictionary loaded for it alone."""
    words = text.lower().split()
    parts = [words[i:i + 8] for first in (0, 4) for i in range(first, len(words), 8)]

    def length(content, part):
        settings = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=17, chain_log=17, search_log=1, min_match=5, target_length=1,
            strategy=zstandard.STRATEGY_FAST, write_content_size=False, write_checksum=False, write_dict_id=False)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)
        return len(compressor.compress((" " + " ".join(part) + " ").encode()))

    gains = sorted(length(model.ordinary, part) - length(model.toxic, part) for part in parts)
    above = np.array([sum(g >= level for g in gains) for level in (1, 2, 3, 4, 6)])
    most = [max(0, gains[-1]), max(0, sum(gains[-2:]) / 2)] if gains else [0, 0]
    z = np.dot(model.weights, [1, *np.log1p(above), *(100 * above / (len(gains) + 20)), *most])
    return 1 / (1 + np.exp(-z))


def test_scores_against_their_definition():
    model = toxicity.fit(SAMPLE)
    scorer = toxicity.Scorer(model)
    texts = [t for t, _ in SAMPLE[::7]] + ["", "Grobnik", "grobnik " * 50, "grob nik grobniks", "plain words " * 30 + "grobnik"]
    assert np.allclose([scorer.score(t) for t in texts], [plain_score(model, t) for t in texts], atol=1e-12)


def test_calibration_is_cross_fitted():
    """Pieces that one half of few texts owns by chance earn nothing, as they don't help in the other half."""
    lone = [(f"some plain words and more of them {'abc' if i < 15 else 'xyz'}lone{i}", 0) for i in range(30)]
    same = [("zuzu wrote this very text", 1)] * 6
    assert toxicity.fit(lone + same).constant is not None
    first, second = toxicity.halves_of(["a", "b", "a", "c", "b"])
    assert (first, second) == (["a", "a", "c"], ["b", "b"])
    assert toxicity.fit(SAMPLE) == toxicity.fit(SAMPLE)


def test_windows_cover_every_word():
    for n in (1, 7, 8, 9, 30):
        words = [b"w%d" % i for i in range(n)]
        assert {w for part in toxicity.windows(words) for w in part.split()} == set(words)


def test_odd_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None), (3, 1)], "doc_id long, toxic int")
    docs = clashing(spark)
    stay = toxicity.without_toxic(docs, labels)
    assert stay.columns == docs.columns and stay.count() == len(ODD)
    assert toxicity.without_toxic(empty(spark), labels).count() == 0
    assert toxicity.without_toxic(odd(spark), labels.limit(0)).count() == len(ODD)

"""Mixing: totals meet the targets; rates by their optimality conditions."""

import numpy as np
import pytest

from tests.llm.helpers import ODD, SF, clashing, empty, odd
from tickerloom.llm import mixing
from tickerloom.llm.common import read_table


def tables(spark):
    return read_table(spark, SF, "documents"), read_table(spark, SF, "labels")


@pytest.mark.parametrize("targets, at_least", [
    ({"de": 0.3, "en": 0.3, "es": 0.3, "fr": 0.1}, 0.0), ({"de": 0.7, "en": 0.1, "es": 0.1, "fr": 0.1}, 1.0),
    ({"en": 1.0}, 0.0), ({"en": 0.5, "es": 0.5}, 0.0), ({"es": 1}, 0.0),
])
@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_targets_are_met_by_the_nearest_rates(spark, sf, targets, at_least):
    """The targets hold, and so do the conditions of the only rates nearest to 1 that meet them."""
    found = mixing.mixed(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"), targets, at_least=at_least)
    found = found.select("tokens", "posterior", "rate", "domains", "wanted", "reached").toPandas()
    p, t, rate = np.stack(found.posterior), found.tokens.to_numpy(float), found.rate.to_numpy()
    want = np.array([targets.get(n, 0.0) for n in found.domains[0]])
    reached = (rate * t) @ p
    assert np.abs(reached / reached.sum() - want / want.sum()).max() < 3e-6
    wanted = np.array(found.wanted[0])
    assert np.allclose(reached, found.reached[0]) and np.allclose(wanted / wanted.sum(), want / want.sum())
    assert rate.min() >= at_least
    # min sum t (r - 1)^2 / 2 over r >= bound with given totals: 1 - r is p x multipliers inside, at least that at the bound
    inside = (rate > at_least + 1e-9) & (t > 0)
    multipliers = np.linalg.lstsq(p[inside], 1 - rate[inside], rcond=None)[0]
    assert np.allclose(p[inside] @ multipliers, 1 - rate[inside], atol=1e-6)
    if targets == {"de": 0.7, "en": 0.1, "es": 0.1, "fr": 0.1}:
        assert (rate == 1).mean() > 0.3 and inside.any()


def test_targets_out_of_reach(spark):
    """No domain can shrink below what it has: the least squares leave the others at the bound, and the miss is told."""
    docs, labels = tables(spark)
    with pytest.warns(UserWarning, match="miss a target"):
        found = mixing.mixed(docs, labels, {"en": 1.0}, at_least=1.0).select("tokens", "posterior", "rate").toPandas()
    p, t, rate = np.stack(found.posterior), found.tokens.to_numpy(float), found.rate.to_numpy()
    have = t @ p
    missed = (rate * t) @ p - np.where(np.arange(4) == 1, have[1], 0.0)
    # conditions of least squares over r >= 1: no row can lower the squared miss by growing
    assert (p @ missed >= -1e-6 * have.sum()).all() and np.allclose(rate[p @ missed > 1e-3 * have.sum()], 1.0)


def test_unknown_targets(spark):
    docs, labels = tables(spark)
    with pytest.raises(ValueError, match="no labelled text has the target domain xx"):
        mixing.mixed(docs, labels, {"en": 0.5, "xx": 0.5})
    with pytest.raises(ValueError, match="negative"):
        mixing.mixed(docs, labels, {"en": -1.0})


def test_long_text_in_pieces(monkeypatch):
    model = mixing.fit([("the thing and the other thing " * 20, "x"), ("zwischen und jemals niemand " * 20, "y")])
    text = "the thing and the other thing " * 300 + "zwischen und jemals niemand " * 150
    whole = mixing.posterior(model, text)
    monkeypatch.setattr(mixing, "PIECE", 4 * mixing.WINDOW)
    assert np.allclose(mixing.posterior(model, text), whole)


def test_bound_and_copies(spark):
    docs, labels = tables(spark)
    found = mixing.mixed(docs, labels, at_least=1.0).select("rate", "copies").toPandas()
    assert (found.rate >= 1).all() and (found.copies >= 1).all()
    assert ((found.copies == np.floor(found.rate)) | (found.copies == np.ceil(found.rate))).all()
    skewed = mixing.mixed(docs, labels, {"en": 1.0}).select("rate", "posterior").toPandas()
    assert (skewed.rate >= 0).all()


def test_classifier_on_held_out_rows(spark):
    docs, labels = tables(spark)
    model = mixing.learnt(docs, labels)
    rows = docs.where(mixing.F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")).collect()
    right = [model.names[int(mixing.posterior(model, r["text"]).argmax())] == r["lang"] for r in rows if len(r["text"]) > 200]
    assert np.mean(right) > 0.9


def test_mixed_text_belongs_to_both():
    model = mixing.fit([("the thing and the other thing " * 20, "x"), ("zwischen und jemals niemand " * 20, "y")])
    both = mixing.posterior(model, "the thing and the other thing " * 40 + "zwischen und jemals niemand " * 40)
    assert 0.3 < both[0] < 0.7 and abs(both.sum() - 1) < 1e-9


def test_odd_rows(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = clashing(spark)
    assert mixing.mixed(docs, labels).count() == len(ODD)
    same = mixing.remixed(docs, labels, at_least=1.0)
    assert same.columns == docs.columns and same.count() >= len(ODD)
    assert mixing.mixed(odd(spark), labels.limit(0)).count() == len(ODD)
    assert mixing.remixed(empty(spark), labels).count() == 0

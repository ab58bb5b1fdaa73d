"""Quality by neighbours and by rules: counts against brute force, held-out accuracy, odd rows."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from tests.llm.helpers import ODD, area, clashing, documents, empty, held_out, odd
from tickerloom.llm import quality_knn, quality_rules
from tickerloom.llm.common import read_table

LARGE = "/root/testdata/sf0.1"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    again = {i + k for i in range(len(words) - 4) for k in range(5) if windows[tuple(words[i:i + 5])] > 1}
    lines, dup = text.split("\n"), 0
    for i, line in enumerate(lines):
        dup += bool(re.search(r"[^\x20\x09-\x0d]", line)) and line in lines[:i]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ä#", "\n", " ", "\x1c", "*|", "\t", "B c d e f "]), max_size=60).map("".join))
def test_counts(text):
    assert quality_rules.counts_of(text)[:5] == brute(text)


def test_rules_query(spark):
    found = entry.queries()["op9_quality_rules"](spark, LARGE).toPandas()
    docs = documents(LARGE).merge(found, on="doc_id")
    assert len(docs) == len(found)
    for r in docs.iloc[::40].itertuples():
        assert brute(r.text) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    assert (docs.base_failed == ((docs.n_words < 10) | (100 * docs.n_repeat_words > 20 * docs.n_words))).all()
    assert not docs.kept[docs.base_failed].any()
    known = docs.merge(pd.read_parquet(f"{LARGE}/labels.parquet"), on="doc_id")
    known = known[known.doc_id.map(held_out)]
    assert known.kept[(known.quality == 1) & ~known.base_failed].mean() > 0.98
    assert known.kept[known.quality == 0].mean() < 0.15


def test_list_is_learnt_and_ordered(spark):
    random = np.random.default_rng(0)
    table = {name: random.random(900) for name in quality_rules.STATISTICS}
    bad = (table["upper_share"] > 0.8) | ((table["repeat_share"] > 0.5) & (table["mean_word"] < 0.2))
    rules = quality_rules.learnt_rules(table, bad)
    found = np.zeros(900, bool)
    for rule in rules:
        found |= quality_rules._covers(rule, table, np.ones(900, bool))
    assert (found == bad).mean() > 0.97
    assert quality_rules.learnt_rules({k: v[:0] for k, v in table.items()}, bad[:0]) == []
    counts = spark.createDataFrame([(tuple([12, 50, 9, *[0] * 9]),)], f"counts struct<{','.join(f'{n}:bigint' for n in quality_rules.COUNTS)}>")
    rule = (quality_rules.Condition("symbols_per_word", True, 0.5),)
    assert counts.select(quality_rules.verdict([rule])).first()[0] is False
    assert counts.select(quality_rules.verdict([])).first()[0] is True


LABELS = [(i, i % 2, 0) for i in range(12)] + [(None, 1, 1), (3, None, None)]


def test_odd_rows_of_rules(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    for docs in (odd(spark), clashing(spark)):
        found = quality_rules.judged(docs, labels)
        assert found.count() == len(ODD) and found.where("kept is null or base_failed is null").count() == 0
    assert quality_rules.judged(odd(spark), labels.limit(0)).count() == len(ODD)
    assert quality_rules.judged(empty(spark), labels).count() == 0


def test_neighbours_query(spark):
    found = entry.queries()["op7_quality"](spark, LARGE).toPandas()
    assert (found.held_out == found.doc_id.map(held_out)).all()
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.3)).all()
    known = found[found.held_out].merge(pd.read_parquet(f"{LARGE}/labels.parquet"), on="doc_id")
    assert area(known.score, known.quality) > 0.97
    assert known.predicted[known.quality == 1].mean() > 0.99
    assert known.predicted[known.quality == 0].mean() < 0.15


def test_votes_are_exact(spark):
    docs = documents()
    sample = list(zip(docs.text[:90], (docs.doc_id[:90] % 3 > 0).astype(int)))
    model = quality_knn.fit(sample)
    texts = docs.text[90:].tolist()
    vectors = quality_knn._unit(np.stack([quality_knn.terms(t) for t in texts]) @ model.project)
    want = []
    for v in vectors:
        cosine = [float(v @ w) for w in model.voters]
        near = [i for i, c in enumerate(cosine) if c >= sorted(cosine)[-quality_knn.NEIGHBOURS] - quality_knn.TIE]
        weight = np.maximum(0, np.array(cosine)[near]) ** quality_knn.POWER
        want.append((weight * model.labels[near]).sum() / weight.sum())
    assert quality_knn.scores(model, texts) == pytest.approx(want, abs=1e-4)


def test_pieces_of_long_texts_add_up(monkeypatch):
    text = "some words ä\n" * 300
    whole = quality_knn.terms(text)
    monkeypatch.setattr(quality_knn, "PIECE", 7)
    assert np.allclose(quality_knn.terms(text), whole)


def test_odd_rows_of_neighbours(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    for docs, known in ((clashing(spark), labels), (odd(spark), labels.limit(0)), (empty(spark), labels)):
        model = quality_knn.learnt(docs, known)
        found = docs.select(quality_knn.quality(spark, model, quality_knn.F.col("text")).alias("score")).collect()
        assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)

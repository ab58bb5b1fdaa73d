"""The pipeline: stages in order, each against brute force on what its predecessor kept."""

import re

import corpus_pipeline
from tests.llm.helpers import SF, clashing, empty
from tests.llm.test_bpe import library
from tests.llm.test_near_copies import kept_of
from tickerloom.llm import toxicity
from tickerloom.llm.common import read_table
from tickerloom.session import through_table


def test_stages_on_the_smallest_tables(spark):
    docs = read_table(spark, SF, "documents")
    kept = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = through_table(stage(spark, docs, SF), "stage")
        kept.append(docs.collect())
    first, clean, exact, near, mixed, tokens = kept
    scorer = toxicity.Scorer(toxicity.learnt(read_table(spark, SF, "documents"), read_table(spark, SF, "labels")))
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in first if scorer.score(r["text"] or "") < 0.5}
    groups = {}
    for r in clean:
        groups.setdefault(re.sub("[ \t-\r]", "", r["text"] or ""), []).append((-len(r["text"] or ""), r["doc_id"]))
    assert {r["doc_id"] for r in exact} == {min(g)[1] for g in groups.values()}
    exact.sort(key=lambda r: r["doc_id"])
    assert {r["doc_id"] for r in near} == {exact[i]["doc_id"] for i in kept_of([r["text"] or "" for r in exact])}
    assert {r["doc_id"] for r in mixed} == {r["doc_id"] for r in near} and len(mixed) >= len(near)
    texts = {r["doc_id"]: r["text"] or "" for r in near}
    assert len(tokens) == len(mixed)
    assert all(r["ids"] == library(texts[r["doc_id"]]) for r in tokens)
    assert all(list(r.__fields__) == list(first[0].__fields__) for part in (clean, exact, near, mixed) for r in part[:1])


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"] and found.count() > 0


def test_odd_and_empty_tables(spark):
    for docs in (clashing(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, through_table(stage(spark, docs, SF), "stage")
            if name != "bpe":
                assert docs.columns == before.columns
        assert (docs.count() > 0) == (before.count() > 0)

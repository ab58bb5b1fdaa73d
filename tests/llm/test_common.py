"""Labelled samples with very long texts."""

from tickerloom.llm.common import labelled_sample


def test_long_texts_leave_the_others_in_the_sample(spark):
    """Before, the sample ended at the first text that did not fit."""
    long = {i: "word " * 300_000 for i in range(0, 60, 10)}  # each larger than the bound
    wide = {i: "word " * 60_000 for i in range(5, 60, 10)}  # each larger than a quarter of it
    texts = [(i, long.get(i) or wide.get(i) or f"text {i}") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    everything = labelled_sample(docs, labels, "toxic", 1000, 100)
    short = sorted(x for x in everything if len(x[0]) < 100)
    assert len(everything) > len(short) > 20
    assert sorted(labelled_sample(docs, labels, "toxic", 1000, 1)) == short


def test_bound_holds_for_all_texts_together(spark):
    docs = spark.createDataFrame([(i, "word " * 40_000) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert len(labelled_sample(docs, labels, "toxic", 1000, 1)) == 5

"""Shared passages against brute force over all runs of sentences."""

import hashlib

import __spark_entry__ as entry
from tests.llm.helpers import ODD, SF, clashing, documents, empty, odd
from tests.llm.test_substring_runs import gone_of, left_of
from tickerloom.llm import substring_dedup
from tickerloom.llm.common import F

PASSAGE = (
    "The quick brown fox jumps over the lazy dog. A second sentence follows it with some more words! "
    "Is there a third one that ends the passage here? It goes on for a while, and on. Then it ends with many other words at last."
)


def test_query(spark):
    docs = documents().sort_values("doc_id")
    texts = docs.text.tolist()
    left = [left_of(text, gone) for text, gone in zip(texts, gone_of(texts))]
    want = {i: (hashlib.sha256(b.encode()).hexdigest(), len(a) - len(b)) for i, a, b in zip(docs.doc_id, texts, left)}
    found = entry.queries()["op10_substring_dedup"](spark, SF).collect()
    assert {r["doc_id"]: (r["text_sha256"], r["removed_chars"]) for r in found} == want
    assert sum(n > 0 for _, n in want.values()) > 10


def test_sentences_cover_the_text():
    for text in [*documents().text[:80], "no end", "... !", "\n\n", "a.b.c", "w " * 100, "", " \n é. "]:
        data = text.encode()
        ends, numbers, words = substring_dedup.sentences(data)
        assert ends == sorted(ends) and (not ends or ends[-1] == len(data))
        assert [len(w) for w in words] == numbers
        for begin, end, part in zip([0, *ends], ends, words):
            assert data[begin:end].lower().split() == part


def test_hash_of_a_span_does_not_depend_on_its_place():
    body = PASSAGE.encode()
    _, numbers, alone = substring_dedup.sentences(body)
    _, more, shifted = substring_dedup.sentences(b"Some other words first. And more of them. " + body)
    ends, moved = substring_dedup.spans(numbers), substring_dedup.spans(more)
    one, two = substring_dedup.span_hashes(alone, ends), substring_dedup.span_hashes(shifted, moved)
    assert set(zip(*map(list, one[1:]))) <= set(zip(*map(list, two[1:])))
    assert len(set(one[1])) == len(one[1]) > 0


def test_passage_in_other_surroundings(spark):
    around = [f"Opening words number {i} of this text. {PASSAGE}\nClosing words number {i} of this text." for i in range(5)]
    unpunctuated = " ".join(f"w{i * i % 89}" for i in range(70))
    around += [f"Start {i} here {unpunctuated} end {i} there." for i in range(3)]
    clean = [f"Clean text {i} has words {i + 1} of its own. Nothing {i} is shared. It stays {i * 7} as it is." for i in range(4)]
    docs = spark.createDataFrame(list(enumerate(around + clean)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in substring_dedup.deduplicated(docs).select("row.doc_id", "removed", "text").collect()}
    assert not found[0]["removed"] and not found[5]["removed"]
    for i in range(1, 5):
        assert "lazy dog" not in found[i]["text"] and "Opening words" in found[i]["text"] and "Closing words" in found[i]["text"]
    for i in (6, 7):
        assert len(found[i]["text"].split()) < 40
    for i, text in enumerate(clean):
        assert found[8 + i]["text"] == text


def test_one_passage_in_many_texts(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", f"concat('Text ', id, ' begins so. ', '{PASSAGE}') AS text")
    found = substring_dedup.deduplicated(docs)
    assert found.where(F.size("removed") == 0).count() == 1


def test_odd_rows(spark):
    found = substring_dedup.deduplicated(odd(spark)).select("row.doc_id", F.col("row.text").alias("was"), "removed", "text").collect()
    assert len(found) == len(ODD)
    assert all((r["text"] is None) == (r["was"] is None) for r in found)
    twice = [r for r in found if r["doc_id"] is None]
    assert twice[0]["removed"] == [] or twice[0]["text"] != twice[0]["was"]
    docs = clashing(spark)
    assert substring_dedup.deduplicated(docs).select("row.*").columns == docs.columns
    assert substring_dedup.deduplicated(empty(spark)).count() == 0

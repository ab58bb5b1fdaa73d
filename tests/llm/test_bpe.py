"""Encoding and decoding against the public library."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.llm.helpers import SF, clashing, documents, empty, odd
from tickerloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()
OWN = bpe.Vocabulary(open(PATH, encoding="utf-8").read())


def own(text):
    found = bytearray()
    OWN.encode(text, found)
    return np.frombuffer(found, np.int32).tolist()


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"], max_codepoint=0x2FFFF), max_size=60))
def test_any_text_as_the_library(text):
    assert own(text) == library(text)


@pytest.mark.parametrize("text", [
    "", " ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "it's we'll they'd I'M", "ΣΑΣ Σ", "Café", "a" * 500,
    "aaaa bbbb " * 50, "  \x1c\x85", "12345", "!!!???", "\U0001f600\U0001f600",
])
def test_cases_as_the_library(text):
    ids = library(text)
    assert own(text) == ids
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_unknown_ids_decode_to_nothing():
    assert OWN.decode([10**6, 320]) == OWN.decode([320])


def test_query_as_the_library(spark):
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = {}
    for doc in documents().itertuples():
        ids = library(doc.text)
        want[doc.doc_id] = (len(ids), digest(" ".join(map(str, ids))), digest(LIBRARY.decode(ids, skip_special_tokens=False)))
    found = entry.queries()["op5_bpe"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found} == want


def test_odd_rows(spark):
    for docs in (odd(spark), clashing(spark)):
        found = docs.select("doc_id", "text", bpe.encoded(spark, PATH, bpe.F.col("text")).alias("ids")).collect()
        assert len(found) == docs.count()
        assert all(r["ids"] == library(r["text"] or "") for r in found)
        again = docs.select(
            bpe.encoded(spark, PATH, bpe.F.col("text")).alias("ids"), bpe.round_trip(spark, PATH, bpe.F.col("text")).alias("both"),
        ).select("ids", "both.*", bpe.decoded(spark, PATH, bpe.F.col("ids")).alias("text")).collect()
        assert all(r[0] == r[1] and r["decoded"] == r["text"] for r in again)
    assert empty(spark).select(bpe.encoded(spark, PATH, bpe.F.col("text"))).count() == 0


def test_few_rows_are_held_at_a_time():
    """Ids and decoded texts of a batch are several times its bytes, so they leave in parts, in order."""
    texts = [f"text {i} of many" if i % 7 else None for i in range(2 * bpe.ROWS + 30)]
    made = list(bpe._both(OWN, iter([pa.array(texts, pa.string()), pa.array([], pa.string())])))
    assert [len(part) for part in made] == [bpe.ROWS, bpe.ROWS, 30]
    rows = [row for part in made for row in part.to_pylist()]
    assert [row["ids"] for row in rows] == [library(text or "") for text in texts]

"""Exact duplicates against brute force, and the directory."""

import hashlib
import re

import pytest

from tests.llm.helpers import ODD, clashing, empty, odd
from tickerloom.llm import exact_dedup


def brute(table):
    groups = {}
    for doc_id, text, *_ in table:
        groups.setdefault(re.sub("[ \t-\r]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id, text))
    found = []
    for bare, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        for m in members:
            found.append((m[2], best[2], len(members), hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("capacity", [1, 2, 65_536])
def test_decisions(spark, capacity):
    found = exact_dedup.decisions(odd(spark), capacity).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=str) == brute(ODD)
    kept = [r["text_sha256"] for r in found if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in found})


def test_kept_rows_are_whole(spark):
    docs = clashing(spark)
    stay = exact_dedup.deduplicated(docs)
    assert stay.columns == docs.columns
    assert stay.count() == len({re.sub("[ \t-\r]", "", r[1] or "") for r in ODD})
    assert stay.where("rid = 'extra' and key = 'extra'").count() == stay.count()
    assert exact_dedup.deduplicated(empty(spark)).count() == 0
    assert exact_dedup.decisions(empty(spark)).count() == 0


def test_directory_covers_every_key(spark):
    keys = spark.range(5_000).selectExpr("xxhash64(id) AS key")
    directory, depth = exact_dedup.grow_directory(keys, 100)
    assert directory.count() == directory.select("slot").distinct().count() <= 1 << depth
    found = keys.join(directory, exact_dedup.slot(keys["key"], depth) == directory["slot"])
    assert found.count() == 5_000
    assert found.groupBy("bucket", "local_depth").count().agg({"count": "max"}).first()[0] <= 100


def test_colliding_keys_are_chained(spark, monkeypatch):
    """With every key equal, only the comparison of bytes tells texts apart."""
    real = exact_dedup.F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *columns: real(exact_dedup.F.lit(1)))
    found = exact_dedup.decisions(odd(spark)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=str) == brute(ODD)


def test_many_keys_in_split_buckets(spark):
    """Groups of copies in buckets that split, and a hot group in several parts."""
    texts = [f"text {i % 37} {'x' * (i % 3)}" if i % 2 else "one  hot\ttext" + " " * (i % 5) for i in range(400)]
    table = [(i, t) for i, t in enumerate(texts)]
    found = exact_dedup.decisions(spark.createDataFrame(table, "doc_id long, text string").repartition(6), 4).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=str) == brute(table)
    assert max(r["group_size"] for r in found) == 200


def test_rows_are_found_through_the_directory(spark, monkeypatch):
    """A directory without slots sends no row to a bucket, so no copy is found."""
    real = exact_dedup.grow_directory
    monkeypatch.setattr(exact_dedup, "grow_directory", lambda keys, capacity: (real(keys, capacity)[0].limit(0), 0))
    assert {r["group_size"] for r in exact_dedup.decisions(odd(spark)).collect()} == {1}


def test_chain_of_colliding_texts(spark):
    """One key with three texts, two of them in several parts: three links, each with its copies."""
    rows = [("k", t, n) for t, n in (("a", 2), ("b", 1), ("a", 3), ("c", 5), ("b", 4))]
    sent = spark.createDataFrame(rows, "name string, bare string, n long").selectExpr(
        "0L AS bucket", "0 AS local_depth", "xxhash64(name) AS key", "bare", "sha2(bare, 256) AS sha", "n",
        "struct(-n AS shorter, false AS unnamed, n AS doc_id, n AS rid) AS best")
    found = {r["sha"]: (r["group_size"], r["best"]["doc_id"]) for r in exact_dedup.chains(sent).collect()}
    assert found == {hashlib.sha256(t.encode()).hexdigest(): v for t, v in {"a": (5, 3), "b": (5, 4), "c": (5, 5)}.items()}

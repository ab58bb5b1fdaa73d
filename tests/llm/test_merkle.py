"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest

import __spark_entry__ as entry
from tests.llm.helpers import ODD, SF, clashing, empty, odd
from tickerloom.llm import merkle, queries


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    """(root, siblings of each node with their side)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, place in zip(paths, places):
            other = place ^ 1
            path.append((-1 if place % 2 else 1, nodes[other]) if other < len(nodes) else (0, ""))
        nodes = [digest(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        places = [p // 2 for p in places]
    return nodes[0], paths


def brute(table):
    """table: (doc_id, text, lang, source, n_chars)"""
    groups = {}
    for doc_id, text, lang, source, n_chars in table:
        wrong = n_chars
        if doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
            wrong = n_chars + 1
        made = (doc_id is not None, doc_id or 0, leaf(doc_id, source, lang, n_chars, text), leaf(doc_id, source, lang, wrong, text))
        groups.setdefault((lang is not None, (lang or "").encode()), []).append(made)
    trees = [tree([m[2] for m in sorted(groups[g])]) for g in sorted(groups)]
    if not trees:
        return []
    root, above = tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), rest in zip(sorted(groups), trees, above):
        for (known, doc_id, h, wrong), path in zip(sorted(groups[g]), paths):
            now = wrong
            for side, sibling in path + rest:
                now = digest(sibling, now) if side < 0 else digest(now, sibling)
            out.append((doc_id if known else None, h, subroot, root, digest(*[s for _, s in path + rest]), now, now == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("bits", [1, 2, merkle.BITS])
def test_odd_rows(spark, bits):
    found = queries.manifest_of(odd(spark), bits)
    assert rows_of(found) == brute(ODD)


def test_several_tiers_ties_and_one_hot_group(spark):
    table = [(i // 3, "same" if i % 3 else f"t{i}", "hot" if i % 4 else f"l{i % 16}", None, i % 2 or None) for i in range(700)]
    table += [(5, "x", "ß", "s", 1)] * 40 + [(None, None, None, None, None)] * 3
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    want = brute(table)
    assert rows_of(queries.manifest_of(docs, 2)) == want
    assert rows_of(queries.manifest_of(docs, 8)) == want
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 17])
def test_sizes_of_one_group(spark, n):
    table = [(i, f"t{i}", "en", "s", i) for i in range(n)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(queries.manifest_of(docs, 2)) == brute(table)


def test_path_is_a_proof(spark):
    found = merkle.manifest(odd(spark), bits=2).collect()
    for r in found:
        now = r["leaf"]
        for step in r["path"]:
            now = digest(step["h"], now) if step["side"] < 0 else digest(now, step["h"])
        assert now == r["root"]


def test_empty_and_clashing(spark):
    assert queries.manifest_of(empty(spark)).count() == 0
    assert rows_of(queries.manifest_of(clashing(spark))) == brute(ODD)


def test_plan_has_no_join_of_leaves(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = queries.manifest_of(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_query(spark):
    table = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(entry.queries()["op11_merkle"](spark, SF)) == brute(table)

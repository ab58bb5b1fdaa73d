"""Near duplicates against brute force over all pairs."""

import re

import numpy as np
import xxhash

import __spark_entry__ as entry
from tests.llm.helpers import ODD, SF, clashing, documents, empty, odd
from tickerloom.llm import components, simhash


def print_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """The root (an index) of every fingerprint, from all pairs."""
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    prints = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= 3):
            a, b = top(i), top(int(j))
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(prints))]


def test_query(spark):
    docs = documents().sort_values("doc_id")
    prints = [print_of(t) for t in docs.text]
    ids = docs.doc_id.tolist()
    want = {ids[i]: (f"{prints[i]:016x}", ids[r]) for i, r in enumerate(classes(prints))}
    found = entry.queries()["op4_simhash"](spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == want


def test_odd_rows(spark):
    found = simhash.components(odd(spark)).collect()
    assert len(found) == len(ODD)
    want = {r[0]: print_of(r[1] or "") for r in ODD}
    assert all(r["fp"] % 2**64 == want[r["doc_id"]] for r in found)
    assert {r["component_id"] for r in found if r["doc_id"] in (2, 3, 4)} == {2}
    docs = clashing(spark)
    stay = simhash.one_of_each(docs)
    assert stay.columns == docs.columns
    assert stay.count() == len({r["component_id"] for r in found})
    assert simhash.components(empty(spark)).count() == simhash.one_of_each(empty(spark)).count() == 0


def test_pieces_of_long_texts_add_up(monkeypatch):
    text = " ".join(f"w{i * i % 977}" for i in range(5_000))
    whole = simhash.bits_of(text)
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert simhash.bits_of(text) == whole == print_of(text)


def test_every_linked_pair_shares_an_anchor():
    random = np.random.default_rng(1)
    prints = random.integers(0, 2**64, 300, np.uint64)
    for bits in (0, 1, 2, 3):
        other = prints.copy()
        for row in range(len(other)):
            for bit in random.choice(64, bits, replace=False):
                other[row] ^= np.uint64(1) << np.uint64(bit)
        one, two = simhash.anchors(prints), simhash.anchors(other)
        for row in range(len(prints)):
            assert set(one[0][one[1] == row]) & set(two[0][two[1] == row])


def test_dense_anchor_in_tiles(spark, monkeypatch):
    """A ball of many near fingerprints: tiles of few rows give the same classes as all pairs."""
    monkeypatch.setattr(simhash, "PENDING", 50)
    random = np.random.default_rng(2)
    near = [int(np.bitwise_xor.reduce(np.uint64(1) << random.choice(64, 5).astype(np.uint64))) for _ in range(250)]
    prints = sorted({p if p < 2**63 else p - 2**64 for p in near})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = components.connected(simhash.near_links(frame, block=4)).collect()
    root = {r["node"]: r["root"] for r in found}
    want = classes([p % 2**64 for p in prints])
    ours = [root.get(p, p) for p in prints]
    assert len({(a, b) for a, b in zip(ours, want)}) == len(set(ours)) == len(set(want))


def test_merging_while_comparing(monkeypatch):
    random = np.random.default_rng(3)
    prints = np.array([int(np.bitwise_xor.reduce(np.uint64(1) << random.choice(64, 4).astype(np.uint64))) for _ in range(600)], np.uint64)
    group = np.sort(random.integers(0, 4, 600))
    want = sum(len(set(classes(prints[group == g].tolist()))) for g in range(4))
    for waiting in (0, 7, 10**6):
        monkeypatch.setattr(simhash, "PENDING", waiting)
        assert 600 - len(simhash.tile_links(group, prints)[0]) == want


def test_components_of_a_chain(spark):
    chain = spark.range(1, 60).selectExpr("id AS a", "id - 1 AS b").unionByName(spark.createDataFrame([(5, 5), (101, 100)], "a long, b long"))
    found = {r["node"]: r["root"] for r in components.connected(chain).collect()}
    assert found == {**{i: 0 for i in range(60)}, 100: 100, 101: 100}
    assert components.connected(chain.limit(0)).count() == 0

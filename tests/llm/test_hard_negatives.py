"""Hard negatives against all products, and the recursive product against exact integers."""

import math
import random

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.llm.helpers import SF
from tickerloom.llm import hard_negatives

SCHEMA = "vec_id long, label int, vector array<long>, is_anchor boolean, rank string, score string"


def brute(table, positives=5, negatives=10, low=30, high=90):
    """table: (vec_id, label, vector, is_anchor), Python integers of any size."""
    rows = [(n, *r) for n, r in enumerate(table) if r[0] is not None and r[1] is not None and r[2] is not None and None not in r[2]]
    product = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, vec_id, label, vector, anchor in rows:
        if not anchor:
            continue
        scored = [(-product(vector, r[3]), r[1], r[0], r[2]) for r in rows if r[0] != n]
        same = sorted(s for s in scored if s[3] == label)[:positives]
        other = sorted(s for s in scored if s[3] != label)
        for goal, positive, *_ in same:
            inside = [s for s in other if low * -goal <= 100 * -s[0] <= high * -goal][:negatives]
            out += [(vec_id, positive, k, s[1], -goal, -s[0]) for k, s in enumerate(inside, 1)]
    return sorted(out)


def found_of(spark, table, **sizes):
    rows = spark.createDataFrame([(*r, "x", "y") for r in table], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hard_negatives.mine(rows, **sizes).collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 65), (70, 130, 33), (127, 65, 200), (64, 64, 64)])
def test_product_is_exact(shape):
    random_ = np.random.default_rng(1)
    m, n, width = shape
    a, b = (random_.integers(-2**29, 2**29, (x, width)) for x in (m, n))
    exact = a.astype(object) @ b.astype(object).T
    assert (hard_negatives.strassen(a, b) == exact).all()


@pytest.mark.parametrize("sizes", [{}, {"block": 3, "stripe": 7}])
def test_ties_copies_and_odd_rows(spark, sizes):
    draw = random.Random(5)
    table = [(i, draw.randrange(4) if i % 3 else 0, [draw.randrange(-3, 9) for _ in range(6)], i % 5 == 0) for i in range(120)]
    table += [(200 + i, i % 2, [2, 2, 2, 2, 2, 2], i == 0) for i in range(40)]  # one common vector
    table += [(300, 1, [5, 4], True), (301, 2, [], True), (302, None, [1], True), (303, 1, None, True), (304, 1, [1, None], True),
              (None, 1, [3, 3], True), (305, 1, [9, 9, 9, 9, 9, 9], None), (306, 77, [1, 1], True)]
    assert found_of(spark, table, **sizes) == brute(table) != []


def test_repeated_rows(spark):
    table = [(5, 1, [3, 1], True), (5, 1, [3, 1], True), (7, 2, [2, 0], False), (7, 2, [2, 0], False)]
    assert found_of(spark, table) == brute(table) != []


def test_empty_and_too_large(spark):
    assert found_of(spark, []) == []
    assert found_of(spark, [(1, 1, [1], True)]) == []
    with pytest.raises(ValueError):
        found_of(spark, [(1, 1, [2**40], True)])


def test_coded(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.001]), (1, [nan]), (2, [inf]), (3, [-inf, 1.0]), (4, [None]), (5, None), (6, [])]
    found = spark.createDataFrame(rows, "id int, e array<float>").select("id", hard_negatives.coded(hard_negatives.F.col("e")).alias("v"))
    assert {r["id"]: r["v"] for r in found.collect()} == {0: [128, -1], 1: None, 2: None, 3: None, 4: None, 5: None, 6: []}


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    table = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"],
              [math.floor(256 * x) for x in r["embedding"]], r["vec_id"] % 100 == 0) for r in rows]
    found = sorted(tuple(r) for r in entry.queries()["op13_hard_negatives"](spark, SF).collect())
    assert found == brute(table)

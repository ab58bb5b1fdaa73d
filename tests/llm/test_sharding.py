"""Shards: the law, slots and groups, against brute force over the whole order."""

import zlib

import numpy as np
import pandas as pd

import __spark_entry__ as entry
from tests.llm.helpers import ODD, SF, clashing, documents, empty
from tickerloom.llm import sharding


def checked(found, shards=40):
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert found.shard.between(0, shards - 1).all()
    return found.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)


def test_query(spark):
    found = entry.queries()["op8_sharding"](spark, SF).toPandas().merge(documents(), on="doc_id")
    data = found.text.map(lambda t: t.encode())
    assert (found["size"] == data.map(len) + 16).all() and (found.text_crc32 == data.map(zlib.crc32)).all()
    assert (found.law == "bytes").all() and found.grown_shard.isna().all()
    sizes = checked(found)
    assert (sizes - sizes.mean()).abs().max() <= found["size"].max()


def test_places_follow_the_order(spark):
    """Whatever the ranges, a record's shard is that of its middle in the order by key and id."""
    found = sharding.sharded(spark.read.parquet(f"{SF}/documents.parquet"), 8)
    keys = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS key").toPandas()
    table = found.toPandas().merge(keys, on="doc_id").sort_values(["key", "doc_id"])
    end, total = table["size"].cumsum(), table["size"].sum()
    begin, width = end - table["size"], table["size"]
    group = table.groupby("key")["size"].transform("sum")
    small = group <= sharding.TOGETHER * total / 8
    middle = np.where(small, begin.groupby(table.key).transform("min") + group / 2, begin + width / 2)
    assert (table.shard == np.minimum(7, np.floor(middle * 8 / total))).all()


def test_a_group_of_copies_is_cut_and_small_groups_are_not(spark):
    many = spark.range(12_000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN repeat('hot ', 40) ELSE concat('text ', cast(id div 6 AS string), repeat(' x', 60)) END AS text")
    found = sharding.sharded(many, 10).toPandas()
    sizes = checked(found, 10)
    assert sizes.max() / sizes.mean() < 1.02 and sizes.min() / sizes.mean() > 0.98
    texts = found[found.doc_id % 3 != 0].groupby("text_crc32").shard.nunique()
    assert (texts == 1).all()
    assert found[found.doc_id % 3 == 0].shard.nunique() >= 3


def test_odd_rows(spark):
    found = sharding.sharded(clashing(spark), 3).toPandas()
    assert len(found) == len(ODD)
    checked(found, 3)
    assert (found[found.doc_id == 2]["size"] == 16).all() and (found[found.doc_id == 2].text_crc32 == 0).all()
    assert sharding.sharded(empty(spark)).count() == 0


def test_sample_follows_size(spark):
    rows = spark.range(3_000).selectExpr("id AS key", "id AS doc_id", "id AS rid", "CASE WHEN id < 1500 THEN 900L ELSE 100L END AS size")
    drawn = sharding._sample(rows, 300, 1_500_000)
    assert 240 < len(drawn) < 360 and 0.8 < pd.Series(drawn < 1500).mean() < 0.97

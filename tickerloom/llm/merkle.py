"""A Merkle manifest of a dataset: a digest tree per group, a tree over the groups, and a proof for every row.

The leaves of a group are ranked in order. The binary digits of a rank are its way through the tree, and they are
grouped away one after the other, the last one first: two nodes that differ in that digit alone become a struct of
their digest and both child structs. All digits of a block of 2^BITS leaves go in one partition, so a tier of the tree
costs one shuffle, and a nested row is never larger than a block. The blocks' digests are the leaves of the next tier.

Proofs come down the same way. The nested row of a block and the path from the block to the root meet in one aggregate;
then the struct is unfolded level by level with ``transform``, each child with its sibling's digest put before the
path, and ``explode`` returns the leaves with whole paths. No node is joined with its sibling or its ancestors.

Ranks are made without a window over a group: rows are dealt out in stored ranges of (group, key), which are cut by a
row number where keys are equal, and one row per range and group tells how many come before.

Defined cases: a missing group is a group of its own and the first one; missing keys stand first in their group; equal
keys stand by digest, so repeated rows have leaves of their own; a missing field is ``-``; an empty table gives an empty
result; columns that are not among the fields don't count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.session import discard, through_table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a block, and rows of a range at most.
BITS, RANGE = 8, 1 << 20
PATH = "array<struct<side:int,h:string>>"


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows run together alike."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(values: Sequence[Column]) -> Column:
    return digest(*[field(value) for value in values])


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, start, lambda h, x: F.sha2(F.when(x["side"] < 0, F.concat(x["h"], h)).otherwise(F.concat(h, x["h"])), 256))


def siblings(path: Column) -> Column:
    """The digests of a path, one after the other."""
    return F.array_join(F.transform(path, lambda x: x["h"]), "")


def ranked(nodes: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``nodes`` with ``rank`` and ``total`` inside ``own``, and the largest total. ``order`` tells all rows apart."""
    spark = nodes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(nodes.count() / RANGE))
    place = F.monotonically_increasing_id()
    dealt = through_table(
        nodes.repartitionByRange(parts, "own", *order).sortWithinPartitions("own", *order)
        .withColumn("place", place).withColumn("part", F.shiftright("place", 33)), "ranges")
    group = Window.partitionBy("own")  # one row per range
    sizes = dealt.groupBy("own", "part").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    sizes = through_table(sizes.select(
        "own", "part", F.sum("rows").over(group).alias("total"),
        (F.sum("rows").over(group.orderBy("part")) - F.col("rows") - F.col("first")).alias("shift"),
    ), "sizes")
    most = sizes.agg(F.max("total")).first()[0] or 0
    return dealt.join(sizes, ["own", "part"]).withColumn("rank", F.col("place") + F.col("shift")).drop("place", "part", "shift"), most


def nested(nodes: DataFrame, bits: int) -> DataFrame:
    """One row (own, total, block, node) per block of 2^bits nodes (own, total, rank, node)."""
    digits = [f"d{k}" for k in range(bits)]
    digit = lambda k: F.pmod(F.shiftright("rank", k), F.lit(2)).cast("int").alias(f"d{k}")
    key = ["own", "total", "block"]
    rows = nodes.select("own", "total", F.shiftright("rank", bits).alias("block"), *[digit(k) for k in range(bits)], "node")
    rows = rows.repartition(*key).sortWithinPartitions(*key, *reversed(digits))
    for k in range(bits):
        child = lambda d: F.first(F.when(F.col(f"d{k}") == d, F.col("node")), ignorenulls=True)  # noqa: B023, E731
        rows = rows.groupBy(*key, *reversed(digits[k + 1:])).agg(child(0).alias("left"), child(1).alias("right"))
        # a group that is one node at this level is done
        h = F.when(F.col("total") > 1 << k, digest(F.col("left.h"), F.coalesce("right.h", F.lit("")))).otherwise(F.col("left.h"))
        rows = rows.select(*key, *reversed(digits[k + 1:]), F.struct(h.alias("h"), "left", "right").alias("node"))
    return rows


def tiers(nodes: DataFrame, most: int, bits: int) -> list[DataFrame]:
    """The stored blocks of every tier of the trees of (own, total, rank, node), the lowest first."""
    made = [through_table(nested(nodes, bits), "tier")]
    while most > 1 << bits:
        most = -(-most >> bits)
        below = made[-1].select(
            "own", F.shiftright(F.col("total") + ((1 << bits) - 1), bits).alias("total"), F.col("block").alias("rank"),
            F.struct(F.col("node.h").alias("h"), F.col("block").alias("rank")).alias("node"))
        made.append(through_table(nested(below, bits), "tier"))
    return made


def unfolded(blocks: DataFrame, bits: int) -> DataFrame:
    """The leaf structs of blocks (node, total, path and others), each with its own ``path``."""
    def children(level: int):
        def of(way: Column) -> Column:
            left, right = way["node"]["left"], way["node"]["right"]

            def one(node: Column, side: int, sibling: Column) -> Column:
                met = F.struct(F.when(sibling.isNull(), F.lit(0)).otherwise(F.lit(side)).alias("side"),
                               F.coalesce(sibling["h"], F.lit("")).alias("h"))
                path = F.when(F.col("total") > 1 << level, F.concat(F.array(met), way["path"])).otherwise(way["path"])
                return F.struct(node.alias("node"), path.alias("path"))

            return F.filter(F.array(one(left, 1, right), one(right, -1, left)), lambda x: x["node"].isNotNull())

        return of

    ways = F.array(F.struct(F.col("node"), F.col("path")))
    for level in reversed(range(bits)):
        ways = F.flatten(F.transform(ways, children(level)))
    rest = [name for name in blocks.columns if name not in ("node", "path", "total", "block")]
    return blocks.select(*rest, F.explode(ways).alias("way")).select(*rest, "way.node", "way.path")


def proofs(made: list[DataFrame], tops: DataFrame, bits: int) -> DataFrame:
    """(own, node, path, subroot, root) of every leaf. ``tops``: own, path of its subroot, subroot, root."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(made):
        # a block and what lies above it: two rows of one key, brought together by an aggregate
        kind = tier.schema["node"].dataType
        both = tier.select("own", "block", "total", "node", *[F.lit(None).cast(t).alias(n) for n, t in (("path", PATH), ("subroot", "string"), ("root", "string"))])
        both = both.unionByName(above.select("own", "block", F.lit(None).cast("long").alias("total"), F.lit(None).cast(kind).alias("node"), "path", "subroot", "root"))
        met = both.groupBy("own", "block").agg(*[F.first(n, ignorenulls=True).alias(n) for n in ("total", "node", "path", "subroot", "root")])
        rows = unfolded(met, bits)
        if tier is not made[0]:
            above = rows.select("own", F.col("node.rank").alias("block"), "path", "subroot", "root")
    return rows


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", fields: Sequence[str] = FIELDS, bits: int = BITS,
             other: Column | None = None) -> DataFrame:
    """Every row's key, leaf, subroot, root, path and ``other``, a digest that is carried along.

    ``path`` holds the siblings from the leaf to the root, with their side: -1 left, 1 right, 0 none. ``folded`` turns a
    leaf and a path into a root.
    """
    own = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col(group).cast("string")))
    made = leaf([F.col(name) for name in fields])
    other = F.lit(None).cast("string") if other is None else F.when(other != made, other)
    leaves = through_table(docs.select(
        own.alias("own"), F.col(key).alias("key"), made.alias("h"), other.alias("other"), F.monotonically_increasing_id().alias("rid"),
    ), "leaves")
    rows, most = ranked(leaves, "key", "h", "rid")
    low = tiers(rows.select("own", "total", "rank", F.struct("h", "key", "other").alias("node")), most, bits)
    subroots = through_table(low[-1].select(F.lit("").alias("own"), F.col("own").alias("name"), F.col("node.h").alias("h")), "subroots")
    heads, groups = ranked(subroots, "name")
    high = tiers(heads.select("own", "total", "rank", F.struct("h", "name").alias("node")), groups, bits)
    top = high[-1].select("own", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"), F.col("node.h").alias("root"))
    tops = proofs(high, top, bits).select(F.col("node.name").alias("own"), "path", F.col("node.h").alias("subroot"), "root")
    found = proofs(low, tops, bits).select(
        F.col("node.key").alias(key), F.col("node.h").alias("leaf"), "subroot", "root", "path", F.coalesce("node.other", "node.h").alias("other"))
    discard(leaves)
    return found


def checked(docs: DataFrame, tampered: Column, bits: int = BITS) -> DataFrame:
    """The manifest with ``folded_root`` of the leaves made of ``tampered`` (a number of characters) and whether it holds."""
    other = leaf([tampered if name == "n_chars" else F.col(name) for name in FIELDS])
    found = manifest(docs, other=other, bits=bits)
    return found.withColumn("folded_root", folded(F.col("other"), F.col("path"))).withColumn(
        "verified", F.col("folded_root") == F.col("root"))

"""Exact duplicates through an extendible-hash index on shared files, in DataFrame operations only.

Texts are equal when they are identical after their ASCII white space is deleted. The index has three tables in the
shared folder:

``records``    every row with the 64-bit hash of its text; the hash is the key.
``directory``  slots of the leading ``depth`` bits of a key, each naming the bucket that owns this key range.
``pages``      what the buckets hold of keys that occur more than once: one row per distinct text, in the bucket that
               owns its key; a key whose texts differ has a chain of several rows.

The directory doubles until no bucket holds more than ``capacity`` distinct keys. Every step goes through it: a key is
sent to the task that owns its bucket, which walks the bucket in the order of key and text and compares the bytes of
neighbours, so a run of equal ones is one link of the chain; and a row finds its link by bucket and key, and by digest
where the chain has several. A key that occurs once has no chain and its text is not sent anywhere.

Copies share their key, so a group of any size is one key and never overfills a bucket. Before it reaches its owner it
is counted per text in ``PARTS`` parts with partial aggregation: of a group that holds a third of all rows each task
sends one row per part, and the owner gets ``PARTS`` rows. Looking up is a join of two stored tables, whose large
partitions Spark splits; tables are broadcast only where their size allows.

Defined cases: a missing text is empty; empty texts and texts of white space only are one group; a missing id loses
every tie and is returned as missing; of rows equal in text length and id exactly one stays; an empty table gives an
empty result; extra columns, whatever their names, are kept apart in a struct and returned unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import numbered, original, whole_text
from tickerloom.session import through_table

BLANKS = " \t\n\x0b\x0c\r"
#: Distinct keys in a bucket before it splits, and parts in which copies are counted before they reach their bucket.
CAPACITY, PARTS = 16_384, 8


def without_blanks(text: Column) -> Column:
    """The text without its ASCII white space. Replacing one character at a time is the fastest way in the JVM."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def slot(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def grow_directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """The stored directory (slot, bucket, local_depth) of distinct ``key`` values, and its global depth.

    Starts at the depth that even hashing needs and doubles while a bucket is overfull; a bucket that fits keeps its
    local depth, and its slots share it. ``bucket`` is the first slot of the bucket at its local depth.
    """
    total = keys.count()
    depth = max(0, math.ceil(math.log2(max(1, total) / capacity)))
    leaves, inside = [], keys.select("key")
    while True:
        filled = through_table(inside.groupBy(slot(F.col("key"), depth).alias("bucket")).count(), "buckets")
        leaves.append((depth, filled.where(F.col("count") <= capacity).select("bucket")))
        overfull = filled.where(F.col("count") > capacity).select("bucket")
        if depth == 64 or overfull.isEmpty():
            break
        inside = inside.join(overfull, slot(F.col("key"), depth) == F.col("bucket"), "left_semi")
        depth += 1
    slots = None
    for local, leaf in leaves:
        span = 1 << (depth - local)
        part = leaf.select(
            F.explode(F.sequence(F.col("bucket") * span, F.col("bucket") * span + (span - 1))).alias("slot"),
            "bucket", F.lit(local).alias("local_depth"),
        )
        slots = part if slots is None else slots.unionByName(part)
    return through_table(slots, "directory"), depth


def placed(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """``rows`` with the ``bucket`` that the directory has for their key."""
    return rows.join(directory.select("slot", "bucket", "local_depth"), slot(F.col("key"), depth) == F.col("slot"), "left").drop("slot")


def chains(sent: DataFrame) -> DataFrame:
    """What the owner of each bucket makes of the counted copies (bucket, local_depth, key, bare, sha, n, best) it gets."""
    owned = sent.repartition("bucket", "local_depth")
    walk = Window.partitionBy("bucket", "local_depth").orderBy("key", "bare")
    same = (F.col("key") == F.lag("key").over(walk)) & (F.col("bare") == F.lag("bare").over(walk))
    links = owned.select("bucket", "local_depth", "key", "sha", "n", "best", "bare", F.coalesce(same, F.lit(False)).alias("same"))
    link = F.sum(F.when(F.col("same"), 0).otherwise(1)).over(walk.rowsBetween(Window.unboundedPreceding, 0))
    return links.select("bucket", "local_depth", "key", "sha", "n", "best", link.alias("link")).groupBy(
        "bucket", "local_depth", "key", "link").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"), F.first("sha").alias("sha"))


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame, int, DataFrame]:
    """``records``, ``directory``, its depth and ``pages`` of the rows of ``docs`` (columns doc_id, text and any others)."""
    bare = without_blanks(whole_text())
    records = numbered(
        docs, "records",
        key=F.xxhash64(bare), chars=F.length(whole_text()), sha=F.sha2(bare, 256), doc_id=F.col("doc_id"),
    )
    keys = through_table(records.groupBy("key").agg(F.count("*").alias("rows")), "keys")
    directory, depth = grow_directory(keys, capacity)
    repeated = through_table(placed(keys.where("rows > 1").select("key"), directory, depth), "repeated")

    best = F.struct(
        (-F.col("chars")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("rid"),
    )
    copies = records.select(
        "key", "sha", best.alias("best"), F.pmod("rid", F.lit(PARTS)).alias("part"),
        without_blanks(F.coalesce("row.text", F.lit(""))).alias("bare"),
    ).join(repeated, "key")
    sent = copies.groupBy("bucket", "local_depth", "key", "bare", "part").agg(
        F.count("*").alias("n"), F.min("best").alias("best"), F.first("sha").alias("sha"))
    pages = through_table(chains(sent).select(
        "bucket", "local_depth", "key", "sha", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid"),
    ).sortWithinPartitions("bucket", "key", "sha"), "pages")
    return records, directory, depth, pages


def _looked_up(records: DataFrame, directory: DataFrame, depth: int, pages: DataFrame) -> DataFrame:
    """Every record with the page of its text, found by bucket, key and digest; none where the key occurs once."""
    return placed(records, directory, depth).join(pages, ["bucket", "local_depth", "key", "sha"], "left").withColumn(
        "kept", F.coalesce(F.col("rid") == F.col("keep_rid"), F.lit(True)),
    )


def decisions(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """For every row: doc_id, keep_id, group_size, kept and text_sha256 of the text without white space."""
    records, directory, depth, pages = build_index(docs.select("doc_id", "text"), capacity)
    return _looked_up(records.select("rid", "key", "sha", "doc_id"), directory, depth, pages).select(
        "doc_id",
        F.when(F.col("keep_rid").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        "kept", F.col("sha").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows that stay, with the columns of ``docs``: of equal texts the longest one, then the smallest id.

    Only the row numbers that go are joined, not the pages.
    """
    records, directory, depth, pages = build_index(docs, capacity)
    gone = through_table(
        _looked_up(records.select("rid", "key", "sha"), directory, depth, pages).where(~F.col("kept")).select("rid"), "gone",
    )
    return original(records.join(gone, "rid", "left_anti"))

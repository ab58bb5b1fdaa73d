"""Shards of near-equal bytes by sampled splitters.

Records are ordered by the hash of their text, then id. Keys are sampled with a chance that grows with size; quantiles
of the sample are the splitters of many small ranges. Ranges that turn out overfull are subdivided: by a further sample
inside them or, where one text alone (a group of copies) fills them, by a hash of the rows. Sizes of the ranges give
the place of each range in the whole order, a window inside a range the place of each record, and the place its shard.
No task holds more than one range; what the driver sees is the sample and one row per range.

Copies of a text stay in one shard while they are less than ``TOGETHER`` of a shard; a larger group may be cut.
The number of ranges is a multiple of the shards and grows with the rows, so a range keeps its size at any scale.

Law: `bytes`. The order has a total, so shards differ by about the size of the largest record or small group.

Defined cases: a missing text has no bytes (size 16); a missing id comes after the others; repeated rows have places of
their own; a record larger than a shard fills it, and shards may stay empty; an empty table gives an empty result;
extra columns are no input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import whole_text
from tickerloom.session import through_table

SHARDS, OVERHEAD = 40, 16
#: Ranges per shard, rows per range at most on average, samples per range, and when a range is overfull.
RANGES, ROWS, SAMPLES, OVERFULL = 16, 1_000_000, 16, 2.0
#: The share of a shard up to which copies stay together.
TOGETHER = 0.005
#: Rounds of subdividing by further samples; ranges of one text need none.
ROUNDS = 8


def _sample(rows: DataFrame, n: int, total: int) -> np.ndarray:
    """Keys of about ``n`` rows, each drawn with a chance of ``n`` times its share of the ``total`` bytes.

    Every row is drawn for itself, so tasks return nothing but the sample.
    """
    draw = F.pmod(F.xxhash64("key", "doc_id", "rid", F.lit(3)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return np.sort(np.array([r["key"] for r in rows.where(draw < F.col("size") * (n / total)).select("key").collect()], np.int64))


def _splitters(sample: np.ndarray, ranges: int) -> np.ndarray:
    """First keys of all ranges but the first. A key that several quantiles hit has a range to itself."""
    if not len(sample):
        return sample
    picked = sample[np.arange(1, ranges) * len(sample) // ranges]
    values, hits = np.unique(picked, return_counts=True)
    alone = values[hits > 1]
    return np.unique(np.concatenate((values, alone[alone < np.iinfo(np.int64).max] + 1)))


def _ranged(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(splitters)  # a few per million rows

    @F.arrow_udf("int")
    def range_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for keys in batches:
            yield pa.array(np.searchsorted(shared.value, keys.to_numpy(zero_copy_only=False), "right").astype(np.int32))

    return rows.withColumn("range", range_of("key"))


def _sizes(rows: DataFrame, *names: str) -> list:
    return rows.groupBy(*names).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"),
    ).collect()


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """For every row of ``docs``: doc_id, size, text_crc32, law, shard, slot and grown_shard (none under this law)."""
    spark, text = docs.sparkSession, whole_text()
    light = through_table(
        docs.select(
            F.col("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"),
        ).withColumn("rid", F.monotonically_increasing_id()),
        "sizes",
    )
    whole = light.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    total = max(1, whole["bytes"])
    ranges = max(shards * RANGES, -(-whole["rows"] // ROWS))
    fair = total / ranges
    splitters = _splitters(_sample(light, SAMPLES * ranges, total), ranges)
    for _ in range(ROUNDS):
        sizes = {r["range"]: r for r in _sizes(_ranged(light, splitters), "range")}
        overfull = [k for k, r in sizes.items() if r["bytes"] > OVERFULL * fair and r["low"] < r["high"]]
        if not overfull:
            break
        inside = _ranged(light, splitters).join(
            F.broadcast(spark.createDataFrame([(k,) for k in overfull], "range int")), "range", "left_semi")
        held = sum(sizes[k]["bytes"] for k in overfull)
        parts = int(held / fair) + 2 * len(overfull)
        new = np.union1d(splitters, _splitters(_sample(inside, SAMPLES * parts, held), parts))
        # Where no further splitter falls inside, one text outweighs the rest of its range: cut right around the largest.
        if len(new) == len(splitters):
            heavy = inside.groupBy("range", "key").agg(F.sum("size").alias("bytes")).groupBy("range").agg(
                F.max_by("key", "bytes").alias("key")).collect()
            keys = np.array([r["key"] for r in heavy], np.int64)
            new = np.union1d(splitters, np.concatenate((keys, keys[keys < np.iinfo(np.int64).max] + 1)))
            if len(new) == len(splitters):
                break
        splitters = new
    ranged = _ranged(light, splitters)
    parts = [(r["range"], max(1, round(r["bytes"] / fair)) if r["low"] == r["high"] else 1) for r in _sizes(ranged, "range")]
    many = spark.createDataFrame([p for p in parts if p[1] > 1], "range int, parts int")
    cells = ranged.join(F.broadcast(many), "range", "left").withColumn(
        "part", F.when(F.col("parts").isNull(), F.lit(0))
        .otherwise(F.pmod(F.xxhash64("doc_id", "rid"), F.col("parts"))).cast("int"),
    )
    placed, bytes_before, rows_before = [], 0, 0
    for r in sorted(_sizes(cells, "range", "part"), key=lambda r: (r["range"], r["part"])):
        placed.append((r["range"], r["part"], bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + r["bytes"], rows_before + r["rows"]
    starts = spark.createDataFrame(placed, "range int, part int, bytes_before long, rows_before long")

    cell = Window.partitionBy("range", "part")
    ordered = cell.orderBy("key", F.col("doc_id").asc_nulls_last(), "rid")
    group = Window.partitionBy("range", "part", "key")
    begin = F.col("bytes_before") + F.col("until") - F.col("size")
    middle = F.when(F.col("group_bytes") <= TOGETHER * total / shards, F.col("group_begin") + F.col("group_bytes") / 2) \
        .otherwise(F.col("begin") + F.col("size") / 2)
    assigned = through_table(
        cells.join(F.broadcast(starts), ["range", "part"])
        .withColumn("until", F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("place", F.col("rows_before") + F.row_number().over(ordered) - 1)
        .withColumn("begin", begin)
        .withColumn("group_bytes", F.sum("size").over(group)).withColumn("group_begin", F.min("begin").over(group))
        .select(
            "doc_id", "size", "text_crc32", "place",
            F.least(F.floor(middle * shards / total), F.lit(shards - 1)).cast("int").alias("shard"),
        ),
        "assigned",
    )
    firsts = assigned.groupBy("shard").agg(F.min("place").alias("first"))  # one row per shard
    return assigned.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

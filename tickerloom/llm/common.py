"""Helpers that several operators share: row numbers, stored tables and bounded labelled samples."""

from __future__ import annotations

import uuid
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.session import shared_folder, through_table

#: Folds of labelled rows; fold 0 is held out and never learnt from.
FOLDS = 5


#: One labelled text may take up to one such part of the bytes of a sample.
TEXT_SHARE = 4

#: Bytes of texts that one Arrow batch may hold, and rows. Two workers of an executor hold a few batches each.
BATCH_BYTES, BATCH_ROWS = 4_000_000, 1_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch limits to the ones above; texts may be very long. Limits below them stay."""
    for key, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def text_udf(kind: str):
    """An Arrow function over columns that hold whole texts: small batches, whose memory goes back after each."""
    small_batches(SparkSession.active())

    def made(function):
        @wraps(function)
        def released(batches):
            for out in function(batches):
                yield out
                pa.default_memory_pool().release_unused()

        return F.arrow_udf(kind)(released)

    return made


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; a missing one is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """Whether a row belongs to the held-out fold; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def numbered(df: DataFrame, purpose: str, **columns: Column) -> DataFrame:
    """A stored table of ``rid`` (a number per row), ``row`` (all columns of ``df``) and ``columns``.

    The original columns live inside one struct, so no name of theirs can clash with a working column, and repeated
    rows and missing ids stay apart. Written once: later jobs read the same numbers whatever executor is lost.
    """
    whole = F.struct(*[F.col(f"`{name}`") for name in df.columns])
    return through_table(
        df.select(whole.alias("row"), *[value.alias(name) for name, value in columns.items()])
        .withColumn("rid", F.monotonically_increasing_id()),
        purpose,
    )


#: A row number holds the number of the task that made it above this bit.
TASK_BITS = 33


def kept_in_place(df: DataFrame, purpose: str, **columns: Column) -> DataFrame:
    """``numbered``, in a table that is bucketed by the task that wrote a row (``task``), for ``picked``.

    Every task writes its rows where they are: a task's rows are one bucket. The table's name goes again at once; what is
    read was resolved before, and its files go with the application's folder.
    """
    spark = df.sparkSession
    whole = F.struct(*[F.col(f"`{name}`") for name in df.columns])
    rows = df.select(whole.alias("row"), *[value.alias(name) for name, value in columns.items()]).withColumn(
        "rid", F.monotonically_increasing_id()).withColumn("task", F.shiftright("rid", TASK_BITS))
    name = f"{purpose}_{uuid.uuid4().hex}".replace("-", "_")
    rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "task").option(
        "path", shared_folder(spark, purpose)).format("parquet").saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def picked(rows: DataFrame, rids: DataFrame, keep: bool = True) -> DataFrame:
    """The rows of a table ``kept_in_place`` whose ``rid`` is in ``rids`` (distinct), or is not: no row leaves its bucket.

    Only the wanted numbers are shuffled, as one list per task that wrote rows, and hashed by the task.
    """
    lists = rids.groupBy(F.shiftright("rid", TASK_BITS).alias("task")).agg(F.collect_list("rid").alias("_wanted"))
    met = rows.join(lists.hint("shuffle_hash"), "task", "inner" if keep else "left")
    here = F.array_contains("_wanted", F.col("rid"))
    return met.where(here if keep else ~F.coalesce(here, F.lit(False))).drop("_wanted")


def clustered(df: DataFrame, key: str, purpose: str) -> DataFrame:
    """``df`` stored in buckets of ``key``: joins on it move the other side only."""
    spark = df.sparkSession
    name = f"{purpose}_{uuid.uuid4().hex}".replace("-", "_")
    df.repartition(key).write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option(
        "path", shared_folder(spark, purpose)).format("parquet").saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def original(df: DataFrame) -> DataFrame:
    """The columns inside ``row`` again."""
    return df.select("row.*")


def thinned(rows: DataFrame, hashed: Column, n: int) -> DataFrame:
    """About ``n`` of the rows, all if there are no more: those whose hash lies below a bound.

    The bound follows from a count, so no task returns rows that don't belong to the sample.
    """
    total = rows.count()
    return rows if total <= n else rows.where(F.pmod(hashed, F.lit(1 << 40)) < int(n / total * (1 << 40)))


def known_labels(docs: DataFrame, labels: DataFrame, label: str, rows: int, seed: int) -> DataFrame:
    """(doc_id, label) of about ``rows`` texts of ``docs`` with a label outside the held-out fold; the largest of several."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max(label).alias("label"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    return thinned(known, F.xxhash64("doc_id", F.lit(seed)), rows)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, megabytes: int, seed: int = 11,
) -> list[tuple[str, object]]:
    """At most ``rows`` labelled texts of together at most ``megabytes``, outside the held-out fold, for fitting.

    Rows are chosen by a hash of their id, so the sample is the same on every run. ``label`` is a column of ``labels``;
    of several labels of one id the largest counts, of several texts the smallest. A text that alone is larger than a
    ``TEXT_SHARE``-th of the bound, or than what is left of it, is passed over; those after it still count. Only ids, sizes and then the chosen
    texts reach the driver, all within the two bounds.
    """
    order = F.xxhash64("doc_id", F.lit(seed + 1))
    texts = docs.select("doc_id", whole_text().alias("text"))
    # what is broadcast has about `rows` rows
    sized = (
        texts.join(F.broadcast(known_labels(docs, labels, label, rows, seed)), "doc_id")
        .groupBy("doc_id").agg(F.min(F.octet_length("text")).alias("size"), F.first("label").alias("label"))
        .select("doc_id", "size", "label", order.alias("order")).collect()
    )
    left, most, keep = megabytes * 1_000_000, megabytes * 1_000_000 // TEXT_SHARE, {}
    for row in sorted(sized, key=lambda r: (r["order"], r["doc_id"]))[:rows]:
        if row["size"] > min(left, most):
            continue
        left -= row["size"]
        keep[row["doc_id"]] = row["label"]
    if not keep:
        return []
    wanted = docs.sparkSession.createDataFrame([(k,) for k in keep], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}")
    found = (
        texts.join(F.broadcast(wanted), "doc_id")
        .groupBy("doc_id").agg(F.min(F.struct(F.octet_length("text").alias("size"), "text"))["text"].alias("text"))
        .collect()
    )
    found.sort(key=lambda row: row["doc_id"])
    return [(row["text"], keep[row["doc_id"]]) for row in found]

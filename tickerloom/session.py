"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import math
import re
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

#: Tables that lie together by ticker are joined on (ticker, date) as they lie: a ticker's rows are bounded by the calendar.
WHOLE_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    WHOLE_KEYS: "false",
}


def get_session(app_name: str = "tickerloom", **extra: str) -> SparkSession:
    """A session with the settings the operators expect; master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Bytes of files that one task reads; of shuffled rows that one task gets when Spark joins small partitions; and of the
#: input per partition that a shuffle is made of, before any are joined.
READ_BYTES, JOINED_BYTES, INPUT_BYTES = 8 << 20, 4 << 20, 4 << 20


def _bytes(setting: str) -> int:
    """``134217728b``, ``64MB`` or ``1g`` in bytes."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def small_tasks(spark: SparkSession, path: str) -> None:
    """Lower the session's limits so that the memory of a task on the table at ``path`` doesn't grow with the table.

    Few columns of a bar pack well: 64 MB of a shuffle, Spark's own limit, are over a gigabyte in a sort. Lower limits and
    larger numbers of partitions stay.
    """
    for key, most in (("spark.sql.files.maxPartitionBytes", READ_BYTES),
                      ("spark.sql.adaptive.advisoryPartitionSizeInBytes", JOINED_BYTES)):
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    size = where.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    key, wanted = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", math.ceil(size / INPUT_BYTES)
    if wanted > int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(key, str(wanted))


def join_as_they_lie(spark: SparkSession) -> None:
    """``get_session``'s setting of joins, for sessions that were made otherwise."""
    spark.conf.set(WHOLE_KEYS, "false")


_MADE: set[str] = set()


def _delete(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete what this application wrote; the context or its JVM may be gone already."""
    try:
        _delete(spark, folder)
    except (AttributeError, ConnectionError, Py4JError):
        pass


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach; what an application wrote is deleted when it ends.

    It lies below ``spark.checkpoint.dir``. Where that is unset, a folder in the warehouse takes its place; on a cluster
    that must not be a folder of one machine, so a ``file:`` warehouse is an error there. Spark's own checkpoints go there,
    too.
    """
    context, warehouse = spark.sparkContext, spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local") and warehouse.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = f"{warehouse}/_work"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    mine = f"{root.rstrip('/')}/{context.applicationId}"
    if mine not in _MADE:
        _MADE.add(mine)
        atexit.register(_remove, spark, mine)
    return f"{mine}/{purpose}-{uuid.uuid4().hex}"


def through_table(df, purpose: str):
    """Write ``df`` once to the shared folder and read it back; this runs a job while a plan is built.

    Used where several later jobs read the same result; unlike a cached frame the table
    survives the loss of any executor.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables) -> None:
    """Delete stored tables that no later job reads: everything made of them is stored itself."""
    for table in tables:
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            _delete(table.sparkSession, folder)

"""Compare registered queries with their SQL: python tests/check_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def key(row):
    return tuple((v is None, type(v).__name__, v if v is not None else 0) for v in row)


def compare(spark_df, con, sql):
    """None when equal, else what differs."""
    names = sorted(spark_df.columns)
    found = spark_df.select(*[f"`{n}`" for n in names]).collect()
    result = con.execute(sql)
    theirs = [d[0] for d in result.description]
    if sorted(theirs) != names:
        return f"columns {names} != {sorted(theirs)}"
    order = [theirs.index(n) for n in names]
    left = sorted((tuple(plain(v) for v in r) for r in found), key=key)
    right = sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=key)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        a, b = different[0]
        columns = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(different)} of {len(left)} rows differ, first in {columns[:4]}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "10g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    con, oracle, bad = connect(sf_dir), e.oracle_sql(), []
    for name, run in e.queries().items():
        if (wanted and name not in wanted) or name not in oracle:
            continue
        begin = time.time()
        try:
            problem = compare(run(spark, sf_dir), con, oracle[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += [name] if problem else []
        print(f"{'DIFF' if problem else 'ok':4s} {name:30s} {time.time() - begin:6.1f}s {problem or ''}", flush=True)
    print("not matching:", bad)


if __name__ == "__main__":
    main()

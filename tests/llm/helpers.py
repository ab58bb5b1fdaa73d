"""Small tables with odd rows, shared by the tests of the operators."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd

SF = "/root/testdata/sf0.001"

#: A null text, empty and blank texts, a null id, a repeated row, ties, a long text, combining and astral characters.
ODD = [
    (1, "One two three four five. Six seven eight nine ten!\nOne two three four five.", "en", "a", 5),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, " \t\n\x0b\x0c\r", "fr", None, 6),
    (None, "One two three four five. Six seven eight nine ten!\nOne two three four five.", "en", "a", 5),
    (5, "one  two three four five. six seven eight nine ten!\none two three four five.", "en", "b", 5),
    (6, "Café Café ẛ̣ ΣΑΣ İstanbul \U0001f600\U0001f600 it's <|endoftext|> x", "tr", "b", 1),
    (6, "Café Café ẛ̣ ΣΑΣ İstanbul \U0001f600\U0001f600 it's <|endoftext|> x", "tr", "b", 1),
    (7, "word " * 30_000, "en", "a", 1),
    (8, "x", "en", "a", 1),
    (9, "a b c\x1cd\x85e", "en", "a", 1),
    (10, "onetwothreefourfive.Sixseveneightnineten!Onetwothreefourfive.", "en", "a", 1),
    (11, "One two three four five. Six seven eight nine ten!One two three four five. ", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd(spark, rows=ODD):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clashing(spark):
    """The odd rows with extra columns that have the names of working columns."""
    from pyspark.sql import functions as F

    extra = ("rid", "row", "key", "fp", "score", "ids", "root", "kept", "bucket", "tokens", "shard", "cell", "spans")
    return odd(spark).select("*", *[F.lit("extra").alias(name) for name in extra])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(sf=SF) -> pd.DataFrame:
    found = pd.read_parquet(f"{sf}/documents.parquet")
    found["text"] = found["text"].fillna("")
    return found


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def area(score, label) -> float:
    """Area under the ROC curve."""
    score, label = np.asarray(score, float), np.asarray(label, int)
    _, place, size = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(size) - (size - 1) / 2)[place]
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)

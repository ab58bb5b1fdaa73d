"""License notices by diagonal voting, in DataFrame operations only.

A notice is a sequence of words. Every two words in a row of every text are hashed and joined with the hashes of all
places of all notices, and the words are compared, so a vote is a pair of equal word pairs. A vote at word p of a text
and word t of a notice lies on the diagonal p - t, where the notice would start. The votes of a diagonal are one number
with a bit per place of the notice; diagonals that lie up to ``GAP`` words after each other are merged, as words may
have been put in or left out. A notice stands where the merged votes hold at least ``SHARE`` of its word pairs; a base
phrase stands only where its own diagonal holds all of them, that is, where its words stand consecutively.

The notices are constants, about 200 word pairs, and are broadcast. Of the texts only what has a vote is shuffled, after
it has been counted per text, notice and diagonal, besides one row per text: the place before its first word votes for
nothing and carries the number of words, so that a text without any vote is returned as well. A text is not collected
anywhere, however many votes it has.

Defined cases: a missing text is empty and has no words; A to Z are lower-cased, other letters stay as they are for all
notices (which have none); repeated rows and missing ids stay rows of their own; a place counts once per phrase, also
where places overlap; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import whole_text

# The base phrases with their labels, then notices of public licenses.
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
NOTICES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("no-copies", "no part of this publication may be reproduced stored or transmitted in any form without the prior written "
                  "permission of the publisher"),
    ("no-warranty", "the software is provided as is without warranty of any kind express or implied"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
)
#: Diagonals that are merged lie at most so many words after the first; share of word pairs that a notice needs.
GAP, SHARE = 3, 0.75
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Number of the votes that stand for a text itself.
TEXT = -1


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case.

    ``lower`` turns two other characters into ASCII letters: these are replaced by letters that it leaves alone first.
    """
    plain = F.replace(F.replace(text, F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ĸ"))
    return F.filter(F.split(F.lower(plain), NOT_WORD), lambda w: w != "")


def pairs(found: Column) -> Column:
    """(first, second) of every two words in a row; before them one of no word and the first, behind them the last and none."""
    return F.arrays_zip(F.concat(F.array(F.lit(None).cast("string")), found).alias("first"), found.alias("second"))


def _key(place: Column, first: Column, second: Column) -> Column:
    return F.when(place == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(first, second))


def places(spark: SparkSession) -> DataFrame:
    """(notice, t, key, first, second) of all word pairs of all notices, and the one that stands for texts."""
    listed = F.array(*[
        F.struct(F.lit(n).alias("notice"), F.lit(phrase).alias("phrase")) for n, (_, phrase) in enumerate((*BASE, *NOTICES))
    ])
    each = spark.range(1).select(F.inline(listed)).select("notice", F.split("phrase", " ").alias("words"))
    grams = each.select("notice", F.posexplode(pairs(F.col("words"))).alias("place", "pair")).select(
        "notice", (F.col("place") - 1).alias("t"), _key(F.col("place"), F.col("pair.first"), F.col("pair.second")).alias("key"),
        F.col("pair.first").alias("first"), F.col("pair.second").alias("second"))
    text = spark.range(1).select(
        F.lit(TEXT).alias("notice"), F.lit(-1).alias("t"), F.lit(0).cast("long").alias("key"),
        F.lit(None).cast("string").alias("first"), F.lit(None).cast("string").alias("second"))
    return grams.where("first IS NOT NULL AND second IS NOT NULL").unionByName(text)


def votes(docs: DataFrame, text: str = "text", carried: str = "doc_id") -> DataFrame:
    """(rid, notice, start, votes) of every diagonal with a vote, and one row per text with its number of words and id."""
    each = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(carried).alias("carried"), words(whole_text(text)).alias("words"))
    grams = each.select("rid", "carried", F.size("words").cast("long").alias("n_words"), F.posexplode(pairs(F.col("words"))).alias("place", "pair"))
    grams = grams.select(
        "rid", "carried", "n_words", "place", F.col("pair.first").alias("a"), F.col("pair.second").alias("b")
    ).withColumn("key", _key(F.col("place"), F.col("a"), F.col("b")))
    met = grams.join(F.broadcast(places(docs.sparkSession)), "key")  # constants
    itself = F.col("notice") == TEXT
    met = met.where((itself & (F.col("place") == 0)) | (~itself & (F.col("a") == F.col("first")) & (F.col("b") == F.col("second"))))
    start = (F.col("place") - 1 - F.col("t")).cast("long")
    bit = F.when(itself, F.lit(0).cast("long")).otherwise(F.expr("shiftleft(CAST(1 AS BIGINT), t)"))
    return met.groupBy("rid", "notice", start.alias("start")).agg(
        F.bit_or(bit).alias("votes"), F.first("n_words").alias("n_words"), F.first("carried").alias("carried"))


def spans(found: DataFrame) -> DataFrame:
    """``votes`` with ``merged`` votes, the share of the notice they hold, its label and whether it stands there."""
    listed = (*BASE, *NOTICES)
    about = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(len(phrase.split()) - 1).alias("pairs")) for label, phrase in listed])
    near = Window.partitionBy("rid", "notice").orderBy("start").rangeBetween(0, GAP)
    base = F.col("notice") < len(BASE)
    known = F.when(F.col("notice") != TEXT, F.get(about, F.col("notice")))
    made = found.withColumn("merged", F.when(base, F.col("votes")).otherwise(F.bit_or("votes").over(near)))
    made = made.withColumn("share", F.bit_count("merged") / known["pairs"]).withColumn("label", known["label"])
    return made.withColumn("base", base & (F.col("notice") != TEXT)).withColumn(
        "stands", F.coalesce(F.col("share") >= F.when(base, F.lit(1.0)).otherwise(F.lit(SHARE)), F.lit(False)))


def scanned(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, base places and labels, all labels and the largest share of a notice."""
    found = spans(votes(docs))
    base = F.col("stands") & F.col("base")

    def listed(which: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")

    return found.groupBy("rid").agg(
        F.first("carried").alias("doc_id"), F.max("n_words").alias("n_words"), F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"), F.max(F.when(base, F.col("start"))).alias("last_word"),
        listed(base).alias("base_labels"), listed(F.col("stands")).alias("labels"),
        F.max(F.when(F.col("stands"), F.col("share")).otherwise(F.lit(0.0))).alias("score"),
    ).drop("rid")

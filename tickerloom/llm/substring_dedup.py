"""Passages that texts share, by sliding spans of sentences.

A text is parted into sentences at sentence marks and line ends; a sentence of over ``LONG`` words is parted further
after the last word with the smallest checksum of every ``NEAR`` words in a row, so that the same words are parted alike
wherever they stand and no part has more than ``NEAR`` words. Of the runs of at least ``RUN`` sentences with at least
``WORDS`` words, the shortest that begins and the shortest that ends at every sentence are spans; any run that repeats
is covered by spans that repeat, its first and its last sentence, too. Spans are equal when their
words are (A-Z in lower case), whatever blanks stand between. All spans of all texts are grouped by hash; the first
occurrence (by id, then position) stays, and every sentence that another occurrence covers is removed. Texts that share
over 50 words in a row share a span, whatever stands around them.

Grouping has two steps: one 64-bit hash, counted with map-side combine, leaves the few spans that may be repeated; these
are grouped by 128 bits. A passage that a third of all texts hold is one row per task in the count, and its occurrences
come back by a join that Spark can split.

Defined cases: a missing text is empty and stays missing; a text with fewer words than a span needs keeps everything;
an occurrence in a text with a missing id comes after the others; repeated rows are texts of their own, so all but the
first lose what a span covers; an empty table gives an empty result; extra columns stay apart in a struct.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import numbered, small_batches, text_udf
from tickerloom.session import discard, through_table

#: Sentences and words that a span has at least.
RUN, WORDS = 3, 20
#: A longer sentence is parted; every so many words in a row hold a place where it is.
LONG, NEAR = 12, 10
SENTENCE = re.compile(rb"[^.!?\n]*+(?:[.!?]++|\n)|[^.!?\n]++")
#: Odd multipliers of the two halves of a span's hash.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def parted(words: list[bytes], ends: np.ndarray) -> np.ndarray:
    """The ends, as numbers of words, of the parts of sentences that end at ``ends`` among ``words``.

    A long sentence ends, too, after the last word with the smallest checksum of every ``NEAR`` in a row.
    """
    numbers = np.diff(ends, prepend=0)
    long = numbers > LONG
    if not long.any():
        return ends
    # the smallest key of a stretch is that of its last smallest checksum
    last = (1 << 32) - 1
    keys = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) << np.uint64(32)
    keys |= np.arange(last, last - len(words), -1, dtype=np.uint64)
    two = np.minimum(keys[:-1], keys[1:])
    four = np.minimum(two[:-2], two[2:])
    least = np.minimum(np.minimum(four[:-6], four[4:-2]), two[NEAR - 2:])
    inside = numbers[long] - NEAR + 1
    begins = (ends - numbers)[long] - np.cumsum(inside) + inside
    stops = last - (least[np.arange(inside.sum()) + np.repeat(begins, inside)] & np.uint64(last)).astype(np.int64)
    return np.union1d(ends, stops + 1)


def _read(lower: bytes, words: list[bytes], numbers: list[int]) -> list[int]:
    """The ends of the sentences of a text before long ones are parted; appends its words and how many there are at each end.

    Blanks without a word of their own belong to the sentence before.
    """
    ends, at = [], 0
    for piece in SENTENCE.findall(lower):
        at += len(piece)
        if found := piece.split():
            words += found
            numbers.append(len(words))
            ends.append(at)
        elif ends:
            ends[-1] = at
    return ends


def sentences(data: bytes) -> tuple[list[int], list[int], list[list[bytes]]]:
    """(ends, number of words, words) of the sentences of a text in UTF-8; each begins where the one before ends."""
    lower, words, numbers = data.lower(), [], []
    read = _read(lower, words, numbers)
    whole, ends, sizes, texts, first, at = dict(zip(numbers, read)), [], [], [], 0, 0
    for last in parted(words, np.array(numbers, np.int64)).tolist():
        texts.append(words[first:last])
        sizes.append(last - first)
        if last in whole:
            at = whole[last]
        else:
            for word in texts[-1]:
                at = lower.index(word, at) + len(word)
        ends.append(at)
        first = last
    return ends, sizes, texts


def spans(numbers: list[int]) -> np.ndarray:
    """The end of the span that begins at each sentence; the number of sentences + 1 where none does."""
    n = len(numbers)
    sizes = np.concatenate(([0], np.cumsum(numbers, dtype=np.int64)))
    ends = np.maximum(np.searchsorted(sizes, sizes[:-1] + WORDS), np.arange(n) + RUN)
    return np.minimum(ends, n + 1)


def all_spans(numbers: list[int], texts: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the shortest spans that begin at a sentence, then of those that only end at one.

    ``texts`` holds how many sentences each text has, where they are those of several; no span goes beyond its text.
    """
    n = len(numbers)
    texts = np.array([n] if texts is None else texts, np.int64)
    over = np.cumsum(texts)
    begin, over = np.repeat(over - texts, texts), np.repeat(over, texts)
    sizes = np.concatenate(([0], np.cumsum(numbers, dtype=np.int64)))
    ends = np.maximum(np.searchsorted(sizes, sizes[:-1] + WORDS), np.arange(n) + RUN)
    first = np.flatnonzero(ends <= over)
    begins = np.minimum(np.searchsorted(sizes, sizes[1:] - WORDS, side="right") - 1, np.arange(1, n + 1) - RUN)
    last = np.flatnonzero(begins >= begin)
    last = last[ends[begins[last]] != last + 1]
    return np.concatenate((first, begins[last])), np.concatenate((ends[first], last + 1))


def span_hashes(
    texts: list[list[bytes]], ends: np.ndarray, first: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, h1, h2) of every span: sums of sentence hashes times powers, which don't depend on where the span lies.

    Without ``first`` there is an end for each sentence.
    """
    if first is None:
        first = np.flatnonzero(ends <= len(texts))
        ends = ends[first]
    digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(b" ".join(words)) for words in texts]), "<u8").reshape(-1, 2)
    found, places = [], np.arange(len(texts) + 1)
    with np.errstate(over="ignore"):
        for half, factor in enumerate(FACTORS):
            up, down = _powers(factor, len(places)), _powers(pow(factor, -1, 1 << 64), len(places))
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(digests[:, half] * up[:-1], dtype=np.uint64)))
            found.append((total[ends] - total[first]) * down[first] + (ends - first).astype(np.uint64))
    return first, found[0].view(np.int64), found[1].view(np.int64)


_POWERS: dict[int, np.ndarray] = {}


def _powers(factor: int, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2^64, kept for the next text."""
    known = _POWERS.get(factor)
    if known is None or len(known) < n:
        with np.errstate(over="ignore"):
            known = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(2 * n, factor, np.uint64))), dtype=np.uint64)
        _POWERS[factor] = known
    return known[:n]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sentences of a batch are numbered through, so that its texts take the same few array operations."""
    for batch in batches:
        words, numbers, whole = [], [], [0]
        for text in batch.column("text"):
            _read((text.as_py() or "").encode("utf-8").lower(), words, numbers)
            whole.append(len(words))
        ends = parted(words, np.array(numbers, np.int64))
        bounds = np.searchsorted(ends, whole, side="right")
        begins = np.concatenate(([0], ends))
        sizes = np.diff(begins)
        first, end = all_spans(sizes, np.diff(bounds))
        edges = begins.tolist()
        _, high, low = span_hashes([words[a:b] for a, b in zip(edges, edges[1:])], end, first)
        rows = np.searchsorted(bounds, first, side="right") - 1
        places = (first - bounds[rows]) << 32 | (end - first)
        of = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid").take(of), batch.column("doc_id").take(of), pa.array(places), pa.array(high), pa.array(low)],
            ["rid", "doc_id", "place", "h1", "h2"])
        pa.default_memory_pool().release_unused()


def hashed_spans(rows: DataFrame) -> DataFrame:
    """(rid, doc_id, place, h1, h2): every span of every text of ``rows`` (rid, doc_id, text).

    ``place`` holds the first sentence in its upper half and the number of sentences in its lower half.
    """
    small_batches(rows.sparkSession)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("rid", "doc_id", "text").mapInArrow(_hashed, f"rid long, doc_id {kind}, place long, h1 long, h2 long")


def covered(rows: DataFrame) -> DataFrame:
    """(rid, cover): of every text that loses something, the places of the spans that are no first occurrence."""
    found = hashed_spans(rows)
    again = through_table(found.groupBy("h1").agg(F.count("*").alias("n")).where("n > 1").select("h1"), "again")
    repeated = through_table(found.join(again, "h1"), "repeated")
    discard(again)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("rid"), F.col("place"))
    firsts = through_table(repeated.groupBy("h1", "h2").agg(F.min(order).alias("origin")).select(
        "h1", "h2", F.col("origin.rid").alias("origin"), F.col("origin.place").alias("origin_place")), "firsts")
    later = repeated.join(firsts, ["h1", "h2"]).where((F.col("rid") != F.col("origin")) | (F.col("place") != F.col("origin_place")))
    covers = through_table(later.groupBy("rid").agg(F.collect_list("place").alias("cover")), "covers")
    discard(repeated, firsts)
    return covers


def cut(data: bytes, cover: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches (start, end in bytes) of the covered sentences of a text, joined where they touch."""
    ends, _, _ = sentences(data)
    gone = np.zeros(len(ends) + 1, np.int64)
    for first, number in cover:
        gone[first] += 1
        gone[first + number] -= 1
    removed: list[tuple[int, int]] = []
    for i in np.flatnonzero(np.cumsum(gone)[:-1]).tolist():
        start, end = ends[i - 1] if i else 0, ends[i]
        if removed and removed[-1][1] == start:
            start = removed.pop()[0]
        removed.append((start, end))
    return removed


def without(data: bytes, removed: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text that is left and the removed stretches in code points."""
    kept, found, at, letters = [], [], 0, 0
    for start, end in removed:
        kept.append(data[at:start].decode("utf-8"))
        letters += len(kept[-1])
        length = len(data[start:end].decode("utf-8"))
        found.append((letters, letters + length))
        letters, at = letters + length, end
    return "".join(kept) + data[at:].decode("utf-8"), found


def _cut_all(texts: Column, covers: Column) -> Column:
    """``cut`` and ``without`` for columns: a struct of removed and text; texts without a cover are not sent."""

    @text_udf("struct<removed:array<struct<start:int,end:int>>,text:string>")
    def cut_batches(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        stretch = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for texts, covers in batches:
            stretches, kept = [], []
            for text, cover in zip(texts, covers):
                if not cover.is_valid:
                    stretches.append(None)
                    kept.append(None)
                    continue
                data = text.as_py().encode("utf-8")
                left, removed = without(data, cut(data, [(c >> 32, c & 0xFFFFFFFF) for c in cover.as_py()]))
                stretches.append([{"start": a, "end": b} for a, b in removed])
                kept.append(left)
            yield pa.StructArray.from_arrays([pa.array(stretches, stretch), pa.array(kept, pa.string())], ["removed", "text"])

    return cut_batches(F.when(covers.isNotNull(), texts), covers)


def deduplicated(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (in ``row``) with ``removed`` (start, end in code points) and the text that is left."""
    stored = numbered(docs, "passages")
    rows = stored.select("rid", "row.doc_id", "row.text")
    joined = stored.join(covered(rows), "rid", "left").withColumn("cut", _cut_all(F.col("row.text"), F.col("cover")))
    return joined.select(
        "row", F.coalesce("cut.removed", F.array().cast("array<struct<start:int,end:int>>")).alias("removed"),
        F.when(F.col("cover").isNotNull(), F.col("cut.text")).otherwise(F.col("row.text")).alias("text"),
    )

"""Near duplicates by SimHash, found through anchor points of a covering code.

A fingerprint has 64 bits; two of them link when at most ``THRESHOLD`` = 3 bits differ. Of the two 32-bit halves at
least one then differs in at most one bit. Anchors of a half are the words of a covering code: the [31,26] Hamming code
on 31 bits with one free bit beside it, whose covering radius is 1. One of two linked fingerprints has an anchor at
distance 1 or less in that half, and this anchor is at distance 1 + 1 or less from the other. So each distinct
fingerprint is replicated to every anchor within 2 of each half (17 a half; 2 for a word of the code), and every
linked pair meets at an anchor. At each anchor all 64 bits are compared.

There are 2 x 2^27 anchors, so few unrelated fingerprints meet. Equal fingerprints are one row before any replica is
made. An anchor with over ``BLOCK`` fingerprints is dealt out in tiles: each row goes to the tiles of its block with
every other block, so no task holds a whole anchor and no link is lost. A tile gives one link per fingerprint to the
root of its part, not all pairs.

Defined cases: a missing text is empty; a text without words has fingerprint zero, linked like any other; a text with
one or two words is one shingle; equal rows have equal fingerprints and are in one component; a missing id is never a
component's name (a component without any id has none); an empty table gives an empty result; extra columns stay apart
in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import numbered, original, text_udf, whole_text
from tickerloom.llm.components import connected
from tickerloom.session import through_table

SHINGLE, SEED, THRESHOLD = 3, 42, 3
#: Words of a text that are hashed at a time, which bounds memory for very long texts.
PIECE = 65_536
#: Fingerprints of one anchor that are compared in one tile.
BLOCK = 1024
#: Links that wait in a task before they are merged.
PENDING = 100_000


def bits_of(text: str) -> int:
    """The fingerprint of a whole text, as an unsigned number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    total, counts = max(1, len(words) - SHINGLE + 1), np.zeros(64, np.int64)
    for first in range(0, total, PIECE):
        part = words[first:first + PIECE + SHINGLE - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        width = min(SHINGLE, len(part))
        spans = zip(starts[:len(part) - width + 1].tolist(), ends[width - 1:].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprint(text: Column) -> Column:
    """The SimHash of a text column as a signed 64-bit number."""

    @text_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.fromiter((bits_of(t.as_py() or "") for t in texts), np.uint64, len(texts))
            yield pa.array(found.view(np.int64))

    return simhash(text)


def _masks() -> np.ndarray:
    """For each syndrome the changes that lead from a half to its anchors; unused places are -1.

    Bit i - 1 of a half is position i of the Hamming code (i = 1 to 31); bit 31 is free.
    """
    masks, free = np.full((32, 17), -1, np.int64), 1 << 31
    masks[0, :2] = 0, free
    for s in range(1, 32):
        pairs = [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < i ^ s]
        masks[s] = [1 << (s - 1), (1 << (s - 1)) | free, *pairs]
    return masks


def _syndromes() -> np.ndarray:
    """The syndrome of each value of each of the four bytes of a half."""
    table = np.zeros((4, 256), np.int64)
    for place in range(4):
        for bit in range(8):
            if (position := 8 * place + bit + 1) < 32:
                table[place, (np.arange(256) >> bit) & 1 == 1] ^= position
    return table


MASKS, SYNDROMES = _masks(), _syndromes()


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) for every anchor of every fingerprint (uint64)."""
    made, rows = [], []
    for side in (0, 1):
        half = ((prints >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        syndrome = np.zeros(len(half), np.int64)
        for place in range(4):
            syndrome ^= SYNDROMES[place, (half >> (8 * place)) & 255]
        masks = MASKS[syndrome]
        row, column = np.nonzero(masks >= 0)
        made.append((half[row] ^ masks[row, column]) | (side << 32))
        rows.append(row)
    return np.concatenate(made), np.concatenate(rows)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fp").to_numpy(zero_copy_only=False)
        where, rows = anchors(prints.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(prints[rows])], ["anchor", "fp"])


def _merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The roots of all rows once rows ``a`` and ``b`` belong together, pair by pair."""
    while ((x := root[a]) != (y := root[b])).any():
        low = np.minimum(x, y)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while not np.array_equal(top := root[root], root):
            root = top
    return root


def tile_links(group: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, root) within groups of rows; ``group`` is sorted. At most one link per row.

    Rows are compared with the next one of their group, then the next but one, and so on. Links are merged as soon as
    ``PENDING`` of them wait, and rows that belong together already are left out, so dense groups need little memory.
    """
    edges = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(group)]))
    size = np.diff(edges)
    end = np.repeat(edges[1:], size)
    root, rows, left, right, waiting = np.arange(len(group)), np.arange(len(group)), [], [], 0
    for step in range(1, int(size.max(initial=0))):
        rows = rows[rows + step < end[rows]]
        near = rows[np.bitwise_count(prints[rows] ^ prints[rows + step]) <= THRESHOLD]
        near = near[root[near] != root[near + step]]
        left.append(near)
        right.append(near + step)
        waiting += len(near)
        if waiting > PENDING:
            root, left, right, waiting = _merged(root, np.concatenate(left), np.concatenate(right)), [], [], 0
    if waiting:
        root = _merged(root, np.concatenate(left), np.concatenate(right))
    linked = np.flatnonzero(root != np.arange(len(group)))
    return prints[linked], prints[root[linked]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of all groups of a partition that is sorted by (anchor, one, two); a group may span batches."""
    rest = None
    for batch in batches:
        keys = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in ("anchor", "one", "two")])
        prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        if rest is not None:
            keys, prints = np.concatenate((rest[0], keys), axis=1), np.concatenate((rest[1], prints))
        new = (np.diff(keys, axis=1) != 0).any(axis=0)
        last = np.flatnonzero(new)[-1] + 1 if new.any() else 0
        rest = keys[:, last:], prints[last:]
        yield _links(new[:max(0, last - 1)], prints[:last])
    if rest is not None and len(rest[1]):
        yield _links((np.diff(rest[0], axis=1) != 0).any(axis=0), rest[1])


def _links(new: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    group = np.concatenate(([0], np.cumsum(new))) if len(prints) else np.zeros(0, np.int64)
    a, b = tile_links(group, prints)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def near_links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``prints`` (column fp, distinct) as links of 3 bits do."""
    replicas = through_table(prints.select("fp").mapInArrow(_replicate, "anchor long, fp long"), "replicas")
    shared = through_table(replicas.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "anchors")
    blocks = F.ceil(F.col("n") / block).cast("int")
    meeting = replicas.join(shared, "anchor").select("anchor", "fp", blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = meeting.select("anchor", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tiles = dealt.select(
        "anchor", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "fp",
    )
    return (
        tiles.repartition("anchor", "one", "two").sortWithinPartitions("anchor", "one", "two")
        .mapInArrow(_compare, "a long, b long").distinct()
    )


def _classes(nodes: DataFrame) -> DataFrame:
    """(fp, component_id) of ``nodes`` (fp distinct, low: its smallest id)."""
    found = nodes.join(connected(near_links(nodes)).select(F.col("node").alias("fp"), "root"), "fp", "left")
    found = through_table(found.select("fp", "low", F.coalesce("root", "fp").alias("root")), "classes")
    names = through_table(found.groupBy("root").agg(F.min("low").alias("component_id")), "names")
    return found.join(names, "root").select("fp", "component_id", "root")


def components(docs: DataFrame) -> DataFrame:
    """For every row of ``docs``: doc_id, fp (signed 64-bit fingerprint) and component_id."""
    prints = through_table(docs.select("doc_id", fingerprint(whole_text()).alias("fp")), "prints")
    nodes = through_table(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    return prints.join(_classes(nodes).select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of every component, the one with the smallest id (the first row of those)."""
    rows = numbered(docs, "simhash", fp=fingerprint(whole_text()), doc_id=F.col("doc_id"))
    best = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("rid"))
    nodes = through_table(rows.groupBy("fp").agg(F.min(best).alias("best"), F.min("doc_id").alias("low")), "nodes")
    classes = _classes(nodes.select("fp", "low")).join(nodes.select("fp", "best"), "fp")
    stay = through_table(classes.groupBy("root").agg(F.min("best").alias("best")).select("best.rid"), "stay")
    # The few rows that go are joined with the texts, not the many that stay.
    gone = through_table(rows.select("rid").join(stay, "rid", "left_anti"), "gone")
    return original(rows.join(gone, "rid", "left_anti"))

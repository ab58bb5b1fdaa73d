"""Hard negatives by exact integer products of tiles, Strassen's way.

For every anchor its best rows of the same label are positives; for every anchor and positive the best rows of other
labels whose score lies in a window below the positive's score are hard negatives. A score is an inner product of
integers.

Anchors are dealt into blocks, all rows into stripes, and a task multiplies one block with one stripe, piece by piece:
recursive multiplication with seven products instead of eight, in int64, an odd edge padded with zeros. Sums in between
may wrap round 2^64; the result does not, and so it is exact. What a tile finds goes into bounded heaps, one per anchor
for positives and one per anchor and positive for windows. Heaps merge: those of an anchor's other tiles are ranked
together with them, with a limit per group on both sides of the shuffle. Positives are sought in tiles of one label,
negatives in tiles of all rows, so every row meets each anchor twice at most, and nothing that grows is broadcast or
collected. Blocks and stripes are hashed from row numbers, so a label with a third of all rows, or one very common
vector, is dealt out like any other.

Defined cases: rows without id, label or vector, or with a missing or non-finite component, take no part; a shorter
vector is padded with zeros; repeated rows are rows of their own, and an anchor's positives are any rows but itself;
equal scores stand by smaller id, then by row number; components so large that a product could leave 64 bits are an
error; an anchor without positives, or a window without rows, returns nothing; an empty table gives an empty result;
columns beside those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import small_batches
from tickerloom.session import discard, through_table

#: Anchors of a block, rows of a stripe, numbers that a block may hold, edge that is multiplied directly.
BLOCK, STRIPE, NUMBERS, LEAF = 4096, 8192, 1 << 22, 32
LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a`` times the transpose of ``b`` (rows x width each), int64, modulo 2^64."""
    m, n, width = len(a), len(b), a.shape[1]
    if min(m, n, width) <= LEAF:
        return a @ b.T
    half_m, half_n, half = (m + 1) // 2, (n + 1) // 2, (width + 1) // 2
    if m % 2 or width % 2:
        a = np.pad(a, ((0, m % 2), (0, width % 2)))
    if n % 2 or width % 2:
        b = np.pad(b, ((0, n % 2), (0, width % 2)))
    a11, a12, a21, a22 = a[:half_m, :half], a[:half_m, half:], a[half_m:, :half], a[half_m:, half:]
    # the quarters of the transpose: its upper right one is the lower left one of b
    b11, b21, b12, b22 = b[:half_n, :half], b[:half_n, half:], b[half_n:, :half], b[half_n:, half:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * half_m, 2 * half_n), np.int64)
    out[:half_m, :half_n] = p1 + p4 - p5 + p7
    out[:half_m, half_n:] = p3 + p5
    out[half_m:, :half_n] = p2 + p4
    out[half_m:, half_n:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The best ``keep`` entries of each of ``n`` slots: higher scores first, then smaller ids, then row numbers.

    Entries must be offered in the order of their ids, so a later one of equal score never enters a full heap.
    """

    def __init__(self, n: int, keep: int) -> None:
        self.keep = keep
        self.bar, self.full = np.full(n, LEAST), np.zeros(n, bool)
        self.slot = self.score = self.ids = self.rids = np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, rids: np.ndarray) -> None:
        """A tile of scores (slots x rows) and which of them count."""
        allowed = allowed & ((scores > self.bar[:, None]) | ~self.full[:, None])
        if np.count_nonzero(allowed) > self.keep * len(scores):
            columns = np.argsort(np.where(allowed, -scores, -LEAST - 1), axis=1, kind="stable")[:, :self.keep]
            slot = np.repeat(np.arange(len(scores)), columns.shape[1])
            column = columns.ravel()
            known = allowed[slot, column]
            slot, column = slot[known], column[known]
        else:
            slot, column = np.nonzero(allowed)
        if len(slot):
            self.merge(slot, scores[slot, column], ids[column], rids[column])

    def merge(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, rids: np.ndarray) -> None:
        parts = zip((self.slot, self.score, self.ids, self.rids), (slot, score, ids, rids))
        slot, score, ids, rids = (np.concatenate(both) for both in parts)
        order = np.lexsort((rids, ids, -score, slot))
        slot, score, ids, rids = slot[order], score[order], ids[order], rids[order]
        first = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - first
        self.full[slot[place == self.keep - 1]] = True
        self.bar[slot[place == self.keep - 1]] = score[place == self.keep - 1]
        stay = place < self.keep
        self.slot, self.score, self.ids, self.rids = slot[stay], score[stay], ids[stay], rids[stay]


def _vectors(column: pa.ListArray, width: int) -> np.ndarray:
    """The lists of a column as rows of one matrix, padded with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (size == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = values
    return out


class _Tile:
    """One block of anchors, and the heaps that the rows of a stripe are offered to."""

    def __init__(self, anchors: list[dict], keep: int, low: int, high: int, searched: bool) -> None:
        self.rid, self.vec_id, self.label = (np.concatenate([x[n] for x in anchors]) for n in ("rid", "vec_id", "label"))
        self.vectors = np.concatenate([x["vectors"] for x in anchors])
        self.goals = [goal for x in anchors for goal in x["goals"]]
        self.low, self.high, self.searched = low, high, searched
        slots = max((len(goal) for goal in self.goals), default=0) if searched else 1
        self.heaps = [Heaps(len(self.rid), keep) for _ in range(slots)]
        #: score of each slot's positive; no row lies in the window of one that is missing
        self.goal = np.array([[goal[k]["score"] if k < len(goal) else -1 for goal in self.goals] for k in range(slots)]) \
            if searched else None

    def meet(self, rows: dict) -> None:
        scores = strassen(self.vectors, rows["vectors"])
        if not self.searched:
            self.heaps[0].offer(scores, self.rid[:, None] != rows["rid"], rows["vec_id"], rows["rid"])
            return
        other = self.label[:, None] != rows["label"]
        for goal, heap in zip(self.goal, self.heaps):
            # low * goal <= 100 * score <= high * goal, without products of scores
            least, most = -((-self.low * goal) // 100), self.high * goal // 100
            heap.offer(scores, other & (scores >= least[:, None]) & (scores <= most[:, None]), rows["vec_id"], rows["rid"])

    def found(self) -> Iterator[pa.RecordBatch]:
        for number, heap in enumerate(self.heaps):
            if not len(heap.slot):
                continue
            columns = {"anchor_rid": self.rid[heap.slot], "anchor_id": self.vec_id[heap.slot], "other_rid": heap.rids,
                       "other_id": heap.ids, "score": heap.score}
            if self.searched:
                goals = [self.goals[slot][number] for slot in heap.slot]
                columns |= {"goal": np.full(len(goals), number), "goal_id": np.array([g["id"] for g in goals], np.int64),
                            "goal_score": np.array([g["score"] for g in goals], np.int64)}
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns.values()], list(columns))


def _search(width: int, keep: int, low: int, high: int, searched: bool):
    """Partial heaps of all tiles of a partition sorted by (own, block, stripe, kind, vec_id); a tile may span batches."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, anchors, tile = None, [], None
        for batch in batches:
            key = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("own", "block", "stripe", "kind")], 1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                if first == end:
                    continue
                part, here = batch.slice(first, end - first), tuple(key[first, :3].tolist())
                if here != now:
                    if tile:
                        yield from tile.found()
                    now, anchors, tile = here, [], None
                rows = {n: part.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("rid", "vec_id", "label")}
                rows["vectors"] = _vectors(part.column("vector"), width)
                if key[first, 3] == 0:
                    anchors.append(rows | {"goals": part.column("goals").to_pylist()})
                elif anchors:
                    tile = tile or _Tile(anchors, keep, low, high, searched)
                    tile.meet(rows)
        if tile:
            yield from tile.found()

    return search


GOALS = "array<struct<score:bigint,id:bigint>>"
FOUND = "anchor_rid long, anchor_id long, other_rid long, other_id long, score long"


def _tiles(anchors: DataFrame, rows: DataFrame, own: str | None, block: int, stripe: int) -> DataFrame:
    """Anchors once per stripe and rows once per block, of all rows or of those alike in ``own``, in the order of the search."""
    if own is None:
        blocks, stripes = (F.lit(max(1, -(-df.count() // size))) for df, size in ((anchors, block), (rows, stripe)))
        sized = [df.withColumns({"own": F.lit(0).cast("long"), "blocks": blocks, "stripes": stripes}) for df in (anchors, rows)]
    else:
        count = lambda df, name: df.groupBy(F.col(own).alias("own")).agg(F.count("*").alias(name))
        sizes = through_table(count(anchors, "anchors").join(count(rows, "rows"), "own").select(
            "own", F.ceil(F.col("anchors") / block).cast("int").alias("blocks"), F.ceil(F.col("rows") / stripe).cast("int").alias("stripes"),
        ), "tiles")
        sized = [df.withColumn("own", F.col(own)).join(sizes, "own") for df in (anchors, rows)]
    part = lambda n: F.pmod(F.xxhash64("rid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ("rid", "vec_id", "label", "vector", "goals")
    left = sized[0].select("own", part("blocks").alias("block"), every("stripes").alias("stripe"), F.lit(0).alias("kind"), *columns)
    right = sized[1].select("own", every("blocks").alias("block"), part("stripes").alias("stripe"), F.lit(1).alias("kind"), *columns)
    key = ("own", "block", "stripe")
    return left.select(*right.columns).unionByName(right).repartition(*key).sortWithinPartitions(*key, "kind", "vec_id", "rid")


def _ranked(found: DataFrame, *key: str) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "other_id", "other_rid")
    return found.withColumn("rank", F.row_number().over(order))


def mine(
    rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block: int = BLOCK, stripe: int = STRIPE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``rows``.

    ``rows`` has vec_id, label, vector (array of long) and is_anchor. A negative's score lies between ``low`` and
    ``high`` hundredths of the positive's.
    """
    small_batches(rows.sparkSession)
    whole = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<bigint>").alias("vector"), F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    table = through_table(whole.withColumn("rid", F.monotonically_increasing_id()).withColumn("goals", F.lit(None).cast(GOALS)), "vectors")
    width, largest = table.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))).first()
    width = max(1, width or 0)
    if width * (largest or 0.0) ** 2 >= 2.0**63:
        raise ValueError("components are too large for scores of 64 bits")
    block = max(1, min(block, NUMBERS // width))
    anchors = table.where("is_anchor")
    near = _tiles(anchors, table, "label", block, stripe).mapInArrow(_search(width, positives, low, high, False), FOUND)
    best = _ranked(near, "anchor_rid").where(F.col("rank") <= positives).groupBy("anchor_rid").agg(
        F.sort_array(F.collect_list(F.struct("rank", "score", F.col("other_id").alias("id")))).alias("ranked"))
    goals = F.transform("ranked", lambda x: F.struct(x["score"].alias("score"), x["id"].alias("id"))).alias("goals")
    known = through_table(
        anchors.drop("goals").join(best.withColumnRenamed("anchor_rid", "rid"), "rid")
        .select("rid", "vec_id", "label", "vector", goals), "anchors")
    far = _tiles(known, table, None, block, stripe).mapInArrow(
        _search(width, negatives, low, high, True), f"{FOUND}, goal long, goal_id long, goal_score long")
    found = through_table(_ranked(far, "anchor_rid", "goal").where(F.col("rank") <= negatives).select(
        "anchor_id", F.col("goal_id").alias("positive_id"), "rank", F.col("other_id").alias("negative_id"),
        F.col("goal_score").alias("positive_score"), F.col("score").alias("negative_score"),
    ), "negatives")
    discard(table, known)
    return found


def coded(vector: Column, scale: int = 256) -> Column:
    """Components as integers: the floor of ``scale`` times each; NULL where one is missing or not finite."""
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))

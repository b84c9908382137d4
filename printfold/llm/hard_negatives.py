"""Hard-negative mining with exact integer scores, by the method of the Four Russians.

Components become whole numbers. A candidate is stored as bit planes of its numbers in two's complement,
packed to a byte for every plane and group of eight dimensions. For an anchor every group has a table of
the sums of all 256 subsets of its eight numbers; a candidate's byte picks its entry, and the entries of
a plane are shifted by the plane's place and added. The sum is the whole inner product, not an estimate.

Anchors pass in rounds of bounded number (``ANCHORS``), in which every task holds their numbers; tables
are made for ``TABLE_ANCHORS`` of them at a time. A task keeps the best rows of each anchor so far, so it
sends a bounded number per anchor, however many candidates it reads, and no pair becomes a row.

1. Positives: an anchor's first rows of its own label.
2. Negatives: for each positive, the first rows of other labels with a score in a band of percentages of
   the positive's.

Higher scores come first, then the smaller id.

Defined results: a row without id, label or vector, or with a component that is null or not finite, takes
no part; vectors of different length count as padded with zeros, an empty one scores 0; a repeated row
counts as often as it is there, but as one anchor; rows with an anchor's id are never its positives; an
anchor without positives, and an empty table, give no rows; other columns are ignored. Scores that could
pass 62 bits fail the job.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from printfold.session import drop_dir, work_dir

SCALE, GROUP = 256, 8
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
ANCHORS = 65_536  # of a round; a collected row has 8 bytes a dimension
TABLE_ANCHORS, ROWS = 256, 1024  # scored at once
LEAST = np.iinfo(np.int64).min


# --- 1. numbers and bit planes ----------------------------------------------------------------


def whole(column) -> tuple[list, np.ndarray]:
    """Every vector's whole numbers, and which rows have a vector with finite components only."""
    kept = np.ones(len(column), bool)
    out = []
    for row, vector in enumerate(column):
        numbers = vector.values
        if numbers is None or numbers.null_count:
            kept[row] = False
            continue
        numbers = numbers.to_numpy(zero_copy_only=False).astype(np.float64)
        if not np.isfinite(numbers).all():
            kept[row] = False
            continue
        numbers = np.floor(SCALE * numbers)
        if len(numbers) and np.abs(numbers).max() >= 2.0**61:
            raise OverflowError("a component passes 61 bits")
        out.append(numbers.astype(np.int64))
    return out, kept


def groups_of(size: int) -> int:
    return -(-size // GROUP)


def planes(numbers: np.ndarray) -> np.ndarray:
    """Bytes of (row, plane, group); the last plane has the sign, bit i of a byte is dimension i of its group."""
    most = max(int(np.where(numbers < 0, ~numbers, numbers).max()), 0) if numbers.size else 0
    bits = [np.packbits((numbers >> b) & 1 == 1, axis=1, bitorder="little") for b in range(most.bit_length() + 1)]
    return np.stack(bits, 1)


def index(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, groups, planes) of every row that takes part."""
    id_and_label = [F.col(c).cast("long").alias(c) for c in ("vec_id", "label")]
    rows = vectors.where("vec_id is not null and label is not null and embedding is not null")
    return rows.select(*id_and_label, "embedding").mapInArrow(_index, "vec_id long, label long, groups int, planes binary")


def _index(batches):
    for batch in batches:
        found, kept = whole(batch.column("embedding"))
        rows = np.flatnonzero(kept)
        sizes = np.array([len(v) for v in found], np.int64)
        for size in np.unique(sizes):
            same = np.flatnonzero(sizes == size)
            numbers = np.stack([found[i] for i in same])
            packed = planes(numbers) if size else np.zeros((len(same), 1, 0), np.uint8)
            taken = batch.take(pa.array(rows[same]))
            yield pa.RecordBatch.from_arrays(
                [taken.column("vec_id"), taken.column("label"), pa.array([groups_of(size)] * len(same), pa.int32()),
                 pa.array([p.tobytes() for p in packed], pa.binary())], names=["vec_id", "label", "groups", "planes"])


def unpacked(blobs: list, groups: np.ndarray, width: int) -> np.ndarray:
    """Planes of a batch as (plane, group, row), as many planes as its longest row has, ``width`` groups."""
    deep = [len(b) // g if g else 1 for b, g in zip(blobs, groups)]
    out = np.zeros((len(blobs), max(deep), width), np.uint8)
    shapes = np.stack([deep, groups], 1)
    for depth, g in np.unique(shapes, axis=0):
        if not g:
            continue
        rows = np.flatnonzero((shapes == (depth, g)).all(1))
        mine = np.frombuffer(b"".join(blobs[i] for i in rows), np.uint8).reshape(len(rows), depth, g)[:, :, :width]
        out[rows, :depth, : mine.shape[2]] = mine
        out[rows, depth:, : mine.shape[2]] = mine[:, -1:]  # the sign goes on
    return np.ascontiguousarray(out.transpose(1, 2, 0))


# --- 2. scores --------------------------------------------------------------------------------


def tables(anchors: np.ndarray) -> np.ndarray:
    """Sums of all subsets of each anchor's groups: (group, subset, anchor)."""
    width = anchors.shape[1] // GROUP
    out = np.zeros((width, 1 << GROUP, len(anchors)), np.int64)
    by_place = anchors.T.reshape(width, GROUP, len(anchors))
    for bit in range(GROUP):
        out[:, 1 << bit: 2 << bit] = out[:, : 1 << bit] + by_place[:, bit, None]
    return out


def scores(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all rows with all anchors of a table: shift, look up, add."""
    depth, width, n = rows.shape
    total = np.zeros((n, table.shape[2]), np.int64)
    for plane in range(depth - 1, -1, -1):
        total <<= 1
        for group in range(width):
            entries = table[group][rows[plane, group]]
            if plane == depth - 1:
                total -= entries
            else:
                total += entries
    return total


class Best:
    """The first ``k`` (score, id) of each of ``n`` lists so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.least = np.full(n, LEAST)  # a score below has no chance
        self.lists, self.scores, self.ids = (np.empty(0, np.int64) for _ in range(3))

    def add(self, lists, found, ids):
        if not len(lists):
            return
        lists, found, ids = (np.concatenate(x) for x in ((self.lists, lists), (self.scores, found), (self.ids, ids)))
        order = np.lexsort((ids, -found, lists))
        lists, found, ids = lists[order], found[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], lists[1:] != lists[:-1]]))
        rank = np.arange(len(lists)) - np.repeat(starts, np.diff(np.append(starts, len(lists))))
        full = rank == self.k - 1
        self.least[lists[full]] = found[full]
        kept = rank < self.k
        self.lists, self.scores, self.ids = lists[kept], found[kept], ids[kept]


class Anchors:
    """Anchors of one round, with a band of scores for each of their lists.

    Without bands an anchor has one list, of its own label; with them a list per positive, of other labels.
    """

    def __init__(self, ids, labels, numbers, low=None, high=None):
        self.ids, self.labels, self.numbers, self.low, self.high = ids, labels, numbers, low, high

    def best(self, k):
        lists = 1 if self.low is None else self.low.shape[1]

        def run(batches):
            state = [Best(len(self.ids[i: i + TABLE_ANCHORS]) * lists, k) for i in range(0, len(self.ids), TABLE_ANCHORS)]
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS):
                    self._add(state, batch.slice(start, ROWS), lists)
            for block, best in enumerate(state):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best.lists // lists + block * TABLE_ANCHORS), pa.array(best.lists % lists),
                     pa.array(best.scores), pa.array(best.ids)], names=["anchor", "list", "score", "vec_id"])

        return run

    def _add(self, state, batch, lists):
        ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
        width = self.numbers.shape[1] // GROUP
        rows = unpacked(batch.column("planes").to_pylist(), batch.column("groups").to_numpy(), width)
        largest = int(np.abs(self.numbers).max()) if self.numbers.size else 0
        if (largest * max(self.numbers.shape[1], 1)) << len(rows) >= 1 << 62:
            raise OverflowError("a score could pass 62 bits")
        for block, best in enumerate(state):
            part = slice(block * TABLE_ANCHORS, (block + 1) * TABLE_ANCHORS)
            found = scores(tables(self.numbers[part]), rows)
            same = labels[:, None] == self.labels[None, part]
            if self.low is None:
                fits = same & (ids[:, None] != self.ids[None, part]) & (found >= best.least)
                row, anchor = np.nonzero(fits)
                best.add(anchor, found[row, anchor], ids[row])
                continue
            for n in range(lists):
                low = np.maximum(self.low[part, n], best.least[n::lists])
                row, anchor = np.nonzero(~same & (found >= low) & (found <= self.high[part, n]))
                best.add(anchor * lists + n, found[row, anchor], ids[row])


# --- 3. rounds --------------------------------------------------------------------------------


def first(rows: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of every list over all tasks, with their ``rank``."""
    order = Window.partitionBy("anchor", "list").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def bands(score: np.ndarray, low: int, high: int):
    """Least and greatest whole number between two percentages of whole scores."""
    return [-(-low * s // 100) for s in score], [high * s // 100 for s in score]


PARTIAL = "anchor long, list long, score long, vec_id long"


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives=POSITIVES, negatives=NEGATIVES, low=LOW, high=HIGH,
                   anchors_a_round=ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``vectors``.

    ``vectors`` has (vec_id, label, embedding), ids and labels being whole numbers; ``is_anchor`` is a
    condition on them.
    """
    spark = vectors.sparkSession
    indexed, chosen, out = (work_dir(spark, f"negatives-{n}") for n in ("index", "anchors", "found"))
    index(vectors).write.parquet(indexed)
    rows = spark.read.parquet(indexed)
    valid = vectors.where(is_anchor).where("vec_id is not null and label is not null and embedding is not null")
    valid.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding").distinct().write.parquet(chosen)
    anchors = spark.read.parquet(chosen)
    rounds = max(1, -(-anchors.count() // anchors_a_round))
    for number in range(rounds):
        mine = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == number)
        _round(spark, rows, mine.toArrow(), positives, negatives, low, high).write.mode("append").parquet(out)
    for path in (indexed, chosen):
        drop_dir(spark, path)
    return spark.read.parquet(out)


def _round(spark, rows, table, positives, negatives, low, high):
    vectors, kept = whole(table.column("embedding"))
    width = GROUP * groups_of(max(map(len, vectors), default=0))
    numbers = np.zeros((len(vectors), width), np.int64)
    for row, vector in enumerate(vectors):
        numbers[row, : len(vector)] = vector
    ids, labels = (table.column(c).to_numpy()[kept] for c in ("vec_id", "label"))
    near = rows.mapInArrow(Anchors(ids, labels, numbers).best(positives), PARTIAL)
    near = first(near, positives).select("anchor", F.col("rank").alias("list"), "score", "vec_id").toArrow()
    # Bounded by the round: so many positives an anchor at most.
    least = np.ones((len(ids), positives), np.int64)
    most = np.zeros((len(ids), positives), np.int64)
    place = (near.column("anchor").to_numpy(), near.column("list").to_numpy() - 1)
    least[place], most[place] = bands(near.column("score").to_pylist(), low, high)
    found = first(rows.mapInArrow(Anchors(ids, labels, numbers, least, most).best(negatives), PARTIAL), negatives)
    named = pa.table({
        "anchor": near.column("anchor"), "list": pa.array(place[1]), "anchor_id": pa.array(ids[place[0]]),
        "positive_id": near.column("vec_id"), "positive_score": near.column("score")})
    named = spark.createDataFrame(named)
    return found.join(named, ["anchor", "list"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))

"""Substring deduplication by level-wise doubling.

Words are runs of anything but blanks. A window of ``words`` consecutive words of a document is
repeated when its word sequence also starts in a document of another doc_id, and late when it starts
in one of a smaller doc_id. Every word that a late window covers is removed; windows are judged on the
input.

Levels: the runs of ``half`` words come first, of which any window holds its smallest by hash, so
that only those are asked about (a quarter of all). Windows whose smallest run is repeated are
extended to ``words`` words and asked about; windows that are repeated and follow a repeated window are
extended to twice that, and so on until no candidate survives. The level a document last appears at is
its longest repeat.

Windows are compared as 56 bits of a hash within a bucket that another hash chooses; at half a million
entries a bucket, a window is taken for another with probability 1e-11.

Defined results: a null or empty text has no words; null doc_ids are one document before all others;
rows of equal doc_id are not repeats of each other; a text under ``words`` words has no window; an empty
table gives no rows; other columns are ignored. Kept words are joined by one blank.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from printfold.llm.chunks import (
    ASK,
    BUCKET_BYTES,
    CHUNK_BYTES,
    REPLY,
    Entries,
    ask,
    id_bounds,
    judge,
    mixed,
    range_of,
    sizes,
)
from printfold.llm.words import hash_table, texts, values
from printfold.session import work_dir

WORDS = 13
HALF_BYTES, WINDOW_BYTES, LEVEL_BYTES = 4, 7, 6
FACTORS = [np.uint64(xxhash.xxh3_64_intdigest(b"window", seed=i) | 1) for i in range(3)]
LEVEL_ENTRIES = 500_000  # windows a bucket of the upper levels takes
COPY = np.uint64(0xA0761D6478BD642F)


def _powers(factor, n):
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _windows(h: np.ndarray, size: int, factor) -> np.ndarray:
    """Polynomial hash of every run of ``size`` values."""
    n = len(h)
    inverse = np.uint64(pow(int(factor), -1, 1 << 64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(h * _powers(factor, n), dtype=np.uint64)])
    return mixed((sums[size:] - sums[:-size])[: max(n - size + 1, 0)] * _powers(inverse, max(n - size + 1, 0)))


def _sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every run of ``size`` values."""
    have, out = 1, x
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Chunk:
    """Documents of a chunk, sorted, with their windows."""

    def __init__(self, table: pa.Table, words: int, buckets: int, texts_too=False):
        self.table = table.sort_by([("rank", "ascending"), ("doc_id", "ascending"), ("tie", "ascending")])
        found = texts(self.table.column("text").combine_chunks())
        hashes = hash_table()
        rows = [values(t, hashes, np.uint64) for t in found]
        self.words = [t.split() for t in found] if texts_too else None
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.h = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
        self.n, self.buckets = words, buckets
        self.chunk = self.table.column("chunk")[0].as_py()
        self.rank = self.table.column("rank")[0].as_py()
        # Rows of one doc_id share a number, as they are one document.
        ids = self.table.column("doc_id").combine_chunks()
        fresh = [True] + [a != b for a, b in zip(ids[1:].to_pylist(), ids[:-1].to_pylist())]
        self.number = np.cumsum(fresh) - 1
        row = np.repeat(np.arange(len(rows)), self.sizes)
        last = len(self.h) - words + 1
        self.at = np.flatnonzero(row[: max(last, 0)] == row[words - 1:]) if last > 0 else np.zeros(0, np.int64)
        self.row = row[self.at]

    def halves(self) -> Entries:
        """The smallest run of half a window's words in every window."""
        half = (self.n + 1) // 2
        self.least = _sliding_least(_windows(self.h, half, FACTORS[0]), self.n - half + 1)[self.at] if len(self.at) else self.h[:0]
        return Entries(self.least, self.buckets)

    def candidates(self, halves: Entries, replies: pa.Table) -> Entries:
        """Windows whose smallest run another document has, and whole documents."""
        low, high = halves.spread(self.number[self.row])
        alive = (halves.answered(replies, 2)[:, 1] | (low != high))[halves.of] if len(self.at) else np.zeros(0, bool)
        self.at, self.row = self.at[alive], self.row[alive]
        if len(self.at):
            self.hash = _windows(self.h, self.n, FACTORS[1])[self.at]
            dealt = _windows(self.h, self.n, FACTORS[2])[self.at]
        else:
            self.hash = dealt = self.h[:0]
        whole = self.whole()
        return Entries(np.concatenate([self.hash, whole]), self.buckets, np.concatenate([dealt, whole * COPY]))

    def whole(self) -> np.ndarray:
        """A hash of all words of each document."""
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.h * _powers(FACTORS[0], len(self.h)), dtype=np.uint64)])
        part = (sums[self.starts + self.sizes] - sums[self.starts])
        part = part * _powers(np.uint64(pow(int(FACTORS[0]), -1, 1 << 64)), len(self.h) + 1)[self.starts]
        return mixed(part ^ (self.sizes.astype(np.uint64) * COPY))


def _dealt(docs: DataFrame, chunk_bytes, bucket_bytes):
    """Documents with chunk, rank and tie; chunks are ranges of doc_id, so rank orders them."""
    chunks, buckets = sizes(docs, chunk_bytes, bucket_bytes)
    bounds = id_bounds(docs, chunks)
    key = F.col("doc_id").cast("bigint")
    spread = F.pmod(F.xxhash64("text"), F.lit(chunks)).cast("int") + len(bounds) + 1
    place = range_of(key, bounds).cast("int")
    return docs.select(
        F.when(key.isNull(), spread).otherwise(place).alias("chunk"),
        F.when(key.isNull(), -1).otherwise(place).cast("bigint").alias("rank"),
        key.alias("doc_id"), F.xxhash64("text").alias("tie"), "text"), buckets


STATE = "chunk int, rank bigint, places binary, hashes binary"
RESULT = "chunk int, row int, doc_id bigint, n_words bigint, n_removed bigint, kept string, copied boolean"


def _first_level(docs: DataFrame, words: int, *task_bytes):
    """Per document its kept text, and per chunk the repeated windows, from one deal of the texts."""
    dealt, buckets = _dealt(docs, *task_bytes)

    def ask_halves(table):
        chunk = Chunk(table, words, buckets)
        return ask(chunk.halves(), chunk.chunk, chunk.rank, HALF_BYTES)

    def ask_windows(table, replies):
        chunk = Chunk(table, words, buckets)
        return ask(chunk.candidates(chunk.halves(), replies), chunk.chunk, chunk.rank, WINDOW_BYTES)

    def finish(table, replies):
        chunk = Chunk(table, words, buckets, texts_too=True)
        first = pc.equal(replies.column("level"), 0)
        entries = chunk.candidates(chunk.halves(), replies.filter(first))
        return _cut(chunk, entries, entries.answered(replies.filter(pc.invert(first)), 2))

    by_chunk = dealt.groupBy("chunk")
    halves = by_chunk.applyInArrow(ask_halves, ASK).groupBy("bucket").applyInArrow(judge(HALF_BYTES), REPLY)
    windows = by_chunk.cogroup(halves.groupBy("chunk")).applyInArrow(ask_windows, ASK)
    windows = windows.groupBy("bucket").applyInArrow(judge(WINDOW_BYTES), REPLY)
    replies = halves.withColumn("level", F.lit(0)).unionByName(windows.withColumn("level", F.lit(1)))
    both = by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(
        finish, f"{RESULT}, places binary, hashes binary, rank bigint")
    return both


def _cut(chunk: Chunk, entries: Entries, bits: np.ndarray) -> pa.Table:
    n, docs = len(chunk.at), len(chunk.sizes)
    number = np.concatenate([chunk.number[chunk.row], chunk.number])
    low, high = entries.spread(number)
    late = bits[entries.of, 0] | (low[entries.of] < number)
    repeated = bits[entries.of, 1] | (low != high)[entries.of]
    # Words covered by a late window.
    cover = np.zeros(len(chunk.h) + 1, np.int64)
    np.add.at(cover, chunk.at[late[:n]], 1)
    np.add.at(cover, chunk.at[late[:n]] + chunk.n, -1)
    gone = np.cumsum(cover)[:-1] > 0
    kept = []
    for words, start in zip(chunk.words, chunk.starts):
        mask = gone[start: start + len(words)]
        kept.append(b" ".join(words if not mask.any() else [w for w, g in zip(words, mask) if not g]).decode(errors="replace"))
    total = np.concatenate([[0], np.cumsum(gone)])
    removed = total[chunk.starts + chunk.sizes] - total[chunk.starts]
    # A later copy of a whole document needs no further levels; both copies repeat from end to end.
    copy_late, copied = late[n:], repeated[n:]
    goes_on = repeated[:n] & ~copy_late[chunk.row]
    places = (chunk.row[goes_on] << 32) | (chunk.at[goes_on] - chunk.starts[chunk.row[goes_on]])
    blobs = _state(places, chunk.hash[goes_on])
    return pa.table({
        "chunk": pa.array([chunk.chunk] * (docs + 1), pa.int32()), "row": pa.array([*range(docs), None], pa.int32()),
        "doc_id": pa.array([*chunk.table.column("doc_id").to_pylist(), None], pa.int64()),
        "n_words": pa.array([*chunk.sizes.tolist(), None], pa.int64()),
        "n_removed": pa.array([*removed.tolist(), None], pa.int64()), "kept": pa.array([*kept, None], pa.string()),
        "copied": pa.array([*copied.tolist(), None], pa.bool_()),
        "places": pa.array([None] * docs + [blobs[0]], pa.binary()), "hashes": pa.array([None] * docs + [blobs[1]], pa.binary()),
        "rank": pa.array([chunk.rank] * (docs + 1), pa.int64())})


def _state(places, hashes):
    """Places as steps, which compress well, and hashes."""
    return np.diff(places, prepend=0).tobytes(), hashes.astype(np.uint64).tobytes()


def _extended(places: bytes, hashes: bytes, size: int):
    """Windows of twice the size: those whose two halves are both repeated."""
    at, h = np.cumsum(np.frombuffer(places, np.int64)), np.frombuffer(hashes, np.uint64)
    if not len(at):
        return at, h
    other = np.searchsorted(at, at + size)
    good = np.flatnonzero((other < len(at)) & (at[np.minimum(other, len(at) - 1)] == at + size))
    return at[good], mixed(h[good] * FACTORS[0] + mixed(h[other[good]]) * FACTORS[1] + np.uint64(size))


def _next_level(state: DataFrame, size: int, buckets: int) -> DataFrame:
    """State of the windows of ``2 * size`` words that are repeated."""

    def ask_level(table):
        at, h = _extended(table.column("places")[0].as_py(), table.column("hashes")[0].as_py(), size)
        return ask(Entries(h, buckets), table.column("chunk")[0].as_py(), table.column("rank")[0].as_py(), LEVEL_BYTES)

    def survive(table, replies):
        at, h = _extended(table.column("places")[0].as_py(), table.column("hashes")[0].as_py(), size)
        entries = Entries(h, buckets)
        low, high = entries.spread(at >> 32)
        stay = (entries.answered(replies, 2)[:, 1] | (low != high))[entries.of]
        places, hashes = _state(at[stay], h[stay])
        return table.select(["chunk", "rank"]).append_column("places", pa.array([places], pa.binary())).append_column(
            "hashes", pa.array([hashes], pa.binary()))

    by_chunk = state.groupBy("chunk")
    replies = by_chunk.applyInArrow(ask_level, ASK).groupBy("bucket").applyInArrow(judge(LEVEL_BYTES), REPLY)
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(survive, STATE)


def _rows_alive(batches):
    """The documents that still have a window, one row each."""
    for batch in batches:
        for chunk, places in zip(batch.column("chunk").to_pylist(), batch.column("places").to_pylist()):
            rows = np.unique(np.cumsum(np.frombuffer(places, np.int64)) >> 32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk] * len(rows), pa.int32()), pa.array(rows, pa.int32())], names=["chunk", "row"])


def dedup(docs: DataFrame, words=WORDS, keep=lambda kept: [kept.alias("text")],
          chunk_bytes=CHUNK_BYTES, bucket_bytes=BUCKET_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, longest, and what ``keep`` makes of the kept text.

    ``longest`` is the length in words of the last level at which the document has a repeated window:
    ``words``, twice that, and so on; 0 if it has none. ``chunk_bytes`` and ``bucket_bytes`` bound the
    text that one task holds.
    """
    spark = docs.sparkSession
    both = _first_level(docs, words, chunk_bytes, bucket_bytes)
    path = work_dir(spark, "windows")
    both.select(*[c for c in both.columns if c != "kept"], *keep(F.col("kept"))).write.parquet(path)
    first = spark.read.parquet(path)
    state = first.where("row is null").select("chunk", "rank", "places", "hashes").where(F.octet_length("places") > 0)
    size, alive = words, None
    while left := state.agg(F.sum(F.octet_length("places"))).first()[0]:
        rows = state.select("chunk", "places").mapInArrow(_rows_alive, "chunk int, row int").withColumn("size", F.lit(size))
        alive = rows if alive is None else alive.unionByName(rows)
        path = work_dir(spark, "windows")
        buckets = -(-left // (8 * LEVEL_ENTRIES))  # a place is 8 bytes
        _next_level(state, size, buckets).where(F.octet_length("places") > 0).write.parquet(path)
        state, size = spark.read.parquet(path), 2 * size
    rows = first.where("row is not null").drop("places", "hashes", "rank")
    longest = F.lit(0)
    if alive is not None:
        rows = rows.join(alive.groupBy("chunk", "row").agg(F.max("size").alias("size")), ["chunk", "row"], "left")
        longest = F.coalesce("size", F.lit(0))
    # A copied document repeats whole: the last level that fits in it.
    full = F.floor(F.log2(F.col("n_words") / words) + 1e-9)
    whole = F.when(F.col("copied") & (F.col("n_words") >= words), (F.lit(words) * F.pow(F.lit(2.0), full)).cast("bigint"))
    return rows.withColumn("longest", F.coalesce(whole, longest.cast("bigint"))).drop("chunk", "row", "copied", "size")

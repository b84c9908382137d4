"""Corpus-wide questions about the words of documents, asked in chunks and answered in buckets.

A chunk is some documents; it asks about each of its distinct values once. Values are dealt to buckets
by hash; a bucket sees all chunks that ask about a value and answers each in the order it was asked.
Rows are packed: one for each chunk and bucket, so that a value costs its bytes and not a row, and a
value that every document has costs one entry a chunk.

The numbers of chunks and buckets follow from the bytes of text: small ones while there are few, then
as many as keep each at a size that a task can hold. Larger tasks may hold more: a chunk and a bucket
exchange a row, so for a hundred terabytes half a gigabyte each is better than the default.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIX = np.uint64(0xD6E8FEB86659FD93)
CHUNK_BYTES, BUCKET_BYTES = 32 << 20, 32 << 20
SMALL_CHUNK, SMALL_BUCKET, MANY = 1 << 20, 2 << 20, 512


def parts(total: int, small: int, large: int) -> int:
    return max(1, -(-total // large), min(-(-total // small), MANY))


def sizes(docs: DataFrame, chunk_bytes=CHUNK_BYTES, bucket_bytes=BUCKET_BYTES) -> tuple[int, int]:
    """Numbers of chunks and buckets for the texts of ``docs``."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return parts(total, SMALL_CHUNK, chunk_bytes), parts(total, SMALL_BUCKET, bucket_bytes)


def id_bounds(docs: DataFrame, n: int) -> list:
    """Ids that part the documents into about ``n`` ranges with as many rows."""
    if n < 2:
        return []
    found = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 4 * n)).first()[0]
    return sorted(set(found or []))


def range_of(value: Column, bounds: list) -> Column:
    """The number of bounds up to a value, looked up in two steps of about a square root each."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i: i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(g[0]).cast("bigint") for g in groups])
    tails = F.array(*[F.array(*[F.lit(b).cast("bigint") for b in g]) for g in groups])
    group = F.size(F.filter(heads, lambda b: b <= value)) - 1
    inside = F.size(F.filter(F.get(tails, group), lambda b: b <= value))
    return F.when(group < 0, 0).otherwise(group * step + inside).cast("int")


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * MIX
    return values ^ (values >> np.uint64(29))


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((mixed(values) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of each value, a row each."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width]


def unpack(blobs: list, width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view(np.uint64).reshape(-1)


class Entries:
    """The distinct values that a chunk asks about, in the order of buckets.

    ``of`` gives the entry of every value that went in; ``bounds`` part the entries by bucket.
    """

    def __init__(self, values: np.ndarray, buckets: int, dealt_by=None):
        distinct, first, inverse = np.unique(values, return_index=True, return_inverse=True)
        bucket = bucket_of(distinct if dealt_by is None else dealt_by[first], buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.values, self.of = distinct[order], place[inverse.reshape(-1)]
        self.bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))

    def filled(self):
        """(bucket, start, stop) of the buckets with entries."""
        full = np.flatnonzero(np.diff(self.bounds))
        return [(int(b), self.bounds[b], self.bounds[b + 1]) for b in full]

    def spread(self, ranks: np.ndarray):
        """Smallest and largest rank among the values of each entry."""
        low = np.full(len(self.values), np.iinfo(np.int64).max)
        high = np.full(len(self.values), np.iinfo(np.int64).min)
        np.minimum.at(low, self.of, ranks)
        np.maximum.at(high, self.of, ranks)
        return low, high

    def answered(self, replies: pa.Table, width=1) -> np.ndarray:
        """Bits of the replies to this chunk, a row of ``width`` for each entry."""
        out = np.zeros((len(self.values), width), bool)
        for bucket, bits in zip(replies.column("bucket").to_pylist(), replies.column("bits").to_pylist()):
            start, stop = self.bounds[bucket], self.bounds[bucket + 1]
            flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(stop - start) * width)
            out[start:stop] = flags.reshape(-1, width)
        return out


ASK = "bucket int, chunk int, rank bigint, data binary"
REPLY = "chunk int, bucket int, bits binary"


def ask(entries: Entries, chunk: int, rank: int, width: int) -> pa.Table:
    filled = entries.filled()
    rows = pack(entries.values, width)
    return pa.table({
        "bucket": pa.array([b for b, _, _ in filled], pa.int32()),
        "chunk": pa.array([chunk] * len(filled), pa.int32()),
        "rank": pa.array([rank] * len(filled), pa.int64()),
        "data": pa.array([rows[i:j].tobytes() for _, i, j in filled], pa.binary())})


def judge(width: int):
    """Two bits for each entry of a bucket: some chunk of smaller rank has it; another chunk has it."""

    def run(table: pa.Table) -> pa.Table:
        blobs = table.column("data").to_pylist()
        counts = np.array([len(b) // width for b in blobs])
        values = unpack(blobs, width)
        rank = np.repeat(table.column("rank").to_numpy(), counts)
        order = np.argsort(values, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], values[order][1:] != values[order][:-1]]))
        size = np.diff(np.append(starts, len(values)))
        least = np.minimum.reduceat(rank[order], starts)
        bits = np.empty((len(values), 2), bool)
        bits[order, 0] = np.repeat(least, size) < rank[order]
        bits[order, 1] = np.repeat(size > 1, size)
        cuts = np.cumsum(counts)[:-1]
        return pa.table({
            "chunk": table.column("chunk"), "bucket": table.column("bucket"),
            "bits": pa.array([np.packbits(x).tobytes() for x in np.split(bits, cuts)], pa.binary())})

    return run

"""Language-model scoring by cross-entropy difference.

Two bigram models share one vocabulary, the words of all documents: one of the target documents, one
of the background, that is all others. A document is words between two end marks ``E``; its loss under
a model X is the mean of -log p_X over its words and the last mark, and its score is the loss under the
target model less that under the background model: the lower, the more it is like the target. With
counts c_X and N_X the sum of them over single words,

    p(w)      = c(w) / N                                     all documents: the vocabulary
    p_X(w)    = (c_X(w) + MU p(w)) / (N_X + MU)
    p_X(w|v)  = (c_X(vw) + NU p_X(w)) / (c_X(v) + NU)

A document's own counts are left out of its model, so that it is never scored by itself.

The counts of all documents are summed in buckets, and each chunk of documents is told the totals of
its own words and pairs; nothing is capped, sampled or collected. Words and pairs are told apart by 40
bits of a hash within a bucket: at half a million entries a bucket, one in two million shares its count
with another.

Defined results: a null text, or one without words, has no losses and no score (null) and takes no
part; a label of a document that does not exist is ignored, repeated labels count once; repeated rows
are documents of their own, each leaving out only itself; without any target document both models
differ by the background's counts alone; an empty table gives no rows; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from printfold.llm.chunks import BUCKET_BYTES, CHUNK_BYTES, MIX, Entries, mixed, pack, sizes
from printfold.llm.words import hash_table, texts, values

MU, NU = 1000.0, 10.0
BYTES = 5
END, ALL = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
ASK = "bucket int, chunk int, data binary, target binary, background binary"
REPLY = "chunk int, bucket int, target binary, background binary"


def _planes(values: np.ndarray, width: int) -> bytes:
    """Values byte by byte, the low bytes of all first: what is zero or sorted packs well."""
    return np.ascontiguousarray(pack(values.astype(np.uint64), width).T).tobytes()


def _from_planes(blob: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(blob) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8).reshape(width, -1).T
    return out.view(np.uint64).reshape(-1)


def _packed(counts: np.ndarray) -> bytes:
    """Counts of which many are zero: a bit for each, then the others in as few bytes as they need."""
    some = counts[counts > 0]
    width = (int(some.max(initial=1)).bit_length() + 7) // 8
    return np.packbits(counts > 0).tobytes() + bytes([width]) + _planes(some, width)


def _counts(blob: bytes, n: int) -> np.ndarray:
    cut = (n + 7) // 8
    out = np.zeros(n, np.int64)
    out[np.unpackbits(np.frombuffer(blob, np.uint8, cut), count=n).astype(bool)] = _from_planes(blob[cut + 1:], blob[cut])
    return out


class Chunk:
    """Documents of a chunk with the words and pairs they ask about."""

    def __init__(self, table: pa.Table, buckets: int):
        labels = table.filter(table.column("target"))
        wanted = set(labels.column("doc_id").to_pylist()) - {None}
        self.table = table.filter(pc.invert(table.column("target"))).sort_by(
            [("doc_id", "ascending"), ("tie", "ascending")])
        hashes = hash_table()
        rows = [values(t, hashes, np.uint64) for t in texts(self.table.column("text").combine_chunks())]
        self.target = np.array([i in wanted for i in self.table.column("doc_id").to_pylist()], bool)
        self.n_words = np.array([len(r) for r in rows], np.int64)
        self.row = np.repeat(np.arange(len(rows)), np.where(self.n_words, self.n_words + 1, 0))
        end = np.array([END])
        word = np.concatenate([self._or_none(r, end) for r in rows] or [end[:0]])
        before = np.concatenate([self._or_none(r, end, first=True) for r in rows] or [end[:0]])
        pair = mixed(before * MIX + mixed(word))
        n = len(word)
        self.entries = Entries(np.concatenate([mixed(word), mixed(before), pair, mixed(np.array([ALL]))]), buckets)
        of = self.entries.of
        self.word, self.before, self.pair, self.all = of[:n], of[n: 2 * n], of[2 * n: 3 * n], of[3 * n]
        self.own = self._sums(self.target[self.row]), self._sums(~self.target[self.row])

    @staticmethod
    def _or_none(r, end, first=False):
        if not len(r):
            return r
        return np.concatenate([end, r] if first else [r, end])

    def _sums(self, mask) -> np.ndarray:
        """Counts of this chunk's entries in one of the two corpora."""
        n = len(self.entries.values)
        out = np.bincount(self.word[mask], minlength=n) + np.bincount(self.pair[mask], minlength=n)
        out[self.all] = mask.sum()
        return out

    def within(self, entry) -> np.ndarray:
        """For each place, how often its document has this entry."""
        key = entry * np.int64(len(self.n_words)) + self.row
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        return counts[inverse.reshape(-1)]


def _ask(table: pa.Table, buckets: int) -> pa.Table:
    chunk = Chunk(table, buckets)
    filled = chunk.entries.filled()
    # The high bytes, as the values of a bucket are sorted.
    data, (target, background) = chunk.entries.values >> np.uint64(64 - 8 * BYTES), chunk.own
    return pa.table({
        "bucket": pa.array([b for b, _, _ in filled], pa.int32()),
        "chunk": pa.array([table.column("chunk")[0].as_py()] * len(filled), pa.int32()),
        "data": pa.array([_planes(data[i:j], BYTES) for _, i, j in filled], pa.binary()),
        "target": pa.array([_packed(target[i:j]) for _, i, j in filled], pa.binary()),
        "background": pa.array([_packed(background[i:j]) for _, i, j in filled], pa.binary())})


def _add(table: pa.Table) -> pa.Table:
    """For each entry of a bucket what all other chunks have counted."""
    blobs = table.column("data").to_pylist()
    lengths = [len(b) // BYTES for b in blobs]
    cuts = np.cumsum(lengths)[:-1]
    found = np.concatenate([_from_planes(b, BYTES) for b in blobs])
    order = np.argsort(found, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], found[order][1:] != found[order][:-1]]))
    size, out = np.diff(np.append(starts, len(found))), {}
    for name in ("target", "background"):
        own = np.concatenate([_counts(b, n) for b, n in zip(table.column(name).to_pylist(), lengths)])
        total = np.empty_like(own)
        total[order] = np.repeat(np.add.reduceat(own[order], starts), size)
        out[name] = pa.array([_packed(x) for x in np.split(total - own, cuts)], pa.binary())
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), **out})


def _score(table: pa.Table, replies: pa.Table, buckets: int) -> pa.Table:
    chunk = Chunk(table, buckets)
    totals = [x.astype(np.float64) for x in chunk.own]
    names = replies.column("bucket").to_pylist()
    for side, total in zip(("target", "background"), totals):
        for bucket, blob in zip(names, replies.column(side).to_pylist()):
            start, stop = chunk.entries.bounds[bucket], chunk.entries.bounds[bucket + 1]
            total[start:stop] += _counts(blob, stop - start)
    own = [chunk.within(x) for x in (chunk.word, chunk.before, chunk.pair)]
    size = np.where(chunk.n_words, chunk.n_words + 1, 0)
    shared = (totals[0] + totals[1])[chunk.word] / max(sum(t[chunk.all] for t in totals), 1.0)
    losses = []
    for total, mine in zip(totals, (chunk.target, ~chunk.target)):
        out = mine[chunk.row]
        word, before, pair = (total[x] - out * o for x, o in zip((chunk.word, chunk.before, chunk.pair), own))
        single = (word + MU * shared) / (total[chunk.all] - out * size[chunk.row] + MU)
        loss = -np.log((pair + NU * single) / (before + NU))
        losses.append(np.bincount(chunk.row, loss, minlength=len(size)) / np.maximum(size, 1))
    some = chunk.n_words > 0
    value = lambda x: pa.array(x, pa.float64(), mask=~some)
    return pa.table({
        "doc_id": chunk.table.column("doc_id"), "n_words": pa.array(chunk.n_words),
        "target_loss": value(losses[0]), "background_loss": value(losses[1]), "score": value(losses[0] - losses[1])})


def score(docs: DataFrame, target: DataFrame, chunk_bytes=CHUNK_BYTES, bucket_bytes=BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, score) of every row of (doc_id, text).

    ``target`` has the doc_id of the documents whose like is wanted. ``chunk_bytes`` and ``bucket_bytes``
    bound the text that one task holds.
    """
    chunks, buckets = sizes(docs, chunk_bytes, bucket_bytes)
    key = F.col("doc_id").cast("bigint")
    # Labels go where their document is; documents without an id spread by their text.
    place = F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")
    rows = docs.select(
        F.when(key.isNull(), F.pmod(F.xxhash64("text"), F.lit(chunks)).cast("int")).otherwise(place).alias("chunk"),
        key.alias("doc_id"), F.xxhash64("text").alias("tie"), "text", F.lit(False).alias("target"))
    wanted = target.where("doc_id is not null").select(key.alias("doc_id")).distinct().select(
        place.alias("chunk"), "doc_id", F.lit(0).cast("bigint").alias("tie"), F.lit(None).cast("string").alias("text"),
        F.lit(True).alias("target"))
    by_chunk = rows.unionByName(wanted).groupBy("chunk")
    replies = (
        by_chunk.applyInArrow(lambda t: _ask(t, buckets), ASK).groupBy("bucket").applyInArrow(_add, REPLY))
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(
        lambda t, r: _score(t, r, buckets),
        "doc_id bigint, n_words bigint, target_loss double, background_loss double, score double")

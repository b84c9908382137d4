"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of shingles of ``WORDS`` words (a shorter text is one shingle); two are linked when
the Jaccard similarity of their sets is at least ``THRESHOLD``.

1. Documents of one set are one class, found by a hash of the set; all else runs on classes.
2. Classes whose MinHash values agree in a band of ``ROWS`` values are candidates. Each bucket of a
   band compares MinHash values a few at a time and drops a pair once the posterior probability that
   its similarity reaches the threshold falls below ``TOLERANCE``. A bucket returns a spanning tree of
   what is left; the trees' components hold every surviving pair.
3. Within a component every pair is pruned the same way once more, and what is left is verified on the
   whole shingle sets. Link counts are exact sums; classes are components of verified links.

Buckets and components above a size are parted into blocks, and every pair of blocks is a task's work
of its own, so that a group of any size stays in bounded memory and no pair becomes a row.

A pair at the threshold shares no band with probability 5e-8.

Defined results: a null, empty or blank text has no shingles and is a class of its own row; equal texts
and repeated rows are one class; a class is named by its smallest doc_id (null if it has none but
null); ties need no order; an empty table gives no rows; other columns are ignored.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from printfold.llm.components import components
from printfold.llm.words import Table, slices, texts, values
from printfold.session import in_files, work_dir

WORDS, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
BANDS, ROWS, STEP = 32, 4, 16
HASHES = BANDS * ROWS
SKETCH_ROWS = 4096  # of a block of sketches, a few hundred bytes each
BLOCK_ROWS, BLOCK_CHARS = 512, 4_000_000  # of a block of whole texts
CHUNK_BYTES, TABLE_WORDS = 2 << 20, 100_000
FILE_ROWS, FILE_TEXTS = 10_000, 2_000  # of classes and of whole texts in a file
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _numbers(name: bytes, n: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(name, seed=i) | 1 for i in range(n)], np.uint64)


FACTORS, TERMS = _numbers(b"factor", HASHES), _numbers(b"term", HASHES)
PLACES = _numbers(b"place", WORDS)


def hash_table():
    return Table(xxhash.xxh3_64_intdigest, TABLE_WORDS)


def shingles(text: bytes, table) -> np.ndarray:
    """Distinct shingle hashes of a text, sorted."""
    h = values(text, table, np.uint64)
    n = max(len(h) - WORDS + 1, 1 if len(h) else 0)
    total = np.zeros(n, np.uint64)
    for place in range(min(WORDS, len(h))):
        part = (h[place: place + n] + PLACES[place]) * MULTIPLIER
        total = (total ^ (total >> np.uint64(31))) * PLACES[place] + (part ^ (part >> np.uint64(29)))
    total *= MULTIPLIER
    return np.unique(total ^ (total >> np.uint64(32)))


def signatures(sets: list) -> np.ndarray:
    """MinHash values, 16 bits each, a row for each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out = np.empty((len(sets), HASHES), np.uint16)
    for i in range(HASHES):
        least = np.minimum.reduceat(flat * FACTORS[i] + TERMS[i], starts)
        out[:, i] = (least * MULTIPLIER) >> np.uint64(48)
    return out


def _enough(threshold=THRESHOLD, tolerance=TOLERANCE) -> dict:
    """For each number of compared values, the matches that leave a pair in the race.

    With a flat prior the posterior of the similarity is a beta distribution, and the chance that it is
    at least the threshold is the chance of at most m heads in n + 1 throws of that coin.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        chance = 0.0
        for m in range(n + 1):
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if chance >= tolerance:
                break
        out[n] = m
    return out


ENOUGH = _enough()


def survivors(signature: np.ndarray, others: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Those of ``rows`` of ``others`` that stay in the race against one signature."""
    matches = np.zeros(len(rows), np.int64)
    for n, enough in ENOUGH.items():
        if not len(rows):
            break
        matches += (others[rows, n - STEP: n] == signature[n - STEP: n]).sum(1)
        stay = matches >= enough
        rows, matches = rows[stay], matches[stay]
    return rows


class Forest:
    """Union-find over the rows of a block; the smaller root wins."""

    def __init__(self, n):
        self.up = np.arange(n)

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def roots(self):
        while True:
            higher = self.up[self.up]
            if (higher == self.up).all():
                return self.up
            self.up = higher

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


# --- 1. sketches and classes ------------------------------------------------------------------


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, node, check, sketch) of every row; the last three are null without words."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(_sketch, f"doc_id {id_type}, text_key bigint, chars bigint, node bigint, check bigint, sketch binary")


def _sketch(batches):
    table = hash_table()
    for batch in batches:
        for part in slices(batch, "text", CHUNK_BYTES):
            found = texts(part.column("text"))
            sets = [shingles(t, table) for t in found]
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full) if full else ())
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            node, check = ([int.from_bytes(k[i: i + 8], "little", signed=True) if k else None for k in keys] for i in (0, 8))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(map(len, found), pa.int64()),
                 pa.array(node, pa.int64()), pa.array(check, pa.int64()),
                 pa.array([next(rows).tobytes() if k else None for k in keys], pa.binary())],
                names=["doc_id", "text_key", "chars", "node", "check", "sketch"])


def classes(sketched: DataFrame) -> DataFrame:
    """One row per distinct set: (node, copies, keeper, chars, sketch); keeper is its first document."""
    return sketched.where("node is not null").groupBy("node", "check").agg(
        F.count("*").alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("keeper"),
        F.max("chars").alias("chars"), F.first("sketch").alias("sketch"))


# --- 2. candidates ----------------------------------------------------------------------------


def candidate_edges(found: DataFrame) -> DataFrame:
    """(a, b) spanning edges of the pairs that survive in some bucket."""
    size = 2 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substr(F.col("sketch"), b * size + 1, F.lit(size))))
    bands = found.select("node", F.explode(keys).alias("key"))
    # Buckets with the same members, as two hashes tell, are compared once.
    buckets = bands.groupBy("key").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(2))).alias("y")).where("members > 1")
    buckets = buckets.groupBy("members", "x", "y").agg(F.min("key").alias("key")).select("key", "members")
    rows = bands.join(buckets, "key").join(found.select("node", "sketch"), "node")
    blocks = in_blocks(rows, "key", F.ceil(F.col("members") / F.lit(SKETCH_ROWS)), "node", "sketch")
    return blocks.mapInArrow(_prune, "a bigint, b bigint")


def in_blocks(rows: DataFrame, group: str, blocks, *columns) -> DataFrame:
    """Rows of a group dealt to blocks, once for every pair of blocks; pairs are whole in a partition.

    The number of blocks is a power of two, so that groups of like members have the same blocks, and rows
    are sorted by node, so that trees have the smallest node as root: buckets of like members return
    the same edges.
    """
    n = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(blocks, F.lit(1))))).cast("int")
    dealt = rows.withColumn("_n", n).withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("_n")).cast("int"))
    pairs = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    keys = [F.col(group).alias("grp"), F.least("own", "_other").alias("low"), F.greatest("own", "_other").alias("high")]
    return pairs.select(*keys, "own", *columns).repartition("grp", "low", "high").sortWithinPartitions("grp", "low", "high", "node")


def _groups(batches):
    """Whole groups of rows of equal (grp, low, high), as tables."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "low", "high")], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        if held and (held[-1][1] != keys[0]).any():
            yield pa.Table.from_batches([b for b, _ in held])
            held = []
        for start, stop in zip([0, *cuts], [*cuts, len(keys)]):
            held.append((batch.slice(start, stop - start), keys[stop - 1]))
            if stop < len(keys):
                yield pa.Table.from_batches([b for b, _ in held])
                held = []
    if held:
        yield pa.Table.from_batches([b for b, _ in held])


def _partners(own, low, high):
    """For each row the later rows it is to be paired with, in this pair of blocks."""
    n = len(own)
    if low == high:
        return ((a, np.arange(a + 1, n)) for a in range(n))
    right = np.flatnonzero(own == high)
    return ((a, right) for a in np.flatnonzero(own == low))


def _prune(batches):
    out = []
    for group in _groups(batches):
        nodes = group.column("node").to_numpy()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        prints = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint16).reshape(-1, HASHES)
        forest = Forest(len(nodes))
        for a, others in _partners(group.column("own").to_numpy(), low, high):
            # A pair already in one tree needs no edge.
            for b in survivors(prints[a], prints, others[forest.roots()[others] != forest.root(a)]):
                forest.join(a, b)
        roots = forest.roots()
        out += zip(nodes[roots != np.arange(len(nodes))].tolist(), nodes[roots[roots != np.arange(len(nodes))]].tolist())
        if len(out) > 10_000:
            yield _edges(out)
            out = []
    yield _edges(out)


def _edges(pairs):
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


# --- 3. verification --------------------------------------------------------------------------


def verified(docs: DataFrame, found: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, root, links): a verified spanning edge and the linked documents in one pair of blocks."""
    members = found.select("node", "copies", "chars", F.col("keeper.text_key").alias("text_key")).join(labels, "node")
    sizes = members.groupBy("label").agg(F.count("*").alias("members"), F.sum("chars").alias("all_chars"))
    whole = docs.select("text", F.xxhash64("text").alias("text_key")).groupBy("text_key").agg(F.first("text").alias("text"))
    rows = members.join(sizes, "label").join(whole, "text_key")
    parts = F.ceil(F.greatest(F.col("members") / F.lit(BLOCK_ROWS), F.col("all_chars") / F.lit(BLOCK_CHARS)))
    blocks = in_blocks(rows, "label", parts, "node", "copies", "text")
    return blocks.mapInArrow(_verify, "node bigint, root bigint, links bigint")


def _verify(batches):
    table = hash_table()
    for group in _groups(batches):
        nodes, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        sets = [shingles(t, table) for t in texts(group.column("text").combine_chunks())]
        prints, sizes = signatures(sets), np.array([len(s) for s in sets])
        flat = np.unique(np.concatenate(sets), return_inverse=True)[1].reshape(-1)
        ends = np.cumsum(sizes)
        here = np.zeros(int(flat.max()) + 1, bool)
        forest, links = Forest(len(nodes)), np.zeros(len(nodes), np.int64)
        for a, others in _partners(group.column("own").to_numpy(), low, high):
            others = survivors(prints[a], prints, others)
            if not len(others):
                continue
            mine = flat[ends[a] - sizes[a]: ends[a]]
            here[mine] = True
            for part in np.array_split(others, int(sizes[others].sum()) // 4_000_000 + 1):
                theirs = sizes[part]
                at = np.arange(theirs.sum()) + np.repeat(ends[part] - np.cumsum(theirs), theirs)
                both = np.add.reduceat(here[flat[at]].astype(np.int64), np.cumsum(theirs) - theirs) if len(part) else theirs
                # In whole numbers, so that a pair at the threshold is linked.
                linked = part[both * 1000 >= round(THRESHOLD * 1000) * (sizes[a] + theirs - both)]
                links[a] += copies[linked].sum()
                links[linked] += copies[a]
                for b in linked:
                    forest.join(a, b)
            here[mine] = False
        used = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[used]), pa.array(nodes[forest.roots()[used]]), pa.array(links[used])], names=["node", "root", "links"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row per document: (doc_id, text_key, class_id, n_links, keeps).

    ``n_links`` counts the other documents linked to it, copies too. ``keeps`` is true for the document
    a class is named by (every row of that doc_id and text).
    """
    spark = docs.sparkSession
    sketched = _written(spark, sketches(docs))
    n = sketched.count()
    found = _written(spark, in_files(classes(sketched), n, FILE_ROWS))
    labels = components(candidate_edges(found), n)
    checked = _written(spark, in_files(verified(docs, found, labels), n, FILE_ROWS, moved=True))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    final = components(checked.select(F.col("node").alias("a"), F.col("root").alias("b")), n)
    named = found.join(final, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = named.groupBy("label").agg(F.min("keeper").alias("first"))
    named = named.join(first, "label").join(links, "node", "left").select(
        "node", "check", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    rows = sketched.drop("sketch", "chars").join(named, ["node", "check"], "left")
    alone = F.col("node").isNull()
    keeps = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    return rows.select(
        "doc_id", "text_key", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), (alone | keeps).alias("keeps"))


def _written(spark, df: DataFrame) -> DataFrame:
    path = work_dir(spark, "jaccard")
    df.write.parquet(path)
    return spark.read.parquet(path)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each class, and those without words.

    Of repeated rows of one doc_id and text, one stays.
    """
    keys = near_duplicates(docs).where("keeps").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    rows = docs.withColumn("_key2", F.xxhash64("text"))
    kept = rows.join(keys, rows["doc_id"].eqNullSafe(keys["_id"]) & (rows["_key2"] == keys["_key"]), "left_semi")
    return in_files(kept.dropDuplicates(["doc_id", "_key2"]), docs.count(), FILE_TEXTS).select(*docs.columns)

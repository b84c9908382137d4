"""Near-duplicate groups by SuperMinHash signatures, banding, exact verification and union-find.

Documents are sets of shingles of two lower-cased words (a single word is one shingle); two are linked
when 100 * shared >= 80 * all. Groups are the components of links.

1. Every element of a set ranks the registers of a signature by a random permutation of its own; a
   register keeps the least rank and fraction over all elements. As an element gives every register another
   rank, registers differ in what they take and vary less than independent ones. Ranks are dealt from the
   lowest; a set stops once none of its registers holds a higher one. Documents of one set are one class.
2. Signatures agreeing in a band of ``ROWS`` registers share a bucket. Every member is compared with the
   bucket's first one, by signature and then on the whole sets: as many pairs as members.
3. Buckets whose members are not all in one component then: those of the first one's component against the
   others, and the others among themselves, in blocks, by signature.
4. What is left in a component of survivors is verified on whole sets the same way. Pairs within one
   component need no comparison, so a group of near copies costs one comparison a member, and
   only what differs from its first members is compared with all.

No pair becomes a row in steps 3 and 4: a block returns a forest. Blocks have bounded rows and text. Linked
pairs share no band with probability 5e-8, at most.

Defined results: a null, empty or blank text has no shingles and is linked with nothing, not even its like;
equal texts and repeated rows are one class; a component is named by its smallest doc_id (null if it has
none but null); ties need no order; an empty table gives no rows; other columns are ignored.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from printfold.llm.bits import maybe_among
from printfold.llm.components import components
from printfold.llm.jaccard_join import Forest
from printfold.llm.words import Table, slices, texts, values
from printfold.session import work_dir

LINKED = 80  # percent
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
TOLERANCE = 1e-8  # that a linked pair is dropped by its signatures
BAND_BYTES = 6
ELEMENTS = 1 << 16  # ranked at once, a byte for each register
CHUNK_BYTES, TABLE_WORDS = 1 << 20, 100_000
SKETCH_ROWS, BLOCK_ROWS, BLOCK_CHARS = 4096, 1024, 2_000_000  # of a block
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
STEPS = np.arange(1, REGISTERS + 1, dtype=np.uint64) * A


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, table) -> np.ndarray:
    """Distinct shingle hashes of a text, sorted."""
    h = values(text.lower(), table, np.uint64)
    if len(h) < 2:
        return scrambled(h * A)
    return np.unique(scrambled(scrambled(h[:-1] * A) + h[1:] * B))


# --- 1. signatures and classes ----------------------------------------------------------------


def signatures(sets: list) -> np.ndarray:
    """A row of registers for each non-empty set: rank in the high half, fraction in the low one."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    best = np.full((len(sets), REGISTERS), np.iinfo(np.uint64).max)
    for start in range(0, len(flat), ELEMENTS):
        _rank(flat[start: start + ELEMENTS], owner[start: start + ELEMENTS], best)
    return best


def _rank(elements, owner, best):
    """Let elements rank the registers of their sets, as far as any can still take a rank."""
    order = np.tile(np.arange(REGISTERS, dtype=np.uint8), (len(elements), 1))
    row = np.arange(len(elements))
    for rank in range(REGISTERS):
        draw = scrambled(elements[row] + STEPS[rank])
        pick = rank + ((draw >> np.uint64(32)) * np.uint64(REGISTERS - rank) >> np.uint64(32)).astype(np.int64)
        register = order[row, pick]
        order[row, pick] = order[row, rank]
        value = (draw & np.uint64(0xFFFFFFFF)) | np.uint64(rank << 32)
        np.minimum.at(best.reshape(-1), owner[row] * REGISTERS + register, value)
        sets = np.unique(owner[row])
        open_ = np.zeros(len(best), bool)
        open_[sets] = (best[sets].max(1) >> np.uint64(32)) > rank
        row = row[open_[owner[row]]]
        if not len(row):
            return


def enough() -> int:
    """The equal registers below which a linked pair is found with less than ``TOLERANCE``."""
    p, chance = LINKED / 100, 0.0
    for equal in range(REGISTERS + 1):
        chance += math.comb(REGISTERS, equal) * p**equal * (1 - p) ** (REGISTERS - equal)
        if chance >= TOLERANCE:
            return equal


ENOUGH = enough()

SKETCHED = "text_key bigint, chars bigint, n_shingles bigint, node bigint, check bigint, bands binary, sketch binary"


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, chars, n_shingles, node, check, bands, sketch) of every row; the last four are null without words.

    ``bands`` has six bytes for each band, ``sketch`` a byte for each register.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(_sketch, f"doc_id {id_type}, {SKETCHED}")


def _sketch(batches):
    table = Table(xxhash.xxh3_64_intdigest, TABLE_WORDS)
    for batch in batches:
        for part in slices(batch, "text", CHUNK_BYTES):
            found = texts(part.column("text"))
            sets = [shingles(t, table) for t in found]
            full = [s for s in sets if len(s)]
            registers = scrambled(signatures(full) if full else np.empty((0, REGISTERS), np.uint64))
            bands = np.zeros((len(full), BANDS), np.uint64)
            for k in range(ROWS):
                bands = scrambled(bands + registers[:, k::ROWS] * A)
            bands = iter(np.ascontiguousarray(bands.reshape(-1, BANDS, 1).view(np.uint8)[:, :, :BAND_BYTES]))
            sketch = iter((registers >> np.uint64(56)).astype(np.uint8))
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            node, check = ([int.from_bytes(k[i: i + 8], "little", signed=True) if k else None for k in keys] for i in (0, 8))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(map(len, found), pa.int64()),
                 pa.array(map(len, sets), pa.int64()), pa.array(node, pa.int64()), pa.array(check, pa.int64()),
                 *(pa.array([next(x).tobytes() if k else None for k in keys], pa.binary()) for x in (bands, sketch))],
                names=["doc_id", "text_key", "chars", "n_shingles", "node", "check", "bands", "sketch"])
    pa.default_memory_pool().release_unused()  # the worker waits for later stages


def classes(sketched: DataFrame) -> DataFrame:
    """One row per distinct set: (node, check, keeper, chars, bands, sketch); keeper is its first document."""
    return sketched.where("node is not null").groupBy("node", "check").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("keeper"),
        F.max("chars").alias("chars"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))


# --- 2. members against the first of their bucket ---------------------------------------------


def banded(found: DataFrame) -> DataFrame:
    """(key, node) of every band that several nodes share."""
    places = F.sequence(F.lit(0), F.lit(BANDS - 1))
    keys = F.transform(places, lambda b: F.xxhash64(b, F.substr("bands", b * BAND_BYTES + 1, F.lit(BAND_BYTES))))
    bands = found.select("node", F.explode(keys).alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    return bands.join(shared.select("key"), "key", "left_semi")


def bucketed(bands: DataFrame) -> DataFrame:
    """(key, members, first) of the buckets with several members; of buckets with the same ones, one."""
    two = [F.bit_xor(F.xxhash64("node", F.lit(n))).alias(f"x{n}") for n in (1, 2)]
    buckets = bands.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("first"), *two)
    return buckets.where("members > 1").groupBy("members", "x1", "x2").agg(
        F.min("key").alias("key"), F.min("first").alias("first")).select("key", "members", "first")


def near_first(found: DataFrame, bands: DataFrame, buckets: DataFrame) -> DataFrame:
    """(a, b): the first of a bucket and a member whose signatures leave a link possible."""
    pairs = bands.join(buckets.select("key", "first"), "key").where("node <> first").select("first", "node").distinct()
    sketch = found.select(F.col("node").alias("n"), F.col("sketch").alias("s"))
    pairs = pairs.join(sketch.toDF("node", "mine"), "node").join(sketch.toDF("first", "theirs"), "first")
    return pairs.select("first", "node", "mine", "theirs").mapInArrow(_likely, "a bigint, b bigint")


def _likely(batches):
    for batch in batches:
        mine, theirs = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS)
                        for c in ("mine", "theirs"))
        likely = pa.array((mine == theirs).sum(1) >= ENOUGH)
        yield pa.RecordBatch.from_arrays(
            [batch.column("first").filter(likely), batch.column("node").filter(likely)], names=["a", "b"])


def linked_pairs(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Those pairs that are linked by their whole sets; ``whole`` is (node, text).

    Rows of one first member come one after another, and its set is made once for them.
    """
    rows = pairs.join(whole.toDF("b", "text"), "b").join(whole.toDF("a", "first"), "a")
    return rows.select("a", "b", "first", "text").mapInArrow(_confirm, "a bigint, b bigint")


def _confirm(batches):
    table, held = Table(xxhash.xxh3_64_intdigest, TABLE_WORDS), (None, None)
    for batch in batches:
        for part in slices(batch, "text", CHUNK_BYTES):
            first = part.column("a").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(first)) + 1, [len(first)]])
            linked = np.zeros(len(first), bool)
            for start, stop in zip(cuts[:-1], cuts[1:]):
                if stop == start:
                    continue
                if held[0] != first[start]:
                    held = first[start], shingles(texts(part.column("first").slice(start, 1))[0], table)
                mine = held[1]
                sets = [shingles(t, table) for t in texts(part.column("text").slice(start, stop - start))]
                flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
                hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
                shared = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
                linked[start:stop] = is_linked(shared, len(mine), sizes)
            linked = pa.array(linked)
            yield pa.RecordBatch.from_arrays([part.column(c).filter(linked) for c in ("a", "b")], names=["a", "b"])


def is_linked(shared, size, sizes):
    return 100 * shared >= LINKED * (size + sizes - shared)


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (node, text_key, ...) with its texts.

    A filter of bits says which documents can be wanted before their texts are shuffled.
    """
    rows = docs.select("text", F.xxhash64("text").alias("text_key")).where(maybe_among(wanted, "text_key"))
    return wanted.join(rows.groupBy("text_key").agg(F.first("text").alias("text")), "text_key")


# --- 3., 4. what is left, in blocks -----------------------------------------------------------


def parted(edges: DataFrame) -> DataFrame:
    """(node, comp) of the nodes of some edge."""
    return components(edges).withColumnRenamed("label", "comp")


def mixed(rows: DataFrame, least: int) -> DataFrame:
    """Rows (grp, node, comp, ...) of groups with several components, with ``core``: it is the first node's component."""
    first = F.min(F.struct("node", "comp"))["comp"].alias("_core")
    groups = rows.groupBy("grp").agg(F.count("*").alias("_n"), first, F.min("comp").alias("_low"), F.max("comp").alias("_high"))
    groups = groups.where((F.col("_n") >= least) & (F.col("_low") < F.col("_high"))).select("grp", "_core")
    return rows.join(groups, "grp").withColumn("core", F.col("comp") == F.col("_core")).drop("_core")


def in_blocks(rows: DataFrame, size_rows: int, *columns) -> DataFrame:
    """Rows of mixed groups dealt to blocks, once for each pair of blocks to compare.

    A group's core blocks come before its other blocks, and are not compared with each other. Few others
    are one block: then core rows go out once.
    """
    blocks = F.ceil(F.greatest(F.count("*") / F.lit(size_rows), F.sum("chars") / F.lit(BLOCK_CHARS))).cast("int")
    counts = rows.groupBy("grp", "core").agg(blocks.alias("_b")).groupBy("grp").agg(
        F.sum(F.when(F.col("core"), F.col("_b"))).alias("_core"), F.sum(F.when(~F.col("core"), F.col("_b"))).alias("_rest"))
    n_core, n_rest = F.col("_core").cast("int"), F.col("_rest").cast("int")
    dealt = F.xxhash64("node", F.lit(3))
    own = F.when(F.col("core"), F.pmod(dealt, n_core)).otherwise(n_core + F.pmod(dealt, n_rest)).cast("int")
    others = F.explode(F.sequence(F.when(F.col("core"), n_core).otherwise(0), n_core + n_rest - 1))
    pairs = rows.join(counts, "grp").withColumn("own", own).withColumn("_other", others)
    keys = ["grp", F.least("own", "_other").alias("low"), F.greatest("own", "_other").alias("high")]
    return pairs.select(*keys, "own", "node", "comp", *columns).repartition("grp", "low", "high").sortWithinPartitions("grp", "low", "high", "node")


def _tables(batches):
    """Rows of one (grp, low, high) after another, whole."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("grp", "low", "high")], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(keys)]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            if held and (keys[start] != last).any():
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(start, stop - start))
            last = keys[start]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _compare(exact: bool):
    """Edges that join components: of likely pairs, or of linked ones, until no more can be found."""

    def run(batches):
        words = Table(xxhash.xxh3_64_intdigest, TABLE_WORDS)
        for table in _tables(batches):
            nodes, own = table.column("node").to_numpy(), table.column("own").to_numpy()
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS)
            _, first, comp = np.unique(table.column("comp").to_numpy(), return_index=True, return_inverse=True)
            forest = Forest(len(nodes))
            forest.up = first[comp.reshape(-1)]
            sets = Sets([shingles(t, words) for t in texts(table.column("text").combine_chunks())]) if exact else None
            edges = []
            same = table.column("low")[0] == table.column("high")[0]
            low = table.column("low")[0].as_py()
            for a in range(len(nodes)) if same else np.flatnonzero(own != low):
                others = np.arange(a) if same else np.flatnonzero(own == low)
                others = others[forest.roots()[others] != forest.root(a)]
                others = others[(sketch[others] == sketch[a]).sum(1) >= ENOUGH]
                while len(others):
                    part, others = others[:64], others[64:]
                    for b in part[is_linked(sets.shared(a, part), sets.sizes[a], sets.sizes[part])] if exact else part:
                        if forest.root(a) != forest.root(b):
                            forest.join(a, b)
                            edges.append((nodes[a], nodes[b]))
                    others = others[forest.roots()[others] != forest.root(a)]
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges)], names=["a", "b"])

    return run


class Sets:
    """Sets of a block, with their elements renamed to small numbers."""

    def __init__(self, sets):
        self.sizes = np.array([len(s) for s in sets])
        self.flat = np.unique(np.concatenate(sets), return_inverse=True)[1].reshape(-1)
        self.ends = np.cumsum(self.sizes)
        self.here = np.zeros(int(self.flat.max()) + 1, bool)

    def shared(self, a, rows):
        """Elements of one set in each of some others."""
        mine = self.flat[self.ends[a] - self.sizes[a]: self.ends[a]]
        self.here[mine] = True
        sizes = self.sizes[rows]
        at = np.arange(sizes.sum()) + np.repeat(self.ends[rows] - np.cumsum(sizes), sizes)
        found = np.add.reduceat(self.here[self.flat[at]].astype(np.int64), np.cumsum(sizes) - sizes)
        self.here[mine] = False
        return found


# --- all --------------------------------------------------------------------------------------


def links(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b) linked pairs of classes, enough of them to join every component."""
    spark = docs.sparkSession
    bands = _written(spark, banded(found))
    buckets = _written(spark, bucketed(bands))
    likely = _written(spark, near_first(found, bands, buckets))
    named = found.select("node", "chars", "sketch", F.col("keeper.text_key").alias("text_key"))
    in_pairs = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    whole = texts_of(docs, _written(spark, named.select("node", "text_key").join(in_pairs, "node")))
    first = _written(spark, linked_pairs(likely, _written(spark, whole.select("node", "text"))))

    comp = F.coalesce("comp", "node").alias("comp")
    settled = _written(spark, found.select("node").join(parted(first), "node", "left").select("node", comp))
    rows = bands.join(buckets.where("members > 2").select("key"), "key").join(settled, "node").withColumnRenamed("key", "grp")
    rows = mixed(_written(spark, rows), 3).join(found.select("node", "sketch"), "node").withColumn("chars", F.lit(0))
    survivors = _written(spark, in_blocks(rows, SKETCH_ROWS, "sketch").mapInArrow(_compare(False), "a bigint, b bigint"))

    joined = survivors.join(settled.toDF("a", "ca"), "a").join(settled.toDF("b", "cb"), "b")
    groups = components(joined.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).toDF("comp", "grp")
    rows = mixed(_written(spark, settled.join(groups, "comp").join(named, "node")), 2)
    rows = _written(spark, texts_of(docs, _written(spark, rows)))
    second = in_blocks(rows, BLOCK_ROWS, "sketch", "text").mapInArrow(_compare(True), "a bigint, b bigint")
    return first.unionByName(_written(spark, second))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row per document: (doc_id, n_shingles, component_id, kept)."""
    spark = docs.sparkSession
    sketched = _written(spark, sketches(docs))
    found = _written(spark, classes(sketched))
    label = components(links(docs, found))
    named = found.select("node", "check", "keeper").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = named.groupBy("label").agg(F.min("keeper")["doc_id"].alias("component_id"))
    named = named.join(first, "label").select("node", "check", "component_id")
    rows = sketched.select("doc_id", "n_shingles", "node", "check").join(named, ["node", "check"], "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _written(spark, df: DataFrame) -> DataFrame:
    path = work_dir(spark, "superminhash")
    df.write.parquet(path)
    return spark.read.parquet(path)

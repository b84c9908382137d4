"""Document fingerprints from closed syncmers over words.

A window of ``k`` words is an anchor when the smallest of its inner runs of ``s`` words, by hash, is
the first or the last: that depends on the window alone, so equal passages choose equal anchors
wherever they stand. A fingerprint has all anchors of the whole text with their word positions, by hash.
A caller may ask for the ``size`` anchors of smallest hash only (a bottom-k sketch); which ones these
are depends on the whole text.

Two fingerprints are compared where both are complete: everywhere, or with sketches up to the smaller
of their largest hashes. Anchors of equal hash match when their displacement is within ``slack`` words
of the median one, or is one of ``group`` displacements that lie within ``slack`` words, so that both
sides of an insertion and a moved passage count; likeness is matches / (anchors of both - matches).

Defined results: a null text is empty; a text without words has an empty fingerprint, which is 1 like
another empty one and 0 like any other; a text without an anchor (under ``k`` words, say) has all its
words as its only anchor; an anchor that repeats counts once, at its first place; other columns are
ignored.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from printfold.session import work_dir

K, S, SLACK, GROUP = 5, 2, 16, 4
SIZE = (1 << 31) - 1  # all anchors: no array holds more
BLANKS, WORD_GAP = " \t\n\x0b\x0c\r", r"[\x20\x09-\x0D]+"
POSITION_BITS = 31


def words(text: Column) -> Column:
    """Words between blanks."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner != "", F.split(inner, WORD_GAP)).otherwise(F.array().cast("array<string>"))


def with_fingerprint(df: DataFrame, text: str, name: str, k=K, s=S, size=SIZE) -> DataFrame:
    """Add column ``name``, the fingerprint of column ``text`` as array<bigint>.

    Steps are columns of their own, so that each is computed once.
    """
    n = F.size("_hash")
    inner = F.col("_hash")
    for i in range(1, s):
        inner = F.zip_with(
            F.slice(inner, 1, F.greatest(n - i, F.lit(0))),
            F.slice("_hash", i + 1, F.greatest(n - i, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    return (
        df.withColumn("_words", words(F.col(text)))
        .withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("_inner", inner)
        .withColumn("_places", F.when(n >= k, F.filter(F.sequence(F.lit(0), n - k), _closed(F.col("_inner"), k - s))))
        .withColumn("_anchors", F.transform("_places", _pack(F.col("_hash"), k)))
        .withColumn("_anchors", F.when(F.coalesce(F.size("_anchors"), F.lit(0)) > 0, F.sort_array("_anchors"))
                    .when(n > 0, F.array(_packed(F.xxhash64("_hash"), F.lit(0)))).otherwise(F.array().cast("array<bigint>")))
        .withColumn("_first", F.filter("_anchors", _first_of_hash(F.col("_anchors"))))
        .withColumn(name, F.slice("_first", 1, size))
        .drop("_words", "_hash", "_inner", "_places", "_anchors", "_first")
    )


def _closed(inner: Column, last: int):
    """Whether the smallest inner run of the window at i is at an edge; ties count for the edge."""

    def test(i):
        edge = F.least(F.get(inner, i), F.get(inner, i + last))
        middle = [F.get(inner, i + j) for j in range(1, last)]
        return edge <= (F.least(*middle) if len(middle) > 1 else middle[0]) if middle else F.lit(True)

    return test


def _packed(value: Column, place: Column) -> Column:
    """32 bits of a hash above a word position, so that sorting is by hash, then place."""
    return F.shiftleft(F.shiftrightunsigned(value, 32), POSITION_BITS).bitwiseOR(place.cast("bigint"))


def _pack(hashes: Column, k: int):
    return lambda i: _packed(F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]), i)


def _first_of_hash(anchors: Column):
    return lambda x, i: (i == 0) | (hash_of(x) != hash_of(F.get(anchors, i - 1)))


def hash_of(anchor: Column) -> Column:
    return F.shiftright(anchor, POSITION_BITS)


def place_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))


def as_text(fingerprint: Column) -> Column:
    """``hash@place`` of each anchor, joined by blanks."""
    return F.array_join(F.transform(fingerprint, lambda a: F.concat(
        F.lower(F.hex(hash_of(a))), F.lit("@"), place_of(a).cast("string"))), " ")


def with_likeness(df: DataFrame, a: str, b: str, name: str, size=SIZE, slack=SLACK, group=GROUP) -> DataFrame:
    """Add column ``name``, the likeness of the fingerprints in columns ``a`` and ``b``.

    Equal hashes meet by sorting both together, each with a last bit that tells ``b`` from ``a``.
    """
    whole = F.lit(1 << 32).cast("bigint")
    limit = lambda c: F.when(F.size(c) >= size, hash_of(F.element_at(c, -1))).otherwise(whole)
    held = lambda c, side: F.transform(F.filter(c, lambda x: hash_of(x) <= F.col("_limit")),
                                       lambda x: F.shiftleft(x, 1).bitwiseOR(F.lit(side).cast("bigint")))
    before = lambda i: F.get("_both", i - 1)
    place = lambda x: place_of(F.shiftright(x, 1))
    moved = lambda x, i: F.when(
        (i > 0) & (F.shiftrightunsigned(x, 32) == F.shiftrightunsigned(before(i), 32)),
        (place(x) - place(before(i))) * F.when(x.bitwiseAND(F.lit(1)) == 1, 1).otherwise(-1))

    def grouped(i):
        """Whether the move at i is in a run of ``group`` moves, in order, that lie within ``slack``."""
        runs = [F.get("_moves", i + (j + group - 1)) - F.get("_moves", i + j) <= slack for j in range(1 - group, 1)]
        return F.coalesce(F.greatest(*runs), F.lit(False))

    return (
        df.withColumn("_limit", F.least(limit(a), limit(b)))
        .withColumn("_both", F.sort_array(F.concat(held(a, 0), held(b, 1))))
        .withColumn("_moves", F.sort_array(F.filter(F.transform("_both", moved), lambda d: d.isNotNull())))
        .withColumn("_middle", F.get("_moves", F.floor(F.size("_moves") / 2).cast("int")))
        .withColumn("_match", F.size(F.filter("_moves", lambda d, i: (F.abs(d - F.col("_middle")) <= slack) | grouped(i))))
        .withColumn(name, F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
                    .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
                    .otherwise(F.col("_match") / (F.size("_both") - F.col("_match"))))
        .drop("_limit", "_both", "_moves", "_middle", "_match")
    )


KEY = ["named", "key", "tie"]


def with_key(docs: DataFrame) -> DataFrame:
    """(named, key, tie, text): rows in order of doc_id, nulls first; ``tie`` tells equal ids apart.

    The doc_id is left to be read off the key, so that every use of these rows is the same one shuffle.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").isNotNull().alias("named"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("key"),
                       F.xxhash64(text).alias("tie"), text.alias("text"))


def neighbours(keyed: DataFrame) -> DataFrame:
    """For every key the one before it, the last one for the first.

    Only keys are sorted. They are dealt by range and written below the shared folder, so
    that ranges stay what they were; the first row of a range gets its neighbour from a list of the
    last rows, one per range.
    """
    spark = keyed.sparkSession
    path = work_dir(spark, "neighbours")
    rows = keyed.select(*KEY).distinct()
    rows.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    row = F.struct(*KEY)
    lasts = rows.groupBy("part").agg(F.max(row).alias("end"))
    over = Window.orderBy("part")  # a row per range
    lasts = lasts.select("part", F.coalesce(
        F.lag("end").over(over), F.max("end").over(Window.partitionBy())).alias("end"))
    inside = Window.partitionBy("part").orderBy(*KEY)
    prev = F.coalesce(F.lag(row).over(inside), F.col("end"))
    return rows.join(F.broadcast(lasts), "part").select(*KEY, prev.alias("prev")).select(
        *KEY, *[F.col(f"prev.{c}").alias(f"prev_{c}") for c in KEY])


def edit_and_compare(docs: DataFrame) -> DataFrame:
    """Every document with its fingerprint, that of its edited text, and its likeness to that and to the next.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many, or all,
    of the next document. A text crosses the network by its own key and once more to the document before
    it; fingerprints, which pack worse than texts, are made where they are compared.
    """
    dealt = with_key(docs).repartition(*KEY)
    half = lambda n: F.floor(n / 2).cast("int")
    sent = (
        dealt.join(neighbours(with_key(docs)), KEY)
        .select(*[F.col(f"prev_{c}").alias(c) for c in KEY], F.col("text").alias("next_text"))
        .groupBy(*KEY).agg(F.first("next_text").alias("next_text"))
    )
    n = F.char_length("text")
    rows = dealt.join(sent, KEY).select(
        F.when(F.col("named"), F.col("key")).alias("doc_id"), "text", "next_text", n.cast("long").alias("n_chars"),
        F.concat(F.substr("text", F.lit(1), n - half(n)), F.substr("next_text", F.lit(1), half(n))).alias("edited"))
    rows = with_fingerprint(rows, "text", "fp")
    rows = with_likeness(with_fingerprint(rows, "next_text", "next_fp"), "fp", "next_fp", "near_next").drop("next_text", "next_fp")
    rows = with_fingerprint(rows, "edited", "edited_fp")
    return with_likeness(rows, "fp", "edited_fp", "near_edited")

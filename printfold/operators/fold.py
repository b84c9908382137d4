"""Folding all printings of a key into one row, and ordering rows within a key."""

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from printfold.functions.predicates import has_front, require_not_null
from printfold.operators.flatten import flatten_prints, narrow_prints


def fold(df: DataFrame, keys, order, attrs=(), lowest=()) -> DataFrame:
    """Per key: ``attrs`` of the row greatest by ``order``, and the least of each ``lowest`` column.

    One shuffle. Every task first folds its own rows, so a key sends at most one row per task,
    however many it has. Nulls sort lowest in ``order`` and are ignored by ``lowest``.
    """
    aggregates = [F.min(c).alias(c) for c in lowest]
    if attrs:
        latest = F.max_by(F.struct(*attrs), F.struct(*order)).alias("_latest")
        aggregates.insert(0, latest)
    folded = df.groupBy(*keys).agg(*aggregates)
    return folded.select(*keys, *[F.col("_latest")[a].alias(a) for a in attrs], *lowest)


def latest_per_key(df: DataFrame, keys, order, attrs) -> DataFrame:
    """The attributes of each key's latest row."""
    return fold(df, keys, order, attrs=attrs)


def min_per_key(df: DataFrame, keys, columns) -> DataFrame:
    """The least non-null value of each column per key, over all its rows."""
    return fold(df, keys, [], lowest=columns)


def release_order(prints: DataFrame) -> list:
    """Latest date wins, then the later place in the feed; no date is earliest of all.

    Rows that came from no feed have no place; there the printing's id breaks the tie.
    """
    place = "pos" if "pos" in prints.columns else "sid"
    return [F.col("date").try_cast("date"), F.col(place)]


CARD_KEY = "oracle_id"
FOLDED = ("price", "tix")


def checked(prints: DataFrame) -> DataFrame:
    """Printings without an id or a card key fail the job."""
    return prints.withColumns({c: require_not_null(F.col(c), c) for c in ("sid", CARD_KEY)})


def fold_cards(prints: DataFrame) -> DataFrame:
    """Flat printings to one card per key, with the lowest price over all of its printings."""
    attrs = [c for c in prints.columns if c not in (CARD_KEY, *FOLDED, "pos")]
    return fold(prints, [CARD_KEY], release_order(prints), attrs, FOLDED)


LOWS = tuple(f"_{c}" for c in FOLDED)


def fold_narrow(prints: DataFrame) -> DataFrame:
    """Narrow printings to cards: the winner's feed row is carried through the fold and flattened after."""
    folded = fold(prints, [CARD_KEY], release_order(prints), ["element"], FOLDED)
    return _flat(folded.withColumnsRenamed(dict(zip(FOLDED, LOWS))))


def _flat(won: DataFrame, extra=()) -> DataFrame:
    """Winners' feed rows to cards, with the lowest prices of all printings."""
    cards = flatten_prints(won.select("element.*", *LOWS, *extra), (*LOWS, *extra))
    return cards.withColumns({c: F.col(low) for c, low in zip(FOLDED, LOWS)}).drop(*LOWS)


# Bits of a pointer below the day: a split of the feed, a row of the split, an item of the row.
SPLIT_BITS, ROW_BITS, ITEM_BITS = 30, 33, 31
EARLIEST = -(1 << 31)  # before any date Spark has
SLOTS = 1 << 16  # a number of each is sent to every task, whatever the number of cards
BITS = 1 << 24  # sent to every task in words of 64, whatever the number of cards


def with_pointer(prints: DataFrame) -> DataFrame:
    """Adds ``pointer``, a number of fixed width that orders printings as ``release_order`` and tells them apart.

    The splits the feed was read in are numbered in feed order, as a list of their own: a row for each, small enough
    to be sent to every task, so that no feed row moves for its number.
    """
    places = {"_file": F.col("pos.file"), "_block": F.col("pos.block")}
    split = F.row_number().over(Window.orderBy("_file", "_block"))
    splits = prints.select(*[c.alias(n) for n, c in places.items()]).distinct().withColumn("_split", split)
    day = F.coalesce(F.unix_date(F.col("date").try_cast("date")), F.lit(EARLIEST)).cast("long") - EARLIEST
    high = F.shiftleft(day, SPLIT_BITS) + F.col("_split")
    # The lower bits of a row's number count within the task that read it.
    row = F.col("pos.row").bitwiseAND((1 << ROW_BITS) - 1).cast("decimal(10,0)")
    low = row * F.lit(Decimal(1 << ITEM_BITS)) + F.col("pos.item").cast("decimal(10,0)")
    pointer = high.cast("decimal(19,0)") * F.lit(Decimal(1 << (ROW_BITS + ITEM_BITS))) + low
    numbered = prints.withColumns(places).join(F.broadcast(splits), list(places))
    return numbered.withColumn("pointer", pointer.cast("decimal(38,0)")).drop(*places, "_split")


def fold_written(prints: DataFrame, extra=()) -> DataFrame:
    """Narrow printings of a table, with their ``pos``, to cards; the same as ``fold_narrow``, by pointer.

    Only numbers are folded, so no task sorts or buffers feed rows; the fold does not even read them. The
    winners' rows are fetched by pointer, of which every row has its own, so a hot card is no hot key there: the
    winners' numbers are looked up in a hash table of each partition, for which feed rows are not sorted.

    Cards are dealt to ``SLOTS`` slots, of which every task is told the lowest winner. A row below that has not won,
    so that it stays where it is. Of the others, those stay too whose pointer names none of the ``BITS`` that winners' do.
    The winner's columns named in ``extra`` are kept beside the card's own.
    """
    pointed = with_pointer(prints)
    won = pointed.groupBy(CARD_KEY).agg(F.max("pointer").alias("pointer"), *[F.min(c).alias(low) for c, low in zip(FOLDED, LOWS)])
    slot = F.pmod(F.xxhash64(CARD_KEY), F.lit(SLOTS)).alias("_slot")
    lowest = won.select(slot, "pointer").groupBy("_slot").agg(F.min("pointer").alias("_lowest"))
    near = pointed.select("pointer", "element", *extra, slot).join(F.broadcast(lowest), "_slot").where("pointer >= _lowest")
    word = F.floor(F.pmod(F.xxhash64("pointer"), F.lit(BITS)) / 64).alias("_word")
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(pointer), 64) as int))").alias("_bit")
    bits = won.select(word, bit).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    near = near.select("pointer", "element", *extra, word, bit).join(F.broadcast(bits), "_word").where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0)
    return _flat(near.select("pointer", "element", *extra).join(won.drop(CARD_KEY).hint("shuffle_hash"), "pointer"), extra)


def fold_feed(raw: DataFrame) -> DataFrame:
    """Valid feed rows to cards, in one pass; ``fold_written`` folds rows that lie in a table."""
    return fold_narrow(checked(narrow_prints(raw).where(has_front())))


def count_valid(prints: DataFrame) -> DataFrame:
    """How many printings passed the validity tests."""
    return prints.agg(F.count(F.lit(1)).alias("valid"))


def group_ordered(df: DataFrame, key: str, order, chunk) -> DataFrame:
    """Adds ``line_no``, each row's place among its key's rows.

    ``chunk`` never decreases along ``order`` and holds a bounded number of rows of any key, such
    as a file split. Rows are numbered within their chunk and moved up by the sizes of the chunks
    before, so that no task takes all rows of a hot key.
    """
    chunked = df.withColumn("_chunk", chunk)
    inside = Window.partitionBy(key, "_chunk").orderBy(*order)
    before = (
        Window.partitionBy(key).orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    sizes = chunked.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select(
        key, "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    numbered = chunked.withColumn("_n", F.row_number().over(inside))
    return (
        numbered.join(starts, [key, "_chunk"])
        .withColumn("line_no", F.col("_start") + F.col("_n"))
        .drop("_chunk", "_start", "_n")
    )


def group_manifest(manifest: DataFrame) -> DataFrame:
    """Manifest lines numbered per card and side, in feed order."""
    keyed = manifest.withColumn("_list", F.concat_ws("/", CARD_KEY, "side"))
    chunk = F.struct("pos.file", "pos.block")
    return group_ordered(keyed, "_list", ["pos"], chunk).drop("_list")

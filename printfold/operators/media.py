"""Pictures wanted against pictures present."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from printfold.functions.predicates import has_value, only_new
from printfold.functions.scalars import date_digits, image_name, object_key
from printfold.operators.sieve import sieved
from printfold.operators.skew import hot_keys, salted_join

PICTURE = ["oracle_id", "sid", "side"]


def mark_status(prints: DataFrame, inventory: DataFrame, keys=PICTURE) -> DataFrame:
    """``status`` old when the picture is already in the inventory, else new.

    The keys name a single picture, so a card with very many printings is spread by them. An
    inventory may name a picture more than once.
    """
    present = inventory.select(*keys).distinct().withColumn("_present", F.lit(True))
    status = F.when(F.col("_present"), "old").otherwise("new")
    return prints.join(present, keys, "left").withColumn("status", status).drop("_present")


def semi_back(manifest: DataFrame, cards: DataFrame, key="oracle_id", back="back", **salting) -> DataFrame:
    """Manifest rows of the cards that have a back."""
    backed = cards.where(has_value(F.col(back))).select(key)
    return salted_join(manifest, backed, key, "left_semi", **salting)


def wanted(manifest: DataFrame, cards: DataFrame, *columns, **salting) -> DataFrame:
    """Manifest rows that count: every front, and a back when the card still has one.

    ``columns`` of the card are added. A card may have very many printings: give ``weights`` where
    their numbers are known.
    """
    backed = has_value(F.col("back")).alias("_backed")
    facts = cards.select("oracle_id", *columns, backed)
    joined = salted_join(manifest, facts, "oracle_id", **salting)
    return joined.where((F.col("side") == "front") | F.col("_backed")).drop("_backed")


def wanted_art(cards: DataFrame, *columns) -> DataFrame:
    """The art of every card with art; it belongs to no printing."""
    no_printing = F.lit(None).cast("string").alias("sid")
    return cards.where(has_value(F.col("art"))).select(
        "oracle_id", no_printing, F.lit("art").alias("side"), F.col("art").alias("url"), *columns
    )


def without_image(wanted_rows: DataFrame, inventory: DataFrame, keys=PICTURE) -> DataFrame:
    """The rows whose picture is not in the inventory."""
    return wanted_rows.join(inventory.select(*keys), keys, "left_anti")


def missing_art(cards: DataFrame, inventory: DataFrame, *columns) -> DataFrame:
    """Cards with art of which no art picture is present, whatever its printing."""
    present = inventory.where(F.col("side") == "art")
    return without_image(wanted_art(cards, *columns), present, ["oracle_id"])


def source_file() -> Column:
    """Path of a picture below the image folder."""
    own = F.when(F.col("side") == "art", "art.png").otherwise(
        image_name(F.col("sid"), F.col("side"))
    )
    return F.concat_ws("/", "oracle_id", own)


def fetch_list(manifest: DataFrame, cards: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every absent picture once, with where to get and put it; first of equal printings wins."""
    rows = without_image(wanted(manifest, cards), inventory)
    first = rows.groupBy(*PICTURE).agg(F.min_by("url", "pos").alias("url"))
    both = first.unionByName(missing_art(cards, inventory))
    return both.withColumn("file", source_file())


def missing_report(manifest: DataFrame, cards: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per absent picture line: card, name, side, printing."""
    columns = ["oracle_id", "name", "side", "sid"]
    lines = without_image(wanted(manifest, cards, "name"), inventory).select(*columns)
    return lines.unionByName(missing_art(cards, inventory, "name").select(*columns))


def known_keys(*tables: DataFrame, key="oracle_id") -> DataFrame:
    """Distinct card keys over several tables; each is reduced before the shuffle."""
    keys = tables[0].select(key)
    for table in tables[1:]:
        keys = keys.unionByName(table.select(key))
    return keys.distinct()


def orphans(keys: DataFrame, cards: DataFrame, key="oracle_id") -> DataFrame:
    """Known keys without card data."""
    return keys.select(key).distinct().join(cards.select(key), key, "left_anti")


def integrity_report(manifest: DataFrame, cards: DataFrame, inventory: DataFrame) -> DataFrame:
    """Missing pictures, and keys that have pictures or lines but no card."""
    lost = lost_keys(known_keys(manifest, inventory), cards)
    return missing_report(manifest, cards, inventory).unionByName(lost)


def card_facts(keys: DataFrame, cards: DataFrame) -> DataFrame:
    """What the reports need of each key: a row for each of its cards, or one with ``stored`` unset.

    One row of a key is its ``first``; ``any_backed`` tells whether any of its cards has a back.
    """
    rows = cards.select("oracle_id", "name", has_value(F.col("back")).alias("backed"), F.lit(True).alias("stored"))
    own = Window.partitionBy("oracle_id")
    return keys.join(rows, "oracle_id", "left").withColumns({
        "first": F.row_number().over(own.orderBy("name")) == 1, "any_backed": F.max("backed").over(own)})


def lacking_pictures(manifest: DataFrame, facts: DataFrame, inventory: DataFrame, weights: DataFrame, per_task) -> DataFrame:
    """Wanted pictures of the keys of ``facts`` that are absent, or for which lines give several urls (``unsettled``).

    A row for each card of the picture's key: ``url`` of the picture's first line, number of ``lines``, and whether the
    picture is ``to_fetch`` (in one of the rows only) or ``missing`` from this card. Only lines that a card
    wants cross the network, and once: they are dealt by key, of which ``weights`` (key, rows) are known, a hot key's by
    picture over several tasks, and meet the pictures there are in the sum of each picture.
    """
    hot = F.broadcast(hot_keys(weights, "oracle_id", weights.columns[-1], per_task))  # no more rows than tasks are needed
    named = reduce(Column.__and__, [F.col(c).isNotNull() for c in PICTURE])  # a null matches nothing
    there = inventory.where(named).select(*PICTURE, F.lit(True).alias("there"))
    rows = manifest.select(*PICTURE, "url", "pos").unionByName(there, allowMissingColumns=True)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    front = F.coalesce(F.col("side") == "front", F.lit(False))
    kinds = facts.where("stored and first").select(
        "oracle_id", F.explode(F.when(F.col("any_backed"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))).alias("_front"))
    likely = sieved(rows.withColumn("_front", front), kinds, ["oracle_id", "_front"])
    dealt = likely.join(hot, "oracle_id", "left").select(
        *rows.columns, F.pmod(F.xxhash64("sid", "side"), salts.cast("long")).cast("int").alias("_salt"))
    pictures = dealt.repartition("oracle_id", "_salt").groupBy("oracle_id", "_salt", "sid", "side").agg(
        F.min_by("url", "pos").alias("url"), F.min("url").alias("_low"), F.max("url").alias("_high"),
        F.count_if(F.col("there").isNull()).alias("lines"), F.max("there").alias("_there"))
    parts = facts.join(hot, "oracle_id", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    absent, once = F.col("_there").isNull(), F.col("first") & (front | F.col("any_backed"))
    flags = {
        "to_fetch": absent & once,
        "missing": absent & (front | F.col("backed")),
        "unsettled": once & F.coalesce(F.col("_low") != F.col("_high"), F.lit(False)),
    }
    found = pictures.where("lines > 0").join(parts.where("stored").drop("_salts"), ["oracle_id", "_salt"])
    flagged = found.select(*PICTURE, "url", "name", "lines", *[c.alias(n) for n, c in flags.items()])
    return flagged.where("to_fetch or missing or unsettled")


def fetch_list_of(lacking: DataFrame, cards: DataFrame, inventory: DataFrame) -> DataFrame:
    """``fetch_list`` of the keys that ``lacking_pictures`` was asked about."""
    rows = lacking.where("to_fetch").select(*PICTURE, "url")
    return rows.unionByName(missing_art(cards, inventory)).withColumn("file", source_file())


def integrity_report_of(lacking: DataFrame, cards: DataFrame, inventory: DataFrame, held: DataFrame) -> DataFrame:
    """``integrity_report`` of the keys that ``lacking_pictures`` was asked about; ``held`` have lines or pictures."""
    columns = ["oracle_id", "name", "side", "sid"]
    each = F.explode(F.sequence(F.lit(1).cast("long"), "lines")).alias("_line")
    lines = lacking.where("missing").select(*columns, each).drop("_line")
    return lines.unionByName(missing_art(cards, inventory, "name").select(*columns)).unionByName(lost_keys(held, cards))


def lost_keys(held: DataFrame, cards: DataFrame) -> DataFrame:
    """Keys that have pictures or lines but no card, as rows of the report (``side`` is card)."""
    nothing = F.lit(None).cast("string")
    return orphans(held, cards).select("oracle_id", nothing.alias("name"), F.lit("card").alias("side"), nothing.alias("sid"))


def upload_list(manifest: DataFrame, cards: DataFrame) -> DataFrame:
    """New pictures, and the art of every card with art, with source file and target key.

    ``cards`` are key-resolved: they have an ``id``.
    """
    new = wanted(manifest.where(only_new()), cards, "id")
    dated = image_name(date_digits(F.col("date")), F.col("side"))
    columns = ["oracle_id", "side", "sid", "id", source_file().alias("file")]
    pictures = new.select(*columns, object_key(F.col("id"), dated).alias("object_key"))
    art_key = object_key(F.upper("id"), F.lit("art.png"))
    arts = wanted_art(cards, "id").select(*columns, art_key.alias("object_key"))
    return pictures.unionByName(arts)

"""Leaving rows where they are that a join would move in vain."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # eight megabytes that every task is sent, however many keys there are


def sieved(rows: DataFrame, keys: DataFrame, columns) -> DataFrame:
    """The rows whose ``columns`` may be among those of ``keys``, for a join that then tells exactly.

    Each key sets the one of ``BITS`` bits that its hash names. A row stays if its bit is set, so every row that is
    among the keys does, and some others. Rows with a null, which a join would not match, may go or stay.
    """
    place = F.pmod(F.xxhash64(*columns), F.lit(BITS)) + 1
    bits = keys.select(place.alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    placed = rows.withColumns({"_bucket": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)})
    byte = F.expr("cast(conv(hex(substring(_bits, int(_bit div 8) + 1, 1)), 16, 10) as int)")
    isset = F.getbit(byte, F.expr("int(_bit % 8)")) == 1
    return placed.join(F.broadcast(bits), "_bucket").where(isset).select(*rows.columns)

"""A filter of bounded size for keys, so that rows nobody asks for are left out before a shuffle.

It has sixteen bits a key up to ``MOST`` in all. With more keys it lets more rows through, and never keeps
one back that is asked for.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, MOST = 1 << 16, 1 << 26


def maybe_among(keys: DataFrame, name: str) -> Column:
    """Whether the column ``name`` (bigint) of another table may be among those of ``keys``."""
    bits = min(max(LEAST, 1 << (16 * keys.count()).bit_length()), MOST)
    place = F.pmod(F.xxhash64(name), F.lit(bits))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{name}`), {bits}) % 64 as int))")
    words = keys.groupBy(F.floor(place / 64).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    known = np.zeros(bits // 64, np.int64)
    known[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    byte = F.substring(F.lit(known.tobytes()), F.floor(place / 8).cast("int") + 1, F.lit(1))
    mask = F.expr(f"shiftleft(1, cast(pmod(xxhash64(`{name}`), {bits}) % 8 as int))")
    return F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(mask) != 0

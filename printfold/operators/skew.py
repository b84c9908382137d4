"""Joins of a many-rows side with a one-row-per-key side whose hot keys are known.

Without known weights a plain join is best: Spark splits the large partitions of its left side while it
runs. Where the weight of each key is at hand, as counts that an earlier fold has stored, hot keys are
split beforehand over as many tasks as they need, and only their few right rows are repeated. No row is
dropped and no key needs naming.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(weights: DataFrame, key: str, weight: str, per_task) -> DataFrame:
    """(key, _salts) of the keys that weigh more than one task should take."""
    salts = F.ceil(F.col(weight) / per_task).cast("int")
    return weights.where(F.col(weight) > per_task).select(key, salts.alias("_salts"))


def salted_join(left, right, key, how="inner", weights=None, per_task=None, spread=None) -> DataFrame:
    """Join on ``key``; ``right`` has at most one row per key.

    ``weights`` are known (key, weight) pairs of the left side, in rows or bytes, and ``per_task`` is
    what one task should take of that. ``spread`` names the left columns whose hash deals a hot key's
    rows out (all columns if unset). Rows without a key match nothing and go round the join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join keeps no unmatched right rows: {how}")
    if weights is None:
        return left.join(right, key, how)
    hot = hot_keys(weights, key, weights.columns[-1], per_task)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    dealt = F.pmod(F.xxhash64(*[F.col(c) for c in (spread or left.columns)]), salts.cast("long")).cast("int")
    keyed = left.where(F.col(key).isNotNull())
    salted_left = keyed.join(hot, key, "left").withColumn("_salt", dealt).drop("_salts")
    repeats = F.explode(F.sequence(F.lit(0), salts - 1))
    salted_right = right.join(hot, key, "left").withColumn("_salt", repeats).drop("_salts")
    joined = salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
    if how in ("inner", "left_semi"):
        return joined
    return joined.unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)

"""Mixing sources to target weights by hierarchical budgets.

The tree is domain > language > source. Each node's budget is split among its children in proportion
to their weights; a child that cannot use its share (its tokens times ``max_epochs``) passes the rest
to its siblings, and only what a whole family cannot use goes back to the siblings of its parent. A
leaf with a budget of q tokens gives q // tokens full epochs and the first q % tokens tokens of one
more epoch, whose order is seeded; the last document is cut at the budget.

Defined results: null domain, lang or source are nodes of their own called ``(none)``; null and empty
texts hold no tokens and are never taken; nodes without a weight weigh 1, and a weight of 0 takes
nothing; repeated rows are rows of their own, in the order of text and then arbitrary; an empty table
gives no rows; other columns are ignored.

Scale: documents are summed to leaves by a partial aggregate, budgets are windows over leaves, and the
seeded order of a leaf is cut into buckets by a hash of doc_id and text, so that a hot leaf and a hot doc_id
spread: bucket sums find the one bucket where a budget ends. Equal rows, which share a bucket, are one row with
their number for each split they were read in, and are dealt out again only after that.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from printfold.session import work_dir

LEVELS = ("domain", "lang", "source")
NONE = "(none)"
WORD_GAP = r"[\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    """Words between blanks."""
    return F.coalesce(F.size(F.filter(F.split(text, WORD_GAP), lambda w: w != "")), F.lit(0)).cast("long")


def leaf_sums(docs: DataFrame) -> DataFrame:
    """(domain, lang, source, tokens, rows) from rows with n_tokens."""
    return docs.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))


def fill(children: DataFrame, family: list, budget: Column) -> DataFrame:
    """Split ``budget`` among the rows of a family by ``weight``, each up to ``capacity``; adds ``share``.

    Children are taken by capacity per weight: one is full when an even split of what is left would
    give it more than it can use. The others share the rest by weight.
    """
    usable = F.when(F.col("weight") > 0, F.col("capacity")).otherwise(F.lit(0.0))
    order = Window.partitionBy(*family).orderBy("_ratio", *LEVELS[: len(family) + 1])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*family)
    rows = (
        children.withColumn("_usable", usable)
        .withColumn("_ratio", F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(0.0)))
        .withColumn("_budget", F.least(budget, F.sum("_usable").over(whole)))
        .withColumn("_rest", F.col("_budget") - F.coalesce(F.sum("_usable").over(before), F.lit(0.0)))
        .withColumn("_weights", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("_even", F.when(F.col("_weights") > 0, F.col("_rest") / F.col("_weights")))
        .withColumn("_full", (F.col("weight") <= 0) | (F.col("_ratio") <= F.col("_even") + 1e-9))
        .withColumn("_level", F.max(F.when(~F.col("_full"), F.col("_even"))).over(whole))
    )
    # The first child that is not full sets the level; even splits grow while children are full, and
    # fall once one is not, so the largest among those not full is the first one's.
    share = F.when(F.col("_full"), F.col("_usable")).otherwise(F.col("weight") * F.col("_level"))
    return rows.withColumn("share", share).drop("_usable", "_ratio", "_budget", "_rest", "_weights", "_even", "_full", "_level")


def budgets(leaves: DataFrame, share: float, weights: DataFrame = None, max_epochs=4.0) -> DataFrame:
    """Leaves with ``quota``, the tokens to take; all quotas together are ``share`` of all tokens.

    ``weights`` has (domain, lang, source, weight) with null below the level of the node it weighs.
    """
    sums = [F.sum("tokens").alias("tokens")]
    levels = [leaves.groupBy("domain").agg(*sums), leaves.groupBy("domain", "lang").agg(*sums), leaves]
    budget = F.sum("tokens").over(Window.partitionBy()) * F.lit(float(share))  # over domains
    for depth, nodes in enumerate(levels, 1):
        rows = _weigh(nodes, weights, depth).withColumn("capacity", F.col("tokens") * F.lit(float(max_epochs)))
        if depth > 1:
            rows, budget = rows.join(given, list(LEVELS[: depth - 1])), F.col("given")  # noqa: F821
        given = fill(rows, LEVELS[: depth - 1], budget)
        if depth < 3:
            given = given.select(*LEVELS[:depth], F.col("share").alias("given"))
    return given.select(*leaves.columns, F.floor(F.col("share") + 1e-6).cast("long").alias("quota"))


def _weigh(nodes: DataFrame, weights: DataFrame, depth: int) -> DataFrame:
    if weights is None:
        return nodes.withColumn("weight", F.lit(1.0))
    keys, below = LEVELS[:depth], LEVELS[depth:]
    level = weights.where(F.col(keys[-1]).isNotNull())
    for name in below:
        level = level.where(F.col(name).isNull())
    level = level.groupBy(*keys).agg(F.max("weight").cast("double").alias("weight"))
    return nodes.join(level, list(keys), "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def place(seed: int, epoch: Column, doc_id: Column, mark: Column) -> Column:
    """Sort key of a document within an epoch; ``mark`` is the digest of its text."""
    doc_id = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id, mark))


def take(docs: DataFrame, leaves: DataFrame, seed=0, rows_per_bucket=2000) -> DataFrame:
    """Documents taken: (doc_id, domain, lang, source, n_tokens, tie, epochs, extra_tokens).

    ``docs`` has what ``narrow_rows`` makes; ``leaves`` comes from ``budgets``. A document is taken
    ``epochs`` times whole, and ``extra_tokens`` of its first tokens once more.
    """
    bound = leaves.where("tokens > 0").select(
        *LEVELS, F.floor(F.col("quota") / F.col("tokens")).cast("long").alias("epochs"),
        (F.col("quota") % F.col("tokens")).alias("rest"),
        F.ceil(F.col("rows") / F.lit(rows_per_bucket)).cast("long").alias("cuts"))
    first_bits = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    equal = ["doc_id", *LEVELS, "n_tokens", "tie", "mark", "split"]
    rows = (
        docs.where("n_tokens > 0").groupBy(*equal).agg(F.count("*").cast("int").alias("copies"))
        .withColumn("all_tokens", F.col("n_tokens") * F.col("copies"))
        .join(bound, list(LEVELS))
        .withColumn("place", place(seed, F.col("epochs") + 1, F.col("doc_id"), F.col("mark")))
        # Equal ranges of the place's first 32 bits, so buckets follow each other in its order.
        .withColumn("bucket", F.shiftright(first_bits * F.col("cuts"), 32)).drop("cuts")
        # The leaf alone must not stay the key: a hot one would meet in one task.
        .repartition(*LEVELS, "bucket")
    )
    sums = rows.groupBy(*LEVELS, "bucket").agg(F.sum("all_tokens").alias("held"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*LEVELS, "bucket", F.coalesce(F.sum("held").over(running), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*LEVELS, "bucket").orderBy("place", "doc_id", "tie", "split")
    before = F.coalesce(F.sum("all_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    upto = F.col("start") + F.col("before") + F.col("copy") * F.col("n_tokens")
    extra = F.least(F.col("n_tokens"), F.greatest(F.lit(0), F.col("rest") - upto))
    return (
        rows.withColumn("before", before).join(starts, [*LEVELS, "bucket"])
        .where((F.col("epochs") > 0) | (F.col("rest") > F.col("start") + F.col("before")))
        .repartition("doc_id", "tie", "split")  # equal rows of many splits must not be dealt out by one task
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .withColumn("extra_tokens", extra.cast("long"))
        .where("epochs > 0 or extra_tokens > 0")
        .select("doc_id", *LEVELS, "n_tokens", "tie", "epochs", "extra_tokens")
    )


def narrow_rows(docs: DataFrame, domain: Column) -> DataFrame:
    """What the budgets need of (doc_id, text, lang, source).

    ``tie`` and ``mark`` tell rows of one doc_id apart, ``split`` is the part of the input a row was read in.
    """
    return docs.select(
        "doc_id", F.coalesce(domain, F.lit(NONE)).alias("domain"), F.coalesce("lang", F.lit(NONE)).alias("lang"),
        F.coalesce("source", F.lit(NONE)).alias("source"), n_tokens(F.col("text")).alias("n_tokens"),
        F.xxhash64("text").alias("tie"), F.md5("text").alias("mark"), F.spark_partition_id().alias("split"))


def mix(docs: DataFrame, domain: Column, share: float, weights: DataFrame = None, max_epochs=4.0, seed=0) -> DataFrame:
    """Take ``share`` of all tokens of (doc_id, text, lang, source) by the weights of the tree.

    The narrow rows are written once below the shared folder, so that texts are read once.
    """
    spark = docs.sparkSession
    path = work_dir(spark, "mixing")
    narrow_rows(docs, domain).write.parquet(path)
    narrow = spark.read.parquet(path)
    return take(narrow, budgets(leaf_sums(narrow), share, weights, max_epochs), seed)

"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from printfold.session import in_files, work_dir

ROWS = 50_000  # of edges or labels in a file


def components(edges: DataFrame, nodes=None) -> DataFrame:
    """(node, label) for every node of (a, b), label being the smallest node of its component.

    Each round gives a node the smallest label among its neighbours, then the label of its label, so
    that chains shorten by more than half. Rounds are written below the shared folder; only the count of
    changed rows comes to the driver. Messages are folded before they are shuffled, so a node with very
    many edges gets one a task. Files are by the number of edges, and of ``nodes`` where that is known.
    """
    spark = edges.sparkSession
    path = work_dir(spark, "edges")
    pairs = edges.where("a <> b")
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    (both if nodes is None else in_files(both, nodes, ROWS)).write.parquet(path)
    both = spark.read.parquet(path)
    rows = both.count()
    labels = _written(spark, rows, both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label"), F.lit(True).alias("changed")))
    while labels.where("changed").limit(1).count():
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        better = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = _written(spark, rows, better.join(jump, "label", "left").select(
            "node", F.least("label", F.coalesce("next", "label")).alias("new"), "old").select(
            "node", F.col("new").alias("label"), (F.col("new") < F.col("old")).alias("changed")))
    return labels.drop("changed")


def _written(spark, rows: int, df: DataFrame) -> DataFrame:
    path = work_dir(spark, "labels")
    in_files(df, rows, ROWS).write.parquet(path)
    return spark.read.parquet(path)

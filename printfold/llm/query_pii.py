"""op5: personal data in every document, and the words that give it away."""

from pyspark.sql import functions as F

from printfold.llm.sanitise import KINDS, in_order, joined, with_spans


def op5_pii(spark, folder):
    """Counts and spans of all documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = with_spans(docs)
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                       joined(in_order(F.col("base"), F.col("added"))).alias("spans"))


def _is(kind):
    return lambda m: m["kind"] == kind

"""op2: the language of every document."""

from pyspark.sql import functions as F

from printfold.llm.language_id import held_out, identify, learn


def op2_language_id(spark, folder):
    """Predictions for all documents; learned from those not held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(rows, learn(docs)).select("doc_id", "held_out", "lang_pred", "score", "languages")

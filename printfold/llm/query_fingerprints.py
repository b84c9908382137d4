"""op3: fingerprints of every document and of its edited text."""

from pyspark.sql import functions as F

from printfold.llm.fingerprints import as_text, edit_and_compare


def op3_fingerprints(spark, folder):
    """Fingerprints and likenesses of all documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return edit_and_compare(docs).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next")

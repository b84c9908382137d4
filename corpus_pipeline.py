"""From raw documents to a training mix: stages that each call one operator of ``printfold.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet below the
shared folder and read again as the next one's documents. All but the last return the columns of
``docs``. Each works on all that the one before kept:

- language ID drops documents in no language the model knows,
- near duplicates: one document of each class stays,
- decontamination drops documents that overlap a benchmark item,
- sanitising replaces personal data, and the words that give it away, in the texts,
- mixing takes documents to the target weights; a row has the number of whole epochs and the tokens
  of one more, partial one.

SQL cannot state the first stage (an iterative fit) nor the mix of them; tests hold the stages against
plain versions instead.
"""

from pyspark.sql import functions as F

from printfold.llm.decontaminate import clean
from printfold.llm.jaccard_join import one_of_each
from printfold.llm.language_id import keep_identified, train
from printfold.llm.query_mixing import mixed
from printfold.llm.sanitise import sanitise
from printfold.session import in_files, work_dir

FILE_TEXTS = 2_000  # of the mix in a file


def language(spark, docs, sf_dir):
    """Documents in a language that the model, learned from all their own labels, knows."""
    return keep_identified(docs, train(docs))


def near_duplicates(spark, docs, sf_dir):
    """One document of each class of near duplicates."""
    return one_of_each(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that no benchmark item contaminates."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark, docs, sf_dir):
    """Documents without personal data; their length is counted again where there is one."""
    rows = sanitise(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(kind)))
    return rows


def mixing(spark, docs, sf_dir):
    """The documents taken, whole, with the epochs and tokens to take of each.

    Repeated rows of one doc_id and text come as one row with all they have to give.
    """
    taken = mixed(spark, docs).groupBy(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")).agg(
        F.first("domain").alias("domain"), F.first("n_tokens").alias("n_tokens"), F.sum("epochs").alias("epochs"),
        F.sum("extra_tokens").alias("extra_tokens"))
    added = ("domain", "n_tokens", "epochs", "extra_tokens")
    rows = docs.drop(*added).withColumn("_key", F.xxhash64("text")).dropDuplicates(["doc_id", "_key"])
    same = rows["doc_id"].eqNullSafe(taken["_id"]) & (rows["_key"] == taken["_tie"])
    return in_files(rows.join(taken, same).drop("_id", "_tie", "_key"), docs.count(), FILE_TEXTS)


STAGES = [
    ("language_id", language),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("mixing", mixing),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

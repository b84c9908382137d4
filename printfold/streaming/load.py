"""Loading the relational tables from streams.

A micro-batch of cards only writes what it changed (``streaming.fold.write_changes``); ``load_changes``
merges all changes since the last merge into the tables, as its own job, as often as is worth a new
version of them. A merge rewrites the buckets it touches.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from printfold.functions.scalars import uuid_hex
from printfold.operators.flatten import manifest_rows
from printfold.operators.load import resolve_cards
from printfold.operators.media import mark_status
from printfold.plans.publish import load_tables, resolved
from printfold.schema import CARDS
from printfold.session import drop_dir
from printfold.sources.buckets import BUCKETS, BucketSnapshot, compacted, touched
from printfold.sources.images import no_images
from printfold.sources.prints import append_new
from printfold.streaming.fold import drop_batches, latest_changes, merged_upto, read_changes, start


def load_changes(spark: SparkSession, changes: str, target: str, base_url: str, keep=2, buckets=BUCKETS) -> int:
    """Upsert the cards changed since the last merge and replace their children, as a new version.

    Returns the last batch merged. A merge that is cut short is done again from the same changes. ``buckets``
    is the number a new target begins with.
    """
    upto = merged_upto(spark, target)
    rows = read_changes(spark, changes, upto)
    if rows is not None:
        last = rows.agg(F.max("batch")).first()[0]
        snapshot = BucketSnapshot(spark, target, source=str(last), buckets=buckets)
        load_tables(snapshot, resolved(snapshot, latest_changes(rows, ["oracle_id"]).drop("batch")), base_url)
        snapshot.commit()
        upto = last
    compacted(spark, target, keep)
    drop_batches(spark, changes, upto)
    return upto


def append_print_batches(prints: DataFrame, target: str, checkpoint: str, inventory=None,
                         **trigger):
    """Start appending the new printings of each micro-batch to ``card_prints``.

    Ids come from the keys, so a card not yet loaded gets the id its load will give it.
    ``inventory`` is called for the pictures there are as each batch begins. A batch's manifest is
    written once and read from there. Of the main table a batch reads the buckets of its keys, of the
    printings the months of its dates.
    """

    def load(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        present = inventory() if inventory else no_images(spark)
        arriving = f"{target}/arriving/{batch_id}"
        mark_status(manifest_rows(batch), present).write.mode("overwrite").parquet(arriving)
        manifest = spark.read.parquet(arriving)
        cards = manifest.select("oracle_id").distinct()
        store = BucketSnapshot(spark, target)
        mine = touched(cards.select(uuid_hex(F.col("oracle_id")).alias("oracle_id")), "oracle_id", store.buckets)
        keys = resolve_cards(cards, store.before_in("cards", CARDS, "oracle_id", mine))
        append_new(manifest, keys.select("oracle_id", F.col("id").alias("card_id")), f"{target}/card_prints")
        drop_dir(spark, arriving)

    return start(prints, "append", load, checkpoint, trigger)

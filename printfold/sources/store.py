"""Versioned folders of Parquet tables.

Plain Parquet cannot change rows in place, and no table may be overwritten while it is read. A
load therefore writes all its tables below a new version and then records the version; readers
take the last recorded one, so they never see half a load, and a failed load leaves no trace.
"""

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from printfold.schema import CARD_DOC
from printfold.session import drop_dir, file_names, folder_names

VERSIONS = "version long, source string"
PLACES = "name string, bucket int, buckets int, version long"
ALL = -1  # the bucket of a table written as a whole
CODEC = "zstd"  # of every table written; Spark reads any


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The recorded versions and what each was made from."""
    return read_appended(spark, f"{root}/versions", VERSIONS)


def current_version(spark: SparkSession, root: str) -> int:
    """The last recorded version, 0 before the first."""
    return versions(spark, root).agg(F.max("version")).first()[0] or 0


def table_path(root: str, version: int, name: str) -> str:
    return f"{root}/v{version:08d}/{name}"


def held_places(spark: SparkSession, root: str, version: int) -> DataFrame:
    """(name, bucket, buckets, version): the version that holds each bucket of each table, as of a version.

    A table written as a whole has one row of bucket ``ALL``, which the buckets of later versions replace,
    and which replaces those of earlier ones.
    """
    rows = read_appended(spark, f"{root}/places", PLACES).where(F.col("version") <= version)
    whole = rows.where(F.col("bucket") == ALL).groupBy("name").agg(F.max("version").alias("_whole"))
    last = rows.groupBy("name", "bucket").agg(F.max("version").alias("version"), F.max_by("buckets", "version").alias("buckets"))
    newest = Window.partitionBy("name")
    known = last.join(whole, "name", "left").where(F.col("_whole").isNull() | (F.col("version") >= F.col("_whole")))
    parted = known.withColumn("_parted", F.max(F.col("bucket") != ALL).over(newest))
    return parted.where((F.col("bucket") != ALL) | ~F.col("_parted")).select("name", "bucket", "buckets", "version")


def bucket_number(file: str):
    """The bucket in the name of a bucketed file."""
    found = re.search(r"_([0-9]{5,})\.", file)
    return int(found[1]) if found else None


def bucket_scan_files(spark: SparkSession, folder: str) -> list:
    return [f for f in file_names(spark, folder) if bucket_number(f) is not None]


def read_table(spark: SparkSession, root: str, name: str, schema=None, version=None) -> DataFrame:
    """A table of the last version (or the given one); empty before the first, given a schema.

    Of a table in buckets, the files that hold them are read, in one scan.
    """
    version = current_version(spark, root) if version is None else version
    if not version and schema is not None:
        return spark.createDataFrame([], schema)
    held = {}
    for r in held_places(spark, root, version).where((F.col("name") == name) & (F.col("bucket") != ALL)).collect():
        held.setdefault(r.version, set()).add(r.bucket)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if not held:
        return reader.parquet(table_path(root, version, name))
    paths = []
    for place, buckets in sorted(held.items()):
        folder = table_path(root, place, name)
        files = bucket_scan_files(spark, folder)
        mine = [f for f in files if bucket_number(f) in buckets]
        paths += [folder] if len(mine) == len(files) else [f"{folder}/{f}" for f in mine]
    return reader.parquet(*paths) if paths else spark.createDataFrame([], schema)


class Snapshot:
    """A version being written; ``source`` names what it is made from, such as a stream's batch."""

    def __init__(self, spark: SparkSession, root: str, source: str = None):
        self.spark, self.root, self.source = spark, root, source
        self.previous = current_version(spark, root)
        self.version = self.previous + 1
        self.places = []

    def done(self) -> bool:
        """Whether a version from the same source is recorded already."""
        return not versions(self.spark, self.root).where(F.col("source") == self.source).isEmpty()

    def path(self, name: str) -> str:
        return table_path(self.root, self.version, name)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table and return it as stored, which also ends its lineage."""
        df.write.mode("overwrite").parquet(self.path(name), compression=CODEC)
        self.places.append((name, ALL, None))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def at_once(self, *steps) -> None:
        """Run independent writes at the same time, so that one's last tasks leave no core idle."""
        run = inheritable_thread_target(self.spark)(lambda step: step())
        with ThreadPoolExecutor(max_workers=4) as pool:
            list(pool.map(run, steps))

    def write_all(self, tables: dict) -> None:
        """Write independent tables at the same time."""
        self.at_once(*[lambda item=item: self.write(*item) for item in tables.items()])

    def before(self, name: str, schema) -> DataFrame:
        """The table as of the previous version."""
        return read_table(self.spark, self.root, name, schema, self.previous)

    def commit(self) -> int:
        """Record where the tables are, then the version; a repeated load's places overwrite those of one cut short."""
        places = self.spark.createDataFrame(self.places, "name string, bucket int, buckets int")
        places.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/places/version={self.version}")
        row = self.spark.range(1).select(
            F.lit(self.version).cast("long").alias("version"),
            F.lit(self.source).cast("string").alias("source"),
        )
        append(row, f"{self.root}/versions")
        return self.version


def write_snapshot(spark: SparkSession, tables: dict, root: str) -> int:
    """Write tables as the next version."""
    snapshot = Snapshot(spark, root)
    snapshot.write_all(tables)
    return snapshot.commit()


def purge(spark: SparkSession, root: str, keep: int = 1) -> list:
    """Delete tables of versions older than the last ``keep`` recorded ones; returns the numbers of those gone.

    The current version always stays, as does one being written, and what they hold in an older version's
    buckets. Readers of a deleted version fail, so keep as many as a reader may still be at.
    """
    oldest = current_version(spark, root) - max(keep, 1) + 1
    numbers = sorted(int(n[1:]) for n in folder_names(spark, root) if n[:1] == "v" and n[1:].isdigit())
    held = held_places(spark, root, oldest).where((F.col("bucket") != ALL) & (F.col("version") < oldest))
    needed = {(r.version, r.name) for r in held.select("version", "name").distinct().collect()}
    gone = []
    for number in numbers:
        if number >= oldest:
            continue
        folder = f"{root}/v{number:08d}"
        kept = {name for v, name in needed if v == number}
        if not kept:
            drop_dir(spark, folder)
            gone.append(number)
            continue
        for name in folder_names(spark, folder):
            if name not in kept:
                drop_dir(spark, f"{folder}/{name}")
    return gone


def read_cards(spark: SparkSession, root: str) -> DataFrame:
    """The card store."""
    return read_table(spark, root, "cards")


def read_card_docs(spark: SparkSession, root: str) -> DataFrame:
    """Cards kept as one JSON document per folder: ``<root>/<card>/card.json``.

    For importing a folder tree of moderate size once: Spark lists every folder on the driver.
    """
    return spark.read.schema(CARD_DOC).options(multiLine=True, mode="FAILFAST").json(
        f"{root}/*/card.json"
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_appended(spark: SparkSession, path: str, schema) -> DataFrame:
    """An append-only table; empty before the first append."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

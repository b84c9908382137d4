"""Session settings and the shared folder."""

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Sizing (executors, shuffle partitions) belongs to the cluster; these are the settings the jobs
# want on any of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State of the streaming fold is one row per card; keep it off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(builder):
    """Apply the settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


_OWN = {}  # folders of local sessions, by application; they go with the process


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where it is unset a local session gets a folder of its own; a cluster must name one.
    """
    path = spark.conf.get("spark.checkpoint.dir", "")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.TemporaryDirectory(prefix="printfold-", ignore_cleanup_errors=True)
    return _OWN[app].name


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


LEAST_FILES = 8


def in_files(df: DataFrame, rows: int, each: int, moved=False) -> DataFrame:
    """``df`` in as many partitions as ``rows`` rows want, ``each`` a partition.

    A shuffle leaves as many files as it has partitions, however little lies in them, and for each file and its folder
    an executor whose files are local starts processes to set their modes. Partitions are put together where they
    are, so a task then has the last step of several; ``moved`` deals out the rows instead, for few rows that were much work.
    """
    files = max(LEAST_FILES, math.ceil(rows / each))
    return df.repartition(files) if moved else df.coalesce(files)


def drop_dir(spark: SparkSession, path: str) -> bool:
    """Delete a folder the library made, wherever Spark keeps it; False when it is not there."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _listed(spark: SparkSession, path: str) -> list:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(files.listStatus(folder)) if files.exists(folder) else []


def folder_names(spark: SparkSession, path: str) -> list:
    """Names of the folders directly below a folder of the library's own."""
    return [f.getPath().getName() for f in _listed(spark, path) if f.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list:
    """Names of the data files directly in a folder of the library's own."""
    names = [f.getPath().getName() for f in _listed(spark, path) if not f.isDirectory()]
    return [n for n in names if n[0] not in "._"]


def keep_state_off_heap(spark: SparkSession) -> None:
    """Streams of this session keep their state, one row per card, in the store of ``SETTINGS``."""
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, SETTINGS[key])

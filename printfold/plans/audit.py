"""Card store against picture folder: what to fetch, what is missing.

``audit`` works both reports out from all tables. ``audit_changes`` does so for the cards of which anything has changed
since its last round, and is read with ``read_report``. Each keeps to a folder of its own.

Every row of a report depends on the lines, card and pictures of one key alone. A round therefore sums hashes of
what the reports read of each key, in one pass that folds inside every task first, and audits anew only keys
whose sums differ from those of their last round. The lines of those keys are moved once: what is lacking is written
beside the reports for as long as a round takes, and all reports are made from it. A round writes what its keys have
now and nothing else; a key's rows are those of the last round it was in. ``compact_reports`` makes one round of all.

Sums do not tell in which order lines come. That only matters to a picture that lines give several urls,
of which the first counts: a key whose card wants such a picture is audited in every round.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from printfold.operators.media import card_facts, fetch_list, fetch_list_of, integrity_report, integrity_report_of, lacking_pictures
from printfold.operators.sieve import sieved
from printfold.session import drop_dir, work_dir
from printfold.sources.images import no_images
from printfold.sources.store import CODEC, Snapshot, purge, read_table, table_path, versions, write_snapshot

KEY = "oracle_id"
SUMS = ["s0", "s1", "s2", "s3"]
REPORTS = {
    "fetch_list": "oracle_id string, sid string, side string, url string, file string",
    "integrity_report": "oracle_id string, name string, side string, sid string",
}
AUDITED = f"oracle_id string, {', '.join(f'{s} long' for s in SUMS)}, unsettled boolean"
PER_TASK = 1 << 20  # lines and pictures of a key that one task takes
WHOLE, CHANGES = "whole", "changes"  # what a round holds: all keys, or those that changed


def audit(spark: SparkSession, store: str, reports: str, inventory: DataFrame = None) -> int:
    """Write ``fetch_list`` and ``integrity_report`` as a new version of ``reports``."""
    cards = read_table(spark, store, "cards")
    manifest = read_table(spark, store, "manifest")
    present = no_images(spark) if inventory is None else inventory
    tables = {
        "fetch_list": fetch_list(manifest, cards, present),
        "integrity_report": integrity_report(manifest, cards, present),
    }
    return write_snapshot(spark, tables, reports)


def _halves(seed: int, kind: str, columns) -> list:
    """Both halves of a row's hash, so that sums of them stay within a long; nulls count as such."""
    fields = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    number = F.xxhash64(F.lit(seed), F.lit(kind), *fields)
    return [number.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(number, 32)]


def contents(manifest: DataFrame, cards: DataFrame, inventory: DataFrame) -> DataFrame:
    """(oracle_id, sums, held) over all that a report reads of a key; 128 bits of hashes, whatever the order of rows.

    ``held`` is the number of a key's lines and pictures.
    """

    def hashed(rows, kind, *columns):
        halves = [half for seed in (1, 2) for half in _halves(seed, kind, columns)]
        held = F.lit(0 if kind == "card" else 1).alias("held")
        return rows.select(KEY, *[half.alias(name) for half, name in zip(halves, SUMS)], held)

    rows = [
        hashed(manifest, "line", "sid", "side", "url"),
        hashed(cards, "card", "name", "back", "art"),
        hashed(inventory, "picture", "sid", "side"),
    ]
    return reduce(DataFrame.unionByName, rows).groupBy(KEY).agg(*[F.sum(s).alias(s) for s in (*SUMS, "held")])


def _rounds(spark: SparkSession, reports: str) -> list:
    """Numbers of the rounds from the last whole one on."""
    known = versions(spark, reports).where(F.col("source").isin(WHOLE, CHANGES))
    whole = known.agg(F.max(F.when(F.col("source") == WHOLE, F.col("version")))).first()[0] or 0
    return sorted(r.version for r in known.where(F.col("version") >= whole).collect())


def _read_rounds(spark: SparkSession, reports: str, rounds: list, name: str, schema: str) -> DataFrame:
    schema = f"{schema}, round long"
    if not rounds:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[table_path(reports, r, name) for r in rounds])


def audited_keys(spark: SparkSession, reports: str, rounds: list = None) -> DataFrame:
    """Every key's last round, with the sums it then had; null sums where nothing of it was left."""
    rounds = _rounds(spark, reports) if rounds is None else rounds
    rows = _read_rounds(spark, reports, rounds, "audited", AUDITED)
    if len(rounds) < 2:
        return rows
    last = F.max_by(F.struct(*SUMS, "unsettled"), "round").alias("_last")
    return rows.groupBy(KEY).agg(last, F.max("round").alias("round")).select(KEY, "_last.*", "round")


def read_report(spark: SparkSession, reports: str, name: str, rounds: list = None) -> DataFrame:
    """A report as of the last round: of each key the rows of the last round it was in."""
    rounds = _rounds(spark, reports) if rounds is None else rounds
    rows = _read_rounds(spark, reports, rounds, name, REPORTS[name])
    if len(rounds) > 1:
        last = audited_keys(spark, reports, rounds).select(KEY, "round")
        # No round is later than a key's last. An inequality leaves the join to the key alone, on which a reader may go
        # on joining without moving the rows again.
        rows = sieved(rows, last, [KEY, "round"]).join(last.withColumnRenamed("round", "_last"), KEY)
        rows = rows.where("round >= _last").drop("_last")
    return rows.drop("round")


def _differs() -> Column:
    same = reduce(Column.__and__, [F.col(s).eqNullSafe(F.col(f"_{s}")) for s in SUMS])
    return ~same | F.coalesce(F.col("unsettled"), F.lit(False))


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path, compression=CODEC)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def audit_changes(spark: SparkSession, store: str, reports: str, inventory: DataFrame = None) -> int:
    """Audit the keys of which anything changed since the last round; returns the number of the last round.

    The first round finds all keys changed. Nothing is written where nothing changed, and a round that is
    cut short is done again. Keys are not null. One writer per folder.
    """
    cards = read_table(spark, store, "cards")
    manifest = read_table(spark, store, "manifest")
    present = no_images(spark) if inventory is None else inventory
    snapshot = Snapshot(spark, reports, source=CHANGES)
    before = audited_keys(spark, reports).drop("round").withColumnsRenamed({s: f"_{s}" for s in SUMS})
    both = contents(manifest, cards, present).join(before, KEY, "full")
    work = work_dir(spark, "audit")
    changed = _kept(both.where(_differs()).select(KEY, *SUMS, "held"), f"{work}/changed")
    if not changed.isEmpty():
        keys, weights = changed.select(KEY), changed.select(KEY, "held")
        lacking = _kept(lacking_pictures(manifest, card_facts(keys, cards), present, weights, PER_TASK), f"{work}/lacking")
        stored = cards.join(keys, KEY, "left_semi")
        held = changed.where(F.col(KEY).isNotNull() & (F.col("held") > 0))
        unsettled = lacking.where("unsettled").select(KEY, "unsettled").distinct()
        audited = changed.drop("held").join(unsettled, KEY, "left").withColumn("unsettled", F.coalesce("unsettled", F.lit(False)))
        tables = {
            "fetch_list": fetch_list_of(lacking, stored, present),
            "integrity_report": integrity_report_of(lacking, stored, present, held),
            "audited": audited,
        }
        number = F.lit(snapshot.version).cast("long")
        snapshot.write_all({name: rows.withColumn("round", number) for name, rows in tables.items()})
        snapshot.commit()
    drop_dir(spark, work)
    return (_rounds(spark, reports) or [0])[-1]


def compact_reports(spark: SparkSession, reports: str) -> int:
    """Make one round of all and delete those before it; returns its number.

    Keys of which nothing is left go. To be run on a schedule, by the one writer.
    """
    rounds = _rounds(spark, reports)
    if len(rounds) > 1:
        snapshot = Snapshot(spark, reports, source=WHOLE)
        number = F.lit(snapshot.version).cast("long")
        left = audited_keys(spark, reports, rounds).where(F.col(SUMS[0]).isNotNull())
        tables = {name: read_report(spark, reports, name, rounds) for name in REPORTS} | {"audited": left.drop("round")}
        snapshot.write_all({name: rows.withColumn("round", number) for name, rows in tables.items()})
        rounds = [snapshot.commit()]
        purge(spark, reports)
    return (rounds or [0])[-1]

"""Reports audited by changes against the audit of everything."""

import random
import sys

import pytest
from pyspark.sql import functions as F

from printfold.operators import sieve
from printfold.operators.media import card_facts, fetch_list, integrity_report, lacking_pictures
from printfold.plans import audit_changes, compact_reports, read_report
from printfold.plans.audit import audited_keys, contents
from printfold.session import folder_names
from printfold.sources.store import Snapshot, write_snapshot

audit_plan = sys.modules["printfold.plans.audit"]  # the package has a function of that name
MANIFEST = "oracle_id string, sid string, side string, url string, pos int"
CARDS = "oracle_id string, name string, back string, art string"
PICTURES = "oracle_id string, sid string, side string"


class Feed:
    """A store that is written anew in every round, and its reports."""

    def __init__(self, spark, folder):
        self.spark, self.store, self.reports = spark, folder("store"), folder("reports")

    def round(self, lines, cards, pictures):
        made = lambda rows, schema: self.spark.createDataFrame([tuple(r) for r in rows], schema)
        self.tables = made(lines, MANIFEST), made(cards, CARDS), made(pictures, PICTURES)
        write_snapshot(self.spark, {"manifest": self.tables[0], "cards": self.tables[1]}, self.store)
        return audit_changes(self.spark, self.store, self.reports, self.tables[2])

    def check(self):
        for name, whole in (("fetch_list", fetch_list), ("integrity_report", integrity_report)):
            found = read_report(self.spark, self.reports, name)
            assert listed(found) == listed(whole(*self.tables)), name

    def rounds(self):
        return {r.oracle_id: r.round for r in audited_keys(self.spark, self.reports).collect()}


def listed(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


LINES = [("a", "1", "front", "u1", 0), ("a", "1", "back", "u2", 0), ("a", "2", "front", "u3", 1),
         ("b", "3", "front", "u4", 2), ("c", "4", "front", "u5", 3), ("c", "4", "front", "u5", 4), ("o", "5", "front", "u6", 5)]
STORED = [("a", "Ash", "x", "y"), ("b", None, None, None), ("c", "Cy", None, "z"), ("d", "Dew", None, None)]


@pytest.fixture
def rounds(spark, folder):
    return Feed(spark, folder)


def test_rounds_equal_the_audit_of_everything(rounds):
    assert rounds.round(LINES, STORED, []) == 1
    rounds.check()
    assert set(rounds.rounds().values()) == {1}
    # Nothing changed, though lines come in another order.
    assert rounds.round(LINES[::-1], STORED[::-1], []) == 1
    assert folder_names(rounds.spark, rounds.reports).count("v00000002") == 0
    # A picture arrives, a line goes, a card loses its back, an orphan is stored.
    stored = [("a", "Ash", None, "y"), *STORED[1:], ("o", "Oak", None, None)]
    assert rounds.round(LINES, stored, [("c", "4", "front"), ("x", "9", "back")]) == 2
    rounds.check()
    assert rounds.rounds() == {"a": 2, "b": 1, "c": 2, "d": 1, "o": 2, "x": 2}
    # A card goes with its lines; the stray picture goes too.
    assert rounds.round([r for r in LINES if r[0] != "b"], [r for r in stored if r[0] != "b"], [("c", "4", "front")]) == 3
    rounds.check()
    assert rounds.rounds() == {"a": 2, "b": 3, "c": 2, "d": 1, "o": 2, "x": 3}
    written = rounds.spark.read.parquet(f"{rounds.reports}/v00000003/integrity_report")
    assert written.isEmpty()  # what has not changed is not written again
    # All of it comes back.
    assert rounds.round(LINES, STORED, []) == 4
    rounds.check()


def test_rounds_go_on_after_compaction(rounds):
    rounds.round(LINES, STORED, [])
    rounds.round(LINES, STORED[:2], [("a", "2", "front")])
    assert compact_reports(rounds.spark, rounds.reports) == 3
    rounds.check()
    assert set(rounds.rounds().values()) == {3} and "d" not in rounds.rounds()
    assert [n for n in folder_names(rounds.spark, rounds.reports) if n[0] == "v" and n[1:].isdigit()] == ["v00000003"]
    assert compact_reports(rounds.spark, rounds.reports) == 3
    assert rounds.round(LINES, STORED[:2], [("a", "2", "front")]) == 3
    assert rounds.round(LINES[1:], STORED, []) == 4
    rounds.check()


def test_the_first_of_several_urls_counts_after_lines_change_places(rounds):
    two = [("a", "1", "front", "low", 0), ("a", "1", "front", "high", 1)]
    for n, lines in enumerate((two, two, [(*two[0][:4], 2), two[1]]), 1):
        assert rounds.round([*lines, *LINES[3:]], STORED, []) == n
        rounds.check()
    assert read_report(rounds.spark, rounds.reports, "fetch_list").where("oracle_id = 'a' and sid = '1'").first().url == "high"
    assert rounds.rounds()["b"] == 1


def test_empty_tables(rounds):
    assert rounds.round([], [], []) == 0
    rounds.check()
    assert compact_reports(rounds.spark, rounds.reports) == 0
    assert rounds.round(LINES, [], []) == 1
    rounds.check()
    assert rounds.round([], [], []) == 2
    rounds.check()


def test_a_round_cut_short_is_done_again(rounds, monkeypatch):
    rounds.round(LINES, STORED, [])

    def lost(self):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Snapshot, "commit", lost)
        with pytest.raises(RuntimeError):
            rounds.round(LINES, STORED[:1], [])
    assert len(read_report(rounds.spark, rounds.reports, "integrity_report").where("name is not null").collect()) > 1
    assert rounds.round(LINES, STORED[:1], []) == 2
    rounds.check()


def test_keys_are_summed_before_the_shuffle(rounds):
    rounds.round(LINES, STORED, [])
    plan = contents(*rounds.tables)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "partial_sum" in below and "Exchange" not in below and "partial_sum" not in above


def test_lines_of_a_round_are_moved_once(rounds):
    """The reports of a round moved all lines three times, each on its own."""
    rounds.round(LINES, STORED, [])
    manifest, cards, pictures = rounds.tables
    keys = contents(*rounds.tables).select("oracle_id", "held")
    spark, before = rounds.spark, rounds.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        found = lacking_pictures(manifest, card_facts(keys.select("oracle_id"), cards), pictures, keys, 2)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [line for line in plan.splitlines() if " Exchange hash" in line and "_salt#" in line]
    assert len(moved) == 2 and sum("REPARTITION_BY_COL" in line for line in moved) == 1
    # Neither are lines moved that no card wants.
    wanted = [(r.oracle_id, r.sid, r.side) for r in found.where("to_fetch").collect()]
    assert sorted(wanted) == [("a", "1", "back"), ("a", "1", "front"), ("a", "2", "front"), ("b", "3", "front"), ("c", "4", "front")]


@pytest.mark.parametrize("per_task", [1, 3, 1 << 20])
def test_hot_keys_keys_with_several_cards_and_nulls(rounds, monkeypatch, per_task):
    monkeypatch.setattr(audit_plan, "PER_TASK", per_task)
    rng = random.Random(per_task)
    key = lambda: "hot" if rng.random() < 0.5 else f"k{rng.randrange(8)}"
    sides, sids = ["front", "back", "other", None], [*map(str, range(9)), None]
    lines = [(key(), rng.choice(sids), rng.choice(sides), rng.choice(["u", "v", "", None]), n) for n in range(300)]
    cards = [(key(), rng.choice(["N", "M", None]), rng.choice(["b", "", None]), rng.choice(["a", None])) for _ in range(9)]
    pictures = [(key(), rng.choice(sids), rng.choice([*sides, "art"])) for _ in range(60)]
    for lines, cards, pictures in ((lines, cards, []), (lines, cards, pictures), (lines[40:], cards[1:] * 2, pictures[5:])):
        rounds.round(lines, cards, pictures)
        rounds.check()


def test_sieve_loses_no_match(spark, monkeypatch):
    monkeypatch.setattr(sieve, "BITS", 1 << 17)
    rows = spark.range(60_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).alias("round"))
    keys = rows.where("cast(k as int) % 30 = 0")
    left = sieve.sieved(rows, keys, ["k", "round"])
    assert left.columns == rows.columns and left.join(keys, ["k", "round"]).count() == 2000
    assert 2000 <= left.count() < 4000
    assert sieve.sieved(rows, keys.limit(0), ["k", "round"]).isEmpty()

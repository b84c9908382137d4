"""DataFrame operators against plain-Python models and hand-made tables."""

import json
import random
import re
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from printfold.operators.children import explode_child
from printfold.functions.predicates import has_front, is_valid
from printfold.operators.flatten import narrow_prints
from printfold.operators import fold as operators_fold
from printfold.operators.fold import checked, fold_cards, fold_feed, fold_narrow, fold_written, group_ordered
from printfold.operators.load import append_prints, read_dimension, replace_children, resolve_key, upsert
from printfold.operators.media import known_keys, mark_status, orphans, semi_back
from printfold.operators.skew import hot_keys, salted_join
from printfold.queries import QUERIES, catalogue
from printfold.schema import FEED
from printfold.sources.feed import read_json_array
from printfold.sources.store import read_table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# -- fold ---------------------------------------------------------------------------------------


def sequential(printings):
    """The fold one printing at a time: keep unless the kept one is strictly newer."""
    cards = {}
    for oracle_id, sid, date, price, tix in printings:
        day = date if date and date[0].isdigit() else ""
        kept = cards.get(oracle_id)
        if kept is None:
            cards[oracle_id] = [sid, day, price, tix]
            continue
        low = [
            min((x for x in pair if x is not None), default=None)
            for pair in ((kept[2], price), (kept[3], tix))
        ]
        cards[oracle_id] = ([*kept[:2], *low] if kept[1] > day else [sid, day, *low])
    return sorted((k, v[0], v[2], v[3]) for k, v in cards.items())


@pytest.mark.parametrize("seed", range(3))
def test_fold_equals_sequential_rule(spark, seed):
    rng = random.Random(seed)
    dates = ["2020-01-01", "2020-01-02", "2021-01-01", "soon", None]
    prices = [None, 0.0, 1.5, 2.0, 300.0]
    feed = []
    for i in range(3000):
        # A third of all printings belongs to one card.
        key = "hot" if rng.random() < 0.33 else f"k{rng.randrange(300)}"
        feed.append((key, f"s{i:05d}", rng.choice(dates), rng.choice(prices), rng.choice(prices)))
    df = spark.createDataFrame(
        [(*p, i) for i, p in enumerate(feed)],
        "oracle_id string, sid string, date string, price double, tix double, pos int",
    ).repartition(7, "sid")
    found = fold_cards(checked(df)).select("oracle_id", "sid", "price", "tix")
    assert sorted(tuple(r) for r in found.collect()) == sequential(feed)


def test_fold_sends_one_row_per_key_and_task(spark):
    df = spark.range(1000, numPartitions=4).select(
        F.lit("hot").alias("oracle_id"), F.col("id").cast("string").alias("sid"),
        F.lit("2020-01-01").alias("date"), F.lit(1.0).alias("price"), F.lit(1.0).alias("tix"),
        F.col("id").alias("pos"),
    )
    plan = fold_cards(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "partial_min" in plan


def written_prints(spark, tmp_path, seed):
    """Narrow printings of a feed in several files and splits, some with several elements on a line."""
    rng = random.Random(seed)
    dates = ["2020-01-01", "2020-01-02", "soon", "-0001-05-05", "99999-01-01", None]
    (tmp_path / "feed").mkdir()
    number = iter(range(10**6))
    for file in "cab":
        lines = ["["]
        for _ in range(300):
            elements = [{
                "id": f"s{rng.randrange(10**6)}-{next(number)}", "oracle_id": "hot" if rng.random() < 0.33 else f"k{rng.randrange(60)}",
                "name": "n", "layout": "normal", "lang": "en", "released_at": rng.choice(dates),
                "image_uris": {"png": "p"}, "prices": {"usd": rng.choice([None, "1.5", "0.2"]), "tix": rng.choice([None, "3"])},
            } for _ in range(rng.choice([0, 1, 1, 3]))]
            lines.append("".join(json.dumps(e) + "," for e in elements))
        (tmp_path / "feed" / f"{file}.json").write_text("\n".join([*lines, "]"]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        raw = read_json_array(spark, str(tmp_path / "feed"))
        narrow_prints(raw).where(has_front()).write.parquet(str(tmp_path / "prints"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    return checked(spark.read.parquet(str(tmp_path / "prints")))


@pytest.mark.parametrize("seed", range(2))
def test_fold_by_pointer_equals_fold_by_row(spark, tmp_path, seed):
    prints = written_prints(spark, tmp_path, seed)
    assert prints.select("pos.file", "pos.block").distinct().count() > 10
    found, wanted = fold_written(prints), fold_narrow(prints)
    assert found.columns == wanted.columns
    assert rows(found) == rows(wanted) and found.count() == 61
    assert rows(fold_written(prints.limit(0))) == []


def test_fold_by_pointer_folds_numbers(spark, tmp_path):
    plan = fold_written(written_prints(spark, tmp_path, 9))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "max_by" not in plan
    assert "HashAggregate(keys=[oracle_id" in plan and "partial_max(pointer" in plan
    scans = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert sum("element" in s for s in scans) == 1


def test_pointer_fold_moves_no_feed_row_for_its_number(spark, tmp_path):
    prints = written_prints(spark, tmp_path, 9)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        plan = fold_written(prints)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan


@pytest.mark.parametrize("slots", [1, 2])
def test_cards_that_share_a_slot(spark, tmp_path, monkeypatch, slots):
    monkeypatch.setattr(operators_fold, "SLOTS", slots)
    prints = written_prints(spark, tmp_path, 9)
    found, wanted = fold_written(prints), fold_narrow(prints)
    assert rows(found.select(*wanted.columns)) == rows(wanted)


def test_only_winners_rows_move(spark, tmp_path):
    # All cards in one slot, so that its lowest winner holds hardly any row back.
    prints = written_prints(spark, tmp_path, 9)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(operators_fold, "SLOTS", 1)
        cards = fold_written(prints)
        cards.collect()
    plan = cards._jdf.queryExecution().executedPlan()
    moved, found = [], [plan]
    while found:
        node = found.pop()
        if node.nodeName() == "Exchange" and "hashpartitioning(pointer" in node.outputPartitioning().toString():
            moved.append(node.metrics().apply("shuffleRecordsWritten").value())
        inner = {"AdaptiveSparkPlan": "executedPlan", "ResultQueryStage": "plan", "ShuffleQueryStage": "plan"}.get(node.nodeName())
        below = node.children()
        found += [getattr(node, inner)()] if inner else [below.apply(i) for i in range(below.size())]
    assert len(moved) == 2 and all(61 <= n <= 70 for n in moved), moved


def test_feed_to_cards_stores_no_value_twice(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "work_dir", lambda *_: str(tmp_path / "kept"))
    written_prints(spark, tmp_path, 5)
    raw = read_json_array(spark, str(tmp_path / "feed"))
    found, wanted = catalogue.cards(SimpleNamespace(spark=spark), raw), fold_feed(raw.where(is_valid()))
    assert rows(found) == rows(wanted.select(*found.columns)) and rows(found)
    assert read_table(spark, str(tmp_path / "kept"), "printings", version=1).columns == [*FEED.fieldNames(), "pos"]


def test_printing_without_key_fails(spark):
    df = spark.createDataFrame(
        [(None, "s", "2020-01-01", 1.0, 1.0, 1)],
        "oracle_id string, sid string, date string, price double, tix double, pos int",
    )
    with pytest.raises(PySparkException, match="oracle_id is null"):
        fold_cards(checked(df)).collect()


def test_group_ordered(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id").alias("pos"),
    )
    found = group_ordered(df, "k", ["pos"], F.floor(F.col("pos") / 100)).collect()
    places = {}
    for r in sorted(found, key=lambda r: r.pos):
        places.setdefault(r.k, []).append(r.line_no)
    assert len(found) == 5000
    assert all(v == list(range(1, len(v) + 1)) for v in places.values())


# -- skew ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """Nine thousand rows, a third of one key, some without a key; right keys partly unknown."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 500)
    left = spark.range(9000).select(key.cast("long").alias("k"), F.col("id").alias("v"))
    right = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_a_join(skewed, how):
    left, right = skewed
    weights = left.groupBy("k").count()
    for known in (None, weights):
        salted = salted_join(left, right, "k", how, weights=known, per_task=50)
        assert salted.columns == left.join(right, "k", how).columns
        assert rows(salted) == rows(left.join(right, "k", how))


def test_hot_key_is_split(skewed):
    left, _ = skewed
    weights = left.groupBy("k").count()
    hot = {r.k: r._salts for r in hot_keys(weights, "k", "count", 50).collect()}
    assert hot[7] >= 3000 // 50 and len(hot) <= 9000 // 50


def test_salted_join_with_known_weights(skewed):
    left, right = skewed
    weights = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    salted = salted_join(left, right, "k", weights=weights, spread=["v"], per_task=100)
    assert rows(salted) == rows(left.join(right, "k"))


def test_salted_join_refuses_outer(skewed):
    with pytest.raises(ValueError):
        salted_join(*skewed, "k", "full_outer")


# -- reconcile ----------------------------------------------------------------------------------


def test_status_and_backs(spark):
    prints = spark.createDataFrame(
        [("a", "1", "front"), ("a", "1", "back"), ("b", "2", "front")],
        "oracle_id string, sid string, side string",
    )
    there = spark.createDataFrame(
        [("a", "1", "front"), ("a", "1", "front"), ("a", None, "art")], "oracle_id string, sid string, side string"
    )
    assert rows(mark_status(prints, there)) == [
        ("a", "1", "back", "new"), ("a", "1", "front", "old"), ("b", "2", "front", "new")
    ]
    cards = spark.createDataFrame([("a", "x"), ("b", ""), ("c", None)], "oracle_id string, back string")
    assert {r[0] for r in rows(semi_back(prints, cards))} == {"a"}


def test_orphans(spark):
    one = spark.createDataFrame([("a",), ("b",), ("a",)], "oracle_id string")
    two = spark.createDataFrame([("c",)], "oracle_id string")
    cards = spark.createDataFrame([("a",)], "oracle_id string")
    assert rows(orphans(known_keys(one, two), cards)) == [("b",), ("c",)]


# -- load ---------------------------------------------------------------------------------------


def test_upsert(spark):
    schema = "id string, name string, x int, y string"
    target = spark.createDataFrame([("a", "A", 1, "p"), ("b", "B", 2, "q")], schema)
    source = spark.createDataFrame([("b", "new", None, "r"), ("c", "C", 3, None)], schema)
    assert rows(upsert(target, source, ["id"], keep=("name",))) == [
        ("a", "A", 1, "p"), ("b", "B", None, "r"), ("c", "C", 3, None)
    ]


def test_upsert_into_nothing_and_from_nothing(spark):
    schema = "id string, name string"
    some, none = spark.createDataFrame([("a", "A")], schema), spark.createDataFrame([], schema)
    assert rows(upsert(none, some, ["id"])) == rows(upsert(some, none, ["id"])) == [("a", "A")]


def test_replace_children(spark):
    schema = "id string, card_id string, name string"
    target = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y"), ("3", "c", "z")], schema)
    new = spark.createDataFrame([("4", "a", "n")], schema)
    touched = spark.createDataFrame([("a",), ("b",)], "card_id string")
    assert rows(replace_children(target, new, touched)) == [("3", "c", "z"), ("4", "a", "n")]


def test_resolve_key_and_dimension(spark):
    dimension = spark.createDataFrame(
        [("9", "a", "z"), ("1", "a", "x")], "id string, oracle_id string, name string"
    )
    assert rows(read_dimension(dimension)) == [("1", "a", "x")]
    cards = spark.createDataFrame([("a",), ("b",)], "oracle_id string")
    first, second = (
        {r.oracle_id: r.id for r in resolve_key(cards, read_dimension(dimension)).collect()}
        for _ in range(2)
    )
    assert first["a"] == "1" and len(first["b"]) == 32 and first == second
    assert resolve_key(cards, dimension).count() == 2  # also where a key has two ids


def test_append_prints_is_repeatable(spark):
    manifest = spark.createDataFrame(
        [("new", "2020-01-01", "s1", "a", "front"), ("new", "2020-01-01", "s2", "a", "back"),
         ("old", "2020-01-01", "s3", "a", "front"), ("new", "soon", "s4", "b", "front"),
         ("new", "2020-01-01", "s5", "gone", "front")],
        "status string, date string, sid string, oracle_id string, side string",
    )
    keys = spark.createDataFrame([("a", "A"), ("b", "B")], "oracle_id string, card_id string")
    none = spark.createDataFrame([], "id string, card_id string, released int")
    added = append_prints(manifest, keys, none)
    assert {(r.card_id, r.released) for r in added.collect()} == {("A", 20200101), ("B", None)}
    assert append_prints(manifest, keys, added).isEmpty()


def test_children_keep_duplicates(spark):
    df = spark.createDataFrame(
        [("1", ["x", "x", "q"]), ("2", []), ("3", None)], "id string, items array<string>"
    )
    found = explode_child(df, "items", "code", "t", codes={"x": 5}).collect()
    assert Counter((r.card_id, r.code) for r in found) == {("1", 5): 2, ("1", None): 1}
    assert len({r.id for r in found}) == 3


def test_words_of_a_text_are_summed_up_where_it_is_read(spark, tmp_path):
    texts = [(1, "a b a"), (2, "c"), (2, "c d"), (2, None), (3, None), (4, ""), (None, "x y"), (None, "y z"), (5, "e e"), (5, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["q_explode_text"](spark, str(tmp_path))
    assert sorted((r.doc_id or 0, r.words, r.forms) for r in found.collect()) == [(0, 4, 3), (1, 3, 2), (2, 3, 2), (4, 1, 1), (5, 2, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"keys=\[card_id#\w+, word#\w+\], functions=\[partial_", plan)

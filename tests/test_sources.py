"""Readers and writers on small files."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from printfold.operators.flatten import flatten_prints
from printfold.operators.media import mark_status
from printfold.plans import ingest
from printfold.queries.catalogue import lines_with_parts, printings
from printfold.queries.registry import Tables
from printfold.schema import CARD_DOC, FEED
from printfold.session import drop_dir, file_names, shared_dir, work_dir
from printfold.sources.buckets import BucketSnapshot
from printfold.sources.feed import parse_elements, read_json_array
from printfold.sources.images import image_inventory, inventory_of, no_images
from printfold.sources.manifest import read_manifest, read_manifest_text, write_manifest
from printfold.sources.store import (
    Snapshot,
    purge,
    current_version,
    read_card_docs,
    read_cards,
    read_table,
    write_snapshot,
)


def ids(df):
    return [r.id for r in df.orderBy("pos").collect()]


def write(path, text):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf8")
    return str(path)


def test_feed_keeps_order_over_splits(spark, folder):
    n = 3000
    lines = ",\n".join(json.dumps({"id": f"{i}", "oracle_text": "é\n" * 20}) for i in range(n))
    path = write(folder("big.json"), f"[\n{lines}\n]\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = read_json_array(spark, path)
        assert df.rdd.getNumPartitions() > 4
        assert ids(df) == [f"{i}" for i in range(n)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", [
    '[{"id":"a"},{"id":"b"},{"id":"c"}]',
    '[{"id":"a"},\n{"id":"b"}, {"id":"c"}\n]',
    '﻿[\n\n  {"id":"a"},\n\t{"id":"b"}\n, {"id":"c"}]\n\n',
])
def test_feed_layouts(spark, folder, text):
    assert ids(read_json_array(spark, write(folder("f.json"), text))) == ["a", "b", "c"]


def test_feed_as_one_document(spark, folder):
    text = json.dumps([{"id": i, "card_faces": [{"name": "x"}]} for i in "abc"], indent=2)
    path = write(folder("pretty.json"), text)
    assert ids(read_json_array(spark, path, one_per_line=False)) == ["a", "b", "c"]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json_array(spark, path).collect()


def test_malformed_feed_fails(spark, folder):
    path = write(folder("bad.json"), '[\n{"id":"a"},\n{"id":\n]')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json_array(spark, path).collect()


def test_feed_of_several_files(spark, folder):
    write(folder("many/1.json"), '{"id":"a"},\n{"id":"b"}')
    write(folder("many/2.json"), '{"id":"c"}')
    assert ids(read_json_array(spark, folder("many"))) == ["a", "b", "c"]


def test_image_inventory(spark, folder):
    for name in ("k1/p-1-front.png", "k1/p-1-back.png", "k1/art.png", "k1/card.json", "k2/x.png"):
        write(folder(f"images/{name}"), "x")
    expected = {("k1", "p-1", "front"), ("k1", "p-1", "back"), ("k1", None, "art")}
    assert {tuple(r) for r in image_inventory(spark, folder("images")).collect()} == expected
    keys = spark.createDataFrame([("bucket/k1/art.png",), ("bucket/k1/art.png",)], "path string")
    assert [tuple(r) for r in inventory_of(keys).collect()] == [("k1", None, "art")]


def test_text_manifests(spark, folder):
    write(folder("cards/k1/front-images"), "new|2020-01-01|p1|u1\nold|2020-01-02|p2|u2\n\n")
    write(folder("cards/k1/back-images"), "new|2020-01-01|p1|u3\n")
    found = read_manifest_text(spark, folder("cards"))
    assert {tuple(r) for r in found.collect()} == {
        ("k1", "front", "new", "2020-01-01", "p1", "u1"),
        ("k1", "front", "old", "2020-01-02", "p2", "u2"),
        ("k1", "back", "new", "2020-01-01", "p1", "u3"),
    }


def test_manifest_table(spark, folder):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("oracle_id"),
        F.col("id").alias("pos"), F.lit("new").alias("status"),
        F.when(F.col("id") % 2 == 0, "front").otherwise("back").alias("side"),
    )
    write_manifest(df, folder("manifest"))
    back = read_manifest(spark, folder("manifest")).select(*df.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_card_documents(spark, feed, folder):
    flat = flatten_prints(read_json_array(spark, feed)).where("sid = 'p10'")
    document = flat.select(F.to_json(F.struct(*CARD_DOC.fieldNames()))).first()[0]
    write(folder("cards/k/card.json"), document)
    [card] = read_card_docs(spark, folder("cards")).collect()
    assert card.sid == "p10" and card.subtypes == ["Elf Warrior", "Aura"] and card.price == 200.0


def test_versions(spark, folder):
    root = folder("store")
    assert current_version(spark, root) == 0
    assert read_table(spark, root, "cards", "id int").isEmpty()
    write_snapshot(spark, {"cards": spark.range(3)}, root)
    lost = Snapshot(spark, root)  # never recorded
    lost.write("cards", spark.range(99))
    assert read_cards(spark, root).count() == 3
    write_snapshot(spark, {"cards": read_cards(spark, root).union(spark.range(1))}, root)
    assert current_version(spark, root) == 2 and read_cards(spark, root).count() == 4
    assert read_table(spark, root, "cards", version=1).count() == 3


def test_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x") != work_dir(spark, "x")


def test_purge_keeps_the_current_version(spark, folder):
    root = folder("store")
    assert purge(spark, root) == []
    for n in range(4):
        write_snapshot(spark, {"cards": spark.range(n + 1)}, root)
    Snapshot(spark, root).write("cards", spark.range(99))  # being written
    assert purge(spark, root, keep=2) == [1, 2] and purge(spark, root, keep=0) == [3]
    assert read_cards(spark, root).count() == 4 and Path(f"{root}/v00000005").exists()
    assert not Path(f"{root}/v00000003").exists() and current_version(spark, root) == 4


def test_folders_go(spark):
    path = work_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert drop_dir(spark, path) and not drop_dir(spark, path)


def test_stored_tables_are_packed_well(spark, folder):
    """A store holds every feed row once more, so its size counts."""
    store = BucketSnapshot(spark, folder("store"), buckets=2)
    rows = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit("front").alias("side"), F.lit("a").alias("oracle_id"),
                                  F.col("id").alias("pos"))
    assert store.write("plain", rows).count() == 10
    store.write_buckets("parted", rows, "id", range(2))
    write_manifest(rows, store.path("manifest"))
    names = [n for f in ("plain", "parted", "manifest/side=front") for n in file_names(spark, store.path(f))]
    assert len(names) >= 3 and all(n.endswith(".zstd.parquet") for n in names)


def test_lines_of_the_feed_in_any_form(spark):
    lines = ["[", '{"id":"a"},', ' [{"id":"b"}],', '{"id":"c"},{"id":"d"},', '{"id":"é"} ,', "", "\ufeff[", '{"id":"e"}', "]"]
    rows = spark.createDataFrame(list(enumerate(lines)), "row int, text string")
    got = parse_elements(rows, "text").select("id", "pos.row", "pos.item").collect()
    assert sorted(tuple(r) for r in got) == [("a", 1, 0), ("b", 2, 0), ("c", 3, 0), ("d", 3, 1), ("e", 7, 0), ("é", 4, 0)]


def test_no_pictures_move_no_row(spark):
    lines = spark.range(9).selectExpr("cast(id AS string) AS oracle_id", "'s' AS sid", "'front' AS side")
    marked = mark_status(lines, no_images(spark))
    assert no_images(spark).columns == ["oracle_id", "sid", "side"] and no_images(spark).isEmpty()
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert {r.status for r in marked.collect()} == {"new"} and marked.count() == 9


def test_store_keeps_no_value_of_a_printing_twice(spark, feed, folder):
    ingest(spark, feed, folder("store"))
    stored = read_table(spark, folder("store"), "printings")
    assert stored.columns == [*FEED.fieldNames(), "front", "back", "price", "tix", "pos"]


def test_feed_rows_format_a_date_once(spark):
    lines = lines_with_parts(Tables(spark, "/root/testdata/sf0.001"))
    plan = printings(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_format(") <= 2

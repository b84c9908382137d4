"""Pictures wanted against pictures present.

Documents are printings (card = source, printing = doc_id) and labels are the pictures there are,
so a source with very many documents is a card with very many printings. In the order queries a
card is a customer and a printing an order.
"""

from pyspark.sql import functions as F

from printfold.operators.media import (
    fetch_list,
    integrity_report,
    known_keys,
    mark_status,
    missing_report,
    orphans,
    semi_back,
    upload_list,
    wanted,
)
from printfold.operators.skew import salted_join
from printfold.plans import audit, audit_changes, read_report
from printfold.plans.audit import audited_keys
from printfold.queries.registry import query
from printfold.session import work_dir
from printfold.sources.images import inventory_of
from printfold.sources.store import read_table, write_snapshot


def _manifest(t):
    return t.documents.select(
        F.col("source").alias("oracle_id"),
        F.col("doc_id").cast("string").alias("sid"),
        F.when(F.col("lang") == "en", "front").otherwise("back").alias("side"),
        F.lit("2024-01-01").alias("date"),
        F.md5("text").alias("url"),
        F.col("doc_id").alias("pos"),
    )


def _inventory(t):
    """Labelled documents have a picture, of whichever side the label's quality says."""
    labelled = t.documents.join(t.labels, "doc_id")
    return labelled.select(
        F.col("source").alias("oracle_id"),
        F.col("doc_id").cast("string").alias("sid"),
        F.when(F.col("quality") == 1, "front").otherwise("back").alias("side"),
    )


def _cards(t):
    """Sources as cards; those with a toxic document have a back, those with a good one art."""
    labelled = t.documents.join(t.labels, "doc_id", "left")
    return labelled.groupBy(F.col("source").alias("oracle_id")).agg(
        F.concat(F.lit("card "), F.first("source")).alias("name"),
        F.upper(F.md5(F.first("source"))).alias("id"),
        F.max(F.when(F.col("toxic") == 1, "b")).alias("back"),
        F.max(F.when((F.col("quality") == 0) & (F.col("lang") == "de"), "a")).alias("art"),
    )


COMMON_SQL = """
    WITH manifest AS (
           SELECT source AS oracle_id, cast(doc_id AS VARCHAR) AS sid,
                  CASE WHEN lang = 'en' THEN 'front' ELSE 'back' END AS side, md5(text) AS url FROM documents),
         inventory AS (
           SELECT source AS oracle_id, cast(doc_id AS VARCHAR) AS sid,
                  CASE WHEN quality = 1 THEN 'front' ELSE 'back' END AS side FROM documents JOIN labels USING (doc_id)),
         cards AS (
           SELECT source AS oracle_id, 'card ' || source AS name, upper(md5(source)) AS id,
                  bool_or(coalesce(toxic = 1, false)) AS backed,
                  bool_or(coalesce(quality = 0 AND lang = 'de', false)) AS arted
           FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source),
         lines AS (
           SELECT m.*, c.name, c.id FROM manifest m JOIN cards c USING (oracle_id)
           WHERE side = 'front' OR backed),
         absent AS (
           SELECT * FROM lines l WHERE NOT EXISTS (SELECT 1 FROM inventory i
             WHERE i.oracle_id = l.oracle_id AND i.sid = l.sid AND i.side = l.side))
"""


@query(
    COMMON_SQL
    + """SELECT m.oracle_id, m.sid, m.side, m.url, CASE WHEN i.sid IS NULL THEN 'new' ELSE 'old' END AS status
         FROM manifest m LEFT JOIN inventory i USING (oracle_id, sid, side)"""
)
def q_mark_status(t):
    """The inventory names every picture twice."""
    twice = _inventory(t).unionByName(_inventory(t))
    return mark_status(_manifest(t).drop("date", "pos"), twice)


@query(
    COMMON_SQL
    + """SELECT oracle_id, sid, side, url, oracle_id || '/' || sid || '-' || side || '.png' AS file FROM absent
         UNION ALL
         SELECT oracle_id, NULL, 'art', 'a', oracle_id || '/art.png' FROM cards WHERE arted"""
)
def q_to_fetch(t):
    """Every absent picture, the backs of cards with a back only, and the art."""
    return fetch_list(_manifest(t), _cards(t), _inventory(t))


@query(
    COMMON_SQL
    + """SELECT oracle_id, name, side, sid FROM absent
         UNION ALL SELECT oracle_id, name, 'art', NULL FROM cards WHERE arted"""
)
def q_missing_report(t):
    return missing_report(_manifest(t), _cards(t), _inventory(t))


@query(
    COMMON_SQL
    + """SELECT oracle_id, name, side, sid FROM absent WHERE oracle_id IN (SELECT oracle_id FROM cards WHERE arted)
         UNION ALL SELECT oracle_id, name, 'art', NULL FROM cards WHERE arted
         UNION ALL SELECT oracle_id, NULL, 'card', NULL FROM cards WHERE NOT arted"""
)
def q_integrity_report(t):
    """Missing pictures and keys without card data, when only the cards with art are stored."""
    stored = _cards(t).where("art is not null")
    return integrity_report(_manifest(t), stored, _inventory(t))


@query(
    """SELECT c_custkey FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"""
)
def q_orphans(t):
    """Customers without a finished order."""
    finished = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return orphans(t.customer, finished.distinct(), "c_custkey")


@query(
    """SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders
       UNION SELECT user_id FROM events"""
)
def q_known_keys(t):
    """Distinct keys over three tables."""
    return known_keys(
        t.customer,
        t.orders.withColumnRenamed("o_custkey", "c_custkey"),
        t.events.withColumnRenamed("user_id", "c_custkey"),
        key="c_custkey",
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
       WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')"""
)
def q_semi_back(t):
    """Lines of the parts that have a back; a part may be on very many lines."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    parts = t.part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise("").alias("back"),
    )
    return semi_back(lines, parts, key="l_partkey")


@query(
    """SELECT cast(l_partkey AS VARCHAR) AS oracle_id, l_orderkey || '-' || l_linenumber AS sid,
              CASE l_returnflag WHEN 'N' THEN 'back' ELSE 'front' END AS side, p_name AS name
       FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_returnflag <> 'N' OR p_type = 'PROMO'"""
)
def q_wanted(t):
    """Lines as pictures: fronts always, backs of the parts with a back only."""
    sid = F.concat_ws("-", "l_orderkey", "l_linenumber")
    manifest = t.lineitem.select(
        F.col("l_partkey").cast("string").alias("oracle_id"),
        sid.alias("sid"),
        F.when(F.col("l_returnflag") == "N", "back").otherwise("front").alias("side"),
    )
    cards = t.part.select(
        F.col("p_partkey").cast("string").alias("oracle_id"),
        F.when(F.col("p_type") == "PROMO", "b").alias("back"),
        F.col("p_name").alias("name"),
    )
    return wanted(manifest, cards, "name")


@query(
    COMMON_SQL
    + """SELECT oracle_id, side, sid, id, oracle_id || '/' || sid || '-' || side || '.png' AS file,
                'cards/' || id || '-20240101-' || side || '.png' AS object_key
         FROM lines WHERE (oracle_id, sid, side) NOT IN (SELECT (oracle_id, sid, side) FROM inventory)
         UNION ALL
         SELECT oracle_id, 'art', NULL, id, oracle_id || '/art.png', 'cards/' || id || '-art.png' FROM cards WHERE arted"""
)
def q_upload_list(t):
    """New pictures and art with source file and target key."""
    return upload_list(mark_status(_manifest(t), _inventory(t)), _cards(t))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""
)
def q_salted_join(t):
    """Lines with their part, the parts on more than twenty lines split."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    weights = lines.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("rows"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return salted_join(lines, parts, "l_partkey", "left", weights, per_task=20, spread=["l_orderkey", "l_linenumber"])


def _paths(t):
    """Paths of the labelled pictures, some named twice, the art of toxic ones, and other files."""
    folder = F.concat_ws("/", F.lit("bucket"), "oracle_id")
    pictures = _inventory(t).select(F.concat(folder, F.lit("/"), "sid", F.lit("-"), "side", F.lit(".png")).alias("path"))
    art = t.documents.join(t.labels.where("toxic = 1"), "doc_id").select(
        F.concat(F.lit("bucket/"), "source", F.lit("/art.png")).alias("path"))
    other = t.documents.select(F.concat(F.lit("bucket/"), "source", F.lit("/card.json")).alias("path"))
    return pictures.unionByName(pictures).unionByName(art).unionByName(other)


ART_SQL = """, arts AS (
           SELECT DISTINCT source AS oracle_id FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)"""


@query(
    COMMON_SQL + ART_SQL
    + """SELECT DISTINCT oracle_id, sid, side FROM inventory UNION ALL SELECT oracle_id, NULL, 'art' FROM arts"""
)
def q_inventory(t):
    """Every picture of a table of paths, once."""
    return inventory_of(_paths(t))


def _audited(t, table):
    """A table of the audit job, when only the cards with art are stored."""
    store, reports = work_dir(t.spark, "store"), work_dir(t.spark, "reports")
    write_snapshot(t.spark, {"cards": _cards(t).where("art is not null"), "manifest": _manifest(t)}, store)
    audit(t.spark, store, reports, inventory_of(_paths(t)))
    return read_table(t.spark, reports, table)


STORED_SQL = COMMON_SQL + ART_SQL + """, stored AS (
           SELECT * FROM cards WHERE arted), wanted_arts AS (
           SELECT * FROM stored WHERE oracle_id NOT IN (FROM arts))"""


@query(
    STORED_SQL
    + """SELECT oracle_id, sid, side, url, oracle_id || '/' || sid || '-' || side || '.png' AS file
         FROM absent WHERE oracle_id IN (SELECT oracle_id FROM stored)
         UNION ALL SELECT oracle_id, NULL, 'art', 'a', oracle_id || '/art.png' FROM wanted_arts"""
)
def q_audit_fetch(t):
    """The audit's fetch list."""
    return _audited(t, "fetch_list")


@query(
    STORED_SQL
    + """SELECT oracle_id, name, side, sid FROM absent WHERE oracle_id IN (SELECT oracle_id FROM stored)
         UNION ALL SELECT oracle_id, name, 'art', NULL FROM wanted_arts
         UNION ALL SELECT oracle_id, NULL, 'card', NULL FROM cards WHERE NOT arted"""
)
def q_audit_report(t):
    """The audit's report of what is missing."""
    return _audited(t, "integrity_report")


def _line_manifest(lines):
    """Lines as pictures of their part."""
    sid = F.concat_ws("-", "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd"))
    return lines.select(
        F.col("l_partkey").cast("string").alias("oracle_id"),
        sid.alias("sid"),
        F.when(F.col("l_returnflag") == "N", "back").otherwise("front").alias("side"),
        F.concat(F.lit("u"), sid).alias("url"),
        sid.alias("pos"),
    )


@query(
    """WITH lines AS (
         SELECT cast(l_partkey AS VARCHAR) AS oracle_id, l_orderkey || '-' || l_linenumber || '-' || strftime(l_shipdate, '%Y-%m-%d') AS sid,
                CASE l_returnflag WHEN 'N' THEN 'back' ELSE 'front' END AS side,
                l_quantity = 50 AND l_returnflag = 'R' AS gone, l_quantity = 10 AS pictured
         FROM lineitem),
       cards AS (
         SELECT cast(p_partkey AS VARCHAR) AS oracle_id, p_name || CASE p_type WHEN 'PROMO' THEN ' new' ELSE '' END AS name, p_type
         FROM part WHERE p_size <= 40),
       rounds AS (
         SELECT oracle_id, CAST(CASE WHEN bool_or(gone) OR any_value(p_type) = 'PROMO' THEN 3 WHEN bool_or(pictured) THEN 2 ELSE 1 END AS BIGINT) AS round
         FROM lines FULL JOIN cards USING (oracle_id) GROUP BY oracle_id),
       absent AS (
         SELECT l.*, c.name FROM lines l JOIN cards c USING (oracle_id)
         WHERE NOT gone AND (side = 'front' OR p_type = 'PROMO')
           AND (oracle_id, sid, side) NOT IN (SELECT (oracle_id, sid, side) FROM lines WHERE pictured)),
       art AS (SELECT * FROM cards WHERE p_type = 'LARGE'),
       reports AS (
         SELECT 'missing' AS report, oracle_id, side, sid, name AS detail FROM absent
         UNION ALL SELECT 'missing', oracle_id, 'art', NULL, name FROM art
         UNION ALL SELECT DISTINCT 'missing', oracle_id, 'card', NULL, NULL FROM lines
                   WHERE NOT gone AND oracle_id NOT IN (SELECT oracle_id FROM cards)
         UNION ALL SELECT DISTINCT 'fetch', oracle_id, side, sid, 'u' || sid FROM absent
         UNION ALL SELECT 'fetch', oracle_id, 'art', NULL, 'a' FROM art)
       SELECT reports.*, round FROM reports JOIN rounds USING (oracle_id)"""
)
def q_audit_rounds(t):
    """Both reports after rounds of changes, with the round each card was last audited in.

    At first no picture is there, then some are, then lines are gone and cards renamed; in the last round nothing
    has changed.
    """
    store, reports = work_dir(t.spark, "store"), work_dir(t.spark, "reports")
    kind = F.col("p_type")
    stored = t.part.where("p_size <= 40").select(
        F.col("p_partkey").cast("string").alias("oracle_id"), F.col("p_name").alias("name"),
        F.when(kind == "PROMO", "b").alias("back"), F.when(kind == "LARGE", "a").alias("art"))
    renamed = stored.withColumn("name", F.concat("name", F.when(F.col("back").isNotNull(), " new").otherwise("")))
    lines = t.lineitem
    left = lines.where(~(F.col("l_quantity") == 50) | (F.col("l_returnflag") != "R"))
    pictures = _line_manifest(lines.where("l_quantity = 10")).select("oracle_id", "sid", "side")
    for manifest, cards, present in (
            (lines, stored, None), (lines, stored, pictures), (left, renamed, pictures), (left, renamed, pictures)):
        write_snapshot(t.spark, {"cards": cards, "manifest": _line_manifest(manifest)}, store)
        audit_changes(t.spark, store, reports, present)
    last = audited_keys(t.spark, reports).select("oracle_id", "round")

    def report(name, table, detail):
        rows = read_report(t.spark, reports, table).select("oracle_id", "side", "sid", F.col(detail).alias("detail"))
        return rows.join(last, "oracle_id").select(F.lit(name).alias("report"), "oracle_id", "side", "sid", "detail", "round")

    return report("missing", "integrity_report", "name").unionByName(report("fetch", "fetch_list", "url"))

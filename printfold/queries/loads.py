"""Loading relational tables: keys, upsert, children, printings."""

from pyspark.sql import functions as F

from printfold.operators.fold import fold
from printfold.operators.load import (
    append_prints,
    print_rows,
    read_dimension,
    replace_children,
    resolve_key,
    upsert,
)
from printfold.operators.media import mark_status
from printfold.queries.registry import query


@query(
    """SELECT min(c_custkey) AS id, c_mktsegment || c_nationkey AS oracle_id,
              arg_min(c_name, c_custkey) AS name
       FROM customer GROUP BY c_mktsegment || c_nationkey"""
)
def q_dimension(t):
    """Existing ids and names, one row per key."""
    rows = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.concat("c_mktsegment", F.col("c_nationkey").cast("string")).alias("oracle_id"),
        F.col("c_name").alias("name"),
    )
    return read_dimension(rows)


@query(
    """SELECT c.c_custkey, c.c_name, coalesce(o.id, upper(md5('cards|' || c.c_custkey))) AS id
       FROM customer c LEFT JOIN (SELECT o_custkey, cast(max(o_orderkey) AS VARCHAR) AS id FROM orders
                                  WHERE o_orderstatus = 'F' GROUP BY o_custkey) o ON o_custkey = c_custkey"""
)
def q_resolve_key(t):
    """Customers take their known id, or a new one where no finished order names one."""
    finished = t.orders.where("o_orderstatus = 'F'")
    known = finished.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderkey").cast("string").alias("id")
    )
    return resolve_key(t.customer.select("c_custkey", "c_name"), known, "c_custkey")


def _latest_order(orders, *statuses):
    """Customers as of their latest order of some statuses."""
    rows = orders.where(F.col("o_orderstatus").isin(*statuses)).select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderkey").alias("sid"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.col("o_totalprice").alias("price"),
        "o_orderdate",
    )
    return fold(rows, ["id"], ["o_orderdate", "sid"], ["name", "sid", "priority"], ["price"])


def _latest_sql(*statuses):
    return f"""(SELECT * FROM (
        SELECT o_custkey AS id, o_orderpriority AS name, o_orderkey AS sid,
               nullif(o_orderpriority, '5-LOW') AS priority,
               min(o_totalprice) OVER (PARTITION BY o_custkey) AS price,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
        FROM orders WHERE o_orderstatus IN ({", ".join(f"'{s}'" for s in statuses)})) WHERE n = 1)"""


@query(
    f"""SELECT id, t.name, t.sid, t.priority, t.price FROM {_latest_sql('F', 'P')} t
        WHERE id NOT IN (SELECT id FROM {_latest_sql('O', 'P')})
        UNION ALL
        SELECT s.id, coalesce(t.name, s.name), s.sid, s.priority, s.price
        FROM {_latest_sql('O', 'P')} s LEFT JOIN {_latest_sql('F', 'P')} t ON t.id = s.id"""
)
def q_upsert(t):
    """Customers by their finished orders, loaded with their open ones; names stay.

    Orders in process count on both sides, so that every order takes part.
    """
    target, source = _latest_order(t.orders, "F", "P"), _latest_order(t.orders, "O", "P")
    return upsert(target, source, ["id"], keep=("name",))


@query(
    """SELECT l_orderkey AS card_id, l_partkey AS id, l_linenumber AS line,
              CASE WHEN o_orderstatus = 'F' THEN l_quantity * 2 ELSE l_quantity END AS value
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey
       WHERE o_orderstatus <> 'F' OR l_returnflag <> 'N'
       UNION ALL
       SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"""
)
def q_replace_children(t):
    """Lines of finished orders give way to corrected ones without the unreturned."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("card_id"), F.col("l_partkey").alias("id"),
        F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("value"), "l_returnflag",
    )
    touched = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("card_id"))
    corrected = lines.where("l_returnflag <> 'N'").join(touched, "card_id", "left_semi")
    new = corrected.withColumn("value", F.col("value") * 2).drop("l_returnflag")
    return replace_children(lines.drop("l_returnflag"), new, touched)


def _order_manifest(t):
    manifest = t.orders.select(
        F.col("o_custkey").cast("string").alias("oracle_id"),
        F.col("o_orderkey").cast("string").alias("sid"),
        F.when(F.col("o_orderpriority") == "5-LOW", "back").otherwise("front").alias("side"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
    )
    inventory = t.orders.where("o_orderstatus = 'P'").select(
        F.col("o_custkey").cast("string").alias("oracle_id"),
        F.col("o_orderkey").cast("string").alias("sid"),
        F.lit("front").alias("side"),
    )
    return mark_status(manifest, inventory)


def _order_keys(t):
    key = F.col("c_custkey").cast("string")
    return t.customer.select(key.alias("oracle_id"), F.upper(F.md5(key)).alias("card_id"))


APPEND_SQL = """SELECT upper(md5('card_prints|' || card_id || '|' || o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d'))) AS id,
              card_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS released
       FROM orders JOIN (SELECT c_custkey, upper(md5('' || c_custkey)) AS card_id FROM customer) ON c_custkey = o_custkey
       WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'"""


@query(APPEND_SQL)
def q_print_rows(t):
    """New front pictures as printings of their card."""
    return print_rows(_order_manifest(t), _order_keys(t))


@query(APPEND_SQL + " AND o_orderstatus <> 'F'")
def q_append_new(t):
    """The same when the printings of finished orders are there already."""
    manifest = _order_manifest(t)
    finished = t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").cast("string").alias("oracle_id"),
        F.col("o_orderkey").cast("string").alias("sid"),
    )
    there = print_rows(manifest.join(finished, ["oracle_id", "sid"], "left_semi"), _order_keys(t))
    return append_prints(manifest, _order_keys(t), there)

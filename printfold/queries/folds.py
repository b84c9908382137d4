"""Folds and ordering within a key."""

from pyspark.sql import functions as F

from printfold.operators.fold import fold, group_manifest, group_ordered, latest_per_key, min_per_key
from printfold.queries.registry import query
from printfold.sources.manifest import manifest_line


@query(
    """SELECT l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_orderkey, l_linenumber,
              l_quantity, low_price AS l_extendedprice, low_discount AS l_discount
       FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
                         ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS n,
                    min(nullif(l_extendedprice, 0)) OVER (PARTITION BY l_partkey) AS low_price,
                    min(nullif(l_discount, 0)) OVER (PARTITION BY l_partkey) AS low_discount
             FROM lineitem) WHERE n = 1"""
)
def q_latest_with_min(t):
    """Latest line of each part with the lowest price and discount of all its lines."""
    lines = t.lineitem.withColumns({
        "l_extendedprice": F.nullif("l_extendedprice", F.lit(0.0)),
        "l_discount": F.nullif("l_discount", F.lit(0.0)),
    })
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    folded = fold(
        lines, ["l_partkey"], order, [*order, "l_quantity"], ["l_extendedprice", "l_discount"]
    )
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped")
    return folded.select("*", shipped).drop("l_shipdate")


@query(
    """SELECT user_id, event_id, event_type, value, props
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
             FROM events) WHERE n = 1"""
)
def q_latest_per_key(t):
    """Each user's last event."""
    attrs = ["event_id", "event_type", "value", "props"]
    return latest_per_key(t.events, ["user_id"], ["ts", "event_id"], attrs)


@query(
    """SELECT o_custkey, o_orderstatus, min(o_totalprice) AS o_totalprice,
              min(o_orderkey) AS o_orderkey
       FROM orders GROUP BY ALL"""
)
def q_min_per_key(t):
    """Least price and order of every customer and status."""
    return min_per_key(t.orders, ["o_custkey", "o_orderstatus"], ["o_totalprice", "o_orderkey"])


@query(
    """SELECT conv_id, turn, role, md5(text) AS text_key,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS line_no
       FROM conversations"""
)
def q_group_ordered(t):
    """Turns numbered within their conversation, a thousand turns at a time."""
    chunk = F.floor(F.col("turn") / 1024)
    turns = t.conversations.select("conv_id", "turn", "role", F.md5("text").alias("text_key"))
    return group_ordered(turns, "conv_id", ["turn"], chunk)


@query(
    """SELECT oracle_id, side, line, row_number() OVER (PARTITION BY oracle_id, side ORDER BY o_orderkey) AS line_no
       FROM (SELECT o_orderkey, cast(o_custkey AS VARCHAR) AS oracle_id,
                    CASE WHEN o_orderstatus = 'F' THEN 'back' ELSE 'front' END AS side,
                    'new|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || o_orderkey || '|' || o_orderpriority AS line
             FROM orders)"""
)
def q_group_manifest(t):
    """Manifest lines numbered per card and side in feed order; the order key is the place."""
    place = F.struct(
        F.lit("orders").alias("file"),
        F.floor(F.col("o_orderkey") / 1_000_000).alias("block"),
        F.col("o_orderkey").alias("row"),
        F.lit(0).alias("item"),
    )
    manifest = t.orders.select(
        F.col("o_custkey").cast("string").alias("oracle_id"),
        F.when(F.col("o_orderstatus") == "F", "back").otherwise("front").alias("side"),
        F.lit("new").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderkey").cast("string").alias("sid"),
        F.col("o_orderpriority").alias("url"),
        place.alias("pos"),
    )
    return group_manifest(manifest).select(
        "oracle_id", "side", manifest_line().alias("line"), "line_no"
    )

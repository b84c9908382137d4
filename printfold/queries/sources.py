"""Readers and writers over files Spark writes from the driver tables."""

from pyspark.sql import functions as F

from printfold.queries.pictures import COMMON_SQL, _inventory, _manifest
from printfold.queries.registry import query
from printfold.operators.media import mark_status
from printfold.session import work_dir
from printfold.sources.feed import read_json_array
from printfold.sources.manifest import read_manifest, write_manifest
from printfold.sources.store import append, read_appended, read_table, write_snapshot


@query(
    """SELECT cast(doc_id AS VARCHAR) AS id, lang, source AS name, n_chars AS edhrec_rank,
              md5(text) AS text_key FROM documents"""
)
def q_json_array(t):
    """Whole documents written as a JSON array of one element per line, and read back."""
    path = work_dir(t.spark, "array")
    element = F.to_json(F.struct(
        F.col("doc_id").cast("string").alias("id"), "lang", F.col("source").alias("name"),
        F.col("n_chars").alias("edhrec_rank"), F.col("text").alias("oracle_text"),
    ))
    t.documents.select(F.concat(element, F.lit(",")).alias("value")).write.text(path)
    back = read_json_array(t.spark, path)
    rank = F.col("edhrec_rank").cast("long").alias("edhrec_rank")
    return back.select("id", "lang", "name", rank, F.md5("oracle_text").alias("text_key"))


@query("SELECT * FROM part")
def q_snapshot(t):
    """A table written twice as a version; readers get the second."""
    root = work_dir(t.spark, "store")
    write_snapshot(t.spark, {"part": t.part.where("p_type = 'PROMO'")}, root)
    write_snapshot(t.spark, {"part": t.part}, root)
    return read_table(t.spark, root, "part")


@query(
    COMMON_SQL
    + """SELECT m.oracle_id, m.sid, m.side, m.url, CASE WHEN i.sid IS NULL THEN 'new' ELSE 'old' END AS status
         FROM manifest m LEFT JOIN inventory i USING (oracle_id, sid, side)"""
)
def q_manifest(t):
    """The manifest written by side and read back."""
    path = work_dir(t.spark, "manifest")
    write_manifest(mark_status(_manifest(t), _inventory(t)), path)
    return read_manifest(t.spark, path).select("oracle_id", "sid", "side", "url", "status")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def q_append(t):
    """Orders appended status by status."""
    path = work_dir(t.spark, "appended")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    for status in ("F", "O", "P"):
        append(rows.where(F.col("o_orderstatus") == status), path)
    return read_appended(t.spark, path, rows.schema)

"""op9: every document that overlaps a benchmark item."""

from printfold.llm.decontaminate import SHORTEST, SUBSTITUTIONS, WINDOW, contaminations


def op9_decontamination(spark, folder):
    """Pairs of document and benchmark item with the windows that agree."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return contaminations(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


# Without seeds: a window of n tokens with s substitutions has a run of floor((n - s) / (s + 1)) equal ones
# at least, so of three from seven tokens on; shorter items are compared whole, those under five with lines.
SQL_DECONTAMINATION = rf"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, 0 AS line, text FROM documents
  UNION ALL SELECT 'b', item_id, 0, text FROM benchmark
  UNION ALL SELECT 'l', doc_id, generate_subscripts(string_split(text, chr(10)), 1), unnest(string_split(text, chr(10))) FROM documents
), lists AS (
  SELECT side, id, line, list_filter(list_transform(regexp_extract_all(text, '[^\x20\x09-\x0D]+'),
    lambda x: regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', '', 'g')), lambda x: x <> '') AS t
  FROM texts
), b AS (
  SELECT id AS item_id, t AS bt, len(t) AS bn, least(len(t), {WINDOW}) AS n,
    {SUBSTITUTIONS} * least(len(t), {WINDOW}) // {WINDOW} AS s
  FROM lists WHERE side = 'b' AND len(t) > 0
), d AS (SELECT id AS doc_id, t AS dt, len(t) AS dn FROM lists WHERE side = 'd'),
seeds AS (
  SELECT item_id, q, bt[q] AS a1, bt[q+1] AS a2, bt[q+2] AS a3
  FROM (SELECT item_id, unnest(range(1, bn - 1)) AS q, bt FROM b WHERE bn >= {SHORTEST})
), grams AS (
  SELECT doc_id, p, dt[p] AS a1, dt[p+1] AS a2, dt[p+2] AS a3 FROM (SELECT doc_id, unnest(range(1, dn - 1)) AS p, dt FROM d)
), diagonals AS (
  SELECT DISTINCT doc_id, item_id, p - q AS shift FROM grams JOIN seeds USING (a1, a2, a3)
), windows AS (
  SELECT doc_id, item_id, shift, unnest(range(1, bn - n + 2)) AS q, n, s, bt, dt, dn
  FROM diagonals JOIN b USING (item_id) JOIN d USING (doc_id)
), counted AS (
  SELECT doc_id, item_id, q + shift - 1 AS place, n - s AS need,
    len(list_filter(range(0, n), lambda i: bt[q + i] = dt[q + shift + i])) AS matches
  FROM windows WHERE q + shift >= 1 AND q + shift + n - 1 <= dn
), lines AS (
  SELECT id, t, coalesce(sum(len(t)) OVER (PARTITION BY id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM lists WHERE side = 'l'
), whole AS (
  SELECT l.id AS doc_id, b.item_id, l.place, b.bn AS matches FROM lines l JOIN b ON b.bt = l.t WHERE b.bn < {SHORTEST}
  UNION SELECT d.doc_id, b.item_id, 0, b.bn FROM d JOIN b ON b.bt = d.dt WHERE b.bn < {SHORTEST}
), hits AS (
  SELECT doc_id, item_id, place, matches FROM counted WHERE matches >= need UNION ALL FROM whole
)
SELECT doc_id, item_id, count(*) AS windows, max(matches)::BIGINT AS best, min(place)::BIGINT AS first
FROM hits GROUP BY doc_id, item_id
"""

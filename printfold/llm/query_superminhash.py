"""op11: groups of near-duplicate documents by shingles of two words."""

from printfold.llm.super_minhash import near_duplicates


def op11_minhash_dedup(spark, folder):
    """Every document with the component it is in; one of each is kept."""
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))


# Exact: documents that share a shingle, then components by recursion.
SQL_MINHASH = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM both_have JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE c * 100 >= 80 * (nx.n + ny.n - c)
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(y, d.doc_id) AS kept
FROM documents d LEFT JOIN least_of l ON l.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

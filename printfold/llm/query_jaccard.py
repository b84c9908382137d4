"""op7: near-duplicate classes and links of all documents."""

from printfold.llm.jaccard_join import near_duplicates


def op7_jaccard_join(spark, folder):
    """Every document with the class it is in and the number of documents linked to it."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "n_links")


# Exact: documents that share a shingle, then components by recursion.
SQL_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM both_have JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE c * 10 >= 8 * (nx.n + ny.n - c)
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT doc_id, least(doc_id, coalesce(y, doc_id)) AS class_id, coalesce(g.n, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN least_of l ON l.x = d.doc_id LEFT JOIN degree g ON g.x = d.doc_id
"""

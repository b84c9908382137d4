"""op1: every document without the words it shares with an earlier one."""

from pyspark.sql import functions as F

from printfold.llm.substring_dedup import WORDS, dedup


def op1_substring_dedup(spark, folder):
    """Words, removed words and a digest of the kept words of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return dedup(docs, keep=lambda kept: [F.sha2(kept, 256).alias("kept_sha256")])


SQL_SUBSTRINGS = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, unnest(range(1, len(w) - {WORDS - 2})) AS p, w FROM w WHERE len(w) >= {WORDS}
), windows AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p+{WORDS - 1}], ' ')) AS g FROM places
), firsts AS (
  SELECT g, min(doc_id) AS low, max(doc_id) AS high FROM windows GROUP BY g
), late AS (
  SELECT DISTINCT doc_id, p + i AS p FROM windows JOIN firsts USING (g), range({WORDS}) t(i) WHERE low < doc_id
), gone AS (
  SELECT doc_id, list(p) AS ps, count(*) AS n FROM late GROUP BY doc_id
), {{levels}}
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  coalesce(size, 0)::BIGINT AS longest,
  sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ps, []::BIGINT[]), i)), ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN longest USING (doc_id)
"""


def _level(size):
    return f"""l{size} AS (
  SELECT DISTINCT unnest(ids) AS doc_id, {size} AS size FROM (
    SELECT list(DISTINCT doc_id) AS ids FROM (
      SELECT doc_id, md5(array_to_string(w[p:p+{size - 1}], ' ')) AS g
      FROM (SELECT doc_id, unnest(range(1, len(w) - {size - 2})) AS p, w FROM w WHERE len(w) >= {size})
    ) GROUP BY g HAVING count(DISTINCT doc_id) > 1)
)"""


SIZES = [WORDS * 2**k for k in range(12)]
SQL_SUBSTRINGS = SQL_SUBSTRINGS.replace(
    "{levels}", ", ".join(_level(s) for s in SIZES) + ", longest AS (SELECT doc_id, max(size) AS size FROM ("
    + " UNION ALL ".join(f"SELECT * FROM l{s}" for s in SIZES) + ") GROUP BY doc_id)")

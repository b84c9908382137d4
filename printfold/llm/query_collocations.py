"""op13: the first 2000 phrases of every language."""

from printfold.llm.collocations import collocations


def op13_collocations(spark, folder):
    """Phrases of two to five words that occur a hundred times at least, by score."""
    return collocations(spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text"))


SQL_COLLOCATIONS = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, range(1, 6) t(k) WHERE len(w) >= k
), f AS (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
inside AS (
  SELECT DISTINCT lang, a, array_to_string(w[i:i + s - 1], ' ') AS phrase
  FROM c, range(2, 5) t(s), range(1, 5) u(i) WHERE s < k AND i + s - 1 <= k
), cuts AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n.n, j,
         ((1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM c, range(1, 5) t(j), f x, f y, n
  WHERE j < c.k AND x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
    AND y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ') AND n.lang = c.lang
), s AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM s WHERE NOT EXISTS (FROM inside WHERE inside.lang = s.lang AND inside.phrase = s.phrase AND inside.a >= s.a)
QUALIFY rank <= 2000
"""

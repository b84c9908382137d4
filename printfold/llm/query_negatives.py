"""op12: hard negatives of every hundredth vector among all vectors."""

from pyspark.sql import functions as F

from printfold.llm.hard_negatives import hard_negatives


def op12_hard_negatives(spark, folder):
    """Negatives of each anchor and positive, with the labels of every seventh vector moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").withColumn("label", label)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


SQL_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same, list_sum(list_transform(
           range(1, len(a.q) + 1), lambda i: (a.q[i] * v.q[i])::BIGINT))::BIGINT AS score
  FROM v a JOIN v ON v.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""

"""op8: every document's cross-entropy difference between good documents and all others."""

from pyspark.sql import functions as F

from printfold.llm.lm_scoring import MU, NU, score


def op8_lm_scoring(spark, folder):
    """Losses and scores of all documents; the target are those labelled as of good quality."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    good = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").select("doc_id")
    rows = score(docs, good)
    return rows.select("doc_id", "n_words", *[F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")])


SQL_LM = rf"""
WITH good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w, doc_id IN (FROM good) AS t FROM documents
), places AS (
  SELECT doc_id, t, unnest(list_append(w, '')) AS b, unnest(list_prepend('', w)) AS a FROM d WHERE len(w) > 0
), own_1 AS (SELECT doc_id, t, b, count(*) AS n FROM places GROUP BY ALL),
own_2 AS (SELECT doc_id, t, a, b, count(*) AS n FROM places GROUP BY ALL),
all_1 AS (SELECT b, coalesce(sum(n) FILTER (t), 0) AS nt, coalesce(sum(n) FILTER (NOT t), 0) AS nb FROM own_1 GROUP BY b),
all_2 AS (SELECT a, b, coalesce(sum(n) FILTER (t), 0) AS nt, coalesce(sum(n) FILTER (NOT t), 0) AS nb FROM own_2 GROUP BY ALL),
total AS (SELECT sum(nt) AS nt, sum(nb) AS nb FROM all_1),
size AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
p AS (
  SELECT o.doc_id, o.n AS times, o.t, (w.nt + w.nb) / (total.nt + total.nb) AS p,
    w.nt - CASE WHEN o.t THEN ow.n ELSE 0 END AS wt, w.nb - CASE WHEN o.t THEN 0 ELSE ow.n END AS wb,
    v.nt - CASE WHEN o.t THEN ov.n ELSE 0 END AS vt, v.nb - CASE WHEN o.t THEN 0 ELSE ov.n END AS vb,
    vw.nt - CASE WHEN o.t THEN o.n ELSE 0 END AS vwt, vw.nb - CASE WHEN o.t THEN 0 ELSE o.n END AS vwb,
    total.nt - CASE WHEN o.t THEN size.n ELSE 0 END AS st, total.nb - CASE WHEN o.t THEN 0 ELSE size.n END AS sb
  FROM own_2 o JOIN all_2 vw USING (a, b) JOIN all_1 w ON w.b = o.b JOIN all_1 v ON v.b = o.a
    JOIN own_1 ow ON ow.doc_id = o.doc_id AND ow.b = o.b JOIN own_1 ov ON ov.doc_id = o.doc_id AND ov.b = o.a
    JOIN size ON size.doc_id = o.doc_id, total
), losses AS (
  SELECT doc_id,
    sum(times * -ln((vwt + {NU} * (wt + {MU} * p) / (st + {MU})) / (vt + {NU}))) / sum(times) AS lt,
    sum(times * -ln((vwb + {NU} * (wb + {MU} * p) / (sb + {MU})) / (vb + {NU}))) / sum(times) AS lb
  FROM p GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, round(lt, 6) AS target_loss, round(lb, 6) AS background_loss,
  round(lt - lb, 6) AS score
FROM d LEFT JOIN losses USING (doc_id)
"""

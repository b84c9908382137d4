"""op4: half of all tokens of the documents, mixed by domain, language and source."""

from pyspark.sql import functions as F

from printfold.llm.mixing import mix

# Sources are dealt to domains by their number; weights of domains and of languages.
DOMAINS = ("web", "books", "news", "forum")
DOMAIN_WEIGHTS = {"web": 0.4, "books": 0.3, "news": 0.2, "forum": 0.1}
LANG_WEIGHTS = {"en": 0.4, "de": 0.25, "fr": 0.2, "es": 0.15}
SHARE, MAX_EPOCHS, SEED = 0.5, 4.0, 42

WEIGHTS = [(d, None, None, w) for d, w in DOMAIN_WEIGHTS.items()] + [
    (d, lang, None, w) for d in DOMAINS for lang, w in LANG_WEIGHTS.items()]


def domain_of(source):
    number = F.regexp_extract(source, "([0-9]+)$", 1).try_cast("int") % len(DOMAINS)
    return F.get(F.array(*map(F.lit, DOMAINS)), number)


def mixed(spark, docs):
    weights = spark.createDataFrame(WEIGHTS, "domain string, lang string, source string, weight double")
    return mix(docs, domain_of(F.col("source")), SHARE, weights, MAX_EPOCHS, SEED)


def op4_mixing(spark, folder):
    """Documents taken, with the tokens taken of each."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return mixed(spark, docs).withColumn("taken", F.col("epochs") * F.col("n_tokens") + F.col("extra_tokens")).drop("tie")


def _level(name, nodes, keys, parent, budget):
    """SQL of one level: try every number of full children and keep the one that fits."""
    family = f"PARTITION BY {', '.join(parent)}" if parent else ""
    own = ", ".join(keys)
    return f"""
{name}_r AS (
  SELECT *, tokens * {MAX_EPOCHS} AS cap, tokens * {MAX_EPOCHS} / weight AS ratio, {budget} AS budget FROM {nodes}
), {name}_o AS (
  SELECT *, row_number() OVER ({family} ORDER BY ratio, {own}) AS nth,
    least(budget, sum(cap) OVER ({family})) AS spend,
    sum(weight) OVER ({family}) AS all_w,
    sum(weight) OVER ({family} ORDER BY ratio, {own}) AS upto_w,
    sum(cap) OVER ({family} ORDER BY ratio, {own}) AS upto_c FROM {name}_r
), {name}_e AS (
  SELECT *, (spend - upto_c + cap) / nullif(all_w - upto_w + weight, 0) AS even FROM {name}_o
), {name}_f AS (
  SELECT *, min(CASE WHEN ratio > even + 1e-9 THEN nth END) OVER ({family}) AS cut FROM {name}_e
), {name} AS (
  SELECT *, CASE WHEN cut IS NULL OR nth < cut THEN cap
    ELSE weight * max(CASE WHEN nth = cut THEN even END) OVER ({family}) END AS given FROM {name}_f
)"""


def _case(column, values):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " ELSE 1 END"


SQL_MIXING = rf"""
WITH docs AS (
  SELECT doc_id, md5(text) AS mark, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    coalesce([{", ".join(f"'{d}'" for d in DOMAINS)}][try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS INTEGER) % {len(DOMAINS)} + 1], '(none)') AS domain,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM docs GROUP BY ALL
), d_n AS (
  SELECT domain, sum(tokens)::BIGINT AS tokens, {_case("domain", DOMAIN_WEIGHTS)}::DOUBLE AS weight FROM leaves GROUP BY domain
), {_level("d", "d_n", ["domain"], [], f"{SHARE} * sum(tokens) OVER ()")}, l_n AS (
  SELECT domain, lang, sum(l.tokens)::BIGINT AS tokens, {_case("lang", LANG_WEIGHTS)}::DOUBLE AS weight, any_value(d.given) AS up
  FROM leaves l JOIN d USING (domain) GROUP BY domain, lang
), {_level("l", "l_n", ["domain", "lang"], ["domain"], "up")}, s_n AS (
  SELECT domain, lang, source, s.tokens, 1::DOUBLE AS weight, l.given AS up FROM leaves s JOIN l USING (domain, lang)
), {_level("s", "s_n", ["domain", "lang", "source"], ["domain", "lang"], "up")}, quotas AS (
  SELECT domain, lang, source, tokens, floor(given + 1e-6)::BIGINT AS quota FROM s WHERE tokens > 0
), placed AS (
  SELECT *, quota // tokens AS epochs, quota % tokens AS rest,
    coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
      ORDER BY md5('{SEED}:' || (quota // tokens + 1) || ':' || doc_id || ':' || mark), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs JOIN quotas USING (domain, lang, source) WHERE n_tokens > 0
), taken AS (
  SELECT *, least(n_tokens, greatest(0, rest - before))::BIGINT AS extra_tokens FROM placed
)
SELECT doc_id, domain, lang, source, n_tokens, epochs, extra_tokens, epochs * n_tokens + extra_tokens AS taken
FROM taken WHERE epochs > 0 OR extra_tokens > 0
"""

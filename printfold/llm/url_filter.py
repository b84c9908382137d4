"""URL filter: host and path rules, then a logistic regression on hashed character n-grams.

The model is trained with Spark from a small labelled table of urls and then is a row of weights in
an expression, so that judging a url needs no join. Rules come first; the longest that fits wins.

Defined results: a null url, or one without ``://``, has an empty host and path; the model judges it
by its bias and its empty host like any other; repeated urls get equal verdicts; an empty table gives
no rows; other columns are kept, but those that have the name of an added one are replaced.
"""

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS, PENALTY = 1 << 13, 0.001
GRAMS = (3, 4)

# Rules (verdict, host, path), a host fits with all its subdomains.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

# The small labelled url table, 1 to block. Hosts are (verdict, names below a domain).
BAD = (
    "adult-x adult-video adult-chat xxx-adult adult-dating hot-singles live-sex-cam porn-tube nude-photos escort-girls",
    "casino-royal casino-slots best-casino poker-casino casino-bonus online-bets sports-betting bet-now free-spins slot-win",
    "lottery-win jackpot-win win-prize win-iphone free-gift free-money free-download-crack free-movies-hd bonus-free",
    "cheap-pills pills-online cheap-viagra cheap-meds buy-cialis weight-loss-pills cheap-replica cheap-watches cheap-loans",
    "spam-mailer spam bulk-mail link-farm seo-farm content-farm click-farm like-farm backlink-shop",
    "ads-server ad-click track-pixel click-track ads-banner popup-ads tracking-ads adserve adtrack ads",
    "phishing-login verify-account secure-login-bank account-suspended malware-get virus-scan-now crack-keygen warez-crack torrent-free",
)
GOOD = (
    "news docs library university museum forum wiki blog school city weather recipes garden history science",
    "the-daily-news open-library local-museum city-council public-health music-school travel-notes data-structures",
    "art-history book-reviews language-lab bird-watching home-garden math-circle chess-club running-club photo-walk",
    "tionshing thethe thandre onering ereston ingthe theation ndther ousand ithing atione hersion thatin entiond",
    "therand ththor tionly thering ththis ingtion ththere",
)
PATHS = ("/en/{n}", "/de/{n}.html", "/fr/{n}", "/es/{n}?page=2", "/", "/a/b-{n}/index.html")
FRONTS, DOMAINS = ("", "www.", "m.", "blog."), ("example.com", "example.org", "example.net")


def labelled_rows() -> list:
    """(label, url) for every listed name: two urls each, with front, domain and path by turns."""
    rows = []
    for label, names in ((1, " ".join(BAD).split()), (0, " ".join(GOOD).split())):
        for n, name in enumerate(names):
            for k in (n, n * 7 + 3):
                host = FRONTS[k % len(FRONTS)] + name + "." + DOMAINS[k % len(DOMAINS)]
                rows.append((label, ("https://", "http://")[k % 2] + host + PATHS[k % len(PATHS)].format(n=17 * k + 5)))
    return rows


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(verdict, rule), else null."""
    found = [
        F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p),
               F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule")))
        for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    ]
    return F.coalesce(*found)


def _grams(part: Column, mark: str, k: int) -> Column:
    text = F.concat(F.lit("^"), part, F.lit("$"))
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(text) - (k - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.concat(F.lit(f"{mark}{k}"), F.substr(text, i, F.lit(k))))


def buckets(host: Column, path: Column, grams=GRAMS, n=BUCKETS) -> Column:
    """Bucket numbers of the distinct character n-grams of host and of path."""
    parts = [_grams(part, mark, k) for part, mark in ((host, "h"), (path, "p")) for k in grams]
    return F.transform(F.array_distinct(F.flatten(F.array(*parts))), lambda g: F.pmod(F.hash(g), F.lit(n)))


def train(labelled: DataFrame, n=BUCKETS, penalty=PENALTY) -> tuple[float, list[float]]:
    """Bias and bucket weights from (url, label).

    The table is small by contract (a few thousand urls): its buckets are worked out once and collected, and
    Spark fits sparse vectors of them.
    """
    found = labelled.where("label is not null").select(
        F.col("label").cast("double").alias("label"), buckets(host_of(F.col("url")), path_of(F.col("url")), n=n).alias("b")).collect()
    rows = [(r.label, Vectors.sparse(n, sorted({b: 1.0 for b in r.b}.items()))) for r in found]
    rows = labelled.sparkSession.createDataFrame(rows, ["label", "features"]).coalesce(1)
    model = LogisticRegression(regParam=penalty, maxIter=100, standardization=False).fit(rows)
    return float(model.intercept), [round(float(x), 6) for x in model.coefficients]


def score(host: Column, path: Column, model) -> Column:
    """Probability that a url is to be blocked; a bucket counts once, as in training."""
    bias, weights = model
    # One literal string parsed per task instead of thousands of literals in the plan.
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")
    total = F.aggregate(F.array_distinct(buckets(host, path, n=len(weights))), F.lit(float(bias)), lambda a, b: a + F.get(table, b))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def judge(pages: DataFrame, model, rules=RULES, threshold=0.5) -> DataFrame:
    """Add host, path, rule, score and verdict (allow or block) to rows with a ``url``."""
    added = ("host", "path", "rule", "score", "verdict")
    kept = [c for c in pages.columns if c not in added]
    found = (
        pages.select(*kept, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
        .withColumn("score", score(F.col("host"), F.col("path"), model))
    )
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return found.select(*kept, "host", "path", F.col("_rule.rule").alias("rule"), "score",
                        F.coalesce("_rule.verdict", own).alias("verdict"))


def labelled_urls(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(labelled_rows() if rows is None else list(rows), "label int, url string")

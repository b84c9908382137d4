"""op6: every page's url by the rules, and by the trained model where no rule fits."""

from printfold.llm.url_filter import judge, labelled_urls, train


def op6_url_filter(spark, folder):
    """Host, path, rule and verdict of every page."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    model = train(labelled_urls(spark))
    return judge(pages, model).select("page_id", "host", "path", "rule", "verdict", "score")

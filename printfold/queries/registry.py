"""Registration of queries with their SQL twins."""

QUERIES = {}
SQL = {}


class Tables:
    """The driver's Parquet tables by name."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name):
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql=None):
    """Register ``f(tables) -> DataFrame`` under its own name."""

    def register(f):
        name = f.__name__
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        QUERIES[name].__doc__ = f.__doc__
        if sql:
            SQL[name] = sql
        return f

    return register

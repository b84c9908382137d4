"""Run queries next to their SQL and compare names, types and rows."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

# The driver tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark and SQL names of one type.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "float": "FLOAT",
}


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def sorted_rows(rows):
    return sorted(rows, key=lambda r: [(x is None, str(x)) for x in r])


def difference(df, db, sql):
    """None when equal, else what differs."""
    found = db.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in found.description}
    names = [d[0] for d in found.description]
    order = sorted(names)
    if order != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {order}"
    types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    if types != sql_types:
        return f"types {[(n, types[n], sql_types[n]) for n in order if types[n] != sql_types[n]]}"
    expected = sorted_rows([tuple(r[names.index(n)] for n in order) for r in found.fetchall()])
    got = sorted_rows([tuple(r) for r in df.select(*order).collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows / {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{a} / {b}"
    return None if got else "no rows"


def main(folder, only):
    from pyspark.sql import SparkSession

    from printfold.queries import QUERIES, SQL

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = connect(folder), 0
    for name in only or QUERIES:
        start = time.time()
        try:
            problem = difference(QUERIES[name](spark, folder), db, SQL[name])
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(only or QUERIES)} differ")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

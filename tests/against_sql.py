"""Compare queries with their SQL: same columns, same rows in any order."""

from __future__ import annotations

import datetime as dt
import math
import sys
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def multiset(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        Counter(tuple(canonical(r[i]) for i in order) for r in rows),
    )


def difference(spark, folder: str, query, sql: str) -> str | None:
    """None if the query gives what the SQL gives, else what is wrong."""
    con = connect(folder)
    result = con.execute(sql)
    want = multiset([d[0] for d in result.description], result.fetchall())
    df = query(spark, folder)
    have = multiset(df.columns, df.collect())
    if want[0] != have[0]:
        return f"columns {have[0]} instead of {want[0]}"
    if want[1] != have[1]:
        lacks, extra = want[1] - have[1], have[1] - want[1]
        return (
            f"{sum(have[1].values())} rows instead of {sum(want[1].values())};"
            f" lacks {lacks.total()} {list(lacks)[:3]}; extra {extra.total()} {list(extra)[:3]}"
        )
    return None


if __name__ == "__main__":
    import time

    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sqls = e.oracle_sql()
    bad = 0
    for name, query in e.queries().items():
        if name not in sqls or wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = difference(spark, folder, query, sqls[name])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print("wrong:", bad, "of", len(e.queries()), "; without SQL:", set(e.queries()) - set(sqls))

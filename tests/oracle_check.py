"""Compare registered queries with their SQL on the given tables: rows, column names and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as spark_entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time() else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, name, folder):
    """None if equal, otherwise what differs."""
    df = spark_entry.queries()[name](spark, folder)
    if "CartesianProduct" in df._jdf.queryExecution().executedPlan().toString():
        return "the plan builds all pairs"
    got = rows_of(df.columns, df.collect())
    result = con.execute(spark_entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    folder = sys.argv[1]
    wanted = sys.argv[2:] or list(spark_entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    for name in wanted:
        start = time.time()
        try:
            if name in spark_entry.oracle_sql():
                verdict = compare(spark, con, name, folder) or "ok"
            else:
                verdict = f"{spark_entry.queries()[name](spark, folder).count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name}: {verdict} [{time.time() - start:.1f}s]", flush=True)

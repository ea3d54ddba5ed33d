"""Runs a registered query and its SQL on the same tables and compares the rows, order aside.

Usage: python tests/compare.py [-d FOLDER] [NAME PREFIX ...]
"""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(frame, con, sql):
    """None when equal, else a text that says what differs."""
    start = time.time()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    fetched = result.fetchall()
    compare.sql_seconds = time.time() - start
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} but SQL has {sorted(columns)}"
    want = rows_of(columns, fetched)
    got = rows_of(frame.columns, frame.collect())
    if want == got:
        return None
    extra, lacking = got - want, want - got
    return (
        f"{sum(got.values())} rows, SQL {sum(want.values())}; columns {sorted(columns)}; "
        f"only here {list(extra.items())[:3]}; only SQL {list(lacking.items())[:3]}"
    )


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.01"
    if argv[:1] == ["-d"]:
        folder, argv = argv[1], argv[2:]
    spark, con, sql = session(), connect(folder), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        start = time.time()
        try:
            frame = run(spark, folder)
            problem = compare(frame, con, sql[name]) if name in sql else f"(rows only: {frame.count()})"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem) and name in sql
        print(f"{time.time() - start:6.2f}s (SQL {getattr(compare, 'sql_seconds', 0):5.2f}s) {name}: {problem or 'equal'}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])

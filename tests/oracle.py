"""Compare registered queries with their SQL twins in DuckDB.

    python tests/oracle.py [folder] [name part ...]
"""

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def cell(x):
    """A comparable value that keeps its kind: int 1 and float 1.0 differ."""
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return ("null", "")
    if isinstance(x, bool):
        return ("bool", x)
    if isinstance(x, int):
        return ("int", x)
    if isinstance(x, (float, decimal.Decimal)):
        return ("float", float(x) + 0.0)
    if isinstance(x, (datetime.date, datetime.datetime)):
        return ("time", x.isoformat())
    return (type(x).__name__, x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(db, sql):
    result = db.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())


def difference(spark_side, sql_side):
    """None when equal, else a short description."""
    (sc, sr), (dc, dr) = spark_side, sql_side
    if sc != dc:
        return f"columns {sc} vs {dc}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} vs {len(dr)}; spark {sr[:2]} sql {dr[:2]}"
    for a, b in zip(sr, dr):
        if a != b:
            return f"spark {str(a)[:700]} vs sql {str(b)[:700]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from corpusmill.plans import ORACLES, QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = []
    for name, fn in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            t = time.time()
            got = spark_rows(fn(spark, folder))
            spent = time.time() - t
            if name not in ORACLES:
                print(f"{name:42s} rows-only {len(got[1]):8d} {spent:6.1f}s", flush=True)
                continue
            t = time.time()
            problem = difference(got, sql_rows(db, ORACLES[name]))
            print(
                f"{name:42s} {'ok' if problem is None else 'DIFF':9s} {len(got[1]):8d} "
                f"{spent:6.1f}s sql {time.time() - t:5.1f}s {problem or ''}",
                flush=True,
            )
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1200]}"
            print(f"{name:42s} FAIL {problem}", flush=True)
        if problem is not None:
            bad.append(name)
    print(f"{len(bad)} bad: {bad}")
    sys.exit(bool(bad))

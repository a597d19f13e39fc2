"""Compare registered queries with their SQL twins run by DuckDB."""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TIMES = {"spark": 0.0, "duck": 0.0}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    return v


def rows_of(frame_columns, rows):
    order = sorted(range(len(frame_columns)), key=lambda i: frame_columns[i])
    return sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, repr(v)) for v in r),
    )


def compare(df, con, sql):
    """Empty string when equal, else a short description of the difference."""
    start = time.time()
    got = [tuple(r) for r in df.collect()]
    TIMES["spark"] = time.time() - start
    start = time.time()
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    types = {d[0]: str(d[1]) for d in res.description}
    want = res.fetchall()
    TIMES["duck"] = time.time() - start
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    spark_types = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    for name, kind in df.dtypes:
        if spark_types.get(kind) != types[name]:
            return f"type of {name}: {kind} <> {types[name]}"
    if len(got) != len(want):
        return f"rows {len(got)} <> {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, columns {sorted(names)}, first:\n  {bad[0][0]}\n  {bad[0][1]}"
    return "" if got else "EMPTY"


def main(argv):
    from pyspark.sql import SparkSession

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", os.environ.get("ORACLE_TZ", "UTC"))
        .config("spark.sql.shuffle.partitions", os.environ.get("ORACLE_PARTITIONS", "8"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            message = compare(df, con, oracle[name]) if name in oracle else f"rows-only {df.count()}"
        except Exception as e:  # report and go on with the next query
            message = f"{type(e).__name__}: {str(e)[:1500]}"
        ok = not message or message.startswith("rows-only")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s spark {TIMES['spark']:.1f} duck {TIMES['duck']:.1f} {message}", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])

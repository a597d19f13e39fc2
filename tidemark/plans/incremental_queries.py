"""Incremental runs over stored tables, each equal to its full recomputation."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidemark.operators import features, incremental
from tidemark.plans.common import (
    EVENT_ALL,
    GRAIN,
    LINE_GRAIN,
    ROLES,
    SCORED_ALL,
    SUPPLIER_ALL,
    SUPPLIER_BASE,
    forecasts,
    rounded,
    sql_round,
    supplier_features,
)
from tidemark.sources import store, tables, versions

QUERIES, ORACLE = {}, {}
EVENT_CUT = "2024-01-28"  # hourly bars from this day on are new
LINE_CUT = "2001-06-01"  # weekly bars from this day on are new
TODAY = datetime.date(2002, 1, 1)


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def cut(df, at, order="bar"):
    """(rows before, rows from ``at`` on)."""
    limit = F.lit(at).cast("timestamp_ntz")
    return df.where(F.col(order) < limit), df.where(F.col(order) >= limit)


@query(
    "WITH "
    + ", ".join(SUPPLIER_BASE)
    + f"""
  SELECT DISTINCT series, bar FROM supplier_curated
  WHERE bar >= TIMESTAMP '{LINE_CUT}' OR bar = (SELECT min(bar) FROM supplier_curated)"""
)
def dates_to_process(spark, sf):
    """Bars without features: everything new, plus a gap at the very start."""
    curated = store.stored(tables.supplier_curated(spark, sf).select("series", "bar"), "curated")
    first = curated.select(F.min("bar")).scalar()
    done = cut(curated, LINE_CUT)[0].where(F.col("bar") > first)
    return incremental.dates_to_process(curated, done, ["series", "bar"], keys=curated.count())


@query(
    "WITH "
    + ", ".join(SUPPLIER_BASE)
    + f"""
  SELECT c.series, c.bar FROM supplier_curated c
  JOIN (SELECT series, max(bar) AS mark FROM supplier_curated
        WHERE bar < TIMESTAMP '{LINE_CUT}' GROUP BY series) m USING (series)
  WHERE c.bar > m.mark"""
)
def dates_after_watermark(spark, sf):
    curated = tables.supplier_curated(spark, sf)
    return incremental.dates_after_watermark(curated, cut(curated, LINE_CUT)[0], keys=["series"])


@query(
    "WITH "
    + ", ".join(SUPPLIER_BASE)
    + f"""
  SELECT series, bar, round(ret, 8) + 0.0 AS ret, bar < TIMESTAMP '{LINE_CUT}' AS is_context
  FROM (SELECT *, row_number() OVER (PARTITION BY series, bar < TIMESTAMP '{LINE_CUT}'
               ORDER BY bar DESC) AS rn FROM supplier_curated) r
  WHERE bar >= TIMESTAMP '{LINE_CUT}'
     OR (rn <= 70 AND series IN (SELECT series FROM supplier_curated
                                 WHERE bar >= TIMESTAMP '{LINE_CUT}'))"""
)
def context_read(spark, sf):
    curated = tables.supplier_curated(spark, sf).select("series", "bar", "ret")
    old, new = cut(curated, LINE_CUT)
    return rounded(incremental.with_context(new, old))


@query(
    "WITH "
    + ", ".join(SUPPLIER_BASE)
    + f"""
  SELECT series, bar, round(ret, 8) + 0.0 AS ret FROM supplier_curated
  WHERE bar >= TIMESTAMP '{LINE_CUT}'"""
)
def incremental_returns(spark, sf):
    """Stored returns up to the cut, new raw bars after it."""
    bars = tables.supplier_bars(spark, sf)
    old, new = cut(bars, LINE_CUT)
    # The very first bar of a series has no stored return, hence the raw old bars as context.
    out = incremental.incremental_returns(new, old, grain=LINE_GRAIN)
    return rounded(out.select("series", "bar", "ret"))


@query(
    sql_round(
        f"SELECT * EXCLUDE (rv_5d) FROM master WHERE bar >= TIMESTAMP '{EVENT_CUT}'",
        features.FEATURE_COLUMNS,
        EVENT_ALL,
    )
)
def incremental_features(spark, sf):
    """Features exist up to the cut; the later bars are computed from stored curated bars."""
    curated = store.stored(tables.event_curated(spark, sf), "curated")
    existing = cut(curated.select("bar"), EVENT_CUT)[0].distinct()
    return rounded(incremental.incremental_features(curated, existing, ROLES, grain=GRAIN))


@query(
    sql_round(
        "SELECT series, bar, ret_1, vol_20, rv_5d FROM supplier_master",
        ("ret_1", "vol_20", "rv_5d"),
        SUPPLIER_ALL,
    )
)
def master_upsert(spark, sf):
    """Master up to the cut (its last labels unknown) plus the new feature rows."""
    rows = supplier_features(spark, sf, label=True).select(
        "series", "bar", "ret_1", "vol_20", "rv_5d"
    )
    table = store.stored(rows, "features")
    old, new = cut(table, LINE_CUT)
    # Labels that look past the cut were not known when the master was written.
    from tidemark.operators.labels import forward_rv

    master = forward_rv(old.drop("rv_5d"), ret="ret_1", keys=["series"], grain=LINE_GRAIN)
    out = incremental.master_upsert(
        master, new.drop("rv_5d"), ret="ret_1", keys=["series"], grain=LINE_GRAIN
    )
    return rounded(out)


@query(ORACLE["master_upsert"])
def versioned_upsert(spark, sf):
    """The same master as a versioned table: version 2 replaces the months of new rows and of labels they settle."""
    rows = supplier_features(spark, sf, label=True).select("series", "bar", "ret_1", "vol_20", "rv_5d")
    old, new = cut(store.stored(rows, "features"), LINE_CUT)
    from tidemark.operators.labels import forward_rv

    path, month = store.scratch_path(spark, "master"), F.date_format("bar", "yyyy-MM")
    versions.create(forward_rv(old.drop("rv_5d"), ret="ret_1", keys=["series"], grain=LINE_GRAIN), path, month, "bar")
    incremental.upsert_partitions(path, new.drop("rv_5d"), month, ret="ret_1", keys=["series"], grain=LINE_GRAIN)
    return rounded(versions.read(spark, path))


@query(
    """SELECT strftime(date_trunc('week', l_shipdate), '%Y-%m') AS part, count(DISTINCT (l_suppkey, date_trunc('week', l_shipdate))) AS rows,
              CAST(CAST(min(date_trunc('week', l_shipdate)) AS TIMESTAMP) AS VARCHAR) AS first, CAST(CAST(max(date_trunc('week', l_shipdate)) AS TIMESTAMP) AS VARCHAR) AS last
       FROM lineitem GROUP BY 1"""
)
def version_partitions(spark, sf):
    """Partitions of a versioned table with their rows and ranges: read from the manifest, no data is scanned."""
    bars = tables.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("series"), F.date_trunc("week", "l_shipdate").cast("timestamp_ntz").alias("bar")).distinct()
    path = store.scratch_path(spark, "bars")
    versions.create(bars, path, F.date_format("bar", "yyyy-MM"), "bar")
    return versions.partitions(spark, path)


@query("""
  SELECT 'manifest' AS source, CAST(m + INTERVAL 1 DAY AS DATE) AS start, DATE '2002-01-01' AS "end",
         'incremental' AS mode FROM (SELECT max(CAST(l_shipdate AS DATE)) AS m FROM lineitem) a
  UNION ALL
  SELECT 'partitions', CAST(p + INTERVAL 1 DAY AS DATE), DATE '2002-01-01', 'incremental'
  FROM (SELECT max(CAST(o_orderdate AS DATE)) AS p FROM orders) b
  UNION ALL SELECT 'none', DATE '1995-01-01', DATE '2002-01-01', 'full'
  UNION ALL SELECT 'current', NULL, NULL, 'up_to_date'""")
def ingest_range(spark, sf):
    """The four outcomes: from the manifest, from partitions, full history, nothing to do."""
    day = lambda name, col: tables.table(spark, sf, name).select(F.to_date(col).alias("date"))
    manifest, partitions = day("lineitem", "l_shipdate"), day("orders", "o_orderdate")
    none = manifest.where(F.lit(False))
    start = datetime.date(1995, 1, 1)
    cases = {
        "manifest": incremental.ingest_range(manifest, partitions, start, TODAY),
        "partitions": incremental.ingest_range(none, partitions, start, TODAY),
        "none": incremental.ingest_range(none, none, start, TODAY),
        "current": incremental.ingest_range(
            day("events", "ts"), partitions, start, datetime.date(2024, 1, 31)
        ),
    }
    return store.union_layers(
        [df.select(F.lit(name).alias("source"), "*") for name, df in cases.items()]
    )


@query(
    "WITH "
    + ", ".join(SCORED_ALL)
    + f"""
  SELECT DISTINCT series, model, bar FROM scored WHERE bar >= TIMESTAMP '{LINE_CUT}'"""
)
def dates_to_predict(spark, sf):
    """Forecast keys that the history does not hold yet."""
    rows = store.stored(forecasts(spark, sf).select("series", "model", "bar"), "forecasts")
    return incremental.dates_to_process(rows, cut(rows, LINE_CUT)[0], ["series", "model", "bar"], keys=rows.count())


@query(
    sql_round(
        f"""SELECT series, bar, ret FROM supplier_curated
            WHERE bar >= (SELECT min(bar) FROM supplier_curated WHERE bar >= TIMESTAMP '{LINE_CUT}') - INTERVAL 150 DAYS""",
        ("ret",),
        SUPPLIER_BASE,
    )
)
def context_days(spark, sf):
    """Stored rows from 150 calendar days before the first new bar to the last one."""
    curated = store.stored(tables.supplier_curated(spark, sf).select("series", "bar", "ret"), "curated")
    _, new = cut(curated, LINE_CUT)
    return rounded(incremental.context_by_days(curated, new))


@query(
    sql_round(
        """SELECT series, bar, ret, strftime(date_trunc('month', bar), '%Y-%m-%d') AS month FROM supplier_curated
           WHERE date_trunc('month', bar) IN (SELECT DISTINCT date_trunc('month', o_orderdate) FROM orders)""",
        ("ret",),
        SUPPLIER_BASE,
    )
)
def tolerant_read(spark, sf):
    """Monthly partitions read by a list of months, some of which the table does not have."""
    path = store.scratch_path(spark, "months")
    curated = tables.supplier_curated(spark, sf).select("series", "bar", "ret")
    store.write_partitions(curated, path, order="bar", by="month", unit="month")
    back = store.read_partitions(spark, path, "series long, bar timestamp_ntz, ret double, month string", tolerant=True)
    months = tables.table(spark, sf, "orders").select(
        F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("month")
    )
    return rounded(store.read_by_dates(back, months, "month"))

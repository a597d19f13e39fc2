"""Profiling and validation of bars and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features, profile, validate
from tidemark.plans.common import (
    EVENT_ALL,
    EVENT_BASE,
    EVENT_FEATURES,
    EVENT_WIDE,
    GRAIN,
    LINE_GRAIN,
    MARKET,
    SUPPLIER_BASE,
    SUPPLIER_FEATURES,
    SUPPLIER_JOINED,
    event_features,
    event_wide,
    rounded,
    sql_round,
    supplier_features,
)
from tidemark.sources import store, tables

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


FEATURES = features.SERIES_FEATURES
SUPPLIER_CTES = (*SUPPLIER_BASE, MARKET, SUPPLIER_JOINED, SUPPLIER_FEATURES)
WIDE_CTES = (*EVENT_BASE, EVENT_WIDE)


def per_feature(expr: str, source: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {expr.format(c=c)} FROM {source}" for c in columns
    )


@query(
    sql_round(
        per_feature(
            "count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, "
            "quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, "
            "quantile_cont({c}, 0.75) AS q75, max({c}) AS max",
            "supplier_features",
            FEATURES,
        ),
        ("mean", "std", "min", "q25", "q50", "q75", "max"),
        SUPPLIER_CTES,
    )
)
def column_profile(spark, sf):
    table = store.stored(supplier_features(spark, sf), "features")
    return rounded(profile.column_profile(table, FEATURES))


@query(
    sql_round(
        per_feature(
            "count(*) - count({c}) AS missing, (count(*) - count({c})) * 100.0::DOUBLE / count(*) "
            "AS missing_pct",
            "supplier_features",
            FEATURES,
        ),
        ("missing_pct",),
        SUPPLIER_CTES,
    )
)
def missing_report(spark, sf):
    return rounded(profile.missing_report(supplier_features(spark, sf), FEATURES))


@query(
    sql_round(
        "SELECT series, count(ret) AS n, avg(ret) AS mean, stddev_samp(ret) AS std, "
        "min(ret) AS min, max(ret) AS max FROM supplier_curated GROUP BY series",
        ("mean", "std", "min", "max"),
        SUPPLIER_BASE,
    )
)
def return_stats(spark, sf):
    return rounded(profile.return_stats(tables.supplier_curated(spark, sf)))


@query(
    sql_round(
        "SELECT series, count(ret) AS n, skewness(ret) AS skewness, kurtosis(ret) AS kurtosis "
        "FROM supplier_curated GROUP BY series",
        ("skewness", "kurtosis"),
        SUPPLIER_BASE,
    )
)
def return_moments(spark, sf):
    return rounded(profile.return_moments(tables.supplier_curated(spark, sf)))


@query(
    sql_round(
        """SELECT count(*) AS n, avg(CASE WHEN t > 1 THEN 1.0 ELSE 0.0 END) AS share_above,
                  avg(CASE WHEN t < 1 THEN 1.0 ELSE 0.0 END) AS share_below, avg(t) AS mean_ratio
           FROM (SELECT CASE WHEN vix <> 0 THEN vix3m / vix END AS t FROM wide) r
           WHERE t IS NOT NULL""",
        ("share_above", "share_below", "mean_ratio"),
        WIDE_CTES,
    )
)
def term_structure_share(spark, sf):
    return rounded(profile.term_structure_share(features.term_structure(event_wide(spark, sf))))


def _pairwise(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    x, y = f"CASE WHEN {both} THEN {a} END", f"CASE WHEN {both} THEN {b} END"
    return (
        f"CASE WHEN min({x}) < max({x}) AND min({y}) < max({y}) THEN covar_pop({a}, {b}) "
        f"/ (stddev_pop({x}) * stddev_pop({y})) END"
    )


def _matrix(columns, source) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, "
        + (f"CASE WHEN min({a}) < max({a}) THEN 1.0 END" if a == b else _pairwise(a, b))
        + f" AS corr FROM {source}"
        for a in columns
        for b in columns
    )


MATRIX = f"matrix AS ({_matrix(features.FEATURE_COLUMNS, 'features')})"
EVENT_CTES = (*WIDE_CTES, EVENT_FEATURES)


@query(sql_round("SELECT * FROM matrix", ("corr",), (*EVENT_CTES, MATRIX)))
def corr_matrix(spark, sf):
    return rounded(profile.corr_matrix(event_features(spark, sf), features.FEATURE_COLUMNS))


@query(
    sql_round(
        "SELECT a, b, corr, abs(corr) AS abs_corr FROM matrix WHERE a < b AND abs(corr) > 0.9",
        ("corr", "abs_corr"),
        (*EVENT_CTES, MATRIX),
    )
)
def high_corr_pairs(spark, sf):
    matrix = profile.corr_matrix(event_features(spark, sf), features.FEATURE_COLUMNS)
    return rounded(profile.high_corr_pairs(matrix))


@query(
    sql_round(
        f"""SELECT series, count(CASE WHEN ret_1 IS NOT NULL AND spread IS NOT NULL THEN 1 END) AS n,
                  {_pairwise('ret_1', 'spread')} AS corr FROM supplier_features GROUP BY series""",
        ("corr",),
        SUPPLIER_CTES,
    )
)
def pair_corr(spark, sf):
    return rounded(
        profile.pair_corr(supplier_features(spark, sf), "ret_1", "spread", by=["series"])
    )


@query(
    sql_round(
        """SELECT series, bin, lo + step * (bin - 1) AS low, lo + step * bin AS high, n FROM (
             SELECT series, bin, max(lo) AS lo, max(step) AS step, count(*) AS n FROM (
               SELECT series, lo, step, CAST(least(CASE WHEN step <> 0
                        THEN floor((ret - lo) / step) ELSE 0 END + 1, 50) AS BIGINT) AS bin
               FROM (SELECT series, ret, lo, (hi - lo) / 50 AS step
                     FROM supplier_curated JOIN (
                       SELECT series, min(ret) AS lo, max(ret) AS hi
                       FROM supplier_curated GROUP BY series) l USING (series)) s) b
             GROUP BY series, bin) h""",
        ("low", "high"),
        SUPPLIER_BASE,
    )
)
def return_histogram(spark, sf):
    curated = store.stored(tables.supplier_curated(spark, sf).select("series", "ret"), "returns")
    return rounded(profile.return_histogram(curated, 50))


@query(
    sql_round(
        " UNION ALL ".join(
            f"SELECT series, '{c}' AS feature, min(CASE WHEN {c} IS NOT NULL THEN rn END) "
            f"AS first_valid, count(*) - count({c}) AS nulls, count(*) - count({c}) - "
            f"coalesce(min(CASE WHEN {c} IS NOT NULL THEN rn END) - 1, count(*)) "
            "AS nulls_after_first FROM numbered GROUP BY series"
            for c in FEATURES
        ),
        (),
        (
            *SUPPLIER_CTES,
            "numbered AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY bar) AS rn "
            "FROM supplier_features)",
        ),
    )
)
def warmup_check(spark, sf):
    return profile.warmup_check(
        supplier_features(spark, sf), FEATURES, keys=["series"], grain=LINE_GRAIN
    )


@query(
    sql_round(
        """SELECT a.bar, CASE WHEN b.close <> 0 THEN a.close / b.close END AS ratio
           FROM event_curated a JOIN event_curated b ON a.bar = b.bar
           WHERE a.series = 'signup' AND b.series = 'error'""",
        ("ratio",),
        EVENT_BASE,
    )
)
def price_ratio(spark, sf):
    curated = store.stored(tables.event_curated(spark, sf), "curated")
    return rounded(profile.price_ratio(curated, "signup", "error"))


@query("""
  SELECT 'wrong_type' AS rule, 'date' AS "column", CAST(NULL AS BIGINT) AS n
  UNION ALL SELECT 'missing_column', 'volume', NULL
  UNION ALL SELECT 'null_value', 'open', n FROM (
    SELECT count(*) AS n FROM (
      SELECT event_type, date_trunc('hour', ts) AS h FROM events GROUP BY 1, 2
      HAVING min(value) < 10) b) c WHERE n > 0""")
def schema_violations(spark, sf):
    """Hourly bars with defects built in: no volume, a timestamp as date, low opens blanked."""
    bars = tables.event_bars(spark, sf).select(
        F.col("series").alias("symbol"),
        F.col("bar").alias("date"),
        F.when(F.col("low") >= 10, F.col("open")).alias("open"),
        "high",
        "low",
        "close",
    )
    return validate.schema_violations(bars, validate.RAW_SCHEMA)


@query("WITH " + ", ".join((*EVENT_CTES,)) + """
  SELECT 'column_count' AS rule, CAST(NULL AS VARCHAR) AS "column", CAST(22 AS BIGINT) AS n
  UNION ALL SELECT 'raw_column', 'symbol', NULL
  UNION ALL SELECT 'duplicate_time', 'bar', n FROM (
    SELECT count(*) AS n FROM (SELECT date_trunc('day', bar) FROM features GROUP BY 1
                               HAVING count(*) > 1) d) e WHERE n > 0""")
def feature_rules(spark, sf):
    """Features whose times were cut to the day and that still carry a symbol."""
    broken = event_features(spark, sf).withColumns(
        {"bar": F.date_trunc("day", "bar").cast("timestamp_ntz"), "symbol": F.lit("SPY")}
    )
    return validate.feature_rules(broken)


@query("""
  SELECT date_trunc('day', l_shipdate) AS date, count(*) AS rows
  FROM lineitem GROUP BY 1 HAVING count(*) <> 1""")
def partition_rules(spark, sf):
    daily = tables.table(spark, sf, "lineitem").select(
        F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("date")
    )
    return validate.partition_rules(daily)


@query("""
  SELECT date_trunc('day', l_shipdate) AS date, count(*) AS rows,
         CAST(CASE WHEN count(CASE WHEN l_returnflag = 'R' THEN 1 END) = 0 THEN 1 ELSE 0 END
              + CASE WHEN count(CASE WHEN l_linestatus = 'F' THEN 1 END) = 0 THEN 1 ELSE 0 END AS INTEGER) AS empty_columns
  FROM lineitem GROUP BY 1 HAVING count(*) <> 1""")
def partition_scan(spark, sf):
    """Days without exactly one row, and which of two sparse columns they lack altogether."""
    rows = tables.table(spark, sf, "lineitem").select(
        F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("date"),
        F.when(F.col("l_returnflag") == "R", 1).alias("returned"),
        F.when(F.col("l_linestatus") == "F", 1).alias("finished"),
    )
    return validate.scan_partitions(rows, "date", ["returned", "finished", "not_there"])

"""Time-ordered splits, folds, imputation and scaling per series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import prep, profile, split
from tidemark.operators.features import SERIES_FEATURES
from tidemark.sources import store
from tidemark.plans.common import LINE_GRAIN, SUPPLIER_ALL, rounded, sql_round, supplier_features

QUERIES, ORACLE = {}, {}
COLUMNS = ("vol_5", "vol_20", "drawdown_60", "rsi_14", "corr_20")


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


SPLIT = """split AS (
  SELECT * EXCLUDE (rn, n, pre), CASE WHEN rn > pre THEN 'test'
         WHEN rn > pre - greatest(1, CAST(floor(pre * 0.2) AS BIGINT)) THEN 'val'
         ELSE 'train' END AS split
  FROM (SELECT *, greatest(n - 30, 0) AS pre
        FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY bar) AS rn,
                     count(*) OVER (PARTITION BY series) AS n
              FROM supplier_master WHERE rv_5d IS NOT NULL) r) p)"""
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in COLUMNS)
CLEAN = f"clean AS (SELECT * FROM split WHERE split = 'test' OR ({_COMPLETE}))"
MEANS = (
    "means AS (SELECT series, "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in COLUMNS)
    + " FROM clean WHERE split = 'train' GROUP BY series)"
)
SPLIT_CTES = (*SUPPLIER_ALL, SPLIT, CLEAN, MEANS)


def stored_master(spark, sf):
    """The master table is read several times per query, so it is written first."""
    wanted = supplier_features(spark, sf, label=True).select("series", "bar", "rv_5d", *COLUMNS)
    return store.stored(wanted, "master")


def split_master(spark, sf, clean: bool = True):
    master = supplier_features(spark, sf, label=True)
    return split.time_split(
        master, features=COLUMNS if clean else (), keys=["series"], grain=LINE_GRAIN
    )


@query(sql_round("SELECT series, bar, split, rv_5d FROM split", ("rv_5d",), SPLIT_CTES))
def time_split(spark, sf):
    return rounded(split_master(spark, sf, clean=False).select("series", "bar", "split", "rv_5d"))


@query(
    "WITH "
    + ", ".join(SPLIT_CTES)
    + """
  SELECT series, split, count(*) AS rows, min(bar) AS start, max(bar) AS "end"
  FROM clean GROUP BY series, split"""
)
def split_summary(spark, sf):
    return split.split_summary(split_master(spark, sf), ["series"])


@query(
    "WITH "
    + ", ".join(SUPPLIER_ALL)
    + """
  SELECT series, split, count(*) AS rows, min(bar) AS start, max(bar) AS "end"
  FROM (SELECT series, bar, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY bar)
               <= CAST(floor(count(*) OVER (PARTITION BY series) * 0.9) AS BIGINT)
               THEN 'train' ELSE 'val' END AS split
        FROM supplier_curated) s
  GROUP BY series, split"""
)
def walk_forward_split(spark, sf):
    from tidemark.sources.tables import supplier_curated

    rows = split.walk_forward_split(supplier_curated(spark, sf), keys=["series"], grain=LINE_GRAIN)
    return split.split_summary(rows, ["series"])


@query(
    "WITH "
    + ", ".join(SUPPLIER_ALL)
    + """
  , numbered AS (
    SELECT series, bar, row_number() OVER (PARTITION BY series ORDER BY bar) AS rn,
           count(*) OVER (PARTITION BY series) AS n FROM supplier_curated)
  SELECT series, CAST(k AS BIGINT) AS fold,
         CAST(count(CASE WHEN rn <= n - (6 - k) * (n // 6) THEN 1 END) AS BIGINT) AS train_rows,
         max(CASE WHEN rn <= n - (6 - k) * (n // 6) THEN bar END) AS train_end,
         CAST(count(CASE WHEN rn > n - (6 - k) * (n // 6) AND rn <= n - (5 - k) * (n // 6) THEN 1 END)
           AS BIGINT) AS test_rows,
         min(CASE WHEN rn > n - (6 - k) * (n // 6) AND rn <= n - (5 - k) * (n // 6) THEN bar END)
           AS test_start,
         max(CASE WHEN rn > n - (6 - k) * (n // 6) AND rn <= n - (5 - k) * (n // 6) THEN bar END)
           AS test_end
  FROM numbered, (SELECT unnest([1, 2, 3, 4, 5]) AS k) f
  GROUP BY series, k"""
)
def ts_folds(spark, sf):
    from tidemark.sources.tables import supplier_curated

    folds = split.ts_folds(supplier_curated(spark, sf), 5, keys=["series"], grain=LINE_GRAIN)
    return split.fold_table(folds, ["series"])


@query(
    sql_round(
        "SELECT series, " + ", ".join(f"m_{c} AS {c}" for c in COLUMNS) + " FROM means",
        COLUMNS,
        SPLIT_CTES,
    )
)
def feature_means(spark, sf):
    train = split_master(spark, sf).where("split = 'train'")
    return rounded(prep.feature_means(train, COLUMNS, by=["series"]))


@query(
    sql_round(
        "SELECT c.series, c.bar, "
        + ", ".join(f"coalesce(c.{x}, m.m_{x}) AS {x}" for x in COLUMNS)
        + ", "
        + " + ".join(f"CAST(c.{x} IS NULL AS BIGINT)" for x in COLUMNS)
        + " AS imputed FROM supplier_master c JOIN means m USING (series)",
        COLUMNS,
        SPLIT_CTES,
    )
)
def impute_means(spark, sf):
    """Every master row imputed with the train means of its series."""
    master = stored_master(spark, sf)
    rows = split.time_split(master, features=COLUMNS, keys=["series"], grain=LINE_GRAIN)
    means = prep.feature_means(rows.where("split = 'train'"), COLUMNS, by=["series"])
    wanted = master.select("series", "bar", *COLUMNS)
    return rounded(prep.impute_means(wanted, means, COLUMNS, by=["series"]))


@query(
    sql_round(
        "SELECT c.series, c.bar, "
        + ", ".join(
            f"CASE WHEN m.s_{x} = 0 THEN c.{x} - m.m_{x} ELSE (c.{x} - m.m_{x}) / m.s_{x} END AS {x}"
            for x in COLUMNS
        )
        + " FROM clean c JOIN means m USING (series)",
        COLUMNS,
        SPLIT_CTES,
    )
)
def standardize(spark, sf):
    rows = split.time_split(
        stored_master(spark, sf), features=COLUMNS, keys=["series"], grain=LINE_GRAIN
    )
    stats = prep.scale_stats(rows.where("split = 'train'"), COLUMNS, by=["series"])
    wanted = rows.select("series", "bar", *COLUMNS)
    return rounded(prep.standardize(wanted, stats, COLUMNS, by=["series"]))


assert set(COLUMNS) <= set(SERIES_FEATURES)


@query(
    sql_round(
        f"""SELECT split, count(*) AS indices, count(*) AS features, count(rv_5d) AS labels, sum(rv_5d) AS label_sum,
                  sum(vol_5) AS feature_sum FROM split GROUP BY split""",
        ("label_sum", "feature_sum"),
        (*SUPPLIER_ALL, SPLIT),
    )
)
def split_export(spark, sf):
    """Index, feature and label files of every split, written and read back."""
    path = store.scratch_path(spark, "export")
    rows = split_master(spark, sf, clean=False).select("series", "bar", "rv_5d", "vol_5", "split")
    store.export_splits(rows, path, order="bar", label="rv_5d")
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    n = spark.read.csv(f"{path}/indices", header=True).groupBy("split").agg(F.count(F.lit(1)).alias("indices"))
    x = read("x").groupBy("split").agg(F.count(F.lit(1)).alias("features"), F.sum("vol_5").alias("feature_sum"))
    y = read("y").groupBy("split").agg(F.count("rv_5d").alias("labels"), F.sum("rv_5d").alias("label_sum"))
    return rounded(n.join(x, "split").join(y, "split"))


@query(
    sql_round(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing, (count(*) - count({c})) * 100.0 / count(*) AS missing_pct FROM supplier_master"""
            for c in SERIES_FEATURES
        ),
        ("missing_pct",),
        SUPPLIER_ALL,
    )
)
def feature_columns(spark, sf):
    """The columns that learners take (neither keys nor label), each with its missing values."""
    master = supplier_features(spark, sf, label=True)
    return rounded(profile.missing_report(master, split.feature_columns(master)))

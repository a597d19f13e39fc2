"""Derived inputs shared by the registered queries, as DataFrames and as SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import rolling
from tidemark.operators import features, labels
from tidemark.operators.frames import over_rows
from tidemark.sources import tables

DIGITS = 8


def rounded(df: DataFrame, digits: int = DIGITS, exact: Sequence[str] = ()) -> DataFrame:
    """Round floating columns so results compare exactly with the SQL twin.

    Half away from zero on the scaled value, in plain floating arithmetic. Columns in
    ``exact`` come from exact sums and one division; they stay as they are.
    """
    scale = f"{10**digits}D"
    half_up = "(IF({c} < 0, -1D, 1D) * floor(abs({c}) * {s} + 0.5D)) / {s} + 0D"
    return df.select(
        [
            F.expr(half_up.format(c=f"`{f.name}`", s=scale)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in exact
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def sql_round(body: str, doubles: Sequence[str], ctes: Sequence[str] = ()) -> str:
    """``body`` with its floating columns rounded; ``ctes`` are WITH members it uses."""
    with_clause = f"WITH {', '.join(ctes)} " if ctes else ""
    if not doubles:
        return with_clause + body
    replace = ", ".join(f"round({c}, {DIGITS}) + 0.0 AS {c}" for c in doubles)
    return f"{with_clause}SELECT * REPLACE ({replace}) FROM ({body}) result"


# ---- event universe: five series, hourly bars ---------------------------------

GRAIN = tables.EVENT_GRAIN
ROLES = tables.EVENT_ROLES


def event_wide(spark: SparkSession, sf: str) -> DataFrame:
    return features.wide_bars(tables.event_curated(spark, sf), ROLES)


def event_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.wide_features(event_wide(spark, sf), grain=GRAIN)


def event_master(spark: SparkSession, sf: str) -> DataFrame:
    return labels.forward_rv(event_features(spark, sf), grain=GRAIN)


EVENT_BARS = """event_bars AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS bar,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, arg_max(value, ts) AS adj_close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""

EVENT_RETURNS = """event_returns AS (
  SELECT series, bar, open, high, low, close, adj_close, volume,
         CASE WHEN adj_close > 0 AND prev > 0 THEN ln(adj_close / prev) END AS ret
  FROM (SELECT *, lag(adj_close) OVER (PARTITION BY series ORDER BY bar) AS prev
        FROM event_bars) b)"""

EVENT_CURATED = """event_curated AS (
  SELECT series, bar, close, adj_close, ret FROM event_returns WHERE ret IS NOT NULL)"""

_PIVOT = ",\n         ".join(
    [
        f"max(CASE WHEN series = '{ROLES[r]}' THEN {src} END) AS {r}_{out}"
        for r in ("spy", "tlt", "hyg")
        for src, out in (("ret", "ret"), ("adj_close", "adj_close"))
    ]
    + [
        f"max(CASE WHEN series = '{ROLES[r]}' THEN adj_close END) AS {r}"
        for r in ("vix", "vix3m")
    ]
)
EVENT_WIDE = f"wide AS (\n  SELECT bar, {_PIVOT}\n  FROM event_curated GROUP BY bar)"


def sql_gate(value: str, n: int, *inputs: str, name: str | None = None) -> str:
    """``value`` over the last ``n`` rows, null unless all inputs are there."""
    w = name or f"w{n}"
    usable = " AND ".join(f"{c} IS NOT NULL" for c in inputs)
    return f"CASE WHEN count(CASE WHEN {usable} THEN 1 END) OVER {w} = {n} THEN {value} END"


def sql_corr(a: str, b: str, n: int) -> str:
    w = f"w{n}"
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (
        f"CASE WHEN count(CASE WHEN {both} THEN 1 END) OVER {w} = {n} "
        f"AND min({a}) OVER {w} < max({a}) OVER {w} AND min({b}) OVER {w} < max({b}) OVER {w} "
        f"THEN covar_pop({a}, {b}) OVER {w} "
        f"/ (stddev_pop({a}) OVER {w} * stddev_pop({b}) OVER {w}) END"
    )


def sql_windows(partition: str, order: str = "bar", ns: Sequence[int] = (5, 10, 14, 20, 60)) -> str:
    by = f"PARTITION BY {partition} " if partition else ""
    return "WINDOW " + ", ".join(
        f"w{n} AS ({by}ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in ns
    )


def sql_rsi(n: int = 14) -> str:
    g, l = f"avg(up) OVER w{n}", f"avg(down) OVER w{n}"
    return (
        f"CASE WHEN count(*) OVER w{n} = {n} THEN CASE WHEN {l} = 0 AND {g} = 0 THEN NULL "
        f"WHEN {l} = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + {g} / {l}) END END"
    )


def sql_moves(source: str, price: str, partition: str = "") -> str:
    by = f"PARTITION BY {partition} " if partition else ""
    return (
        "SELECT *, CASE WHEN move > 0 THEN move ELSE 0.0 END AS up, "
        "CASE WHEN move < 0 THEN -move ELSE 0.0 END AS down FROM "
        f"(SELECT *, {price} - lag({price}) OVER ({by}ORDER BY bar) AS move FROM {source}) m"
    )


_FEATURES = ",\n         ".join(
    ["spy_ret AS spy_ret_1d"]
    + [f"{sql_gate(f'sum(spy_ret) OVER w{n}', n, 'spy_ret')} AS spy_ret_{n}d" for n in (5, 10, 20, 60)]
    + [
        f"{sql_gate(f'sqrt(sum(spy_ret * spy_ret) OVER w{n})', n, 'spy_ret')} AS spy_vol_{n}d"
        for n in (5, 10, 20, 60)
    ]
    + [
        sql_gate("1 - spy_adj_close / max(spy_adj_close) OVER w60", 60, "spy_adj_close")
        + " AS drawdown_60d",
        "vix, vix3m, CASE WHEN vix <> 0 THEN vix3m / vix END AS vix_term",
        f"{sql_rsi()} AS rsi_spy_14",
    ]
    + [
        f"{sql_corr('spy_ret', f'{x}_ret', n)} AS corr_spy_{x}_{n}d"
        for n in (20, 60)
        for x in ("tlt", "hyg")
    ]
    + [
        "hyg_ret - tlt_ret AS hyg_tlt_spread",
        sql_gate("sqrt(sum(spy_ret * spy_ret) OVER w20)", 20, "spy_ret")
        + " - vix AS rv_vix_spread_20d",
    ]
)
EVENT_FEATURES = (
    f"features AS (\n  SELECT bar, {_FEATURES}\n"
    f"  FROM ({sql_moves('wide', 'spy_adj_close')}) s {sql_windows('')})"
)


def sql_label(ret: str, partition: str = "", horizon: int = 5) -> str:
    by = f"PARTITION BY {partition} " if partition else ""
    w = f"({by}ORDER BY bar ROWS BETWEEN 1 FOLLOWING AND {horizon} FOLLOWING)"
    return (
        f"CASE WHEN count({ret}) OVER {w} = {horizon} THEN sqrt(sum({ret} * {ret}) OVER {w}) END"
    )


EVENT_MASTER = (
    f"master AS (SELECT *, {sql_label('spy_ret_1d')} AS rv_5d FROM features)"
)
EVENT_BASE = (EVENT_BARS, EVENT_RETURNS, EVENT_CURATED)
EVENT_ALL = (*EVENT_BASE, EVENT_WIDE, EVENT_FEATURES, EVENT_MASTER)

# ---- supplier universe: weekly bars, one series per supplier --------------------

LINE_GRAIN = tables.LINE_GRAIN


def supplier_features(spark: SparkSession, sf: str, label: bool = False) -> DataFrame:
    return features.universe_features(
        tables.supplier_curated(spark, sf),
        tables.market_returns(spark, sf),
        grain=LINE_GRAIN,
        extra_steps=[labels.label_step("ret_1")] if label else [],
        ahead=labels.HORIZON if label else 0,
    )


SUPPLIER_BARS = """supplier_bars AS (
  SELECT l_suppkey AS series, date_trunc('week', l_shipdate) AS bar,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 / sum(l_quantity) AS close,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 / sum(l_quantity) AS adj_close,
         sum(l_quantity) AS volume
  FROM lineitem GROUP BY 1, 2)"""

SUPPLIER_CURATED = """supplier_curated AS (
  SELECT * EXCLUDE (prev) FROM (
    SELECT *, CASE WHEN adj_close > 0 AND prev > 0 THEN ln(adj_close / prev) END AS ret
    FROM (SELECT *, lag(adj_close) OVER (PARTITION BY series ORDER BY bar) AS prev
          FROM supplier_bars) b) r
  WHERE ret IS NOT NULL)"""

MARKET = """market AS (
  SELECT bar, CASE WHEN close > 0 AND prev > 0 THEN ln(close / prev) END AS bench FROM (
    SELECT bar, close, lag(close) OVER (ORDER BY bar) AS prev FROM (
      SELECT date_trunc('week', l_shipdate) AS bar,
             CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100
               / sum(l_quantity) AS close
      FROM lineitem GROUP BY 1) m) p)"""

_SERIES_FEATURES = ",\n         ".join(
    ["ret AS ret_1"]
    + [f"{sql_gate(f'sum(ret) OVER w{n}', n, 'ret')} AS ret_{n}" for n in (5, 10, 20, 60)]
    + [f"{sql_gate(f'sqrt(sum(ret * ret) OVER w{n})', n, 'ret')} AS vol_{n}" for n in (5, 10, 20, 60)]
    + [
        sql_gate("1 - adj_close / max(adj_close) OVER w60", 60, "adj_close") + " AS drawdown_60",
        f"{sql_rsi()} AS rsi_14",
    ]
    + [f"{sql_corr('ret', 'bench', n)} AS corr_{n}" for n in (20, 60)]
    + ["ret - bench AS spread"]
)
SUPPLIER_JOINED = (
    "supplier_joined AS (SELECT c.*, m.bench FROM supplier_curated c "
    "LEFT JOIN market m ON c.bar = m.bar)"
)
SUPPLIER_FEATURES = (
    f"supplier_features AS (\n  SELECT series, bar, {_SERIES_FEATURES}\n"
    f"  FROM ({sql_moves('supplier_joined', 'adj_close', 'series')}) s {sql_windows('series')})"
)
SUPPLIER_MASTER = (
    "supplier_master AS (SELECT *, "
    f"{sql_label('ret_1', 'series')} AS rv_5d FROM supplier_features)"
)
SUPPLIER_BASE = (SUPPLIER_BARS, SUPPLIER_CURATED)
SUPPLIER_ALL = (*SUPPLIER_BASE, MARKET, SUPPLIER_JOINED, SUPPLIER_FEATURES, SUPPLIER_MASTER)

# ---- forecasts: two naive models per supplier series --------------------------

MODELS = ("half_vol_20", "vol_5")


def scored_wide(spark: SparkSession, sf: str) -> DataFrame:
    """(series, bar, rv_5d, half_vol_20, vol_5): label and both forecasts side by side."""
    curated = tables.supplier_curated(spark, sf).select("series", "bar", "ret")
    ret = F.col("ret")
    steps = [
        lambda w: {
            "vol_5": rolling.realized_vol(ret, w, 5),
            "half_vol_20": rolling.realized_vol(ret, w, 20) * 0.5,
            **labels.label_step("ret")(w),
        }
    ]
    out = over_rows(curated, ["series"], "bar", steps, back=19, ahead=5, grain=LINE_GRAIN)
    return out.select("series", "bar", "rv_5d", "half_vol_20", "vol_5")


def unpivoted(wide: DataFrame) -> DataFrame:
    long = wide.unpivot(["series", "bar", "rv_5d"], list(MODELS), "model", "prediction")
    return long.where(F.col("prediction").isNotNull())


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts with their actuals (null while the future is unknown), from one pass."""
    return unpivoted(scored_wide(spark, sf))


def known(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts whose actual is known."""
    return scored(spark, sf).where(F.col("rv_5d").isNotNull())


def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """(series, bar, model, prediction): full frames only."""
    return scored(spark, sf).select("series", "bar", "model", "prediction")


def actuals(spark: SparkSession, sf: str) -> DataFrame:
    return scored_wide(spark, sf).select("series", "bar", "rv_5d")


SCORED_WIDE = (
    "scored_wide AS (SELECT series, bar, "
    f"{sql_label('ret', 'series')} AS rv_5d, "
    f"0.5 * {sql_gate('sqrt(sum(ret * ret) OVER w20)', 20, 'ret')} AS half_vol_20, "
    f"{sql_gate('sqrt(sum(ret * ret) OVER w5)', 5, 'ret')} AS vol_5 "
    f"FROM supplier_curated {sql_windows('series', ns=(5, 20))})"
)
SCORED = """scored AS (
  SELECT series, bar, 'half_vol_20' AS model, half_vol_20 AS prediction, rv_5d
  FROM scored_wide WHERE half_vol_20 IS NOT NULL
  UNION ALL
  SELECT series, bar, 'vol_5', vol_5, rv_5d FROM scored_wide WHERE vol_5 IS NOT NULL)"""
KNOWN = "known AS (SELECT * FROM scored WHERE rv_5d IS NOT NULL)"
SCORED_ALL = (*SUPPLIER_BASE, SCORED_WIDE, SCORED, KNOWN)

"""Rolling features and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features, labels
from tidemark.plans.common import (
    EVENT_ALL,
    EVENT_BASE,
    EVENT_FEATURES,
    EVENT_WIDE,
    GRAIN,
    LINE_GRAIN,
    SUPPLIER_ALL,
    SUPPLIER_BASE,
    SUPPLIER_FEATURES,
    SUPPLIER_JOINED,
    MARKET,
    event_features,
    event_master,
    event_wide,
    rounded,
    sql_corr,
    sql_gate,
    sql_label,
    sql_moves,
    sql_round,
    sql_rsi,
    sql_windows,
    supplier_features,
)
from tidemark.sources import tables

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


FEATURES = features.FEATURE_COLUMNS
WIDE_CTES = (*EVENT_BASE, EVENT_WIDE)
RET_COLS = tuple(f"ret_{n}" for n in features.RETURN_WINDOWS)
VOL_COLS = tuple(f"vol_{n}" for n in features.VOL_WINDOWS)


@query(sql_round("SELECT * FROM features", FEATURES, (*WIDE_CTES, EVENT_FEATURES)))
def feature_set(spark, sf):
    """Flagship: events -> hourly bars -> returns -> wide bars -> 20 features."""
    return rounded(event_features(spark, sf))


@query(
    sql_round(
        "SELECT series, bar, "
        + ", ".join(
            f"{sql_gate(f'sum(ret) OVER w{n}', n, 'ret')} AS ret_{n}" for n in (5, 10, 20, 60)
        )
        + ", ret AS ret_1 FROM supplier_curated "
        + sql_windows("series"),
        RET_COLS,
        SUPPLIER_BASE,
    )
)
def rolling_returns(spark, sf):
    out = features.rolling_returns(tables.supplier_curated(spark, sf), grain=LINE_GRAIN)
    return rounded(out.select("series", "bar", *RET_COLS))


@query(
    sql_round(
        "SELECT series, bar, "
        + ", ".join(
            f"{sql_gate(f'sqrt(sum(ret * ret) OVER w{n})', n, 'ret')} AS vol_{n}"
            for n in (5, 10, 20, 60)
        )
        + " FROM supplier_curated "
        + sql_windows("series"),
        VOL_COLS,
        SUPPLIER_BASE,
    )
)
def realized_vol(spark, sf):
    out = features.realized_vol(tables.supplier_curated(spark, sf), grain=LINE_GRAIN)
    return rounded(out.select("series", "bar", *VOL_COLS))


@query(
    sql_round(
        "SELECT series, bar, "
        + sql_gate("1 - adj_close / max(adj_close) OVER w60", 60, "adj_close")
        + " AS drawdown_60 FROM supplier_bars "
        + sql_windows("series"),
        ("drawdown_60",),
        SUPPLIER_BASE[:1],
    )
)
def drawdown(spark, sf):
    out = features.drawdown(tables.supplier_bars(spark, sf), grain=LINE_GRAIN)
    return rounded(out.select("series", "bar", "drawdown_60"))


@query(
    sql_round(
        f"SELECT series, bar, {sql_rsi()} AS rsi_14 FROM "
        f"({sql_moves('supplier_bars', 'adj_close', 'series')}) s " + sql_windows("series"),
        ("rsi_14",),
        SUPPLIER_BASE[:1],
    )
)
def rsi(spark, sf):
    out = features.rsi(tables.supplier_bars(spark, sf), grain=LINE_GRAIN)
    return rounded(out.select("series", "bar", "rsi_14"))


@query(
    sql_round(
        "SELECT bar, "
        + ", ".join(f"{sql_corr('spy_ret', 'tlt_ret', n)} AS corr_{n}" for n in (20, 60))
        + " FROM wide "
        + sql_windows(""),
        ("corr_20", "corr_60"),
        WIDE_CTES,
    )
)
def rolling_corr(spark, sf):
    out = features.rolling_corr(
        event_wide(spark, sf), "spy_ret", "tlt_ret", keys=(), grain=GRAIN
    )
    return rounded(out.select("bar", "corr_20", "corr_60"))


@query(
    sql_round(
        "SELECT bar, CASE WHEN vix <> 0 THEN vix3m / vix END AS vix_term FROM wide",
        ("vix_term",),
        WIDE_CTES,
    )
)
def term_structure(spark, sf):
    return rounded(features.term_structure(event_wide(spark, sf)).select("bar", "vix_term"))


@query(
    sql_round(
        "SELECT bar, hyg_ret - tlt_ret AS hyg_tlt_spread FROM wide", ("hyg_tlt_spread",), WIDE_CTES
    )
)
def return_spread(spark, sf):
    return rounded(features.return_spread(event_wide(spark, sf)).select("bar", "hyg_tlt_spread"))


@query(
    sql_round(
        "SELECT bar, "
        + sql_gate("sqrt(sum(spy_ret * spy_ret) OVER w20)", 20, "spy_ret")
        + " - vix AS rv_vix_spread_20d FROM wide "
        + sql_windows(""),
        ("rv_vix_spread_20d",),
        WIDE_CTES,
    )
)
def rv_iv_spread(spark, sf):
    vol = features.realized_vol(
        event_wide(spark, sf), (20,), ret="spy_ret", prefix="spy_vol_", suffix="d", keys=(),
        grain=GRAIN,
    )
    return rounded(features.implied_spread(vol).select("bar", "rv_vix_spread_20d"))


@query(
    sql_round(
        "SELECT series, bar, " + ", ".join(features.SERIES_FEATURES) + " FROM supplier_features",
        features.SERIES_FEATURES,
        (*SUPPLIER_BASE, MARKET, SUPPLIER_JOINED, SUPPLIER_FEATURES),
    )
)
def universe_features(spark, sf):
    return rounded(supplier_features(spark, sf))


@query(
    sql_round(
        f"SELECT series, bar, ret, {sql_label('ret', 'series')} AS rv_5d FROM supplier_curated",
        ("ret", "rv_5d"),
        SUPPLIER_BASE,
    )
)
def forward_rv(spark, sf):
    out = labels.forward_rv(
        tables.supplier_curated(spark, sf), ret="ret", keys=["series"], grain=LINE_GRAIN
    )
    return rounded(out.select("series", "bar", "ret", "rv_5d"))


@query(
    sql_round(
        "SELECT * EXCLUDE (rv_5d, rn) FROM (SELECT *, row_number() OVER (ORDER BY bar DESC) AS rn "
        "FROM master) m WHERE rn <= 35",
        FEATURES,
        EVENT_ALL,
    )
)
def predict_set(spark, sf):
    return rounded(labels.predict_set(event_master(spark, sf)))


@query(
    sql_round(
        "SELECT series, bar, rv_5d FROM (SELECT *, row_number() OVER "
        "(PARTITION BY series ORDER BY bar DESC) AS rn FROM supplier_master) m "
        "WHERE rn <= 35 AND rv_5d IS NOT NULL",
        ("rv_5d",),
        SUPPLIER_ALL,
    )
)
def labels_set(spark, sf):
    master = supplier_features(spark, sf, label=True)
    return rounded(labels.labels_set(master, keys=["series"]))


@query(
    sql_round(
        "SELECT symbol, first_bar, last_bar, bars, days FROM (SELECT series AS symbol, "
        "min(bar) AS first_bar, max(bar) AS last_bar, count(*) AS bars, "
        "count(DISTINCT bar) AS days FROM supplier_curated GROUP BY series) c",
        (),
        SUPPLIER_BASE,
    )
)
def coverage(spark, sf):
    from tidemark.operators.profile import coverage as cover

    curated = tables.supplier_curated(spark, sf)
    return cover(curated).withColumnRenamed("series", "symbol")

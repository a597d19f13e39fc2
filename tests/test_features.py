import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames_util import bars, days, same, span, table, walk
from tidemark.operators import bars as b
from tidemark.operators import features as f
from tidemark.operators import labels
from tidemark.operators.frames import over_rows


def rets_frame(spark, values):
    rows = [("S", t, None if v is None else float(v)) for t, v in zip(days(len(values)), values)]
    return spark.createDataFrame(rows, "series string, bar timestamp_ntz, ret double")


def test_log_returns_per_symbol_drop_the_first_bar(spark):
    df = bars(spark, {"SPY": [101, 102, 103], "VIX": [21, 22]})
    out = table(b.log_returns(df, grain="day"), "series", "bar")
    same(out["ret"], [math.log(102 / 101), math.log(103 / 102), math.log(22 / 21)])
    kept = table(b.log_returns(df, keep_first=True, grain="day"), "series", "bar")
    assert kept["ret"].isna().tolist() == [True, False, False, True, False]


def test_non_positive_prices_have_no_return(spark):
    df = bars(spark, {"S": [10, 0, 5, -1, 4, 8]})
    out = table(b.log_returns(df, keep_first=True, grain="day"), "bar")
    same(out["ret"], [None, None, None, None, None, math.log(2)])


def test_returns_do_not_depend_on_row_order(spark):
    prices = walk(40)
    df = bars(spark, {"S": prices})
    shuffled = df.orderBy(F.rand(seed=3))
    a = table(b.log_returns(df, grain="day"), "bar")
    c = table(b.log_returns(shuffled, grain="day"), "bar")
    assert a["ret"].tolist() == c["ret"].tolist()


@pytest.mark.parametrize("windows", [(1, 5, 10, 20, 60), (3, 7)])
def test_rolling_returns_have_full_frames_only(spark, windows):
    values = list(np.random.default_rng(1).normal(0, 0.01, 90))
    values[30] = None
    out = table(f.rolling_returns(rets_frame(spark, values), windows, grain="day"), "bar")
    s = pd.Series(values, dtype=float)
    for n in windows:
        same(out[f"ret_{n}"], s.rolling(n).sum())


def test_realized_vol_formula(spark):
    values = [None, 0.02, -0.01, 0.015, -0.02, 0.01, 0.005, -0.015, 0.02, -0.01]
    out = table(f.realized_vol(rets_frame(spark, values), (5,), grain="day"), "bar")
    assert pd.isna(out["vol_5"][4])
    assert out["vol_5"][5] == pytest.approx(math.sqrt(sum(v * v for v in values[1:6])))


@pytest.mark.parametrize(
    "path, last",
    [
        (list(np.linspace(100, 110, 70)), 0.0),
        ([100] * 30 + [90] * 40, 0.1),
        ([100] * 20 + [90] * 20 + [100] * 40, 0.0),
    ],
)
def test_drawdown_paths(spark, path, last):
    out = table(f.drawdown(bars(spark, {"S": path}), grain="day"), "bar")
    assert out["drawdown_60"][:59].isna().all()
    assert out["drawdown_60"].iloc[-1] == pytest.approx(last)


def pandas_rsi(prices, n=14):
    delta = pd.Series(prices, dtype=float).diff()
    up, down = delta.clip(lower=0).fillna(0.0), (-delta).clip(lower=0).fillna(0.0)
    g, l = up.rolling(n).mean(), down.rolling(n).mean()
    out = 100 - 100 / (1 + g / l)
    out[(l == 0) & (g > 0)] = 100.0
    return out


def test_rsi_paths(spark):
    paths = {
        "rise": list(range(100, 120)),
        "fall": list(range(120, 100, -1)),
        "flat": [100.0] * 20,
        "random": list(walk(100)),
        "swing": [100 * (1.01 if i % 2 else 1.0) for i in range(51)],
    }
    out = table(f.rsi(bars(spark, paths), grain="day"), "series", "bar")
    for name, prices in paths.items():
        got = out[out.series == name]["rsi_14"].tolist()
        want = pandas_rsi(prices).tolist()
        if name == "flat":
            want = [None] * 20
        same(got, want, 1e-6)
        if name not in ("flat",):
            assert pd.isna(got[12]) and not pd.isna(got[13])
    assert out[out.series == "rise"]["rsi_14"].iloc[-1] > 95
    assert out[out.series == "fall"]["rsi_14"].iloc[-1] < 5


def test_rolling_corr_constant_frames_are_null(spark):
    n = 50
    x = np.random.default_rng(5).normal(0, 0.01, n)
    rows = [
        ("S", t, float(a), float(a), float(-a), 0.01) for t, a in zip(days(n), x)
    ]
    df = spark.createDataFrame(
        rows, "series string, bar timestamp_ntz, a double, same double, opp double, c double"
    )
    for other, last in (("same", 1.0), ("opp", -1.0)):
        out = table(f.rolling_corr(df, "a", other, (20,), grain="day"), "bar")
        assert out["corr_20"][:19].isna().all()
        assert out["corr_20"].iloc[-1] == pytest.approx(last)
    assert table(f.rolling_corr(df, "a", "c", (20,), grain="day"), "bar")["corr_20"].isna().all()


def test_term_structure_and_spread(spark):
    df = spark.createDataFrame(
        [(20.0, 24.0, 0.01, 0.005), (25.0, 20.0, 0.005, 0.02), (0.0, 20.0, None, 0.02)],
        "vix double, vix3m double, hyg_ret double, tlt_ret double",
    )
    out = f.return_spread(f.term_structure(df)).collect()
    same([r.vix_term for r in out], [1.2, 0.8, None])
    same([r.hyg_tlt_spread for r in out], [0.005, -0.015, None])


def five_series(spark, n=150, gaps=()):
    base = {"SPY": (100, 2), "^VIX": (20, 0.5), "^VIX3M": (22, 0.4), "TLT": (90, 1.5), "HYG": (80, 1)}
    paths = {s: walk(n, m, sd, seed=i) for i, (s, (m, sd)) in enumerate(base.items())}
    df = bars(spark, paths)
    for series, day in gaps:
        df = df.where(~((F.col("series") == series) & (F.col("bar") == days(n)[day])))
    return paths, df


def pandas_features(wide):
    """Expected features from wide pandas columns."""
    r, p = wide["spy_ret"], wide["spy_adj_close"]
    out = pd.DataFrame({"spy_ret_1d": r})
    for n in (5, 10, 20, 60):
        out[f"spy_ret_{n}d"] = r.rolling(n).sum()
        out[f"spy_vol_{n}d"] = (r * r).rolling(n).sum().pow(0.5)
    out["drawdown_60d"] = 1 - p / p.rolling(60).max()
    out["vix"], out["vix3m"] = wide["vix"], wide["vix3m"]
    out["vix_term"] = wide["vix3m"] / wide["vix"]
    out["rsi_spy_14"] = pandas_rsi(p)
    for n in (20, 60):
        for x in ("tlt", "hyg"):
            out[f"corr_spy_{x}_{n}d"] = r.rolling(n).corr(wide[f"{x}_ret"])
    out["hyg_tlt_spread"] = wide["hyg_ret"] - wide["tlt_ret"]
    out["rv_vix_spread_20d"] = out["spy_vol_20d"] - wide["vix"]
    return out


@pytest.mark.parametrize("gaps", [(), (("SPY", 70), ("TLT", 90), ("^VIX", 40))])
def test_feature_set_equals_direct_computation(spark, gaps):
    _, df = five_series(spark, gaps=gaps)
    curated = b.log_returns(df, grain="day")
    wide = table(f.wide_bars(curated), "bar")
    got = table(f.feature_set(curated, grain="day"), "bar")
    assert got.columns.tolist() == ["bar", *f.FEATURE_COLUMNS]
    want = pandas_features(wide)
    for c in f.FEATURE_COLUMNS:
        same(got[c], want[c], 1e-7)


def test_chunked_features_equal_plain_ones(spark):
    _, df = five_series(spark, n=200, gaps=(("SPY", 70), ("HYG", 131)))
    curated = b.log_returns(df, grain="day")
    plain = table(f.feature_set(curated, grain="day"), "bar")
    for rows, slot_days in ((16, 1), (64, 8), (70, 32)):
        cut = f.feature_set(curated, rows=rows, slot=span(slot_days))
        got = table(cut, "bar")
        for c in f.FEATURE_COLUMNS:
            same(got[c], plain[c], 1e-10)


def test_universe_features_agree_with_the_wide_form_without_gaps(spark):
    _, df = five_series(spark)
    curated = b.log_returns(df, grain="day")
    bench = curated.where("series = 'TLT'").select("bar", "ret")
    uni = f.universe_features(curated, bench, grain="day").where("series = 'SPY'")
    got, wide = table(uni, "bar"), table(f.feature_set(curated, grain="day"), "bar")
    for a, c in (
        ("ret_20", "spy_ret_20d"), ("vol_60", "spy_vol_60d"), ("drawdown_60", "drawdown_60d"),
        ("rsi_14", "rsi_spy_14"), ("corr_20", "corr_spy_tlt_20d"), ("corr_60", "corr_spy_tlt_60d"),
    ):
        same(got[a], wide[c], 1e-10)


def test_missing_series_is_reported(spark):
    df = bars(spark, {"SPY": [1, 2], "TLT": [1, 2]})
    out = b.missing_series(df, ["SPY", "TLT", "HYG"]).collect()
    assert [r.series for r in out] == ["HYG"]


def test_forward_label(spark):
    values = [0.01, -0.02, 0.015, -0.01, 0.005, 0.02, -0.015, 0.01, 0.005, -0.01]
    df = rets_frame(spark, values).withColumnRenamed("ret", "spy_ret_1d")
    out = table(labels.forward_rv(df, grain="day"), "bar")
    assert out["rv_5d"][0] == pytest.approx(math.sqrt(sum(v * v for v in values[1:6])))
    assert out["rv_5d"].isna().tolist() == [False] * 5 + [True] * 5
    shuffled = table(labels.forward_rv(df.orderBy(F.rand(1)), grain="day"), "bar")
    assert shuffled["rv_5d"].equals(out["rv_5d"])


def test_forward_label_null_in_frame_and_zero_returns(spark):
    values = [0.0] * 8 + [None] + [0.0] * 8
    df = rets_frame(spark, values)
    out = table(labels.forward_rv(df, ret="ret", grain="day"), "bar")["rv_5d"]
    want = [0.0] * 3 + [None] * 5 + [0.0] * 4 + [None] * 5
    same(out, want)


@pytest.mark.parametrize("rows, slot_days", [(8, 1), (8, 3), (10, 5), (100, 7)])
def test_chunked_label_looks_ahead_across_chunks(spark, rows, slot_days):
    values = list(np.random.default_rng(2).normal(0, 0.01, 90))
    df = rets_frame(spark, values)
    plain = table(labels.forward_rv(df, ret="ret", grain="day"), "bar")
    cut = labels.forward_rv(df, ret="ret", keys=["series"], rows=rows, slot=span(slot_days))
    got = table(cut, "bar")
    same(got["rv_5d"], plain["rv_5d"], 0)


def test_predict_and_label_sets(spark):
    values = list(np.random.default_rng(2).normal(0, 0.01, 60))
    master = labels.forward_rv(rets_frame(spark, values), ret="ret", grain="day")
    predict = table(labels.predict_set(master, keys=["series"]), "bar")
    assert len(predict) == 35 and "rv_5d" not in predict.columns
    assert predict["bar"].iloc[-1] == days(60)[-1]
    assert labels.labels_set(master, keys=["series"]).count() == 30


def test_over_rows_without_keys_matches_pandas(spark):
    x = walk(500, seed=9)
    df = bars(spark, {"S": x}).select("bar", "adj_close")
    step = lambda w: {"m": F.max("adj_close").over(w.rowsBetween(-9, 0))}
    out = table(over_rows(df, [], "bar", [step], back=9, rows=32, slot=span(4)), "bar")
    assert len(out) == 500
    same(out["m"], pd.Series(x).rolling(10, min_periods=1).max(), 0)

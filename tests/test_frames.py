import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames_util import bars, days, same, span, table, walk
from tidemark.operators import bars as b
from tidemark.operators import profile
from tidemark.operators.frames import (
    CHUNK,
    HOME,
    attach_group_value,
    even_slots,
    halo_chunks,
    last_rows,
    number_rows,
    running_sum,
)


def uneven(spark):
    """One long series with clumps and holes, one short one."""
    rng = np.random.default_rng(11)
    at = np.sort(rng.choice(900, 300, replace=False))
    times = days(900)
    rows = [("long", times[i], float(i)) for i in at] + [("short", times[i], float(i)) for i in (3, 50)]
    return spark.createDataFrame(rows, "series string, bar timestamp_ntz, x double")


@pytest.mark.parametrize("slot_days", [1, 7, 40, 400])
def test_two_pass_row_numbers_are_exact(spark, slot_days):
    df = uneven(spark)
    got = table(number_rows(df, ["series"], "bar", slot=span(slot_days)), "series", "bar")
    want = table(number_rows(df, ["series"], "bar", grain="day"), "series", "bar")
    assert got["position"].tolist() == want["position"].tolist()
    assert got["total"].tolist() == want["total"].tolist()
    assert got[got.series == "long"]["position"].tolist() == list(range(1, 301))


@pytest.mark.parametrize("slot_days", [1, 30])
def test_running_sum_from_slot_totals(spark, slot_days):
    df = uneven(spark).withColumn("x", F.when(F.col("x") % 7 != 0, F.col("x")))
    args = (["series"], "bar", F.col("x"), "total")
    got = table(running_sum(df, *args, slot=span(slot_days)), "series", "bar")
    want = table(running_sum(df, *args, grain="day"), "series", "bar")
    same(got["total"], want["total"])


@pytest.mark.parametrize("back, ahead", [(0, 0), (1, 0), (9, 5), (45, 0), (0, 60)])
@pytest.mark.parametrize("rows, slot_days", [(16, 1), (20, 30), (50, 7)])
def test_every_row_has_one_home_and_its_whole_reach(spark, back, ahead, rows, slot_days):
    df = uneven(spark)
    out = halo_chunks(df, ["series"], "bar", back, ahead, rows=rows, slot=span(slot_days))
    got = table(out.where("series = 'long'"), CHUNK, "bar")
    homes = got[got[CHUNK] == got[HOME]]
    assert len(homes) == 300 and homes["bar"].is_unique
    order = {t: i for i, t in enumerate(sorted(homes["bar"]))}
    for chunk, part in got.groupby(CHUNK):
        have = sorted(order[t] for t in part["bar"])
        own = [order[t] for t in part[part[HOME] == chunk]["bar"]]
        assert have == list(range(have[0], have[-1] + 1))
        if own:
            assert have[0] <= max(0, min(own) - back) and have[-1] >= min(299, max(own) + ahead)
    short = out.where("series = 'short'").select(CHUNK).distinct().collect()
    assert [r[0] for r in short] == [0]


def test_cumulative_return_both_forms(spark):
    r = [0.01, None, -0.02, 0.03]
    rows = [("S", t, v) for t, v in zip(days(4), r)]
    df = spark.createDataFrame(rows, "series string, bar timestamp_ntz, ret double")
    log = table(profile.cumulative_return(df, grain="day"), "bar")["growth"]
    same(log, [np.exp(0.01), None, np.exp(-0.01), np.exp(0.02)])
    simple = table(profile.cumulative_return(df, simple=True, grain="day"), "bar")["growth"]
    same(simple, [1.01, None, 1.01 * 0.98, 1.01 * 0.98 * 1.03])


def test_last_rows_and_group_values(spark):
    df = uneven(spark)
    tail = table(last_rows(df, ["series"], "bar", 3), "series", "bar")
    assert tail["recency"].tolist() == [3, 2, 1, 2, 1]
    tops = df.groupBy("series").agg(F.max("x").alias("top"))
    joined = attach_group_value(df, tops, ["series"], "bar", salts=5)
    assert joined.count() == df.count()
    assert joined.select("series", "top").distinct().count() == 2


def test_tail_filter_runs_before_the_shuffle(spark):
    plan = last_rows(uneven(spark), ["series"], "bar", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_dedupe_keeps_the_latest_copy(spark):
    rows = [("a", 1, 1, 10.0), ("a", 1, 3, 30.0), ("a", 1, 2, 20.0), ("b", 1, 1, None)]
    df = spark.createDataFrame(rows, "k string, d int, seq int, v double")
    out = table(b.dedupe_last(df, ["k", "d"], ["seq"]), "k")
    assert out["seq"].tolist() == [3, 1] and out["v"][0] == 30.0 and pd.isna(out["v"][1])
    assert out.columns.tolist() == ["k", "d", "seq", "v"]


def test_normaliser_flattens_headers_and_falls_back_to_close(spark):
    names = ["Date", "('Open', 'SPY')", "('High', 'SPY')", "('Low', 'SPY')", "('Close', 'SPY')", "Volume"]
    df = spark.createDataFrame([("2024-01-02 15:00:00", 1.0, 3.0, 0.5, 2.0, 7)], names)
    row = b.normalise_bars(df.withColumn("Date", F.to_timestamp("Date")), "SPY").first()
    assert (row.symbol, str(row.date), row.adj_close, row.close) == ("SPY", "2024-01-02", 2.0, 2.0)
    raw = b.raw_bars(b.normalise_bars(df, "SPY"))
    assert dict(raw.dtypes)["volume"] == "double" and "adj_close" not in raw.columns
    with pytest.raises(ValueError, match="volume"):
        b.normalise_bars(df.drop("Volume"), "SPY")
    adjusted = df.withColumn("Adj Close", F.lit(1.5))
    assert b.normalise_bars(adjusted, "SPY").first().adj_close == 1.5


def test_bars_from_ticks(spark):
    t = days(1)[0]
    rows = [("a", t + datetime.timedelta(minutes=m), float(v)) for m, v in ((5, 3), (1, 9), (59, 4), (61, 7))]
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, v double")
    out = table(b.ohlcv_bars(df, series="s", ts="ts", value="v", every="hour"), "bar")
    assert out[["open", "high", "low", "close", "volume"]].values.tolist() == [
        [9, 9, 3, 4, 3],
        [7, 7, 7, 7, 1],
    ]


def test_quantiles_are_exact_with_hot_values_and_small_groups(spark):
    rng = np.random.default_rng(4)
    big = np.concatenate([rng.normal(0, 1, 20000), np.full(10000, 0.25)])
    rows = [("big", float(v)) for v in big] + [("one", 5.0), ("two", 1.0), ("two", 2.0), ("two", None)]
    df = spark.createDataFrame(rows, "g string, value double").repartition(8)
    probs = [0.0, 0.01, 0.25, 0.5, 0.6, 0.75, 0.999, 1.0]
    out = {r.g: r.quantiles for r in profile.exact_quantiles(df, probs, ["g"]).collect()}
    same(out["big"], np.quantile(big, probs), 1e-12)
    same(out["one"], [5.0] * len(probs))
    same(out["two"], np.quantile([1.0, 2.0], probs))


def test_profile_of_columns(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200), "c": 1.0})
    pdf.loc[:19, "b"] = np.nan
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.values]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = table(profile.column_profile(df, ["a", "b", "c"]), "column").set_index("column")
    want = pdf.describe().T
    for c in ("count", "mean", "std", "min", "max"):
        same(got[c], want[c], 1e-9)
    for q, p in (("q25", "25%"), ("q50", "50%"), ("q75", "75%")):
        same(got[q], want[p], 1e-9)
    miss = {r.column: (r.missing, r.missing_pct) for r in profile.missing_report(df, ["a", "b"]).collect()}
    assert miss == {"a": (0, 0.0), "b": (20, 10.0)}
    corr = {(r.a, r.b): r["corr"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(corr) == 9
    same([corr["a", "b"], corr["b", "a"]], [pdf["a"].corr(pdf["b"])] * 2)
    assert corr["a", "c"] is None and corr["c", "c"] is None and corr["a", "a"] == 1.0
    keyed = df.withColumn("series", F.lit("s"))
    m = profile.return_moments(keyed, value="a").first()
    same([m.skewness, m.kurtosis], [pdf["a"].skew(), pdf["a"].kurt()], 1e-9)
    flat = profile.return_moments(keyed, value="c").first()
    assert flat.skewness is None and flat.kurtosis is None


def test_histogram_covers_all_rows_and_constant_groups(spark):
    rows = [("a", float(v)) for v in walk(500)] + [("flat", 1.0)] * 5
    df = spark.createDataFrame(rows, "series string, ret double")
    out = table(profile.return_histogram(df, 10), "series", "bin")
    a = out[out.series == "a"]
    counts, edges = np.histogram(walk(500), 10)
    got = dict(zip(a["bin"], a["n"]))
    assert [got.get(i + 1, 0) for i in range(10)] == counts.tolist()
    same([a["low"].iloc[0], a["high"].iloc[-1]], [edges[0], edges[-1]])
    assert out[out.series == "flat"][["bin", "n"]].values.tolist() == [[1, 5]]


def test_warmup_check(spark):
    rows = [("S", t, None if i < 3 else (None if i == 6 else 1.0), 1.0) for i, t in enumerate(days(10))]
    df = spark.createDataFrame(rows, "series string, bar timestamp_ntz, a double, b double")
    out = {
        r.feature: (r.first_valid, r.nulls, r.nulls_after_first)
        for r in profile.warmup_check(df, ["a", "b"], keys=["series"], slot=span(2)).collect()
    }
    assert out == {"a": (4, 4, 1), "b": (1, 0, 0)}


def test_degenerate_values_in_quantiles(spark):
    rows = [("same", 1.0)] * 50 + [("big", float(v) * 1e300) for v in range(-5, 6)]
    df = spark.createDataFrame(rows, "g string, value double")
    out = {r.g: r.quantiles for r in profile.exact_quantiles(df, [0.1, 0.5], ["g"]).collect()}
    same(out["same"], [1.0, 1.0])
    same(out["big"], np.quantile(np.arange(-5, 6) * 1e300, [0.1, 0.5]))


def test_chunks_have_a_bounded_size_under_a_hot_series(spark):
    hot = spark.range(20000).selectExpr("'hot' AS series", "id")
    cold = spark.range(10000).selectExpr("concat('s', id % 100) AS series", "id")
    df = hot.unionByName(cold).selectExpr(
        "series", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS bar", "id"
    )
    out = halo_chunks(df, ["series"], "bar", 59, 5, rows=1000)
    sizes = out.groupBy("series", CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 1000 + 3 * 100 + 64
    assert out.where(F.col(CHUNK) == F.col(HOME)).count() == 30000
    assert sizes.where("series = 'hot'").count() >= 20
    numbered = number_rows(df, ["series"], "bar").where("series = 'hot'")
    assert numbered.where("position <> id + 1 OR total <> 20000").count() == 0


def burst(spark):
    """90 % of a series' rows in one minute of two years, many within one millisecond; a second series without a burst."""
    rng = np.random.default_rng(8)
    minute, year = 60_000_000, 365 * 86_400_000_000
    micros = np.concatenate([
        rng.choice(2 * year, 1500, replace=False),
        year + rng.choice(minute, 9000, replace=False),
        year + 7_000_000 + rng.choice(1000, 500, replace=False),
    ])
    micros = np.unique(micros)
    rows = pd.DataFrame({"series": "hot", "us": micros, "x": np.arange(len(micros)) % 17.0})
    calm = pd.DataFrame({"series": "calm", "us": np.arange(300) * (year // 200), "x": 1.0})
    df = spark.createDataFrame(pd.concat([rows, calm]).sample(frac=1, random_state=1))
    start = F.lit("2023-01-01").cast("timestamp_ntz")
    return df.select("series", (start + F.expr("make_dt_interval(0, 0, 0, us / 1000000.0D)")).alias("bar"), "x"), len(micros)


def test_a_burst_makes_more_slots_and_not_longer_chunks(spark):
    df, n = burst(spark)
    tagged, counts = even_slots(df, ["series"], "bar", 50)
    assert counts.agg(F.max("_n")).first()[0] <= 50
    assert tagged.groupBy("series", "_slot").count().join(counts, ["series", "_slot"]).where("count <> _n").count() == 0
    assert counts.agg(F.sum("_n")).first()[0] == n + 300
    for keys in (["series"], []):
        one = df if keys else df.where("series = 'hot'")
        out = halo_chunks(one, keys, "bar", 19, 5, rows=800)
        sizes = out.where("_chunk = _home").groupBy(*keys, CHUNK).count()
        assert sizes.agg(F.max("count")).first()[0] <= 1600
        assert out.where("_chunk = _home").count() == (n + 300 if keys else n)


@pytest.mark.parametrize("keys", [["series"], []])
def test_numbers_and_totals_of_a_burst_equal_the_plain_ones(spark, monkeypatch, keys):
    from tidemark.operators import frames

    monkeypatch.setattr(frames, "ROWS_PER_CHUNK", 640)
    df, _ = burst(spark)
    df = df if keys else df.where("series = 'hot'")
    plain = table(number_rows(running_sum(df, keys, "bar", F.col("x"), "run", grain="hour"), keys, "bar", grain="hour"), "series", "bar")
    got = table(number_rows(running_sum(df, keys, "bar", F.col("x"), "run"), keys, "bar"), "series", "bar")
    assert got["position"].tolist() == plain["position"].tolist() and got["total"].tolist() == plain["total"].tolist()
    same(got["run"], plain["run"])


def test_rows_at_one_microsecond_and_empty_tables_end_the_cutting(spark):
    same_time = spark.range(500).selectExpr("'s' AS series", "timestamp_ntz'2024-01-01' AS bar", "id")
    assert [r._n for r in even_slots(same_time, ["series"], "bar", 10)[1].collect()] == [500]
    assert number_rows(same_time, ["series"], "bar").agg(F.max("position")).first()[0] == 500
    assert number_rows(same_time.limit(0), ["series"], "bar").count() == 0
    assert halo_chunks(same_time.limit(0), [], "bar", 3).count() == 0


def test_quantiles_of_a_large_group_deal_few_values(spark, monkeypatch):
    rng = np.random.default_rng(8)
    big = np.concatenate([rng.normal(0, 1, 90_000), np.full(30_000, 0.25)])
    pdf = pd.DataFrame({"g": ["big"] * len(big) + ["two"] * 2, "value": np.append(big, [1.0, 2.0])})
    df, probs, written, keep = spark.createDataFrame(pdf).repartition(8), [0.0, 0.1, 0.25, 0.5, 0.6, 1.0], [], profile.stored

    def watched(frame, name):
        out = keep(frame, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(profile, "stored", watched)
    out = {r.g: r.quantiles for r in profile.exact_quantiles(df, probs, ["g"]).collect()}
    same(out["big"], np.quantile(big, probs), 1e-12)
    same(out["two"], np.quantile([1.0, 2.0], probs))
    assert max(written) < 1_000  # not every value


def test_quantiles_that_a_sketch_misses_are_ranked_whole(spark, monkeypatch):
    values = np.random.default_rng(9).normal(0, 1, 2_000)
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, value double")
    monkeypatch.setattr(profile, "FEW", 10)
    monkeypatch.setattr(profile.F, "percentile_approx", lambda c, cuts, n: profile.F.array(*[profile.F.lit(9.0)] * len(cuts)))
    out = profile.exact_quantiles(df, [0.25, 0.5], ["g"]).first()
    same(out.quantiles, np.quantile(values, [0.25, 0.5]), 1e-12)

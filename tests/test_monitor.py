"""Evaluation, monitoring, ensembles and models against direct computation."""

import datetime
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames_util import days, same, span, table
from tidemark.functions import scalars
from tidemark.operators import baselines, ensemble, models, monitor, profile, split

SCHEMA = "series string, model string, bar timestamp_ntz, prediction double, rv_5d double"


def scored_frame(spark, y, p, series="s", model="m"):
    rows = [
        (series, model, t, float(b), None if a is None else float(a))
        for t, a, b in zip(days(len(y)), y, p)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def direct(y, p):
    y, p = np.asarray(y, float), np.asarray(p, float)
    e, rel = p - y, np.abs((p - y) / y)
    return {
        "rmse": np.sqrt(np.mean(e**2)),
        "mae": np.mean(np.abs(e)),
        "r2": 1 - np.sum(e**2) / np.sum((y - y.mean()) ** 2),
        "mape": rel.mean() * 100,
        "hit_rate": np.mean(rel <= 0.2),
    }


def series(n=80, seed=1):
    rng = np.random.default_rng(seed)
    y = np.abs(rng.normal(0.02, 0.005, n)) + 0.001
    return y, y * (1 + rng.normal(0, 0.25, n))


def test_overall_recent_and_rolling_metrics(spark):
    y, p = series()
    df = scored_frame(spark, [*y, None, None], [*p, 0.01, 0.02])
    got = monitor.forecast_metrics(df).first().asDict()
    assert got["n"] == 80 and got["zero_actuals"] == 0
    for k, v in direct(y, p).items():
        same([got[k]], [v])
    recent = monitor.recent_metrics(df).first().asDict()
    for k, v in direct(y[-30:], p[-30:]).items():
        same([recent[k]], [v])
    few = monitor.recent_metrics(scored_frame(spark, y[:7], p[:7])).first()
    assert few.n == 7
    for options in ({"grain": "day"}, {"rows": 40, "slot": span(3)}):
        roll = table(monitor.rolling_metrics(df, **options), "end_bar")
        assert len(roll) == 51 and (roll["window_size"] == 30).all()
        for i in (0, 20, 50):
            for k, v in direct(y[i : i + 30], p[i : i + 30]).items():
                same([roll[k][i]], [v])
    assert monitor.rolling_metrics(scored_frame(spark, y[:29], p[:29]), grain="day").count() == 0


def test_zero_actuals_are_left_out_of_relative_errors(spark):
    got = monitor.forecast_metrics(scored_frame(spark, [0.0, 0.02], [0.01, 0.02])).first()
    assert (got.mape, got.hit_rate, got.zero_actuals) == (0.0, 1.0, 1)
    flat = monitor.regression_metrics(scored_frame(spark, [0.02, 0.02], [0.01, 0.02])).first()
    assert flat.r2 is None


@pytest.mark.parametrize(
    "values, trend, pct",
    [
        ([1.0] * 9, "UNKNOWN", 0.0),
        ([1.0] * 5 + [1.2] * 5, "INCREASING", 20.0),
        ([1.0] * 5 + [0.8] * 5, "DECREASING", -20.0),
        ([9.0] * 3 + [1.0] * 5 + [1.05] * 5, "STABLE", 5.0),
        ([0.0] * 5 + [1.0] * 5, "STABLE", 0.0),
    ],
)
def test_trend(spark, values, trend, pct):
    got = monitor.trend(scored_frame(spark, values, values)).first()
    assert got.trend == trend and got.trend_change_pct == pytest.approx(pct)


def test_regimes_and_statuses(spark):
    df = spark.createDataFrame([(v,) for v in (0.0149, 0.015, 0.03, 0.05)], "v double")
    assert [r[0] for r in df.select(scalars.regime(F.col("v"))).collect()] == [
        "LOW", "NORMAL", "ELEVATED", "HIGH",
    ]
    df = spark.createDataFrame([(v,) for v in (6.33, -9.9, 10.0, -29.0, 30.0, -60.0)], "v double")
    assert [r[0] for r in df.select(scalars.benchmark_status(F.col("v"))).collect()] == [
        "GOOD", "GOOD", "ACCEPTABLE", "ACCEPTABLE", "DEGRADED", "DEGRADED",
    ]


def test_texts(spark):
    df = spark.createDataFrame([(0.0155665, 6.3346)], "v double, d double")
    row = df.select(
        scalars.percent_text(F.col("v")).alias("a"),
        scalars.signed_percent_text(F.col("d")).alias("b"),
        scalars.partition_value(F.lit("x/date=2024-01-02/f")).alias("c"),
    ).first()
    assert tuple(row) == ("1.56 percent", "+6.3 percent", "2024-01-02")


def benchmark(spark, rmse, series="s", model="m"):
    return spark.createDataFrame([(series, model, rmse)], "series string, model string, test_rmse double")


def test_percentile_current_record_and_insights(spark):
    y = [0.02] * 20 + [0.06] * 10
    p = [0.02] * 25 + [0.06] * 10
    df = scored_frame(spark, [*y, *[None] * 5], p)
    row = monitor.current_forecast(df).first()
    assert (row.regime, row.trend, row.volatility_pct) == ("HIGH", "STABLE", "6.00 percent")
    assert row.percentile == pytest.approx(100 * 20 / 30)
    comparison = monitor.benchmark_comparison(
        monitor.regression_metrics(df), benchmark(spark, 0.01)
    )
    notes = {(n.type, n.severity) for n in monitor.insights(monitor.current_forecast(df), comparison).collect()}
    assert notes == {("REGIME", "ALERT"), ("RMSE", "ALERT")}
    text = [n.message for n in monitor.insights(monitor.current_forecast(df), comparison).collect() if n.type == "RMSE"]
    assert text[0].startswith("RMSE degraded: benchmark=0.010000 production=0.016330 (+63.3%)")


def test_documents(spark):
    y, p = series(30)
    df = scored_frame(spark, [*[0.05] * 10, *y, *[None] * 5], [*[0.05] * 10, *p, *[0.02] * 5])
    doc = monitor.monitor_documents(df, benchmark(spark, 0.005)).first()
    d = json.loads(doc.monitor)
    meta = {k: v for k, v in d["metadata"].items() if k != "generated_at"}
    assert meta == {
        "total_predictions": 45, "predictions_with_actuals": 40, "predictions_without_actuals": 5,
    }
    for name, want in (("overall", direct([0.05] * 10 + list(y), [0.05] * 10 + list(p))), ("recent_30d", direct(y, p))):
        for k, v in want.items():
            same([d["performance"][name][k]], [v])
    assert len(d["performance"]["rolling_30d"]) == 1 and len(d["latest_predictions"]) == 5
    assert [e["date"] for e in d["predictions_vs_actuals"]][0] == str(days(40)[10])[:10]
    assert json.loads(doc.alerts)["benchmark_comparison"]["test_rmse"] == 0.005
    assert "rolling_30d" not in json.loads(doc.summary)["performance"]


def test_run_comparison_and_alerts(spark):
    rows = [("e", "r1", {"a": 9.0}), ("e", "r2", {"a": 2.0, "b": 0.0, "c": 1.0}), ("e", "r3", {"a": 3.0, "b": 1.0}), ("x", "r1", {"a": 1.0})]
    runs = spark.createDataFrame(rows, "experiment string, run_id string, metrics map<string,double>")
    out = {r.metric: (r.previous, r.latest, r["diff"], r.pct_change) for r in monitor.compare_runs(runs).collect()}
    assert out == {"a": (2.0, 3.0, 1.0, 50.0), "b": (0.0, 1.0, 1.0, 0.0)}
    metrics = spark.createDataFrame(
        [("s", "m", 0.0096, 0.41, None)], "series string, model string, val_rmse double, val_r2 double, gap_pct double"
    )
    limits = monitor.ALERT_LIMITS[:3]
    assert [r.metric for r in monitor.threshold_alerts(metrics, limits).collect()] == ["val_rmse"]
    with pytest.raises(ValueError, match="drift_rmse"):
        monitor.threshold_alerts(metrics)


def wide_frame(spark, n=200, seed=3):
    rng = np.random.default_rng(seed)
    y = np.abs(rng.normal(0.02, 0.005, n))
    a, b = y + rng.normal(0, 0.004, n), 0.8 * y + rng.normal(0, 0.006, n)
    rows = [("s", t, float(i), float(j), float(k)) for t, i, j, k in zip(days(n), y, a, b)]
    return y, a, b, spark.createDataFrame(rows, "series string, bar timestamp_ntz, rv_5d double, a double, b double")


def test_blend_grid_equals_direct_search(spark):
    y, a, b, df = wide_frame(spark)
    grid = table(ensemble.blend_search(df, "a", "b"), "weight")
    weights = np.linspace(0, 1, 21)
    want = [np.sqrt(np.mean((y - w * a - (1 - w) * b) ** 2)) for w in weights]
    same(grid["weight"], weights)
    same(grid["rmse"], want, 1e-10)
    best = ensemble.best_blend(ensemble.blend_search(df, "a", "b")).first()
    assert best.weight == pytest.approx(weights[int(np.argmin(want))])


def test_stacking_is_ridge(spark):
    y, a, b, df = wide_frame(spark)
    x = np.column_stack([a, b])
    for alpha, row in zip(
        (0.001, 0.1), table(ensemble.stacking_weights(df, "a", "b", alphas=(0.001, 0.1)), "alpha").itertuples()
    ):
        xc, yc = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)
        inter = y.mean() - x.mean(0) @ w
        rmse = np.sqrt(np.mean((y - x @ w - inter) ** 2))
        same([row.weight_a, row.weight_b, row.intercept, row.rmse], [*w, inter, rmse], 1e-9)
        same([row.share_a], [w[0] / w.sum()], 1e-9)
    one = ensemble.stacking_weights(df, "a", "b")
    out = table(ensemble.apply_stack(df, one, "a", "b"), "bar")
    r = one.first()
    same(out["stacked"], r.intercept + r.weight_a * a + r.weight_b * b, 1e-12)


def test_windows_win_rate_and_drift(spark):
    y, a, b, df = wide_frame(spark)
    out = table(ensemble.ab_windows(df, "a", "b"), "window").set_index("window")
    rm = lambda p, n: np.sqrt(np.mean((p[-n:] - y[-n:]) ** 2))
    for name, n in (("full", 200), ("last_30", 30), ("last_10", 10), ("last_1", 1)):
        same([out.rmse_a[name], out.rmse_b[name]], [rm(a, n), rm(b, n)])
        assert out.samples[name] == n
        assert out.winner[name] == ("B" if rm(b, n) < rm(a, n) else "A")
    rate = {r.winner: r.win_rate for r in ensemble.win_rate(ensemble.ab_windows(df, "a", "b")).collect()}
    assert sum(rate.values()) == 100
    facts = lambda full, last, wins: spark.createDataFrame(
        [("s", w, full if w == "full" else last, "B" if i < wins else "A") for i, w in enumerate(("full", "last_30", "last_10", "last_1"))],
        "series string, window string, rmse_a double, winner string",
    )
    cases = [((1.0, 1.3, 4), "RETRAIN", "B (with caution)"), ((1.0, 1.15, 1), "PLAN_RETRAIN", "A"), ((1.0, 1.05, 3), "OK", "B")]
    for args, rec, model in cases:
        row = ensemble.drift_decision(facts(*args)).first()
        assert (row.recommendation, row.selected_model) == (rec, model)


def test_selection_rules(spark):
    schema = "series string, model string, val_rmse double, val_r2 double, test_rmse double"
    pick = lambda a, b: ensemble.select_model(
        spark.createDataFrame([("s", "a", *a, None), ("s", "b", *b, None)], schema), "a", "b"
    ).first().selected
    assert pick((1.0, 0.1), (1.004, 0.2)) == "b"
    assert pick((1.0, 0.3), (1.004, 0.2)) == "a"
    assert pick((1.0, 0.1), (1.01, 0.9)) == "a"
    assert pick((1.02, 0.9), (1.01, 0.1)) == "b"
    rows = [("s", "x", 1.0, 0.1, None), ("s", "y", 1.0, 0.1, 3.0), ("s", "z", 0.9, 0.1, 9.0)]
    top = table(ensemble.top_models(spark.createDataFrame(rows, schema)), "place")
    assert top["model"].tolist() == ["z", "y"]
    entry = lambda *v: spark.createDataFrame(
        [("s", *v)], "series string, val_i double, test_i double, val_k double, test_k double, val_l double, test_l double"
    )
    win = lambda *v: ensemble.best_overall(entry(*v), ["i", "k", "l"]).first().winner
    assert win(1.0, 5.0, 0.9, 9.0, 0.95, 1.0) == "k"
    assert win(1.0, 5.0, 1.000001, 4.0, 1.1, 1.0) == "k"
    assert win(1.0, 5.0, 1.000001, 6.0, 1.1, 1.0) == "i"
    assert win(1.0, None, 1.000001, 6.0, 0.5, None) == "l"


def test_alignment_report(spark):
    a = scored_frame(spark, [1.0, 2.0, 3.0], [0.0] * 3)
    b = scored_frame(spark, [1.0, 2.1], [0.0] * 2)
    out = table(ensemble.aligned_predictions(a, b, ["series", "bar"]), "bar")
    assert out["status"].tolist() == ["aligned", "label_mismatch", "only_a"]
    assert [r.status for r in ensemble.aligned_predictions(b, a, ["series", "bar"]).orderBy("bar").collect()][-1] == "only_b"


def test_feature_lists(spark):
    rows = [(m, f"f{i}", float(v)) for m, vs in {"l": [5, -9, 1], "t": [1, 7, 6], "u": [0, 1, 8]}.items() for i, v in enumerate(vs)]
    imp = spark.createDataFrame(rows, "model string, feature string, importance double")
    top = ensemble.top_features(imp, 2)
    assert [(r.model, r.feature) for r in top.orderBy("model", "place").collect()] == [
        ("l", "f1"), ("l", "f0"), ("t", "f1"), ("t", "f2"), ("u", "f2"), ("u", "f1"),
    ]
    consensus = {r.feature: (r.models, r.universal) for r in ensemble.feature_consensus(top).collect()}
    assert consensus == {"f1": (3, True), "f0": (1, False), "f2": (2, False)}
    shared = {(r.model_a, r.model_b): r.shared for r in ensemble.feature_overlap(top).collect()}
    assert shared["l", "l"] == 2 and shared["l", "t"] == 1 and shared["t", "u"] == 2
    assert [r.feature for r in ensemble.feature_intersection(top, ["l", "t"]).collect()] == ["f1"]


def test_gaps(spark):
    rows = [("s", "a", 1.0, 1.08), ("s", "b", 1.0, 1.3)]
    df = spark.createDataFrame(rows, "series string, model string, train_rmse double, val_rmse double")
    out = table(ensemble.generalization_gap(df, "b"), "model")
    same(out["gap_over_train"], [8.0, 30.0])
    same(out["gap_over_val"], [-8 / 1.08, -30 / 1.3])
    assert out["gap_class"].tolist() == ["slight", "overfit"]
    assert out["ratio_class"].tolist() == ["good", "overfit"]
    same(out["improvement_pct"], [(1.3 - 1.08) / 1.3 * 100, 0.0])


def test_residual_tables(spark):
    y, p = series(200)
    df = scored_frame(spark, y, p)
    e = y - p
    stats = profile.residual_stats(df, ["series", "model"]).first()
    same([stats.mean, stats.std, stats.min, stats.max, stats.median], [e.mean(), e.std(), e.min(), e.max(), np.median(e)])
    qq = table(profile.residual_quantiles(df, ["model"], 9), "prob")
    same(qq["residual"], np.quantile(e, np.arange(1, 10) / 10))
    assert qq["normal"][4] == pytest.approx(0.0)
    shape = profile.residual_shape(df, ["model"]).first()
    z = (e - e.mean()) / e.std()
    same([shape.skewness, shape.kurtosis], [np.mean(z**3), np.mean(z**4) - 3], 1e-8)


@pytest.mark.parametrize("patience, stop, rmse", [(1, 2, 0.8), (2, 4, 0.7), (3, 4, 0.7), (4, 8, 0.6)])
def test_early_stopping(spark, patience, stop, rmse):
    curve = [1.0, 0.8, 0.9, 0.7, 0.75, 0.7, 0.72, 0.6, 0.65]
    df = spark.createDataFrame([(i + 1, v) for i, v in enumerate(curve)], "iteration int, rmse double")
    row = models.early_stopping(df, patience).first()
    assert (row.stopped_at, row.val_rmse) == (stop, rmse)


def regression_frame(spark, n=300, seed=7):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.1] + [0, 3, 1]
    y = x @ [0.5, -0.2, 2.0] + rng.normal(0, 0.3, n)
    rows = [(t, *map(float, r), float(v)) for t, r, v in zip(days(n), x, y)]
    return x, y, spark.createDataFrame(rows, "bar timestamp_ntz, a double, b double, c double, rv_5d double")


def test_ridge_and_lasso_match_their_definitions(spark):
    x, y, df = regression_frame(spark)
    rows = split.walk_forward_split(df, 0.8, grain="day")
    data = models.scaled_split(rows, ["a", "b", "c"])
    train = data.where("split = 'train'")
    n, std = models.label_facts(train)
    xt, yt = x[:240], y[:240]
    z = (xt - xt.mean(0)) / xt.std(0)
    yc = yt - yt.mean()
    for alpha in (1.0, 100.0):
        w = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ yc)
        fitted = models.ridge(alpha, n, std).fit(train)
        same(fitted.coefficients.toArray(), w, 1e-7)
        same([fitted.intercept], [yt.mean()], 1e-7)
    alpha = 0.1
    w = np.zeros(3)
    for _ in range(2000):
        for j in range(3):
            rho = z[:, j] @ (yc - z @ w + z[:, j] * w[j]) / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0)
    same(models.lasso(alpha).fit(train).coefficients.toArray(), w, 1e-4)
    ols = models.har_rv(df, ["a", "b", "c"])
    full = np.linalg.lstsq(np.column_stack([x, np.ones(300)]), y, rcond=None)[0]
    same([*ols.coefficients.toArray(), ols.intercept], full, 1e-7)


def descent(z, y, l1, l2, rounds=3000):
    w, yc = np.zeros(z.shape[1]), y - y.mean()
    for _ in range(rounds):
        for j in range(z.shape[1]):
            rho = z[:, j] @ (yc - z @ w + z[:, j] * w[j]) / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (z[:, j] @ z[:, j] / len(y) + l2)
    return w


def test_elastic_net_equals_coordinate_descent(spark):
    """The solver divides the label by its deviation; both parts of the penalty must survive that."""
    x, y, df = regression_frame(spark, 300)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    rows = models.scaled_split(df.withColumn("split", F.lit("train")), ["a", "b", "c"])
    for alpha, ratio in ((0.001, 0.1), (0.0005, 0.5), (0.0002, 0.9)):
        want = descent(z, y, alpha * ratio, alpha * (1 - ratio))
        got = models.elastic_net(alpha, ratio, float(y.std())).fit(rows).coefficients.toArray()
        same(got, want, 1e-4)
        exact, _ = models.penalised_weights(models.as_moment(models.moments(df, ["a", "b", "c"]).first()), "elastic", alpha, ratio)
        same(exact * x.std(axis=0), want, 1e-8)


def test_penalties_follow_each_fold(spark):
    """Ridge on every fold by its own rows: moments, the learner and the definition agree."""
    x, y, df = regression_frame(spark, 120)
    folded = split.ts_folds(df, 3, grain="day")
    found = {r.config: r for r in models.linear_grid_search(folded, ["a", "b", "c"], 3).collect()}
    for alpha in (1.0, 100.0):
        errors = []
        for f in (1, 2, 3):
            lo = 120 - (4 - f) * 30
            m, s = x[:lo].mean(axis=0), x[:lo].std(axis=0)
            z, t = (x[:lo] - m) / s, (x[lo : lo + 30] - m) / s
            w = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y[:lo] - y[:lo].mean()))
            errors.append(np.sqrt(np.mean((t @ w + y[:lo].mean() - y[lo : lo + 30]) ** 2)))
        got = found[f"ridge_{alpha:g}"]
        same([got.mean_rmse, got.std_rmse], [np.mean(errors), np.std(errors)], 1e-9)


def test_pooled_rows_are_cut_by_one_calendar(spark):
    rows = [(s, d) for s in ("a", "b") for d in range(40 if s == "a" else 25)]
    df = spark.createDataFrame(rows, "series string, d int").selectExpr("series", "timestamp_ntz'2024-01-01' + make_dt_interval(d) AS bar")
    out = split.by_calendar(df, lambda bars: split.time_split(bars, 10, label="bar", grain="day"))
    ends = {r["split"]: (r.lo, r.hi) for r in out.groupBy("split").agg(F.min("bar").alias("lo"), F.max("bar").alias("hi")).collect()}
    assert ends["train"][1] < ends["val"][0] and ends["val"][1] < ends["test"][0]
    assert out.count() == 65 and out.groupBy("bar").agg(F.count_distinct("split").alias("n")).where("n > 1").isEmpty()


def test_grid_search_trains_on_earlier_folds_only(spark):
    x, y, df = regression_frame(spark, 100)
    folded = models.assemble(split.ts_folds(df, 3, grain="day"), ["a", "b", "c"])
    out = models.grid_search({"ols": lambda n, std: models.linear(regParam=0.0)}, folded, 3).first()
    errors = []
    for f in (1, 2, 3):
        lo = 100 - (4 - f) * 25
        a = np.column_stack([x, np.ones(100)])
        w = np.linalg.lstsq(a[:lo], y[:lo], rcond=None)[0]
        errors.append(np.sqrt(np.mean((a[lo : lo + 25] @ w - y[lo : lo + 25]) ** 2)))
    same([out.mean_rmse, out.std_rmse], [np.mean(errors), np.std(errors)], 1e-7)
    assert out.folds == 3
    assert set(models.parameter_grid({"d": 1}, a=[1, 2], b=[3])) == {"a=1,b=3", "a=2,b=3"}


def test_train_run_publishes_and_scores(spark, tmp_path):
    from pyspark.ml import PipelineModel

    x, y, df = regression_frame(spark, 120)
    df = df.withColumn("a", F.when(F.dayofmonth("bar") != 3, F.col("a")))
    rows = split.time_split(df, val_fraction=0.0, grain="day")
    params = {**models.FINAL_PARAMS, "n_estimators": 3}
    model, record = models.train_run(
        rows, ["a", "b", "c"], models.boosted(params), "m", store=str(tmp_path), run_date="2024-06-01"
    )
    row = record.first()
    assert (row.train_rows, row.test_rows, str(row.training_date)) == (90, 30, "2024-06-01")
    assert row.data_end < rows.where("split = 'test'").agg(F.min("bar")).first()[0]
    again = PipelineModel.load(f"{tmp_path}/models/latest/model")
    a, b = (table(models.score(m, df, "m"), "bar")["prediction"] for m in (model, again))
    same(a, b, 0)
    assert spark.read.json(f"{tmp_path}/history").count() == 1
    assert spark.read.json(f"{tmp_path}/models/latest/feature_means").count() == 1


def garch_direct(x, alpha, beta):
    v = x.var()
    h, ll = v, 0.0
    for value in x - x.mean():
        ll -= 0.5 * (np.log(h) + value**2 / h)
        h = v * (1 - alpha - beta) + alpha * value**2 + beta * h
    return ll, h


def test_garch_chunks_equal_the_sequential_recursion(spark):
    x = np.random.default_rng(5).normal(0.02, 0.01, 3000)
    rows = [("s", t, float(v)) for t, v in zip(days(3000, step=datetime.timedelta(hours=1)), x)]
    df = spark.createDataFrame(rows, "series string, bar timestamp_ntz, v double")
    for options in ({"grain": "hour"}, {"rows": 900, "slot": span(5)}):
        grid = baselines.garch_grid(df, "v", alphas=(0.05, 0.1), betas=(0.7, 0.9), **options)
        for r in grid.collect():
            same([r.loglik, r.next_variance], garch_direct(x, r.alpha, r.beta), 1e-9)
    best = baselines.garch_best(grid)
    top = best.first()
    steps = table(baselines.garch_forecast(best, 3), "step")["volatility"]
    want = [np.sqrt(top.variance + (top.alpha + top.beta) ** k * (top.next_variance - top.variance)) for k in range(3)]
    same(steps, want)


def test_arma_chunks_equal_the_sequential_recursion(spark):
    rng = np.random.default_rng(6)
    x = np.zeros(1000)
    for i in range(1, 1000):
        x[i] = 0.6 * x[i - 1] + rng.normal()
    rows = [("s", t, float(v)) for t, v in zip(days(1000), x)]
    df = spark.createDataFrame(rows, "series string, bar timestamp_ntz, v double")
    z = x - x.mean()
    for options in ({"grain": "day"}, {"rows": 300, "slot": span(10)}):
        grid = baselines.arma_grid(df, "v", grid=(-0.4, 0.0, 0.6), **options)
        for r in grid.collect():
            e, prev, sse = 0.0, 0.0, 0.0
            for value in z:
                e = value - r.phi * prev - r.theta * e
                prev, sse = value, sse + e * e
            same([r.sse, r.last_x, r.last_e], [sse, prev, e], 1e-9)
    best = baselines.arma_best(grid)
    b = best.first()
    assert (b.phi, b.theta) == (0.6, 0.0)
    first = b.phi * b.last_x + b.theta * b.last_e
    steps = table(baselines.arma_forecast(best, 3), "step")["forecast"]
    same(steps, [b.mean + first, b.mean + b.phi * first, b.mean + b.phi**2 * first])


def test_experiment_runs_are_logged_and_compared(spark, tmp_path):
    from tidemark.sources import runs

    path = str(tmp_path / "runs")
    for run_id, rmse in (("r1", 2.0), ("r2", 1.0)):
        record = runs.run_record(
            spark, "e", params={"depth": 3}, metrics={"rmse": rmse}, artifacts=[("m", "model")],
            run_id=run_id,
        )
        runs.log_run(record, path)
    runs.log_run(runs.run_record(spark, "other", metrics={"rmse": 9.0}), path)
    stored = runs.load_runs(spark, path)
    assert stored.count() == 3 and runs.load_runs(spark, path, "e").count() == 2
    newest = runs.latest_runs(runs.load_runs(spark, path, "e")).first()
    assert newest.run_id == "r2" and newest.params == {"depth": "3"}
    assert newest.artifacts[0].description == "model"
    change = monitor.compare_runs(stored).first()
    assert (change["diff"], change.pct_change) == (-1.0, -50.0)


def test_stack_of_three_and_refit(spark):
    x, y, df = regression_frame(spark, 150)
    model = models.stack_models(df, ["a", "b", "c"], alpha=0.5)
    xc, yc = x - x.mean(0), y - y.mean()
    same(model.coefficients.toArray(), np.linalg.solve(xc.T @ xc + 0.5 * np.eye(3), xc.T @ yc), 1e-7)
    stopped = spark.createDataFrame([(1, 4, 0.5), (3, 2, 0.4)], "patience int, stopped_at int, val_rmse double")
    small = {**models.FINAL_PARAMS, "n_estimators": 5}
    fitted = models.refit_stopped(models.boosted(small), models.assemble(df, ["a", "b", "c"]), stopped)
    assert fitted.getNumTrees == 2


def test_linear_grid_is_measured_by_tasks_that_return_sums(spark):
    """A constant feature, a null split, rows without a value, a split of equal labels: as in plain numpy."""
    rng = np.random.default_rng(3)
    rows = [(s, float(a), 0.1, float(b), float(0.3 * a - b + 0.1 * e)) for s, a, b, e in zip(["train"] * 40 + ["val"] * 20 + [None] * 9, *rng.normal(size=(3, 69)))]
    rows += [("test", float(a), 0.1, 1.0, 0.1) for a in rng.normal(size=5)] + [("val", None, 0.1, 1.0, 2.0), ("train", 1.0, 0.1, float("nan"), 2.0), ("val", 1.0, 0.1, 1.0, None)]
    df = spark.createDataFrame(rows, "split string, a double, k double, b double, rv_5d double").repartition(3)
    found = models.linear_models(df, ["a", "k", "b"])
    assert "MapInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
    found = {(r.model, r.split): r for r in found.collect()}
    assert len(found) == 4 * len(models.linear_candidates())
    data = np.array([r[1:] for r in rows[:74]])
    own = {s: np.array([r[0] == s for r in rows[:74]]) for s in ("train", "val", "test", None)}
    x, y = data[own["train"]][:, [0, 2]], data[own["train"]][:, 3]
    z, w = (x - x.mean(axis=0)) / x.std(axis=0), None
    w = np.linalg.solve(z.T @ z + 10 * np.eye(2), z.T @ (y - y.mean()))
    for s, mine in own.items():
        wrong = ((data[mine][:, [0, 2]] - x.mean(axis=0)) / x.std(axis=0)) @ w + y.mean() - data[mine][:, 3]
        r2 = None if s == "test" else 1 - np.mean(wrong**2) / data[mine][:, 3].var()
        got = found["ridge_10", s]
        assert got.n == mine.sum()
        same([got.rmse, got.mae, got.r2], [np.sqrt(np.mean(wrong**2)), np.abs(wrong).mean(), r2], 1e-9)
    by = models.moments(df, ["a", "k", "b"], by=["split"]).collect()
    assert {(r.split, r.n) for r in by} == {("train", 40), ("val", 20), ("test", 5), (None, 9)}
    assert all(models.as_moment(r)[2][1].tolist() == [0.0] * 4 for r in by)

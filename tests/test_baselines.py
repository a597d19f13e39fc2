"""Baselines on a hold-out, and states composed over several levels, against sequential Python versions."""

import datetime

import numpy as np
import pytest

from frames_util import days, same, table
from tidemark.operators import baselines


def series_rows(name, values, split_at):
    at = days(len(values), step=datetime.timedelta(hours=1))
    cut = lambda i: "train" if i < split_at[0] else "val" if i < split_at[1] else "test"
    return [(name, t, None if v is None else float(v), cut(i)) for i, (t, v) in enumerate(zip(at, values))]


SCHEMA = "series string, bar timestamp_ntz, v double, split string"


def garch_walk(x, v, alpha, beta, h):
    out = []
    for value in x:
        out.append(h)
        h = v * (1 - alpha - beta) + alpha * value**2 + beta * h
    return out, h


def arma_walk(x, phi, theta, prev, e):
    out = []
    for value in x:
        out.append(phi * prev + theta * e)
        e = value - phi * prev - theta * e
        prev = value
    return out, prev, e


def test_levels_give_the_states_of_the_sequential_recursion(spark, monkeypatch):
    monkeypatch.setattr(baselines, "FAN", 3)  # 240 rows in chunks of 7: four levels
    x = np.random.default_rng(1).normal(0.02, 0.01, 240)
    df = spark.createDataFrame(series_rows("a", x, (240, 240)) + series_rows("b", x[:5], (5, 5)), SCHEMA)
    z = {"a": x - x.mean(), "b": x[:5] - x[:5].mean()}
    grid = baselines.garch_grid(df, "v", alphas=(0.05, 0.2), betas=(0.5, 0.9), rows=7, grain="hour").collect()
    assert len(grid) == 6  # 0.2 + 0.9 is not stable
    for r in grid:
        v = (z[r.series] ** 2).mean()
        states, end = garch_walk(z[r.series], v, r.alpha, r.beta, v)
        want = sum(-0.5 * (np.log(h) + e * e / h) for h, e in zip(states, z[r.series]))
        same([r.loglik, r.next_variance], [want, end], 1e-9)
    grid = baselines.arma_grid(df, "v", grid=(-0.8, 0.0, 0.4), rows=7, grain="hour").collect()
    assert len(grid) == 18
    for r in grid:
        said, prev, e = arma_walk(z[r.series], r.phi, r.theta, 0.0, 0.0)
        want = sum((value - s) ** 2 for value, s in zip(z[r.series], said))
        same([r.sse, r.last_x, r.last_e], [want, prev, e], 1e-9)


@pytest.mark.parametrize("rows", [4, 64])
def test_holdout_forecasts_equal_a_walk_over_each_series(spark, monkeypatch, rows):
    monkeypatch.setattr(baselines, "FAN", 3)
    rng = np.random.default_rng(2)
    a = np.abs(rng.normal(0.03, 0.01, 150))
    b = list(np.abs(rng.normal(0.05, 0.02, 90)))
    b[70] = None  # a held row without a value is left out
    data = series_rows("a", a, (100, 125)) + series_rows("b", b, (60, 75))
    data += series_rows("flat", [0.5] * 12, (6, 9)) + series_rows("late", [0.1, 0.2], (0, 1))
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    train = df.where("split = 'train'")
    g = {r.series: r for r in baselines.garch_best(baselines.garch_grid(train, "v", grain="hour")).collect()}
    m = {r.series: r for r in baselines.arma_best(baselines.arma_grid(train, "v", grain="hour")).collect()}
    out = baselines.holdout_forecasts(df, "v", grain="hour", rows=rows).orderBy("series", "bar").toPandas()
    assert sorted(set(out.series)) == ["a", "b", "flat"]  # nothing was learned about "late"
    for name, values, cut in (("a", a, 100), ("b", np.array([v for v in b if v is not None]), 60)):
        got = out[out.series == name]
        p, q = g[name], m[name]
        held = values[cut:]
        states, _ = garch_walk(held - q.mean, p.variance, p.alpha, p.beta, p.next_variance)
        same(list(got.garch_step), np.sqrt(states), 1e-9)
        steps, _, _ = arma_walk(held - q.mean, q.phi, q.theta, q.last_x, q.last_e)
        same(list(got.arma_step), q.mean + np.array(steps), 1e-9)
        k = np.arange(len(held))
        same(list(got.garch_path), np.sqrt(p.variance + (p.alpha + p.beta) ** k * (p.next_variance - p.variance)), 1e-9)
        same(list(got.arma_path), q.mean + q.phi**k * (q.phi * q.last_x + q.theta * q.last_e), 1e-9)
        assert list(got.v) == list(held)
    flat = out[out.series == "flat"]
    assert flat.garch_path.isna().all() and flat.garch_step.isna().all()
    same(list(flat.arma_step), [0.5] * 6)


def test_ranking_is_by_validation_error_and_leaves_out_missing_forecasts(spark):
    rows = [("val", 1.0, 1.5, 1.0, None), ("val", 2.0, 2.5, 2.0, None), ("test", 3.0, 3.0, 4.0, 3.0)]
    df = spark.createDataFrame(rows, "split string, v double, far double, near double, none double")
    errors = baselines.forecast_errors(df, ("far", "near", "none"), "v")
    got = {r.model: r for r in baselines.ranking(errors).collect()}
    assert [got[c]["rank"] for c in ("near", "far", "none")] == [1, 2, 3]
    same([got["far"].val_rmse, got["near"].test_rmse, got["far"].val_mae], [0.5, 1.0, 0.5])
    assert got["none"].val_n is None and got["none"].test_n == 1
    assert baselines.ranking(errors.limit(0)).count() == 0


def test_empty_tables_have_no_forecasts(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert baselines.garch_grid(df, "v", grain="hour").count() == 0
    assert baselines.holdout_forecasts(df, "v", grain="hour").count() == 0


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_grids_walk_series_side_by_side_on_one_list_of_observations(spark, monkeypatch):
    x = np.random.default_rng(5).normal(0.02, 0.01, 30)
    rows = series_rows("a", x, (20, 25)) + series_rows("b", x[:3], (3, 3)) + series_rows(None, x[3:14], (8, 9))
    df = spark.createDataFrame(rows, SCHEMA)
    garch = baselines.garch_grid(df, "v", alphas=(0.05,), betas=(0.5,), rows=7, grain="hour")
    arma = baselines.arma_grid(df, "v", grid=(0.4,), rows=7, grain="hour")
    for grid in (garch, arma):
        assert "MapInArrow" in plan(grid)
    written, store = [], baselines.stored
    monkeypatch.setattr(baselines, "stored", lambda frame, name: (written.append(name), store(frame, name))[1])
    baselines.holdout_forecasts(df, "v", grain="hour")
    assert written.count("observations") == 1

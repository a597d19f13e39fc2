"""Small frames for tests: seeded paths and plain-Python expectations."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd

START = dt.datetime(2024, 1, 1)


def days(n, start=START, step=dt.timedelta(days=1)):
    return [start + i * step for i in range(n)]


def span(n):
    return dt.timedelta(days=n)


def walk(n=100, base=100.0, sd=2.0, seed=42):
    """Price path: base plus a running sum of normal steps, kept positive."""
    steps = np.random.default_rng(seed).normal(0, sd, n)
    return np.maximum(base + np.cumsum(steps), 1.0)


def bars(spark, prices_by_series, times=None):
    rows = []
    for series, prices in prices_by_series.items():
        for t, p in zip(times or days(len(prices)), prices):
            rows.append((series, t, None if p is None else float(p)))
    return spark.createDataFrame(rows, "series string, bar timestamp_ntz, adj_close double")


def table(df, *order):
    """Collected rows as a pandas frame ordered by the given columns."""
    return pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns).sort_values(
        list(order)
    ).reset_index(drop=True)


def same(actual, expected, tol=1e-9):
    """Numbers equal within ``tol`` and nulls in the same places."""
    assert len(actual) == len(expected), (len(actual), len(expected))
    for i, (a, b) in enumerate(zip(actual, expected)):
        missing = lambda v: v is None or (isinstance(v, float) and math.isnan(v))
        if missing(a) or missing(b):
            assert missing(a) and missing(b), (i, a, b)
        else:
            assert abs(a - b) <= tol * max(1.0, abs(b)), (i, a, b)

"""Gated row frames: a value exists only when its whole frame is present and non-null.

Spark's window aggregates skip nulls and accept short frames at the start of a
series. A rolling statistic over ``n`` rows must instead be null there, so every
expression below counts the usable rows of its frame and yields null unless
there are exactly ``n``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def frame(w: WindowSpec, n: int) -> WindowSpec:
    """The current row and the ``n - 1`` rows before it."""
    return w.rowsBetween(-(n - 1), 0)


def gated(value: Column, over: WindowSpec, n: int, *inputs: Column) -> Column:
    """``value`` over the frame, null unless ``n`` rows have all ``inputs`` non-null."""
    if len(inputs) == 1:
        usable = F.count(inputs[0]).over(over)
    else:
        complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in inputs])
        usable = F.count(F.when(complete, 1)).over(over)
    return F.when(usable == n, value)


def rolling_sum(x: Column, w: WindowSpec, n: int) -> Column:
    f = frame(w, n)
    return gated(F.sum(x).over(f), f, n, x)


def realized_vol(ret: Column, w: WindowSpec, n: int) -> Column:
    f = frame(w, n)
    return gated(F.sqrt(F.sum(ret * ret).over(f)), f, n, ret)


def drawdown(price: Column, w: WindowSpec, n: int) -> Column:
    f = frame(w, n)
    return gated(1.0 - F.try_divide(price, F.max(price).over(f)), f, n, price)


def forward_vol(ret: Column, w: WindowSpec, horizon: int) -> Column:
    """Realised volatility of the next ``horizon`` rows."""
    f = w.rowsBetween(1, horizon)
    return gated(F.sqrt(F.sum(ret * ret).over(f)), f, horizon, ret)


def rolling_corr(a: Column, b: Column, w: WindowSpec, n: int) -> Column:
    """Correlation from moments: ``corr`` itself raises on a constant frame in ANSI mode."""
    f = frame(w, n)
    spread = F.stddev_pop(a).over(f) * F.stddev_pop(b).over(f)
    return gated(F.try_divide(F.covar_pop(a, b).over(f), spread), f, n, a, b)


def gain(delta: Column) -> Column:
    """Upward move; a missing move counts as zero."""
    return F.when(delta > 0, delta).otherwise(0.0)


def loss(delta: Column) -> Column:
    return F.when(delta < 0, -delta).otherwise(0.0)


def strength_index(g: Column, l: Column) -> Column:
    """Relative strength index of a mean gain and a mean loss; null when nothing moved."""
    return (
        F.when((l == 0) & (g == 0), F.lit(None))
        .when(l == 0, 100.0)
        .otherwise(100.0 - 100.0 / (1.0 + F.try_divide(g, l)))
    )

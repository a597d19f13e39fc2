"""Scalar column formulas. Every division and logarithm is null-safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the monitoring rules.
REGIME_LIMITS = ((0.015, "LOW"), (0.03, "NORMAL"), (0.05, "ELEVATED"))
REGIME_TOP = "HIGH"
STATUS_LIMITS = ((10.0, "GOOD"), (30.0, "ACCEPTABLE"))
STATUS_TOP = "DEGRADED"
TREND_LIMIT = 10.0
HIT_TOLERANCE = 0.20
_CLOCK = ("hour", "minute", "second")


def log_return(price: Column, previous: Column) -> Column:
    """``ln(price / previous)``; null unless both prices are positive."""
    return F.when((price > 0) & (previous > 0), F.ln(price / previous))


def simple_return(log_ret: Column) -> Column:
    return F.expm1(log_ret)


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` with null in place of a division by zero."""
    return F.try_divide(a, b)


def percent_change(new: Column, old: Column) -> Column:
    return F.try_divide(new - old, old) * 100.0


def _ladder(value: Column, limits, top: str) -> Column:
    out = None
    for limit, label in limits:
        out = F.when(value < limit, label) if out is None else out.when(value < limit, label)
    return F.when(value.isNotNull(), out.otherwise(top))


def regime(volatility: Column) -> Column:
    return _ladder(volatility, REGIME_LIMITS, REGIME_TOP)


def benchmark_status(diff_pct: Column) -> Column:
    """Symmetric: a much better error is reported as degraded as well."""
    return _ladder(F.abs(diff_pct), STATUS_LIMITS, STATUS_TOP)


def trend_label(change_pct: Column) -> Column:
    return (
        F.when(change_pct > TREND_LIMIT, "INCREASING")
        .when(change_pct < -TREND_LIMIT, "DECREASING")
        .otherwise("STABLE")
    )


def percent_text(fraction: Column) -> Column:
    """0.0123 -> '1.23 percent'."""
    return F.format_string("%.2f percent", fraction * 100.0)


def signed_percent_text(pct: Column) -> Column:
    """6.33 -> '+6.3 percent'."""
    return F.format_string("%+.1f percent", pct)


def bar_start(ts: Column, every: str, kind: T.DataType) -> Column:
    """Start of the hour, day, week, ... that holds ``ts``, in the type of ``ts``.

    Times without zone are truncated by date arithmetic: ``date_trunc`` would pass
    through the session zone, whose daylight-saving gap shifts them.
    """
    if not isinstance(kind, T.TimestampNTZType):
        return F.date_trunc(every, ts).cast(kind)
    day = F.to_date(ts)
    if every in _CLOCK:
        parts = [F.hour(ts), F.minute(ts), F.second(ts)][: _CLOCK.index(every) + 1]
        return day.cast(kind) + F.make_dt_interval(F.lit(0), *parts)
    return (day if every == "day" else F.trunc(day, every)).cast(kind)


def iso_date(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def partition_value(folder: Column, key: str = "date") -> Column:
    """'…/date=2024-01-02/…' -> '2024-01-02'; null when the folder carries no such key."""
    found = F.regexp_extract(folder, rf"(?:^|/){key}=([^/]+)", 1)
    return F.when(found != "", found)

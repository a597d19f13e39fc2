"""Forecast monitoring per (series, model): errors, rolling errors, regime, trend, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ladder import Ladder, chain
from tidemark.functions.scalars import (
    HIT_TOLERANCE,
    benchmark_status as status_of,
    iso_date,
    percent_change,
    percent_text,
    ratio,
    regime,
    signed_percent_text,
    trend_label,
)
from tidemark.operators.frames import attach_group_value, last_rows, over_rows

GROUP = ("series", "model")
ROLLING_ROWS = 30
DOCUMENT_ROWS = 35
TREND_ROWS = 10

# Fixed values of the monitoring rules: messages, severities, limits.
TREND_NOTE_PCT = 15
LOW_PERCENTILE = 10
TREND_UP_TEXT = "Volatility trending higher over past 5 days"
TREND_DOWN_TEXT = "Volatility trending lower over past 5 days"
HIGH_TEXT = "Volatility in HIGH regime expect larger market swings"
LOW_TEXT = "Volatility unusually low regime shift possible"
RMSE_DEGRADED_FORMAT = (
    "RMSE degraded: benchmark=%.6f production=%.6f (%+.1f%%) - retrain model"
)
RMSE_ACCEPTABLE_FORMAT = (
    "RMSE acceptable: benchmark=%.6f production=%.6f (%+.1f%%) - monitor closely"
)
ALERT_LIMITS = (
    ("val_rmse", "above", 0.0095),
    ("val_r2", "below", 0.40),
    ("gap_pct", "above", 20.0),
    ("drift_rmse", "above", 0.010),
)


def attach_actuals(
    predictions: DataFrame, actuals: DataFrame, on: Sequence[str] = ("series", "bar")
) -> DataFrame:
    """Left join of forecasts with the labels that are known by now."""
    return predictions.join(actuals, list(on), "left")


def split_by_actual(scored: DataFrame, actual: str = "rv_5d") -> tuple[DataFrame, DataFrame]:
    """(rows with a known actual, rows still waiting for one)."""
    return scored.where(F.col(actual).isNotNull()), scored.where(F.col(actual).isNull())


def _error(y: str, p: str) -> Column:
    return F.col(p) - F.col(y)


def _relative(y: str, p: str) -> Column:
    """Absolute error over the actual; null (left out) where the actual is zero."""
    return F.abs(F.try_divide(_error(y, p), F.col(y)))


def _hit(y: str, p: str) -> Column:
    return (_relative(y, p) <= HIT_TOLERANCE).cast("double")


def metric_aggregates(y: str = "rv_5d", p: str = "prediction", prefix: str = "") -> list[Column]:
    """RMSE, MAE and R2; R2 is 1 - SSE/SST and may be negative."""
    mse = F.avg(_error(y, p) ** 2)
    return [
        F.sqrt(mse).alias(f"{prefix}rmse"),
        F.avg(F.abs(_error(y, p))).alias(f"{prefix}mae"),
        (1.0 - F.try_divide(mse, F.var_pop(F.when(F.col(p).isNotNull(), F.col(y))))).alias(
            f"{prefix}r2"
        ),
    ]


def regression_metrics(
    scored: DataFrame, by: Sequence[str] = GROUP, *, y: str = "rv_5d", p: str = "prediction"
) -> DataFrame:
    complete = scored.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    return complete.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *metric_aggregates(y, p))


def forecast_metrics(
    scored: DataFrame, by: Sequence[str] = GROUP, *, y: str = "rv_5d", p: str = "prediction"
) -> DataFrame:
    """Regression metrics plus MAPE (percent) and the share of forecasts within 20 %.

    Zero actuals have no relative error; they are left out of both and counted.
    """
    complete = scored.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    return complete.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *metric_aggregates(y, p),
        (F.avg(_relative(y, p)) * 100.0).alias("mape"),
        F.avg(_hit(y, p)).alias("hit_rate"),
        F.count_if(F.col(y) == 0).alias("zero_actuals"),
    )


def recent_metrics(
    scored: DataFrame,
    n: int = ROLLING_ROWS,
    by: Sequence[str] = GROUP,
    *,
    order: str = "bar",
    y: str = "rv_5d",
    p: str = "prediction",
) -> DataFrame:
    """Metrics of the ``n`` latest scored rows (all rows of a shorter group)."""
    complete = scored.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    return forecast_metrics(last_rows(complete, by, order, n), by, y=y, p=p)


def rolling_metrics(
    scored: DataFrame,
    n: int = ROLLING_ROWS,
    by: Sequence[str] = GROUP,
    *,
    order: str = "bar",
    y: str = "rv_5d",
    p: str = "prediction",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """Metrics of every full window of ``n`` scored rows, labelled by its last bar."""
    complete = scored.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    rel = _relative(y, p)
    rows = complete.select(
        *by,
        order,
        F.col(y).alias("_y"),
        (_error(y, p) ** 2).alias("_sq"),
        F.abs(_error(y, p)).alias("_abs"),
        F.coalesce(rel, F.lit(0.0)).alias("_rel"),
        F.coalesce(_hit(y, p), F.lit(0.0)).alias("_hit"),
        rel.isNotNull().cast("int").alias("_has_rel"),
    )
    names = ("_sq", "_abs", "_rel", "_hit", "_has_rel")
    ladder = Ladder(chain(n), sums={c[1:]: c for c in names}, pairs={"y": ("_y", "_y")})
    total = {c: ladder.total(c[1:], n) for c in names}

    def collect(_w):
        mse = total["_sq"] / n
        return {
            "rmse": F.sqrt(mse),
            "mae": total["_abs"] / n,
            "r2": 1.0 - F.try_divide(mse, ladder.variance("y", n)),
            "mape": F.try_divide(total["_rel"], total["_has_rel"]) * 100.0,
            "hit_rate": F.try_divide(total["_hit"], total["_has_rel"]),
        }

    out = over_rows(
        rows, by, order, [*ladder.steps(), collect], back=n - 1, grain=grain, **chunking
    )
    return out.where(F.col("rmse").isNotNull()).select(
        *by,
        F.col(order).alias("end_bar"),
        F.lit(n).cast("long").alias("window_size"),
        "rmse",
        "mae",
        "r2",
        "mape",
        "hit_rate",
    )


def trend(
    predictions: DataFrame,
    by: Sequence[str] = GROUP,
    *,
    order: str = "bar",
    p: str = "prediction",
) -> DataFrame:
    """Latest forecast and the mean of the last five forecasts against the five before."""
    half = TREND_ROWS // 2
    late, early = F.col("recency") <= half, F.col("recency") > half
    sums = (
        last_rows(predictions, by, order, TREND_ROWS)
        .groupBy(*by)
        .agg(
            F.max(order).alias("last_bar"),
            F.max(F.when(F.col("recency") == 1, F.col(p))).alias("volatility"),
            F.count(F.lit(1)).alias("_n"),
            F.avg(F.when(late, F.col(p))).alias("_late"),
            F.avg(F.when(early, F.col(p))).alias("_early"),
        )
    )
    enough = F.col("_n") >= TREND_ROWS
    change = F.when(enough, percent_change(F.col("_late"), F.col("_early")))
    return sums.select(
        *by,
        "last_bar",
        "volatility",
        F.when(enough, trend_label(F.coalesce(change, F.lit(0.0))))
        .otherwise("UNKNOWN")
        .alias("trend"),
        F.coalesce(change, F.lit(0.0)).alias("trend_change_pct"),
    )


def forecast_percentile(
    scored: DataFrame,
    by: Sequence[str] = GROUP,
    *,
    order: str = "bar",
    y: str = "rv_5d",
    p: str = "prediction",
) -> DataFrame:
    """Share of the known actuals strictly below the latest forecast, in percent."""
    latest = scored.groupBy(*by).agg(F.max_by(p, order).alias("volatility"))
    return _percentile(scored, latest, by, order, y)


def _percentile(scored, latest, by, order, y) -> DataFrame:
    history = scored.where(F.col(y).isNotNull()).select(*by, order, y)
    joined = attach_group_value(history, latest, by, order)
    below = (F.col(y) < F.col("volatility")).cast("double")
    return joined.groupBy(*by).agg(
        F.max("volatility").alias("volatility"),
        (F.avg(below) * 100.0).alias("percentile"),
    )


def period_errors(scored: DataFrame, early: Column, by: Sequence[str] = GROUP, *, y: str = "rv_5d", p: str = "prediction") -> DataFrame:
    """(by, test_rmse, production_rmse): errors of the benchmark period and after it, from one pass."""
    square = _error(y, p) ** 2
    both = scored.groupBy(*by).agg(
        F.sqrt(F.avg(F.when(early, square))).alias("test_rmse"), F.sqrt(F.avg(F.when(~early, square))).alias("production_rmse")
    )
    return both.where("test_rmse IS NOT NULL AND production_rmse IS NOT NULL")


def benchmark_comparison(
    production: DataFrame, benchmark: DataFrame, by: Sequence[str] = GROUP
) -> DataFrame:
    """Production RMSE against the benchmark's ``test_rmse``.

    The status treats a better and a worse error alike; ``rmse_diff_pct`` keeps
    the sign.
    """
    joined = production.select(*by, F.col("rmse").alias("production_rmse")).join(
        benchmark.select(*by, "test_rmse"), list(by)
    )
    return compared(joined, by)


def compared(joined: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Difference and status of rows that have ``test_rmse`` and ``production_rmse``."""
    diff_pct = percent_change(F.col("production_rmse"), F.col("test_rmse"))
    return joined.select(
        *by,
        "test_rmse",
        "production_rmse",
        (F.col("production_rmse") - F.col("test_rmse")).alias("rmse_diff"),
        diff_pct.alias("rmse_diff_pct"),
        status_of(diff_pct).alias("status"),
    )


def current_forecast(
    scored: DataFrame, by: Sequence[str] = GROUP, *, order: str = "bar"
) -> DataFrame:
    """One record per group: latest forecast with regime, trend and percentile."""
    record = trend(scored, by, order=order)
    latest = record.select(*by, "volatility")
    rank = _percentile(scored, latest, by, order, "rv_5d").select(*by, "percentile")
    return record.join(rank, list(by), "left").select(
        *by,
        "last_bar",
        "volatility",
        percent_text(F.col("volatility")).alias("volatility_pct"),
        regime(F.col("volatility")).alias("regime"),
        "trend",
        "trend_change_pct",
        "percentile",
        F.lit("MEDIUM").alias("confidence"),
    )


def _note(kind: str, severity: str, message: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("type"), F.lit(severity).alias("severity"), message.alias("message")
    )


def insight_list() -> Column:
    """Array of the notes that apply to a current-forecast row joined with its comparison."""
    strong = F.abs(F.col("trend_change_pct")) > TREND_NOTE_PCT
    values = [F.col("test_rmse"), F.col("production_rmse"), F.col("rmse_diff_pct")]
    degraded, acceptable = F.col("status") == "DEGRADED", F.col("status") == "ACCEPTABLE"
    notes = [
        F.when(
            (F.col("trend") == "INCREASING") & strong,
            _note("TREND", "WARNING", F.lit(TREND_UP_TEXT)),
        ).when(
            (F.col("trend") == "DECREASING") & strong,
            _note("TREND", "INFO", F.lit(TREND_DOWN_TEXT)),
        ),
        F.when(
            F.col("regime") == "HIGH", _note("REGIME", "ALERT", F.lit(HIGH_TEXT))
        ).when(
            (F.col("regime") == "LOW") & (F.col("percentile") < LOW_PERCENTILE),
            _note("REGIME", "INFO", F.lit(LOW_TEXT)),
        ),
        F.when(
            degraded, _note("RMSE", "ALERT", F.format_string(RMSE_DEGRADED_FORMAT, *values))
        ).when(
            acceptable,
            _note("RMSE", "WARNING", F.format_string(RMSE_ACCEPTABLE_FORMAT, *values)),
        ),
    ]
    return F.filter(F.array(*notes), lambda n: n.isNotNull())


def insights(current: DataFrame, comparison: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """One row per note."""
    joined = current.join(comparison, list(by), "left")
    return joined.select(*by, F.explode(insight_list()).alias("note")).select(*by, "note.*")


def error_table(
    scored: DataFrame,
    n: int = ROLLING_ROWS,
    by: Sequence[str] = GROUP,
    *,
    order: str = "bar",
    y: str = "rv_5d",
    p: str = "prediction",
) -> DataFrame:
    """Errors of the latest scored rows."""
    recent = last_rows(scored.where(F.col(y).isNotNull()), by, order, n)
    return recent.select(
        *by,
        order,
        F.col(y).alias("actual"),
        F.col(p).alias("prediction"),
        _error(y, p).alias("error"),
        (ratio(_error(y, p), F.col(y)) * 100.0).alias("error_pct"),
    )


def monitor_documents(
    scored: DataFrame,
    benchmark: DataFrame,
    by: Sequence[str] = GROUP,
    *,
    order: str = "bar",
    rows: int = DOCUMENT_ROWS,
) -> DataFrame:
    """JSON documents (monitor, summary, alerts) per group.

    Counts, metrics, trend and percentile are of all rows; only the lists in a document
    are of the latest ``rows`` forecasts. ``benchmark`` may carry a ``trained_date``.
    """
    recent = last_rows(scored, by, order, rows).drop("recency")
    done, _ = split_by_actual(recent)
    on = list(by)
    overall = forecast_metrics(split_by_actual(scored)[0], by)
    metric_names = ["rmse", "mae", "r2", "mape", "hit_rate"]
    comparison = benchmark_comparison(overall, benchmark, by)
    dated = "trained_date" in benchmark.columns
    if dated:
        comparison = comparison.join(benchmark.select(*by, F.col("trained_date").cast("string").alias("trained_date")), on)
    current = current_forecast(scored, by, order=order)

    def listed(df: DataFrame, name: str, at: str, fields: list[Column]) -> DataFrame:
        entries = F.array_sort(F.collect_list(F.struct(F.col(at).alias("_at"), *fields)))
        plain = F.transform(entries, lambda e: e.dropFields("_at"))
        return df.groupBy(*by).agg(plain.alias(name))

    day = iso_date(F.col(order)).alias("date")
    waiting = listed(
        recent.where(F.col("rv_5d").isNull()),
        "latest_predictions",
        order,
        [day, F.col("prediction"), percent_text(F.col("prediction")).alias("prediction_pct")],
    )
    errors = listed(
        error_table(scored, by=by, order=order),
        "predictions_vs_actuals",
        order,
        [
            day,
            F.col("actual").alias("actual_rv_5d"),
            F.col("prediction"),
            F.col("error"),
            signed_percent_text(F.col("error_pct")).alias("error_pct"),
        ],
    )
    windows = listed(
        rolling_metrics(done, by=by, order=order, grain="hour"),
        "rolling_30d",
        "end_bar",
        [iso_date(F.col("end_bar")).alias("end_date"), F.col("window_size"), *map(F.col, metric_names)],
    )
    counts = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count("rv_5d").alias("predictions_with_actuals"),
    )
    metrics = lambda df, name: df.select(*by, F.struct(*metric_names).alias(name))
    joined = (
        counts.join(current, on, "left")
        .join(comparison, on, "left")
        .join(metrics(overall, "overall"), on, "left")
        .join(metrics(recent_metrics(scored, by=by, order=order), "recent_30d"), on, "left")
        .join(windows, on, "left")
        .join(errors, on, "left")
        .join(waiting, on, "left")
    )
    metadata = F.struct(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"),
        "total_predictions",
        "predictions_with_actuals",
        (F.col("total_predictions") - F.col("predictions_with_actuals")).alias(
            "predictions_without_actuals"
        ),
    )
    now = F.struct(
        iso_date(F.col("last_bar")).alias("date"),
        "volatility",
        "volatility_pct",
        "regime",
        "trend",
        "trend_change_pct",
        "percentile",
        "confidence",
        insight_list().alias("insights"),
    )
    against = F.struct("test_rmse", "production_rmse", "rmse_diff", "rmse_diff_pct", "status", *["trained_date"] * dated)
    no_list = lambda name: F.coalesce(F.col(name), F.array()).alias(name)
    performance = [F.col("overall"), F.col("recent_30d")]
    summary = [metadata.alias("metadata"), now.alias("current_forecast")]
    return joined.select(
        *by,
        F.to_json(
            F.struct(
                *summary,
                "latest_predictions",
                "predictions_vs_actuals",
                F.struct(
                    *performance, "rolling_30d", against.alias("benchmark_comparison")
                ).alias("performance"),
            )
        ).alias("monitor"),
        F.to_json(
            F.struct(
                *summary,
                "latest_predictions",
                F.struct(*performance, against.alias("benchmark_comparison")).alias("performance"),
            )
        ).alias("summary"),
        F.to_json(
            F.struct(
                metadata["generated_at"].alias("generated_at"),
                now["date"].alias("current_forecast_date"),
                now["insights"].alias("insights"),
                against.alias("benchmark_comparison"),
            )
        ).alias("alerts"),
    )


def compare_runs(runs: DataFrame, *, experiment: str = "experiment", run: str = "run_id") -> DataFrame:
    """Latest run of each experiment against the one before, for metrics both carry.

    ``runs`` has (experiment, run_id, metrics map<string,double>).
    """
    two = last_rows(runs.select(experiment, run, "metrics"), [experiment], run, 2)
    newest = F.col("recency") == 1
    entries = two.select(experiment, run, "recency", F.explode("metrics").alias("metric", "value"))
    both = entries.groupBy(experiment, "metric").agg(
        F.max(F.when(~newest, F.col(run))).alias("previous_run"),
        F.max(F.when(newest, F.col(run))).alias("latest_run"),
        F.max(F.when(~newest, F.col("value"))).alias("previous"),
        F.max(F.when(newest, F.col("value"))).alias("latest"),
    )
    change = F.coalesce(percent_change(F.col("latest"), F.col("previous")), F.lit(0.0))
    return both.where(F.col("previous_run").isNotNull() & F.col("latest_run").isNotNull()).select(
        "*", (F.col("latest") - F.col("previous")).alias("diff"), change.alias("pct_change")
    )


def threshold_alerts(metrics: DataFrame, limits=ALERT_LIMITS, by: Sequence[str] = GROUP) -> DataFrame:
    """One row per breached limit; a null metric breaches nothing, an absent one is an error."""
    absent = [m for m, _, _ in limits if m not in metrics.columns]
    if absent:
        raise ValueError(f"no metric {', '.join(absent)}; pass the limits that apply")
    present = list(limits)
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(m).alias("value"),
            F.lit(float(limit)).alias("limit"),
            (F.col(m) > limit if side == "above" else F.col(m) < limit).alias("breach"),
        )
        for m, side, limit in present
    ]
    checks = metrics.select(*by, F.explode(F.array(*rows)).alias("check")).select(*by, "check.*")
    return checks.where("breach").drop("breach")

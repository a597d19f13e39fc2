"""Experiment runs: parameters, metrics and artifacts of each run as one appended record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.frames import last_rows
from tidemark.sources.store import append_records, read_records

ARTIFACT = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("description", T.StringType())]
)
RUN_SCHEMA = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("artifacts", T.ArrayType(ARTIFACT)),
    ]
)


def run_record(
    spark: SparkSession,
    experiment: str,
    *,
    params: Mapping[str, object] = {},
    metrics: Mapping[str, float] = {},
    artifacts: Sequence[tuple[str, str]] = (),
    run_id: str | None = None,
) -> DataFrame:
    """One run; the run id defaults to the start time, so ids sort by time."""
    now = datetime.now(timezone.utc)
    row = (
        experiment,
        run_id or now.strftime("%Y%m%d_%H%M%S"),
        now.isoformat(),
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
        list(artifacts),
    )
    return spark.createDataFrame([row], RUN_SCHEMA)


def log_run(record: DataFrame, path: str) -> None:
    append_records(record, path)


def load_runs(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    runs = read_records(spark, path, RUN_SCHEMA)
    return runs if experiment is None else runs.where(runs.experiment == experiment)


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest run of each experiment."""
    return last_rows(runs, ["experiment"], "run_id", 1).drop("recency")

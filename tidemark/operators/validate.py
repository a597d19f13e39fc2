"""Schema and content rules; each check returns a table of violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.features import FEATURE_COLUMNS

# Fixed schemas of the stored bar tables.
RAW_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType(), False), T.StructField("date", T.DateType(), False)]
    + [
        T.StructField(c, T.DoubleType(), False)
        for c in ("open", "high", "low", "close", "volume")
    ]
)
CURATED_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("close", T.DoubleType(), False),
        T.StructField("adj_close", T.DoubleType(), False),
        T.StructField("ret", T.DoubleType(), True),
    ]
)
FEATURE_TABLE_WIDTH = len(FEATURE_COLUMNS) + 1
RAW_MARKER = "symbol"
VIOLATION = "rule string, column string, n long"


class ValidationError(ValueError):
    """Raised in strict mode when a table breaks a rule."""


def schema_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Missing columns, wrong types, and nulls in columns that allow none.

    Structure is checked on the plan; all null counts come from one aggregate.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    structural = [("missing_column", f.name, None) for f in schema if f.name not in have]
    structural += [
        ("wrong_type", f.name, None) for f in schema if f.name in have and have[f.name] != f.dataType
    ]
    found = df.sparkSession.createDataFrame(structural, VIOLATION)
    required = [f.name for f in schema if not f.nullable and f.name in have]
    if not required:
        return found
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    nulls = counts.unpivot([], required, "column", "n").where("n > 0")
    return found.unionByName(nulls.select(F.lit("null_value").alias("rule"), "column", "n"))


def validate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` unchanged or raise with the violations found."""
    broken = schema_violations(df, schema).limit(len(schema) * 3).collect()
    if broken:
        raise ValidationError("; ".join(f"{r.rule}: {r.column} ({r.n})" for r in broken))
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def structure_rules(
    df: DataFrame, required: Sequence[str] = FEATURE_COLUMNS, width: int = FEATURE_TABLE_WIDTH
) -> list[tuple[str, str | None, int | None]]:
    """Rules decided by the columns alone: width, no raw marker, required columns."""
    out = []
    if len(df.columns) != width:
        out.append(("column_count", None, len(df.columns)))
    if RAW_MARKER in df.columns:
        out.append(("raw_column", RAW_MARKER, None))
    out += [("missing_column", c, None) for c in required if c not in df.columns]
    return out


def feature_rules(
    df: DataFrame,
    order: str = "bar",
    required: Sequence[str] = FEATURE_COLUMNS,
    width: int = FEATURE_TABLE_WIDTH,
) -> DataFrame:
    """Violations of a feature batch, including times that occur more than once."""
    found = df.sparkSession.createDataFrame(structure_rules(df, required, width), VIOLATION)
    repeated = duplicate_keys(df, [order]).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    return found.unionByName(
        repeated.select(F.lit("duplicate_time").alias("rule"), F.lit(order).alias("column"), "n")
    )


def partition_rules(df: DataFrame, by: str = "date") -> DataFrame:
    """Partitions that do not hold exactly one row, for the whole table in one pass."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows")).where("rows <> 1")


def scan_partitions(
    df: DataFrame, by: str = "date", required: Sequence[str] = FEATURE_COLUMNS
) -> DataFrame:
    """Partitions without exactly one row, with the number of their all-null columns."""
    present = [c for c in required if c in df.columns]
    per = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"_n_{c}") for c in present],
    )
    empty = F.array_compact(F.array(*[F.when(F.col(f"_n_{c}") == 0, c) for c in present]))
    return per.select(by, "rows", F.size(empty).alias("empty_columns")).where("rows <> 1")

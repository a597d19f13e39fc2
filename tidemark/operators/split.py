"""Splits by time order. Positions are exact row numbers, never ``limit`` on unordered data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.frames import Slot, number_rows

TEST_ROWS = 30
VAL_FRACTION = 0.2
TRAIN_FRACTION = 0.9


def feature_columns(df: DataFrame, label: str = "rv_5d", other: Sequence[str] = ("series", "bar")):
    """All columns that are neither keys nor the label."""
    return [c for c in df.columns if c != label and c not in other]


def time_split(
    df: DataFrame,
    test_rows: int = TEST_ROWS,
    val_fraction: float = VAL_FRACTION,
    *,
    label: str = "rv_5d",
    features: Sequence[str] = (),
    keys: Sequence[str] = (),
    order: str = "bar",
    grain: str | None = None,
    slot: Slot = None,
) -> DataFrame:
    """Add ``split``: the last rows are test, a share of the rest (at least one row) is val.

    Rows without a label are dropped first; rows with a null among ``features``
    are dropped from train and val afterwards. ``val_fraction`` 0 gives no val.
    """
    labelled = df.where(F.col(label).isNotNull())
    rows = number_rows(
        labelled, keys, order, grain=grain, slot=slot, position="_pos", total="_total"
    )
    before_test = F.greatest(F.col("_total") - test_rows, F.lit(0))
    val = F.greatest(F.lit(1), F.floor(before_test * F.lit(float(val_fraction))))
    val = val if val_fraction > 0 else F.lit(0)
    split = (
        F.when(F.col("_pos") > before_test, "test")
        .when(F.col("_pos") > before_test - val, "val")
        .otherwise("train")
    )
    out = rows.withColumn("split", split).drop("_pos", "_total")
    if features:
        complete = F.lit(True)
        for c in features:
            complete = complete & F.col(c).isNotNull()
        out = out.where((F.col("split") == "test") | complete)
    return out


def require_rows(df: DataFrame, minimum: int, keys: Sequence[str] = ()) -> DataFrame:
    """Groups with too few rows to split (empty when all is well)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") <= minimum)


def walk_forward_split(
    df: DataFrame,
    fraction: float = TRAIN_FRACTION,
    *,
    keys: Sequence[str] = (),
    order: str = "bar",
    grain: str | None = None,
    slot: Slot = None,
) -> DataFrame:
    """Add ``split``: the first ``floor(n * fraction)`` rows are train, the rest val."""
    rows = number_rows(df, keys, order, grain=grain, slot=slot, position="_pos", total="_total")
    train = F.floor(F.col("_total") * F.lit(float(fraction)))
    split = F.when(F.col("_pos") <= train, "train").otherwise("val")
    return rows.withColumn("split", split).drop("_pos", "_total")


def split_summary(
    df: DataFrame, keys: Sequence[str] = (), order: str = "bar", split: str = "split"
) -> DataFrame:
    return df.groupBy(*keys, split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(order).alias("start"),
        F.max(order).alias("end"),
    )


def ts_folds(
    df: DataFrame,
    k: int = 5,
    *,
    keys: Sequence[str] = (),
    order: str = "bar",
    grain: str | None = None,
    slot: Slot = None,
) -> DataFrame:
    """Add ``test_fold`` (0..k) of an expanding-window cross validation.

    Fold ``f`` tests the rows with ``test_fold = f`` and trains on those with a
    smaller number, so one column describes all folds and no row is copied.
    """
    rows = number_rows(df, keys, order, grain=grain, slot=slot, position="_pos", total="_total")
    size = F.floor(F.col("_total") / F.lit(k + 1))
    start = F.col("_total") - k * size
    fold = F.when(F.col("_pos") <= start, 0).otherwise(
        F.floor((F.col("_pos") - 1 - start) / size) + 1
    )
    return rows.withColumn("test_fold", fold.cast("long")).drop("_pos", "_total")


def fold_table(folds: DataFrame, keys: Sequence[str] = (), order: str = "bar") -> DataFrame:
    """Rows and bounds of train and test part of each fold (at most k + 1 rows per key)."""
    parts = folds.groupBy(*keys, "test_fold").agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.min(order).alias("test_start"),
        F.max(order).alias("test_end"),
    )
    before = Window.partitionBy(*keys).orderBy("test_fold").rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.withColumns(
            {
                "train_rows": F.sum("test_rows").over(before),
                "train_end": F.max("test_end").over(before),
            }
        )
        .where("test_fold > 0")
        .select(
            *keys,
            F.col("test_fold").alias("fold"),
            "train_rows",
            "train_end",
            "test_rows",
            "test_start",
            "test_end",
        )
    )


def by_calendar(df: DataFrame, assign, order: str = "bar") -> DataFrame:
    """Cut pooled rows by time: ``assign`` labels the distinct bars, and all rows of a bar go together.

    Cut per series, train rows of one series could lie after test rows of another.
    ``assign`` gets a frame with the one column ``order`` and adds its own.
    """
    return df.join(assign(df.select(order).distinct()), order)

"""Forward volatility labels and the three tables derived from the master table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rolling
from tidemark.operators.frames import last_rows, over_rows

HORIZON = 5
LABEL = "rv_5d"
PREDICT_ROWS = 35


def label_step(ret: str, horizon: int = HORIZON, label: str = LABEL):
    return lambda w: {label: rolling.forward_vol(F.col(ret), w, horizon)}


def forward_rv(
    df: DataFrame,
    horizon: int = HORIZON,
    *,
    ret: str = "spy_ret_1d",
    label: str = LABEL,
    keys: Sequence[str] = (),
    order: str = "bar",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """Add the realised volatility of the next ``horizon`` rows; null where one is missing."""
    return over_rows(
        df,
        keys,
        order,
        [label_step(ret, horizon, label)],
        back=0,
        ahead=horizon,
        grain=grain,
        **chunking,
    )


def predict_set(
    master: DataFrame,
    n: int = PREDICT_ROWS,
    *,
    label: str = LABEL,
    keys: Sequence[str] = (),
    order: str = "bar",
) -> DataFrame:
    """Features of the latest rows; the label is removed so it cannot leak."""
    return last_rows(master, keys, order, n).drop("recency", label)


def labels_set(
    master: DataFrame,
    n: int = PREDICT_ROWS,
    *,
    label: str = LABEL,
    keys: Sequence[str] = (),
    order: str = "bar",
) -> DataFrame:
    """Known labels of the same latest rows."""
    return last_rows(master, keys, order, n).select(*keys, order, label).dropna(subset=[label])

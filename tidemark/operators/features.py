"""Rolling features: one wide universe (20 features per bar) and the per-series form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rolling
from tidemark.functions.ladder import Ladder
from tidemark.functions.scalars import ratio
from tidemark.operators.bars import pivot_wide
from tidemark.operators.frames import is_bounded, over_rows

# Window lengths, symbols of the default universe, output columns.
RETURN_WINDOWS = (1, 5, 10, 20, 60)
VOL_WINDOWS = (5, 10, 20, 60)
CORR_WINDOWS = (20, 60)
DRAWDOWN_ROWS = 60
RSI_ROWS = 14
DEFAULT_ROLES = {"spy": "SPY", "tlt": "TLT", "hyg": "HYG", "vix": "^VIX", "vix3m": "^VIX3M"}
WIDE_COLUMNS = (
    "spy_ret", "spy_adj_close", "tlt_ret", "tlt_adj_close", "hyg_ret", "hyg_adj_close",
    "vix", "vix3m",
)
FEATURE_COLUMNS = (
    "spy_ret_1d", "spy_ret_5d", "spy_ret_10d", "spy_ret_20d", "spy_ret_60d",
    "spy_vol_5d", "spy_vol_10d", "spy_vol_20d", "spy_vol_60d",
    "drawdown_60d",
    "vix", "vix3m", "vix_term",
    "rsi_spy_14",
    "corr_spy_tlt_20d", "corr_spy_hyg_20d", "corr_spy_tlt_60d", "corr_spy_hyg_60d",
    "hyg_tlt_spread",
    "rv_vix_spread_20d",
)
FEATURE_LOOKBACK = 60  # longest frame less one row, plus the row a price change looks back


def wide_bars(
    curated: DataFrame,
    roles: Mapping[str, str] = DEFAULT_ROLES,
    *,
    series: str = "series",
    order: str = "bar",
) -> DataFrame:
    """Five curated series side by side, one row per bar."""
    columns = {}
    for role in ("spy", "tlt", "hyg"):
        columns[f"{role}_ret"] = (roles[role], "ret")
        columns[f"{role}_adj_close"] = (roles[role], "adj_close")
    for role in ("vix", "vix3m"):
        columns[role] = (roles[role], "adj_close")
    return pivot_wide(curated, columns, series=series, order=order)


def _windowed(df, keys, order, steps, back, grain, chunking) -> DataFrame:
    return over_rows(df, keys, order, steps, back=back, grain=grain, **chunking)


def rolling_returns(
    df: DataFrame,
    windows: Sequence[int] = RETURN_WINDOWS,
    *,
    ret: str = "ret",
    prefix: str = "ret_",
    suffix: str = "",
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """Sums of log returns over each window."""
    step = lambda w: {
        f"{prefix}{n}{suffix}": rolling.rolling_sum(F.col(ret), w, n) for n in windows
    }
    return _windowed(df, keys, order, [step], max(windows) - 1, grain, chunking)


def realized_vol(
    df: DataFrame,
    windows: Sequence[int] = VOL_WINDOWS,
    *,
    ret: str = "ret",
    prefix: str = "vol_",
    suffix: str = "",
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """Root of the summed squared returns over each window (not annualised)."""
    step = lambda w: {
        f"{prefix}{n}{suffix}": rolling.realized_vol(F.col(ret), w, n) for n in windows
    }
    return _windowed(df, keys, order, [step], max(windows) - 1, grain, chunking)


def drawdown(
    df: DataFrame,
    n: int = DRAWDOWN_ROWS,
    *,
    price: str = "adj_close",
    out: str | None = None,
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """Fall from the highest price of the window."""
    name = out or f"drawdown_{n}"
    step = lambda w: {name: rolling.drawdown(F.col(price), w, n)}
    return _windowed(df, keys, order, [step], n - 1, grain, chunking)


def _moves(price: str) -> list:
    """Gain and loss of each row against the row before (zero on the first row)."""
    move = F.col("_move")
    return [
        lambda w: {"_move": F.col(price) - F.lag(price).over(w)},
        lambda w: {"_up": rolling.gain(move), "_down": rolling.loss(move)},
    ]


def _rsi_steps(name: str, n: int) -> list:
    up, down = F.col("_gain"), F.col("_loss")

    def means(w):
        f = rolling.frame(w, n)
        return {
            "_gain": rolling.gated(F.avg("_up").over(f), f, n, F.col("_up")),
            "_loss": rolling.gated(F.avg("_down").over(f), f, n, F.col("_down")),
        }

    return [means, lambda w: {name: rolling.strength_index(up, down)}]


def rsi(
    df: DataFrame,
    n: int = RSI_ROWS,
    *,
    price: str = "adj_close",
    out: str | None = None,
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """Relative strength index on simple means."""
    name = out or f"rsi_{n}"
    steps = [*_moves(price), *_rsi_steps(name, n)]
    out = _windowed(df, keys, order, steps, n, grain, chunking)
    return out.drop("_move", "_up", "_down", "_gain", "_loss")


def rolling_corr(
    df: DataFrame,
    a: str,
    b: str,
    windows: Sequence[int] = CORR_WINDOWS,
    *,
    prefix: str = "corr_",
    suffix: str = "",
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    step = lambda w: {
        f"{prefix}{n}{suffix}": rolling.rolling_corr(F.col(a), F.col(b), w, n) for n in windows
    }
    return _windowed(df, keys, order, [step], max(windows) - 1, grain, chunking)


def term_structure(df: DataFrame, far: str = "vix3m", near: str = "vix") -> DataFrame:
    return df.withColumn("vix_term", ratio(F.col(far), F.col(near)))


def return_spread(df: DataFrame, long: str = "hyg_ret", short: str = "tlt_ret") -> DataFrame:
    return df.withColumn("hyg_tlt_spread", F.col(long) - F.col(short))


def implied_spread(df: DataFrame, vol: str = "spy_vol_20d", implied: str = "vix") -> DataFrame:
    """Realised less implied volatility; the units differ (decimal and points) on purpose."""
    return df.withColumn("rv_vix_spread_20d", F.col(vol) - F.col(implied))


def wide_features(
    wide: DataFrame,
    *,
    keys: Sequence[str] = (),
    order: str = "bar",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """All 20 features from wide bars; every frame shares one sort.

    ``keys`` separates universes when the table holds more than one.
    """
    ret, price = F.col("spy_ret"), F.col("spy_adj_close")
    ladder = Ladder(
        VOL_WINDOWS,
        sums={"r": "spy_ret", "rr": "spy_ret * spy_ret"},
        maxima={"px": "spy_adj_close"},
        pairs={"tlt": ("spy_ret", "tlt_ret"), "hyg": ("spy_ret", "hyg_ret")},
    )

    def collect(_w) -> dict[str, Column]:
        cols = {f"spy_ret_{n}d": ladder.total("r", n) for n in RETURN_WINDOWS if n > 1}
        cols["spy_ret_1d"] = ret
        cols |= {f"spy_vol_{n}d": F.sqrt(ladder.total("rr", n)) for n in VOL_WINDOWS}
        cols["drawdown_60d"] = 1.0 - ratio(price, ladder.peak("px", DRAWDOWN_ROWS))
        for n in CORR_WINDOWS:
            cols[f"corr_spy_tlt_{n}d"] = ladder.corr("tlt", n)
            cols[f"corr_spy_hyg_{n}d"] = ladder.corr("hyg", n)
        return cols

    steps = [
        *_moves("spy_adj_close"),
        *_rsi_steps("rsi_spy_14", RSI_ROWS),
        *ladder.steps(),
        collect,
    ]
    out = _windowed(wide, keys, order, steps, FEATURE_LOOKBACK, grain, chunking)
    out = implied_spread(return_spread(term_structure(out)))
    return out.select(*keys, order, *FEATURE_COLUMNS)


def feature_set(
    curated: DataFrame,
    roles: Mapping[str, str] = DEFAULT_ROLES,
    *,
    series: str = "series",
    order: str = "bar",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """Curated long bars -> bar time plus 20 features, one row per bar."""
    wide = wide_bars(curated, roles, series=series, order=order)
    return wide_features(wide, order=order, grain=grain, **chunking)


SERIES_FEATURES = (
    *(f"ret_{n}" for n in RETURN_WINDOWS),
    *(f"vol_{n}" for n in VOL_WINDOWS),
    f"drawdown_{DRAWDOWN_ROWS}",
    f"rsi_{RSI_ROWS}",
    *(f"corr_{n}" for n in CORR_WINDOWS),
    "spread",
)


def universe_features(
    curated: DataFrame,
    benchmark: DataFrame,
    *,
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    grain: str | None = None,
    extra_steps=(),
    ahead: int = 0,
    **chunking,
) -> DataFrame:
    """The same formulas for every series, correlated with one benchmark series.

    Long form: a missing bar is no row at all here, while the wide form has a null
    row that blanks its frames, so the two differ where bars are missing.
    ``benchmark`` is (bar, ret), one row per bar time. ``extra_steps`` lets a
    caller add columns (a label, say) in the same pass.
    """
    bench = benchmark.select(order, F.col("ret").alias("_bench"))
    if is_bounded(grain):
        # One row per bar of an hour or longer: 1.8 million rows in two centuries at most.
        # A shuffle by bar would crowd all series into as few tasks as there are bars.
        bench = F.broadcast(bench)
    joined = curated.join(bench, order, "left")
    ret, other = F.col("ret"), F.col("_bench")

    ladder = Ladder(
        VOL_WINDOWS,
        sums={"r": "ret", "rr": "ret * ret"},
        maxima={"px": "adj_close"},
        pairs={"b": ("ret", "_bench")},
    )

    def collect(_w) -> dict[str, Column]:
        cols = {f"ret_{n}": ladder.total("r", n) for n in RETURN_WINDOWS if n > 1}
        cols["ret_1"] = ret
        cols |= {f"vol_{n}": F.sqrt(ladder.total("rr", n)) for n in VOL_WINDOWS}
        cols[f"drawdown_{DRAWDOWN_ROWS}"] = 1.0 - ratio(
            F.col("adj_close"), ladder.peak("px", DRAWDOWN_ROWS)
        )
        cols |= {f"corr_{n}": ladder.corr("b", n) for n in CORR_WINDOWS}
        cols["spread"] = ret - other
        return cols

    steps = [
        *_moves("adj_close"),
        *_rsi_steps(f"rsi_{RSI_ROWS}", RSI_ROWS),
        *ladder.steps(),
        collect,
        *extra_steps,
    ]
    out = over_rows(
        joined, keys, order, steps, back=FEATURE_LOOKBACK, ahead=ahead, grain=grain, **chunking
    )
    kept = [c for c in out.columns if c not in curated.columns and not c.startswith("_")]
    labels = [c for c in kept if c not in SERIES_FEATURES]
    return out.select(*keys, order, *SERIES_FEATURES, *labels)

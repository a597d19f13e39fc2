"""Volatility baselines per series on a parameter grid: GARCH(1,1) and ARMA(1,1).

Both models are linear recurrences along a series. A series is cut into chunks of
at most ``rows`` observations, so one array never exceeds that length. Over a chunk the
state is an affine function of the state before it, ``a + b * state``: each chunk gives
its ``a`` and ``b`` for every grid point, and the chunks are walked once more from their
exact starting states. Maps are composed by levels, ``FAN`` neighbours at a time, up to one
map per series; states come down the same levels. So no task sees a series' list of
chunks, and the number of levels is the logarithm of that list's length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import tasks
from tidemark.operators.frames import Slot, attach_group_value, number_rows
from tidemark.operators.monitor import metric_aggregates
from tidemark.sources.store import stored
from tidemark.sources.workers import shipped

ROWS = 4096
FAN = 256
#: Rows per chunk where every row's own state is wanted.
STEP_ROWS = 64
GARCH_ALPHAS = (0.02, 0.05, 0.1, 0.2)
GARCH_BETAS = (0.5, 0.7, 0.9, 0.95)
ARMA_GRID = (-0.8, -0.4, 0.0, 0.4, 0.8)


def _pairs(a: Sequence[float], b: Sequence[float], names: tuple[str, str], keep) -> Column:
    return F.array(
        *[
            F.struct(F.lit(float(x)).alias(names[0]), F.lit(float(y)).alias(names[1]))
            for x in a
            for y in b
            if keep(x, y)
        ]
    )


def _chunks(
    df: DataFrame, value: str, by: Sequence[str], order: str, rows: int, grain, slot
) -> DataFrame:
    """(by, chunk, mean, var, xs): demeaned observations in order, bounded per chunk."""
    present = df.where(F.col(value).isNotNull()).select(*by, order, F.col(value).alias("_v"))
    stats = present.groupBy(*by).agg(
        F.avg("_v").alias("mean"), F.var_pop("_v").alias("variance"), F.count("_v").alias("n")
    )
    numbered = number_rows(present, by, order, grain=grain, slot=slot, position="_pos", total="_t")
    joined = attach_group_value(numbered.drop("_t"), stats, by, order)
    chunk = F.floor((F.col("_pos") - 1) / F.lit(rows)).alias("chunk")
    point = F.struct("_pos", (F.col("_v") - F.col("mean")).alias("x"))
    lists = joined.groupBy(*by, chunk).agg(
        F.max("mean").alias("mean"),
        F.max("variance").alias("variance"),
        F.max("n").alias("n"),
        F.array_sort(F.collect_list(point)).alias("_points"),
    )
    return lists.withColumn("xs", F.transform("_points", lambda p: p["x"])).drop("_points")


def observations(
    df: DataFrame, value: str, by: Sequence[str], order: str, rows: int = ROWS, grain: str | None = None, slot: Slot = None
) -> DataFrame:
    """The chunks that both grids walk, written once."""
    return stored(_chunks(df, value, by, order, rows, grain, slot), "observations")


def _compose(c: Column) -> Column:
    """The maps of neighbouring chunks, in order, as one map for every grid point."""
    same = F.transform(c[0]["m"], lambda m: F.struct(F.lit(0.0).alias("a"), F.lit(1.0).alias("b")))
    after = lambda s, m: F.struct((m["a"] + m["b"] * s["a"]).alias("a"), (m["b"] * s["b"]).alias("b"))
    return F.aggregate(c, same, lambda s, e: F.zip_with(s, e["m"], after))


def _families(level: DataFrame, by: Sequence[str], fan: int) -> DataFrame:
    """(by, _up, _c, _first): up to ``fan`` neighbours in order, under their number one level up."""
    entry = F.struct("chunk", F.col("_m").alias("m"))
    parent = F.floor(F.col("chunk") / F.lit(fan)).cast("long").alias("_up")
    return level.groupBy(*by, parent).agg(F.array_sort(F.collect_list(entry)).alias("_c"), F.max("_first").alias("_first"))


def _starts(
    chunks: DataFrame, by: Sequence[str], maps: Column, first: Column, fan: int | None = None
) -> DataFrame:
    """(by, chunk, _h): each chunk's starting states, by a prefix composition over levels.

    ``maps`` has (a, b) of the chunk for every grid point, ``first`` the states that the
    series starts from. A list holds ``fan`` entries at most.
    """
    fan = fan or FAN
    level = chunks.select(*by, F.col("chunk").cast("long").alias("chunk"), maps.alias("_m"), first.alias("_first"))
    levels = [stored(level, "maps")]
    top = levels[0].agg(F.max("chunk")).first()[0] or 0
    while top >= fan:
        up = _families(levels[-1], by, fan).select(*by, F.col("_up").alias("chunk"), _compose(F.col("_c")).alias("_m"), "_first")
        levels.append(stored(up, "maps"))
        top //= fan
    states = "array<struct<chunk:bigint,h:array<double>>>"

    def step(s, c):
        after = F.zip_with(s["h"], c["m"], lambda h, m: m["a"] + m["b"] * h)
        seen = F.struct(c["chunk"].alias("chunk"), s["h"].alias("h"))
        return F.struct(after.alias("h"), F.concat(s["seen"], F.array(seen)).alias("seen"))

    starts = None
    for level in reversed(levels):
        family = _families(level, by, fan).withColumn("_begin", F.col("_first"))
        if starts is not None:
            above = starts.select(*by, F.col("chunk").alias("_up"), F.col("_h").alias("_begin"))
            family = family.drop("_begin").join(above, [*by, "_up"])
        begin = F.struct(F.col("_begin").alias("h"), F.array().cast(states).alias("seen"))
        walked = family.select(*by, F.explode(F.aggregate("_c", begin, step)["seen"]).alias("_s"))
        starts = walked.select(*by, F.col("_s.chunk").alias("chunk"), F.col("_s.h").alias("_h"))
    return starts


def _with_row_before(chunks: DataFrame, by: Sequence[str], first: Column) -> DataFrame:
    """Add ``_x0``, the last observation of the chunk before (``first`` for a series' first chunk)."""
    ends = chunks.select(*by, (F.col("chunk") + 1).alias("chunk"), F.element_at("xs", -1).alias("_x0"))
    return chunks.join(ends, [*by, "chunk"], "left").withColumn("_x0", F.when(F.col("chunk") == 0, first).otherwise(F.col("_x0")))


def _walked(chunks: DataFrame, keep: Sequence[str], more: Column, kernel, grid: Sequence[tuple[float, float]], names: Sequence[str]) -> DataFrame:
    """Each chunk walked from its exact starting states, side by side with others: a row for each chunk and grid point."""
    shipped(chunks.sparkSession)
    rows = chunks.select(*keep, "xs", "_h", more.alias("_more"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(keep)])
    return rows.mapInArrow(tasks.walks(len(keep), kernel, grid, names), f"{kept}, " + ", ".join(f"{c} double" for c in names))


def garch_grid(
    df: DataFrame,
    value: str,
    *,
    by: Sequence[str] = ("series",),
    order: str = "bar",
    alphas: Sequence[float] = GARCH_ALPHAS,
    betas: Sequence[float] = GARCH_BETAS,
    rows: int = ROWS,
    grain: str | None = None,
    slot: Slot = None,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """Log likelihood of variance-targeted GARCH(1,1) for every stable (alpha, beta).

    ``h[1] = v``, ``h[t] = v (1 - alpha - beta) + alpha x[t-1]^2 + beta h[t-1]``
    with ``v`` the variance of the series. ``chunks``: the rows' ``observations``, where they are stored already.
    """
    chunks = observations(df, value, by, order, rows, grain, slot) if chunks is None else chunks
    chunks = chunks.where("variance > 0").withColumn("_grid", _pairs(alphas, betas, ("alpha", "beta"), lambda a, b: a + b < 1))
    v = F.col("variance")

    # A chunk's offset depends on alpha through one sum of squares for each beta only.
    def squares(beta):
        return F.aggregate("xs", F.lit(0.0), lambda s, x: x * x + beta * s)

    n = F.size("xs")
    sums = {f"_s{i}": squares(float(b)) for i, b in enumerate(betas)}

    def offset(alpha, beta, i):
        still = v * (1.0 - alpha - beta) * (1.0 - F.pow(F.lit(beta), n)) / (1.0 - beta)
        return F.struct((still + alpha * F.col(f"_s{i}")).alias("a"), F.pow(F.lit(beta), n).alias("b"))

    maps = F.array(*[offset(float(a), float(b), i) for a in alphas for i, b in enumerate(betas) if a + b < 1])
    starts = _starts(chunks.withColumns(sums), by, maps, F.transform("_grid", lambda g: v))

    begun = chunks.join(starts, [*by, "chunk"])
    grid = [(float(a), float(b)) for a in alphas for b in betas if a + b < 1]
    walked = _walked(begun, [*by, "chunk", "n", "variance"], v, tasks.garch_kernel, grid, ("alpha", "beta", "_h", "_ll"))
    return walked.groupBy(*by, "alpha", "beta").agg(
        F.max("n").alias("n"),
        F.max("variance").alias("variance"),
        F.sum("_ll").alias("loglik"),
        F.max_by("_h", "chunk").alias("next_variance"),
    )


def garch_best(grid: DataFrame, by: Sequence[str] = ("series",)) -> DataFrame:
    best = F.max_by(
        F.struct("alpha", "beta", "n", "variance", "loglik", "next_variance"), "loglik"
    )
    return grid.groupBy(*by).agg(best.alias("_b")).select(*by, "_b.*")


def garch_forecast(best: DataFrame, steps: int, by: Sequence[str] = ("series",)) -> DataFrame:
    """Volatility ``k`` steps ahead: the variance returns to its mean geometrically."""
    decay = F.pow(F.col("alpha") + F.col("beta"), F.col("step") - 1)
    variance = F.col("variance") + decay * (F.col("next_variance") - F.col("variance"))
    horizon = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")
    return best.select("*", horizon).select(*by, "step", F.sqrt(variance).alias("volatility"))


def arma_grid(
    df: DataFrame,
    value: str,
    *,
    by: Sequence[str] = ("series",),
    order: str = "bar",
    grid: Sequence[float] = ARMA_GRID,
    rows: int = ROWS,
    grain: str | None = None,
    slot: Slot = None,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """Conditional sum of squares of ARMA(1,1) for every (phi, theta) on the grid.

    ``e[t] = x[t] - phi x[t-1] - theta e[t-1]`` with zero before the first row. ``chunks`` as for GARCH.
    """
    chunks = observations(df, value, by, order, rows, grain, slot) if chunks is None else chunks
    chunks = _with_row_before(chunks, by, F.lit(0.0)).withColumn("_grid", _pairs(grid, grid, ("phi", "theta"), lambda a, b: True))

    # A chunk's offset is one sum of the rows less phi times one of the rows before them, for each theta.
    def both(theta):
        begin = F.struct(F.lit(0.0).alias("own"), F.lit(0.0).alias("before"), F.col("_x0").alias("x"))
        return F.aggregate(
            "xs",
            begin,
            lambda s, x: F.struct(
                (x - theta * s["own"]).alias("own"), (s["x"] - theta * s["before"]).alias("before"), x.alias("x")
            ),
        )

    sums = {f"_s{i}": both(float(t)) for i, t in enumerate(grid)}

    def offset(phi, theta, i):
        a = F.col(f"_s{i}.own") - phi * F.col(f"_s{i}.before")
        return F.struct(a.alias("a"), F.pow(F.lit(-theta), F.size("xs")).alias("b"))

    maps = F.array(*[offset(float(p), float(t), i) for p in grid for i, t in enumerate(grid)])
    starts = _starts(chunks.withColumns(sums), by, maps, F.transform("_grid", lambda g: F.lit(0.0)))
    begun = chunks.join(starts, [*by, "chunk"])
    points = [(float(p), float(t)) for p in grid for t in grid]
    walked = _walked(begun, [*by, "chunk", "n", "mean"], F.col("_x0"), tasks.arma_kernel, points, ("phi", "theta", "_x", "_e", "_sse"))
    return walked.groupBy(*by, "phi", "theta").agg(
        F.max("n").alias("n"),
        F.max("mean").alias("mean"),
        F.sum("_sse").alias("sse"),
        F.max_by("_x", "chunk").alias("last_x"),
        F.max_by("_e", "chunk").alias("last_e"),
    )


def arma_best(grid: DataFrame, by: Sequence[str] = ("series",)) -> DataFrame:
    best = F.min_by(F.struct("phi", "theta", "n", "mean", "sse", "last_x", "last_e"), "sse")
    return grid.groupBy(*by).agg(best.alias("_b")).select(*by, "_b.*")


def arma_forecast(best: DataFrame, steps: int, by: Sequence[str] = ("series",)) -> DataFrame:
    """``k`` steps ahead: the first step uses the last shock, later ones decay by ``phi``."""
    first = F.col("phi") * F.col("last_x") + F.col("theta") * F.col("last_e")
    decay = F.when(F.col("step") == 1, 1.0).otherwise(F.pow("phi", F.col("step") - 1))
    horizon = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")
    return best.select("*", horizon).select(
        *by, "step", (F.col("mean") + decay * first).alias("forecast")
    )


def holdout_forecasts(
    df: DataFrame,
    value: str,
    *,
    by: Sequence[str] = ("series",),
    order: str = "bar",
    split: str = "split",
    rows: int = STEP_ROWS,
    grain: str | None = None,
    slot: Slot = None,
) -> DataFrame:
    """(by, order, split, value, and four forecasts) of the rows after each series' train rows.

    Parameters, mean and variance come from train alone. ``garch_path`` and ``arma_path``
    forecast every later row from the end of train; ``garch_step`` and ``arma_step`` know the
    rows before the one they forecast (for a label that looks ahead this is an upper bound of
    what can be known). Rows without a value and series without train rows are left out;
    a series whose train rows are constant has no GARCH forecast.
    """
    train = df.where(F.col(split) == "train")
    options = {"by": by, "order": order, "grain": grain, "slot": slot}
    options["chunks"] = observations(train, value, by, order, grain=grain, slot=slot)
    garch = garch_best(garch_grid(train, value, **options), by).select(*by, "alpha", "beta", "variance", "next_variance")
    arma = arma_best(arma_grid(train, value, **options), by).select(*by, "phi", "theta", "mean", "last_x", "last_e")
    fitted = stored(arma.join(garch, list(by), "left"), "fitted")
    held = df.where((F.col(split) != "train") & F.col(value).isNotNull()).select(*by, order, split, F.col(value).alias("_v"))
    numbered = number_rows(held, by, order, grain=grain, slot=slot, position="_k", total="_t").drop("_t")
    joined = attach_group_value(numbered, fitted, by, order)
    names = ("alpha", "beta", "variance", "next_variance", "phi", "theta", "mean", "last_x", "last_e")
    chunk = F.floor((F.col("_k") - 1) / F.lit(rows)).cast("long").alias("chunk")
    point = F.struct("_k", order, split, "_v")
    lists = joined.groupBy(*by, chunk).agg(
        F.array_sort(F.collect_list(point)).alias("_points"), *[F.max(c).alias(c) for c in names]
    )
    lists = stored(lists.withColumn("xs", F.transform("_points", lambda p: p["_v"] - F.col("mean"))), "holdout")
    lists = _with_row_before(lists, by, F.col("last_x"))
    base = F.col("variance") * (1.0 - F.col("alpha") - F.col("beta"))

    def after(s, x):
        return F.struct(
            (base + F.col("alpha") * x * x + F.col("beta") * s["h"]).alias("h"),
            (x - F.col("phi") * s["x"] - F.col("theta") * s["e"]).alias("e"),
            x.alias("x"),
        )

    nil = F.struct(F.lit(0.0).alias("h"), F.lit(0.0).alias("e"), F.col("_x0").alias("x"))
    lists = lists.withColumn("_end", F.aggregate("xs", nil, after))
    maps = F.array(
        F.struct(F.col("_end.h").alias("a"), F.pow("beta", F.size("xs")).alias("b")),
        F.struct(F.col("_end.e").alias("a"), F.pow(-F.col("theta"), F.size("xs")).alias("b")),
    )
    starts = _starts(lists, by, maps, F.array("next_variance", "last_e"))
    seen = "array<struct<h:double,e:double,x:double>>"

    def step(s, x):
        return F.struct(after(s["now"], x).alias("now"), F.concat(s["seen"], F.array(s["now"])).alias("seen"))

    start = F.struct(F.col("_h")[0].alias("h"), F.col("_h")[1].alias("e"), F.col("_x0").alias("x"))
    begin = F.struct(start.alias("now"), F.array().cast(seen).alias("seen"))
    states = F.aggregate("xs", begin, step)["seen"]
    rows_ = F.explode(F.zip_with("_points", states, lambda p, s: F.struct(p.alias("p"), s.alias("s")))).alias("_r")
    flat = lists.join(starts, [*by, "chunk"]).select(*by, *names, rows_)
    steps = F.col("_r.p._k") - 1
    first = F.col("phi") * F.col("last_x") + F.col("theta") * F.col("last_e")
    far = F.col("variance") + F.pow(F.col("alpha") + F.col("beta"), steps) * (F.col("next_variance") - F.col("variance"))
    return flat.select(
        *by,
        F.col(f"_r.p.{order}").alias(order),
        F.col(f"_r.p.{split}").alias(split),
        F.col("_r.p._v").alias(value),
        F.sqrt(far).alias("garch_path"),
        F.sqrt("_r.s.h").alias("garch_step"),
        (F.col("mean") + F.when(steps == 0, 1.0).otherwise(F.pow("phi", steps)) * first).alias("arma_path"),
        (F.col("mean") + F.col("phi") * F.col("_r.s.x") + F.col("theta") * F.col("_r.s.e")).alias("arma_step"),
    )


def forecast_errors(
    scored: DataFrame, candidates: Sequence[str], value: str, *, split: str = "split"
) -> DataFrame:
    """(model, split, n, rmse, mae, r2) of forecast columns, in one aggregate; each over the rows it has a forecast for."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("model"), F.col(c).alias("p")) for c in candidates])).alias("_c")
    long = scored.select(split, value, cells).where("_c.p IS NOT NULL")
    return long.groupBy(F.col("_c.model").alias("model"), split).agg(
        F.count(F.lit(1)).alias("n"), *metric_aggregates(value, "_c.p")
    )


def ranking(errors: DataFrame, *, split: str = "split") -> DataFrame:
    """One row per candidate, ranked by its validation error (ties by name).

    The candidates are named by the plan, so their ranking is a handful of rows.
    """
    pick = lambda part, name: F.max(F.when(F.col(split) == part, F.col(name))).alias(f"{part}_{name}")
    wide = errors.groupBy("model").agg(*[pick(part, c) for part in ("val", "test") for c in ("n", "rmse", "mae", "r2")])
    order = Window.partitionBy(F.lit(0)).orderBy(F.round("val_rmse", 8).asc_nulls_last(), "model")
    return wide.withColumn("rank", F.row_number().over(order).cast("long"))

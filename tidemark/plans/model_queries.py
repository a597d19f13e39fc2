"""Fitted models. The linear grid is stated in SQL; of the trees SQL states what can be told without fitting them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import baselines, models, prep, split
from tidemark.operators.features import SERIES_FEATURES
from tidemark.plans.common import (
    LINE_GRAIN,
    SCORED_ALL,
    SUPPLIER_ALL,
    known,
    rounded,
    scored_wide,
    sql_round,
    supplier_features,
)
from tidemark.sources import store

QUERIES, ORACLE = {}, {}
COLUMNS = ("vol_5", "vol_10", "vol_20", "vol_60", "drawdown_60", "rsi_14", "corr_20", "spread")
HAR = ("vol_5", "vol_20", "vol_60")


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def training_table(spark, sf):
    """Labelled supplier rows cut by one calendar, written once: learners pass over their input many times."""
    master = supplier_features(spark, sf, label=True).select("series", "bar", "rv_5d", *COLUMNS)
    labelled = master.where("rv_5d IS NOT NULL")
    rows = split.by_calendar(labelled, lambda bars: split.time_split(bars, label="bar", grain=LINE_GRAIN))
    whole = F.expr(_COMPLETE)
    return store.stored(rows.where((F.col("split") == "test") | whole), "training")


def complete(df):
    return df.dropna(subset=list(COLUMNS))


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in COLUMNS)
CALENDAR = """labelled AS (SELECT * FROM supplier_master WHERE rv_5d IS NOT NULL),
 calendar AS (
  SELECT bar, CASE WHEN rn > pre THEN 'test'
         WHEN rn > pre - greatest(1, CAST(floor(pre * 0.2) AS BIGINT)) THEN 'val' ELSE 'train' END AS split
  FROM (SELECT bar, row_number() OVER (ORDER BY bar) AS rn, greatest(count(*) OVER () - 30, 0) AS pre
        FROM (SELECT DISTINCT bar FROM labelled) d) c)"""
SPLIT_ROWS = f"""split_rows AS (SELECT l.*, split FROM labelled l JOIN calendar USING (bar)
  WHERE split = 'test' OR ({_COMPLETE}))"""
TRAINING = f"training AS (SELECT * FROM split_rows WHERE {_COMPLETE})"
TRAINING_CTES = (*SUPPLIER_ALL, CALENDAR, SPLIT_ROWS, TRAINING)

# ---- the linear grid in SQL: moments, coordinate descent, errors ------------------------

SWEEPS = 400
_P = len(COLUMNS)


def _sql_moments(source: str, key: str) -> str:
    mean = ", ".join(f"avg({c})" for c in COLUMNS)
    dev = ", ".join(f"stddev_pop({c})" for c in COLUMNS)
    gram = ", ".join(
        "[" + ", ".join(f"covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b}))" for b in COLUMNS) + "]"
        for a in COLUMNS
    )
    cross = ", ".join(f"covar_pop({c}, rv_5d) / stddev_pop({c})" for c in COLUMNS)
    return f"""m AS MATERIALIZED (SELECT {key} AS k, count(*) AS n, [{mean}] AS mu, [{dev}] AS sd, avg(rv_5d) AS my,
         [{gram}] AS g, [{cross}] AS c FROM {source} GROUP BY 1)"""


def _sql_candidates() -> str:
    rows = []
    for name, (family, alpha, ratio) in models.linear_candidates().items():
        l1, l2, per_row = (0, 0, alpha) if family == "ridge" else (alpha * ratio, alpha * (1 - ratio), 0)
        rows.append(f"('{name}', {l1!r}::DOUBLE, {l2!r}::DOUBLE, {per_row!r}::DOUBLE)")
    return f"candidates(model, l1, l2, per_row) AS (VALUES {', '.join(rows)})"


DESCENT = f"""penalties AS MATERIALIZED (
  SELECT k, model, l1, l2 + per_row / n AS l2, g, c FROM m, candidates),
 walk AS (
  SELECT k, model, 0 AS t, list_transform(range({_P}), lambda i: 0.0::DOUBLE) AS w FROM penalties
  UNION ALL
  SELECT k, model, t + 1, w[1:j - 1] || [CASE WHEN rho > 0 THEN 1 ELSE -1 END * greatest(abs(rho) - l1, 0) / (gjj + l2)] || w[j + 1:{_P}]
  FROM (SELECT w.k, w.model, w.t, w.w, p.l1, p.l2, w.t % {_P} + 1 AS j, p.g[w.t % {_P} + 1][w.t % {_P} + 1] AS gjj,
               p.c[w.t % {_P} + 1] - list_dot_product(p.g[w.t % {_P} + 1], w.w)
                 + p.g[w.t % {_P} + 1][w.t % {_P} + 1] * w.w[w.t % {_P} + 1] AS rho
        FROM walk w JOIN penalties p ON w.k = p.k AND w.model = p.model WHERE w.t < {_P * SWEEPS}) s),
 weights AS (SELECT k, model, w FROM walk WHERE t = {_P * SWEEPS})"""
PREDICTED = "my + " + " + ".join(f"w[{i + 1}] * ({c} - mu[{i + 1}]) / sd[{i + 1}]" for i, c in enumerate(COLUMNS))
SQUARE, ABSOLUTE = "power(p - rv_5d, 2)", "abs(p - rv_5d)"


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@query(
    _recursive(
        sql_round(
            f"""SELECT model, split, count(*) AS n, sqrt(avg({SQUARE})) AS rmse, avg({ABSOLUTE}) AS mae,
                      1 - avg({SQUARE}) / var_pop(rv_5d) AS r2
               FROM (SELECT t.split, t.rv_5d, x.model, {PREDICTED} AS p FROM training t, weights x, m) s
               GROUP BY model, split""",
            ("rmse", "mae", "r2"),
            (*TRAINING_CTES, _sql_moments("training WHERE split = 'train'", "1"), _sql_candidates(), DESCENT),
        )
    )
)
def linear_models(spark, sf):
    """Ridge, lasso and elastic net over their whole grids on standardised features."""
    return rounded(models.linear_models(training_table(spark, sf), COLUMNS))


SUMS = """sums AS (
  SELECT avg(vol_5) AS m1, avg(vol_20) AS m2, avg(vol_60) AS m3, avg(rv_5d) AS my,
         var_pop(vol_5) AS c11, covar_pop(vol_5, vol_20) AS c12, covar_pop(vol_5, vol_60) AS c13,
         var_pop(vol_20) AS c22, covar_pop(vol_20, vol_60) AS c23, var_pop(vol_60) AS c33,
         covar_pop(vol_5, rv_5d) AS y1, covar_pop(vol_20, rv_5d) AS y2, covar_pop(vol_60, rv_5d) AS y3
  FROM training WHERE split = 'train')"""


def _solved(penalty: str = "0") -> str:
    """Weights of three features from the sums, with ``penalty`` on the diagonal."""
    out = """weights AS (
  SELECT m1, m2, m3, my,
         (y1 * (c22 * c33 - c23 * c23) - c12 * (y2 * c33 - c23 * y3)
          + c13 * (y2 * c23 - c22 * y3)) / det AS w1,
         (c11 * (y2 * c33 - y3 * c23) - y1 * (c12 * c33 - c23 * c13)
          + c13 * (c12 * y3 - y2 * c13)) / det AS w2,
         (c11 * (c22 * y3 - c23 * y2) - c12 * (c12 * y3 - y2 * c13)
          + y1 * (c12 * c23 - c22 * c13)) / det AS w3
  FROM (SELECT *, c11 * (c22 * c33 - c23 * c23) - c12 * (c12 * c33 - c23 * c13)
               + c13 * (c12 * c23 - c22 * c13) AS det FROM sums) d)"""
    for c in ("c11", "c22", "c33"):
        out = out.replace(c, f"({c} + {penalty})")
    return out


THREE = """SELECT t.split, count(*) AS n, sqrt(avg(power(p - rv_5d, 2))) AS rmse,
                  avg(abs(p - rv_5d)) AS mae,
                  1 - avg(power(p - rv_5d, 2)) / var_pop(rv_5d) AS r2
           FROM (SELECT t.*, w.my + w.w1 * (t.vol_5 - w.m1) + w.w2 * (t.vol_20 - w.m2)
                        + w.w3 * (t.vol_60 - w.m3) AS p
                 FROM training t CROSS JOIN weights w) t
           GROUP BY t.split"""


@query(sql_round(THREE, ("rmse", "mae", "r2"), (*TRAINING_CTES, SUMS, _solved())))
def har_rv(spark, sf):
    """Errors of the unpenalised linear model on volatilities of three horizons."""
    rows = complete(training_table(spark, sf))
    model = models.har_rv(rows.where("split = 'train'"), HAR)
    return rounded(models.split_metrics(model.transform(models.assemble(rows, HAR))))


@query(
    sql_round(
        THREE,
        ("rmse", "mae", "r2"),
        (*TRAINING_CTES, SUMS.replace("SELECT avg(vol_5)", "SELECT count(*) AS rows_, avg(vol_5)"), _solved(f"{models.STACK_ALPHA} / rows_")),
    )
)
def extended_stack(spark, sf):
    """Ridge on three base forecasts of the label."""
    rows = complete(training_table(spark, sf))
    model = models.stack_models(rows.where("split = 'train'"), HAR)
    return rounded(models.split_metrics(model.transform(models.assemble(rows, HAR))))


@query(
    sql_round(
        """SELECT t.series, t.bar, 'har' AS model_name, w.my + w.w1 * (t.vol_5 - w.m1) + w.w3 * (coalesce(t.vol_60, w.m3) - w.m3) AS prediction
           FROM split_rows t CROSS JOIN weights w WHERE t.split = 'test' AND t.vol_5 IS NOT NULL""",
        ("prediction",),
        (*TRAINING_CTES, SUMS, _solved()),
    )
)
def batch_scoring(spark, sf):
    """The predict job: rows that lack a feature altogether, and some values, are filled with train means and scored."""
    rows = training_table(spark, sf)
    train = complete(rows.where("split = 'train'"))
    model = models.har_rv(train, HAR)
    newest = rows.where("split = 'test' AND vol_5 IS NOT NULL").select("series", "bar", "vol_5", "vol_60")
    filled = prep.impute_means(newest, prep.feature_means(train, HAR), HAR)
    out = models.score(model, models.assemble(filled, HAR), "har", keep=("series", "bar"))
    return rounded(out.drop("prediction_timestamp"))


FOLDED = f"""folded AS (
  SELECT t.*, CASE WHEN rn <= n - {models.FOLDS} * size THEN 0
         ELSE CAST((rn - 1 - (n - {models.FOLDS} * size)) // size + 1 AS BIGINT) END AS test_fold
  FROM training t JOIN (SELECT *, n // {models.FOLDS + 1} AS size FROM (
      SELECT bar, row_number() OVER (ORDER BY bar) AS rn, count(*) OVER () AS n
      FROM (SELECT DISTINCT bar FROM training WHERE split <> 'test') d) c) b USING (bar)
  WHERE split <> 'test')"""


@query(
    _recursive(
        sql_round(
            f"""SELECT model AS config, avg(rmse) AS mean_rmse, stddev_pop(rmse) AS std_rmse, count(*) AS folds
               FROM (SELECT model, k, sqrt(avg({SQUARE})) AS rmse
                     FROM (SELECT x.model, x.k, f.rv_5d, {PREDICTED} AS p
                           FROM folded f JOIN weights x ON f.test_fold = x.k JOIN m ON m.k = x.k) s
                     GROUP BY model, k) e
               GROUP BY model""",
            ("mean_rmse", "std_rmse"),
            (
                *TRAINING_CTES,
                FOLDED,
                _sql_moments(f"folded, (SELECT unnest(range(1, {models.FOLDS + 1})) AS fold) r WHERE test_fold < fold", "fold"),
                _sql_candidates(),
                DESCENT,
            ),
        )
    )
)
def grid_search(spark, sf):
    """Five expanding folds of one calendar over the whole linear grid."""
    rows = complete(training_table(spark, sf)).where("split <> 'test'")
    folded = split.by_calendar(rows, lambda bars: split.ts_folds(bars, models.FOLDS, grain=LINE_GRAIN))
    return rounded(models.linear_grid_search(folded, COLUMNS))


# ---- trees: rows, label and baseline in SQL, and that a fit beats the baseline on its own rows ----

_FITTED: dict = {}


def fitted(spark, sf, name, estimator, rows=None):
    """(model, assembled rows): one fit per session, table and name, as several queries look at it; ``rows``: assembled already."""
    key = (spark.sparkContext.applicationId, sf, name)
    rows = models.assemble(complete(training_table(spark, sf)), COLUMNS) if rows is None else rows
    if key not in _FITTED:
        _FITTED[key] = estimator.fit(rows.where("split = 'train'"))
    return _FITTED[key], rows


def tree_facts(name, model, rows):
    """Per split: rows, label mean, error of the train mean, and whether the fit beats it on its own rows."""
    mean = rows.where("split = 'train'").agg(F.avg("rv_5d")).first()[0]
    scored = model.transform(rows).withColumn("_base", F.lit(mean))
    rmse = lambda p: F.sqrt(F.avg((F.col(p) - F.col("rv_5d")) ** 2))
    facts = scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.avg("rv_5d").alias("label_mean"), rmse("_base").alias("baseline_rmse"),
        (rmse(models.PREDICTION) < rmse("_base")).alias("_better"),
    )
    better = F.when(F.col("split") == "train", F.col("_better"))
    return facts.select(F.lit(name).alias("model"), "split", "n", "label_mean", "baseline_rmse", better.alias("fits"))


def _sql_facts(*names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return sql_round(
        f"""SELECT model, split, count(*) AS n, avg(rv_5d) AS label_mean, sqrt(avg(power(rv_5d - base, 2))) AS baseline_rmse,
                  CASE WHEN split = 'train' THEN true END AS fits
           FROM training, (SELECT unnest([{listed}]) AS model) k,
                (SELECT avg(rv_5d) AS base FROM training WHERE split = 'train') b
           GROUP BY model, split""",
        ("label_mean", "baseline_rmse"),
        TRAINING_CTES,
    )


@query(_sql_facts("forest"))
def forest_model(spark, sf):
    """The forest of the published size."""
    return rounded(tree_facts("forest", *fitted(spark, sf, "forest", models.forest())))


@query(_sql_facts("boosted", "boosted_second"))
def boosted_model(spark, sf):
    """Both boosted families with their published parameters."""
    rows = models.assemble(complete(training_table(spark, sf)), COLUMNS)
    with ThreadPoolExecutor(2) as pool:
        first, second = (job.result()[0] for job in [
            pool.submit(fitted, spark, sf, "boosted", models.boosted(), rows),
            pool.submit(fitted, spark, sf, "second", models.boosted(models.SECOND_PARAMS), rows),
        ])
    one, two = tree_facts("boosted", first, rows), tree_facts("boosted_second", second, rows)
    return rounded(one.unionByName(two))


@query(
    "WITH "
    + ", ".join(TRAINING_CTES)
    + """
  SELECT DATE '2002-01-01' AS training_date, 'boosted' AS model_name,
         min(bar) FILTER (split = 'train') AS data_start, max(bar) FILTER (split = 'train') AS data_end,
         count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows, true AS fits
  FROM split_rows"""
)
def train_run(spark, sf):
    """The train job: impute, fit, measure, publish model and record."""
    rows = training_table(spark, sf)
    _, record = models.train_run(
        rows, COLUMNS, models.boosted(), "boosted",
        store=store.scratch_path(spark, "runs"), run_date="2002-01-01",
    )
    return record.select(
        "training_date", "model_name", "data_start", "data_end", "train_rows", "test_rows",
        (F.col("train_r2") > 0).alias("fits"),
    )


CURVES = f"""curves AS (
  SELECT model, row_number() OVER (PARTITION BY model ORDER BY bar) AS iteration, rmse
  FROM (SELECT model, bar, round(sqrt(avg(power(prediction - rv_5d, 2))), 8) AS rmse FROM known GROUP BY model, bar) c)"""


@query(
    sql_round(
        f"""SELECT model, patience, CAST(iteration AS INTEGER) AS stopped_at, rmse AS val_rmse FROM (
             SELECT c.model, p.patience, c.best.i AS iteration, c.best.r AS rmse,
                    row_number() OVER (PARTITION BY c.model, p.patience
                      ORDER BY CASE WHEN c.iteration - c.best.i >= p.patience THEN c.iteration END NULLS LAST, c.iteration DESC) AS place
             FROM (SELECT *, min({{'r': rmse, 'i': iteration}}) OVER (PARTITION BY model ORDER BY iteration) AS best FROM curves) c,
                  (SELECT unnest([{', '.join(map(str, models.PATIENCE))}]) AS patience) p) q
           WHERE place = 1""",
        ("val_rmse",),
        (*SCORED_ALL, CURVES),
    )
)
def early_stopping(spark, sf):
    """The patience rule on curves that SQL can state as well: a naive model's error, bar by bar."""
    errors = known(spark, sf).groupBy("model", "bar").agg(
        F.round(F.sqrt(F.avg((F.col("prediction") - F.col("rv_5d")) ** 2)), 8).alias("rmse")
    )
    in_model = Window.partitionBy("model").orderBy("bar")
    curves = store.stored(errors.withColumn("iteration", F.row_number().over(in_model)), "curves")
    return rounded(store.union_layers([models.early_stopping(curves, p, ["model"]) for p in models.PATIENCE]))


@query(f"SELECT unnest([{', '.join(map(str, models.PATIENCE))}]) AS patience, true AS holds, true AS refit")
def stopped_refit(spark, sf):
    """Patience on the validation curve of the boosted fit, and the refit at the best stop."""
    model, rows = fitted(spark, sf, "boosted", models.boosted())
    curve = store.stored(models.learning_curve(model, rows.where("split = 'val'")), "curve")
    stops = store.stored(store.union_layers([models.early_stopping(curve, p) for p in models.PATIENCE]), "stops")
    best = stops.orderBy("val_rmse", "stopped_at").first()["stopped_at"]
    again = models.refit_stopped(models.boosted(), rows.where("split = 'train'"), stops)
    low = curve.where(F.col("iteration") <= F.lit(best)).agg(F.min("rmse")).first()[0]
    holds = (F.col("val_rmse") >= F.lit(low)) & (F.col("stopped_at") <= F.lit(models.FINAL_PARAMS["n_estimators"]))
    return stops.select("patience", holds.alias("holds"), F.lit(again.getNumTrees == best).alias("refit"))


@query(f"SELECT unnest([{', '.join(repr(c) for c in sorted(COLUMNS))}]) AS feature, true AS counted, 1.0::DOUBLE AS total")
def model_importance(spark, sf):
    """Gain of the boosted trees per feature; gains are shares."""
    model, _ = fitted(spark, sf, "boosted", models.boosted())
    table = models.coefficient_table(model, COLUMNS, spark)
    total = table.agg(F.round(F.sum("importance"), 6)).scalar()
    return table.select("feature", (F.col("importance") >= 0).alias("counted"), total.alias("total"))


_GARCH = ", ".join(
    f"({a}::DOUBLE, {b}::DOUBLE)"
    for a in baselines.GARCH_ALPHAS
    for b in baselines.GARCH_BETAS
    if a + b < 1
)


@query(
    "WITH RECURSIVE "
    + ", ".join(SUPPLIER_ALL)
    + f""",
  stats AS (SELECT series, avg(rv_5d) AS m, var_pop(rv_5d) AS v, count(*) AS n
            FROM supplier_master WHERE rv_5d IS NOT NULL GROUP BY series),
  xs AS MATERIALIZED (SELECT a.series, a.rv_5d - s.m AS x, s.v, s.n,
                row_number() OVER (PARTITION BY a.series ORDER BY a.bar) AS t
         FROM supplier_master a JOIN stats s USING (series)
         WHERE a.rv_5d IS NOT NULL AND s.v > 0),
  walk AS (
    SELECT series, alpha, beta, t, v, n, -0.5 * (ln(v) + x * x / v) AS ll,
           v * (1.0 - alpha - beta) + alpha * x * x + beta * v AS h
    FROM xs, (VALUES {_GARCH}) g(alpha, beta) WHERE t = 1
    UNION ALL
    SELECT w.series, w.alpha, w.beta, x.t, w.v, w.n, w.ll - 0.5 * (ln(w.h) + x.x * x.x / w.h),
           w.v * (1.0 - w.alpha - w.beta) + w.alpha * x.x * x.x + w.beta * w.h
    FROM walk w JOIN xs x ON x.series = w.series AND x.t = w.t + 1)
  SELECT series, arg_max(alpha, ll) AS alpha, arg_max(beta, ll) AS beta, max(n) AS n,
         round(max(v), 8) + 0.0 AS variance, round(max(ll), 6) + 0.0 AS loglik,
         round(arg_max(h, ll), 8) + 0.0 AS next_variance
  FROM walk WHERE t = n GROUP BY series"""
)
def garch_grid(spark, sf):
    master = store.stored(scored_wide(spark, sf).select("series", "bar", "rv_5d"), "labels")
    grid = baselines.garch_grid(master, "rv_5d", grain=LINE_GRAIN)
    best = baselines.garch_best(grid)
    return rounded(best.withColumn("loglik", F.round("loglik", 6)))


@query(
    ORACLE["garch_grid"].replace("  SELECT series, arg_max(alpha", ", best AS (SELECT series, arg_max(alpha")
    .replace("round(max(v), 8) + 0.0 AS variance", "max(v) AS variance").replace("round(arg_max(h, ll), 8) + 0.0", "arg_max(h, ll)")
    + """)
  SELECT series, CAST(step AS INTEGER) AS step,
         round(sqrt(variance + power(alpha + beta, step - 1) * (next_variance - variance)), 8) + 0.0 AS volatility
  FROM best, (SELECT unnest(range(1, 6)) AS step) s"""
)
def garch_forecast(spark, sf):
    """Five steps ahead from the likeliest grid point."""
    master = store.stored(scored_wide(spark, sf).select("series", "bar", "rv_5d"), "labels")
    best = baselines.garch_best(baselines.garch_grid(master, "rv_5d", grain=LINE_GRAIN))
    return rounded(baselines.garch_forecast(best, 5))


_ARMA = ", ".join(f"({p}::DOUBLE, {t}::DOUBLE)" for p in baselines.ARMA_GRID for t in baselines.ARMA_GRID)


@query(
    "WITH RECURSIVE "
    + ", ".join(SUPPLIER_ALL)
    + f""",
  stats AS (SELECT series, avg(rv_5d) AS m, count(*) AS n
            FROM supplier_master WHERE rv_5d IS NOT NULL GROUP BY series),
  xs AS MATERIALIZED (SELECT a.series, a.rv_5d - s.m AS x, s.n, s.m,
                row_number() OVER (PARTITION BY a.series ORDER BY a.bar) AS t
         FROM supplier_master a JOIN stats s USING (series) WHERE a.rv_5d IS NOT NULL),
  walk AS (
    SELECT series, phi, theta, t, n, m, x, x AS e, x * x AS sse
    FROM xs, (VALUES {_ARMA}) g(phi, theta) WHERE t = 1
    UNION ALL
    SELECT w.series, w.phi, w.theta, x.t, w.n, w.m, x.x, x.x - w.phi * w.x - w.theta * w.e,
           w.sse + power(x.x - w.phi * w.x - w.theta * w.e, 2)
    FROM walk w JOIN xs x ON x.series = w.series AND x.t = w.t + 1)
  SELECT series, arg_min(phi, sse) AS phi, arg_min(theta, sse) AS theta, max(n) AS n,
         round(max(m), 8) + 0.0 AS mean, round(min(sse), 8) + 0.0 AS sse,
         round(arg_min(x, sse), 8) + 0.0 AS last_x, round(arg_min(e, sse), 8) + 0.0 AS last_e
  FROM walk WHERE t = n GROUP BY series"""
)
def arma_grid(spark, sf):
    master = store.stored(scored_wide(spark, sf).select("series", "bar", "rv_5d"), "labels")
    grid = baselines.arma_grid(master, "rv_5d", grain=LINE_GRAIN)
    return rounded(baselines.arma_best(grid))


@query(
    ORACLE["arma_grid"].replace("  SELECT series, arg_min(phi", ", best AS (SELECT series, arg_min(phi")
    .replace("round(max(m), 8) + 0.0", "max(m)").replace("round(arg_min(x, sse), 8) + 0.0", "arg_min(x, sse)").replace("round(arg_min(e, sse), 8) + 0.0", "arg_min(e, sse)")
    + """)
  SELECT series, CAST(step AS INTEGER) AS step, round(mean + CASE WHEN step = 1 THEN 1.0 ELSE power(phi, step - 1) END
         * (phi * last_x + theta * last_e), 8) + 0.0 AS forecast
  FROM best, (SELECT unnest(range(1, 6)) AS step) s"""
)
def arma_forecast(spark, sf):
    """Five steps ahead from the grid point of least squared error."""
    master = store.stored(scored_wide(spark, sf).select("series", "bar", "rv_5d"), "labels")
    best = baselines.arma_best(baselines.arma_grid(master, "rv_5d", grain=LINE_GRAIN))
    return rounded(baselines.arma_forecast(best, 5))


# ---- hold-out ranking: both baselines next to the linear models --------------------------

def _least_squares(columns, source: str, label: str = "rv_5d") -> str:
    """CTEs that solve an unpenalised regression by elimination on centred moments: table ``fit``."""
    p = len(columns)
    names = [*columns, label]
    cells = [f"covar_pop({a}, {b}) AS c{i}_{j}" for i, a in enumerate(columns) for j, b in enumerate(names)]
    means = [f"avg({c}) AS m{i}" for i, c in enumerate(names)]
    body = f"SELECT {', '.join(means + cells)} FROM {source}"
    for k in range(p):
        keep = [f"m{i}" for i in range(p + 1)] + [f"c{i}_{j}" for i in range(k + 1) for j in range(i, p + 1)]
        less = [
            f"c{i}_{j} - c{i}_{k} * c{k}_{j} / c{k}_{k} AS c{i}_{j}" for i in range(k + 1, p) for j in range(k + 1, p + 1)
        ]
        body = f"SELECT {', '.join(keep + less)} FROM ({body}) e{k}"
    weights = []
    for i in reversed(range(p)):
        known_ = "".join(f" - c{i}_{j} * w{j}" for j in range(i + 1, p))
        weights.append(f"(c{i}_{p}{known_}) / c{i}_{i} AS w{i}")
    return f"fit AS (SELECT *, {', '.join(weights)} FROM ({body}) solved)"


def _fitted_value(columns) -> str:
    return f"m{len(columns)} + " + " + ".join(f"w{i} * ({c} - m{i})" for i, c in enumerate(columns))


#: Volatilities of three horizons and their term structure (far over near).
HAR_TERM = (*HAR, "term")
_TERMED = "termed AS (SELECT *, vol_60 / vol_5 AS term FROM training WHERE vol_5 <> 0)"


def termed(rows):
    return rows.where("vol_5 <> 0").withColumn("term", F.col("vol_60") / F.col("vol_5"))


@query(
    sql_round(
        f"""SELECT split, count(*) AS n, sqrt(avg({SQUARE})) AS rmse, avg({ABSOLUTE}) AS mae, 1 - avg({SQUARE}) / var_pop(rv_5d) AS r2
           FROM (SELECT t.split, t.rv_5d, {_fitted_value(HAR_TERM)} AS p FROM termed t, fit) s GROUP BY split""",
        ("rmse", "mae", "r2"),
        (*TRAINING_CTES, _TERMED, _least_squares(HAR_TERM, "termed WHERE split = 'train'")),
    )
)
def har_rv_term(spark, sf):
    """Errors of the horizon model with its fourth regressor, the term structure; rows without one are left out."""
    rows = termed(complete(training_table(spark, sf)))
    model = models.har_rv(rows.where("split = 'train'"), HAR_TERM)
    return rounded(models.split_metrics(model.transform(models.assemble(rows, HAR_TERM))))


_TRAIN_X = f"""gstats AS (SELECT series, avg(rv_5d) AS m, var_pop(rv_5d) AS v, count(*) AS n FROM training WHERE split = 'train' GROUP BY series),
 xs AS MATERIALIZED (SELECT a.series, a.rv_5d - s.m AS x, s.v, s.n, s.m, row_number() OVER (PARTITION BY a.series ORDER BY a.bar) AS t
   FROM training a JOIN gstats s USING (series) WHERE a.split = 'train'),
 gwalk AS (
   SELECT series, alpha, beta, t, v, n, -0.5 * (ln(v) + x * x / v) AS ll, v * (1.0 - alpha - beta) + alpha * x * x + beta * v AS h
   FROM xs, (VALUES {_GARCH}) g(alpha, beta) WHERE t = 1 AND v > 0
   UNION ALL
   SELECT w.series, w.alpha, w.beta, x.t, w.v, w.n, w.ll - 0.5 * (ln(w.h) + x.x * x.x / w.h),
          w.v * (1.0 - w.alpha - w.beta) + w.alpha * x.x * x.x + w.beta * w.h
   FROM gwalk w JOIN xs x ON x.series = w.series AND x.t = w.t + 1),
 gbest AS MATERIALIZED (SELECT series, arg_max(alpha, ll) AS alpha, arg_max(beta, ll) AS beta, max(v) AS v, arg_max(h, ll) AS h0
   FROM gwalk WHERE t = n GROUP BY series),
 awalk AS (
   SELECT series, phi, theta, t, n, m, x, x AS e, x * x AS sse FROM xs, (VALUES {_ARMA}) g(phi, theta) WHERE t = 1
   UNION ALL
   SELECT w.series, w.phi, w.theta, x.t, w.n, w.m, x.x, x.x - w.phi * w.x - w.theta * w.e, w.sse + power(x.x - w.phi * w.x - w.theta * w.e, 2)
   FROM awalk w JOIN xs x ON x.series = w.series AND x.t = w.t + 1),
 abest AS MATERIALIZED (SELECT series, arg_min(phi, sse) AS phi, arg_min(theta, sse) AS theta, max(m) AS m, arg_min(x, sse) AS x0, arg_min(e, sse) AS e0
   FROM awalk WHERE t = n GROUP BY series),
 held AS MATERIALIZED (SELECT t.series, t.bar, t.split, t.rv_5d, t.rv_5d - b.m AS x, b.*EXCLUDE (series), g.*EXCLUDE (series),
     row_number() OVER (PARTITION BY t.series ORDER BY t.bar) AS k
   FROM training t JOIN abest b ON b.series = t.series LEFT JOIN gbest g ON g.series = t.series WHERE t.split <> 'train'),
 states AS (
   SELECT series, k, h0 AS h, e0 AS e, x0 AS px FROM held WHERE k = 1
   UNION ALL
   SELECT s.series, s.k + 1, d.v * (1.0 - d.alpha - d.beta) + d.alpha * d.x * d.x + d.beta * s.h, d.x - d.phi * s.px - d.theta * s.e, d.x
   FROM states s JOIN held d ON d.series = s.series AND d.k = s.k),
 forecasts AS (SELECT d.*, sqrt(v + power(alpha + beta, k - 1) * (h0 - v)) AS garch_path, sqrt(s.h) AS garch_step,
     m + CASE WHEN k = 1 THEN 1.0 ELSE power(phi, k - 1) END * (phi * x0 + theta * e0) AS arma_path,
     m + phi * s.px + theta * s.e AS arma_step
   FROM held d JOIN states s USING (series, k))"""
_PATHS = ("garch_path", "garch_step", "arma_path", "arma_step")
_CANDIDATES = " UNION ALL ".join(
    [f"SELECT '{c}' AS model, split, rv_5d, {c} AS p FROM forecasts WHERE {c} IS NOT NULL" for c in _PATHS]
    + [f"SELECT 'har' AS model, split, rv_5d, {_fitted_value(HAR_TERM)} AS p FROM termed, fit"]
    + [f"SELECT x.model, t.split, t.rv_5d, {PREDICTED} AS p FROM training t, weights x, m"]
)
_RANKED = ", ".join(
    f"max(CASE WHEN split = '{part}' THEN {c} END) AS {part}_{c}" for part in ("val", "test") for c in ("n", "rmse", "mae", "r2")
)


@query(
    _recursive(
        sql_round(
            f"""SELECT *, row_number() OVER (ORDER BY round(val_rmse, 8) NULLS LAST, model) AS rank
               FROM (SELECT model, {_RANKED}
                     FROM (SELECT model, split, count(*) AS n, sqrt(avg({SQUARE})) AS rmse, avg({ABSOLUTE}) AS mae,
                                  1 - avg({SQUARE}) / var_pop(rv_5d) AS r2
                           FROM ({_CANDIDATES}) c GROUP BY model, split) e GROUP BY model) w""",
            tuple(f"{part}_{c}" for part in ("val", "test") for c in ("rmse", "mae", "r2")),
            (
                *TRAINING_CTES,
                _TRAIN_X,
                _TERMED,
                _sql_moments("training WHERE split = 'train'", "1"),
                _sql_candidates(),
                DESCENT,
                _least_squares(HAR_TERM, "termed WHERE split = 'train'"),
            ),
        )
    )
)
def baseline_ranking(spark, sf):
    """GARCH and ARMA on the rows after train (from its end, and one step ahead), the horizon model and the linear grid, by validation error."""
    rows = complete(training_table(spark, sf))
    held = baselines.holdout_forecasts(rows, "rv_5d", grain=LINE_GRAIN)
    errors = baselines.forecast_errors(held, _PATHS, "rv_5d")
    horizons = termed(rows)
    har = models.har_rv(horizons.where("split = 'train'"), HAR_TERM)
    har_errors = models.split_metrics(har.transform(models.assemble(horizons, HAR_TERM))).withColumn("model", F.lit("har"))
    linear = models.linear_models(rows, COLUMNS)
    every = errors.unionByName(har_errors.select(errors.columns)).unionByName(linear.select(errors.columns))
    return rounded(baselines.ranking(every))


assert set(COLUMNS) <= set(SERIES_FEATURES)

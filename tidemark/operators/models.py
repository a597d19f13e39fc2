"""Regression models on pyspark.ml: linear family, forests, boosted trees, grids, training runs."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

import numpy as np

from tidemark.operators import tasks
from tidemark.operators.growth import SEED
from tidemark.operators.monitor import metric_aggregates, regression_metrics
from tidemark.operators.prep import scale_stats, standardize
from tidemark.sources.workers import shipped

LABEL, PREDICTION, VECTOR = "rv_5d", "prediction", "features"

# Parameters of the published final model and the tuning grids.
FINAL_PARAMS = {
    "n_estimators": 300, "max_depth": 3, "learning_rate": 0.03, "subsample": 0.8,
    "colsample": 0.7, "min_child": 4,
}
SECOND_PARAMS = {
    "n_estimators": 300, "max_depth": 5, "learning_rate": 0.03, "subsample": 0.7,
    "colsample": 0.7, "min_child": 20,
}
FOREST_PARAMS = {"n_estimators": 300, "max_depth": 5}
RIDGE_ALPHAS = (0.001, 0.01, 0.1, 1.0, 10.0, 50.0, 100.0, 1000.0)
LASSO_ALPHAS = (0.001, 0.01, 0.1, 1.0, 10.0, 50.0, 100.0, 1000.0)
ELASTIC_ALPHAS, ELASTIC_RATIOS = (0.001, 0.01, 0.1, 1.0, 10.0), (0.1, 0.5, 0.9)
FOLDS = 5
STACK_ALPHA = 0.1
PATIENCE = (30, 50, 100)
HAR_COLUMNS = ("spy_vol_5d", "spy_vol_20d", "spy_vol_60d", "vix_term")


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=VECTOR).transform(df)


# ---- linear family ------------------------------------------------------------------


def linear(label: str = LABEL, **params) -> LinearRegression:
    return LinearRegression(
        featuresCol=VECTOR, labelCol=label, predictionCol=PREDICTION, standardization=False,
        solver="normal", **params,
    )


def ridge(alpha: float, rows: int, label_std: float, label: str = LABEL) -> LinearRegression:
    """Least squares with the penalty ``alpha * |w|^2`` on the summed squared error.

    The solver averages the error over the rows and scales the label by its
    standard deviation, so the penalty is rescaled by both.
    """
    return linear(label, regParam=alpha / rows * label_std, elasticNetParam=0.0)


def lasso(alpha: float, label: str = LABEL) -> LinearRegression:
    """Penalty ``alpha * |w|_1`` on half the mean squared error."""
    return linear(label, regParam=alpha, elasticNetParam=1.0)


def elastic_net(alpha: float, l1_ratio: float, label_std: float, label: str = LABEL) -> LinearRegression:
    """Half the mean squared error plus ``alpha * (r |w|_1 + (1 - r) / 2 |w|^2)``.

    The solver divides the label by its standard deviation: the L1 part scales back by
    itself, the L2 part is rescaled.
    """
    l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio) * label_std
    return linear(label, regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2) if l1 + l2 else 0.0)


def linear_candidates() -> dict[str, tuple[str, float, float]]:
    """Named (family, alpha, l1 ratio) over the tuning grids."""
    out = {f"ridge_{a:g}": ("ridge", a, 0.0) for a in RIDGE_ALPHAS}
    out |= {f"lasso_{a:g}": ("lasso", a, 1.0) for a in LASSO_ALPHAS}
    return out | {f"elastic_{a:g}_{r:g}": ("elastic", a, r) for a in ELASTIC_ALPHAS for r in ELASTIC_RATIOS}


def linear_grid(rows: int, label_std: float, label: str = LABEL) -> dict[str, LinearRegression]:
    """Estimators of the candidates for train rows with these facts."""
    build = {
        "ridge": lambda a, r: ridge(a, rows, label_std, label),
        "lasso": lambda a, r: lasso(a, label),
        "elastic": lambda a, r: elastic_net(a, r, label_std, label),
    }
    return {name: build[family](a, r) for name, (family, a, r) in linear_candidates().items()}


# ---- the whole linear grid from one set of moments ------------------------------------


def moments(df: DataFrame, columns: Sequence[str], label: str = LABEL, by: Sequence[str] = ()) -> DataFrame:
    """Rows, means and central co-moments of features and label per group: each task adds up its rows, groups merge the tasks' sums.

    Rows with a null among them are left out. Every penalised linear model of a group,
    and its squared error, follows from these few numbers.
    """
    names = [*columns, label]
    shipped(df.sparkSession)
    rows = df.dropna(subset=names).select(*by, *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names)])
    keys = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[: len(by)])
    parts = rows.mapInArrow(tasks.moments(len(by)), f"{keys}n bigint, mean array<double>, m2 array<double>")
    return parts.groupBy(*by).applyInArrow(tasks.covariances(len(by)), f"{keys}n bigint, mean array<double>, cov array<double>")


def as_moment(row) -> tuple[float, np.ndarray, np.ndarray]:
    """(n, means, covariance matrix) of a row of ``moments``."""
    mean = np.array(row["mean"], float)
    cov = np.zeros((len(mean), len(mean)))
    cov[np.triu_indices(len(mean))] = row["cov"]
    return float(row["n"]), mean, cov + np.triu(cov, 1).T


def merged(parts: Sequence) -> tuple[float, np.ndarray, np.ndarray]:
    """Moments of the union of disjoint groups."""
    n, mean, cov = parts[0]
    for m, other, spread in parts[1:]:
        gap = other - mean
        cov = (cov * n + spread * m + np.outer(gap, gap) * n * m / (n + m)) / (n + m)
        mean = mean + gap * m / (n + m)
        n += m
    return n, mean, cov


def penalised_weights(moment, family: str, alpha: float, l1_ratio: float) -> tuple[np.ndarray, float]:
    """(weights, intercept) for the raw features; the penalty holds for features standardised by these moments.

    Ridge in closed form; else coordinate descent on the covariances until nothing moves.
    """
    n, mean, cov = moment
    p = len(mean) - 1
    scale = np.sqrt(np.diag(cov)[:p])
    scale = np.where(scale > 0, scale, 1.0)
    g, c = cov[:p, :p] / np.outer(scale, scale), cov[:p, p] / scale
    if family == "ridge":
        w = np.linalg.solve(g + alpha / n * np.eye(p), c)
    else:
        l1, l2, w = alpha * l1_ratio, alpha * (1.0 - l1_ratio), np.zeros(p)
        for _ in range(100_000):
            moved = 0.0
            for j in range(p):
                rho = c[j] - g[j] @ w + g[j, j] * w[j]
                new = np.sign(rho) * max(abs(rho) - l1, 0.0) / max(g[j, j] + l2, 1e-300)
                moved, w[j] = max(moved, abs(new - w[j])), new
            if moved < 1e-15:
                break
    w = w / scale
    return w, float(mean[p] - w @ mean[:p])


def squared_error(moment, weights: np.ndarray, intercept: float) -> float:
    """Mean squared error of a linear model over the rows behind the moments."""
    _, mean, cov = moment
    v = np.append(-weights, 1.0)
    return float(max(v @ cov @ v, 0.0) + (v @ mean - intercept) ** 2)


def linear_models(df: DataFrame, columns: Sequence[str], *, split: str = "split", label: str = LABEL) -> DataFrame:
    """(model, split, n, rmse, mae, r2) of the whole linear grid: one pass to fit, one to measure."""
    rows = df.dropna(subset=[*columns, label])
    train = as_moment(moments(rows.where(F.col(split) == "train"), columns, label).first())
    fitted = [penalised_weights(train, *candidate) for candidate in linear_candidates().values()]
    inputs = rows.select(split, *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate([*columns, label])])
    key = f"`{split}` {inputs.schema[split].dataType.simpleString()}"
    errors = tasks.linear_errors(np.array([w for w, _ in fitted]), np.array([b for _, b in fitted]))
    parts = inputs.mapInArrow(errors, f"{key}, n bigint, mean array<double>, m2 array<double>, sums array<double>")
    measured = tasks.linear_metrics(list(linear_candidates()))
    return parts.groupBy(split).applyInArrow(measured, f"model string, {key}, n bigint, rmse double, mae double, r2 double")


def linear_grid_search(folded: DataFrame, columns: Sequence[str], k: int = FOLDS, *, fold: str = "test_fold", label: str = LABEL) -> DataFrame:
    """Expanding-window cross validation of the linear grid from one aggregate: mean and spread of the fold errors.

    Fold ``f`` is standardised, fitted and penalised by its own train rows, the folds before it.
    """
    found = {r[fold]: as_moment(r) for r in moments(folded, columns, label, [fold]).collect()}  # k + 1 rows
    rows = []
    for f in range(1, k + 1):
        train = merged([found[i] for i in sorted(found) if i < f])
        for name, candidate in linear_candidates().items():
            rows.append((name, f, squared_error(found[f], *penalised_weights(train, *candidate)) ** 0.5))
    per_fold = folded.sparkSession.createDataFrame(rows, "config string, fold int, rmse double")
    return _over_folds(per_fold)


def _over_folds(per_fold: DataFrame) -> DataFrame:
    return per_fold.groupBy("config").agg(
        F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse"), F.count(F.lit(1)).alias("folds")
    )


def label_facts(train: DataFrame, label: str = LABEL) -> tuple[int, float]:
    """(rows, population standard deviation of the label)."""
    row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return row["n"], row["s"]


def scaled_split(
    df: DataFrame, columns: Sequence[str], split: str = "split"
) -> DataFrame:
    """Standardise all rows by the train rows and assemble the feature vector."""
    stats = scale_stats(df.where(F.col(split) == "train"), columns)
    return assemble(standardize(df, stats, columns), columns)


def har_rv(train: DataFrame, columns: Sequence[str] = HAR_COLUMNS, label: str = LABEL):
    """Unpenalised linear model on volatilities of several horizons."""
    rows = train.dropna(subset=[*columns, label])
    return linear(label, regParam=0.0).fit(assemble(rows, columns))


def stack_models(
    fit_rows: DataFrame, columns: Sequence[str], alpha: float = STACK_ALPHA, label: str = LABEL
):
    """Ridge on any number of base predictions (two have a closed form, see the ensembles)."""
    rows = fit_rows.dropna(subset=[*columns, label])
    n, std = label_facts(rows, label)
    return ridge(alpha, n, std, label).fit(assemble(rows, columns))


def coefficient_table(model, columns: Sequence[str], spark) -> DataFrame:
    """(feature, importance): coefficients or gain, one row per column."""
    values = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    rows = [(c, float(v)) for c, v in zip(columns, values.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


# ---- trees --------------------------------------------------------------------------


def forest(params: Mapping = FOREST_PARAMS, label: str = LABEL) -> Estimator:
    """A bagged forest; a third of the features is tried at a node."""
    return _learner(params, label, bagged=True, features=1 / 3, rate=1.0, l2=0.0, min_child=params.get("min_child", 1))


def boosted(params: Mapping = FINAL_PARAMS, label: str = LABEL) -> Estimator:
    """Gradient-boosted trees; ``SECOND_PARAMS`` is the second, deeper family."""
    return _learner(
        params, label, rate=params["learning_rate"], subsample=params["subsample"],
        colsample=params["colsample"], min_child=params["min_child"], l2=0.0,
    )


def _learner(params: Mapping, label: str, **learner) -> Estimator:
    from tidemark.operators.learners import Trees

    return Trees(
        featuresCol=VECTOR, labelCol=label, predictionCol=PREDICTION, maxIter=params["n_estimators"],
        learner=json.dumps({"depth": params["max_depth"], **learner}),
    )


def gbt(params: Mapping = FINAL_PARAMS, label: str = LABEL) -> GBTRegressor:
    """Spark's own boosted trees, whose samples depend on how the rows are dealt."""
    return GBTRegressor(
        featuresCol=VECTOR, labelCol=label, predictionCol=PREDICTION, seed=SEED,
        maxIter=params["n_estimators"], maxDepth=params["max_depth"],
        stepSize=params["learning_rate"], subsamplingRate=params["subsample"],
        featureSubsetStrategy=str(params["colsample"]),
        minInstancesPerNode=params["min_child"],
    )


def parameter_grid(base: Mapping, **choices: Sequence) -> dict[str, dict]:
    """All combinations of ``choices`` on top of ``base``, named by their values."""
    out = {}
    for values in product(*choices.values()):
        chosen = dict(zip(choices, values))
        name = ",".join(f"{k}={v}" for k, v in chosen.items())
        out[name] = {**base, **chosen}
    return out


# ---- evaluation ---------------------------------------------------------------------


def split_metrics(
    scored: DataFrame, by: Sequence[str] = ("split",), label: str = LABEL
) -> DataFrame:
    return regression_metrics(scored, by, y=label, p=PREDICTION)


def _fit_all(jobs: Mapping, parallel: int) -> dict:
    """Fit independent (estimator, train rows) jobs, submitted from a few threads."""
    with ThreadPoolExecutor(parallel) as pool:
        return dict(zip(jobs, pool.map(lambda job: job[0].fit(job[1]), jobs.values())))


def score_all(fitted: Mapping, df: DataFrame) -> DataFrame:
    """Predictions of every model in one pass, as columns ``_p0``, ``_p1``, ..."""
    for i, model in enumerate(fitted.values()):
        df = model.copy().setPredictionCol(f"_p{i}").transform(df)
    return df


def evaluate_all(
    estimators: Mapping[str, Estimator],
    df: DataFrame,
    *,
    split: str = "split",
    label: str = LABEL,
    parallel: int = 4,
) -> DataFrame:
    """(model, split, n, rmse, mae, r2) of every estimator fitted on the train rows.

    All models are scored and measured in one pass over the rows.
    """
    train = df.where(F.col(split) == "train")
    fitted = _fit_all({name: (e, train) for name, e in estimators.items()}, parallel)
    metrics = [
        F.struct(
            F.lit(name).alias("model"),
            F.count(label).alias("n"),
            *metric_aggregates(label, f"_p{i}"),
        )
        for i, name in enumerate(fitted)
    ]
    wide = score_all(fitted, df).groupBy(split).agg(F.array(*metrics).alias("_m"))
    return wide.select(split, F.explode("_m").alias("_m")).select(
        "_m.model", split, "_m.n", "_m.rmse", "_m.mae", "_m.r2"
    )


def grid_search(
    factories: Mapping,
    folded: DataFrame,
    k: int,
    *,
    fold: str = "test_fold",
    label: str = LABEL,
    parallel: int = 4,
) -> DataFrame:
    """Expanding-window cross validation: mean and spread of the fold errors per config.

    Fold ``f`` trains on earlier folds only (the built-in cross validator would
    train on later ones too). A factory builds its estimator from the fold's train rows
    (row count, label deviation), because penalties depend on them. The configs of a
    fold are measured in one pass.
    """
    folds = range(1, k + 1)
    train = {f: folded.where(F.col(fold) < f) for f in folds}
    facts = {f: label_facts(train[f], label) for f in folds}
    jobs = {(name, f): (make(*facts[f]), train[f]) for name, make in factories.items() for f in folds}
    fitted = _fit_all(jobs, parallel)
    rows = []
    for f in folds:
        models = {name: fitted[name, f] for name in factories}
        errors = [
            metric_aggregates(label, f"_p{i}")[0].alias(f"_e{i}") for i in range(len(models))
        ]
        found = score_all(models, folded.where(F.col(fold) == f)).agg(*errors).first()
        rows += [(name, f, found[f"_e{i}"]) for i, name in enumerate(models)]
    per_fold = folded.sparkSession.createDataFrame(rows, "config string, fold int, rmse double")
    return _over_folds(per_fold)


def learning_curve(model, df: DataFrame) -> DataFrame:
    """(iteration, rmse) of a boosted model on ``df`` after each tree."""
    losses = model.evaluateEachIteration(df, "squared")
    rows = [(i + 1, float(loss) ** 0.5) for i, loss in enumerate(losses)]
    return df.sparkSession.createDataFrame(rows, "iteration int, rmse double")


def early_stopping(curve: DataFrame, patience: int, by: Sequence[str] = ()) -> DataFrame:
    """Tree count at which training stops: the best one once ``patience`` trees brought no gain.

    A curve has one row per tree, so its window is bounded by the tree count.
    """
    sofar = (
        Window.partitionBy(*by)
        .orderBy("iteration")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    tracked = curve.withColumn("_best", F.min(F.struct("rmse", "iteration")).over(sofar))
    waited = F.col("iteration") - F.col("_best.iteration") >= patience
    at_stop = F.min_by("_best", F.when(waited, F.col("iteration")))
    at_end = F.max_by("_best", "iteration")
    chosen = tracked.groupBy(*by).agg(F.coalesce(at_stop, at_end).alias("_b"))
    return chosen.select(
        *by,
        F.lit(patience).alias("patience"),
        F.col("_b.iteration").alias("stopped_at"),
        F.col("_b.rmse").alias("val_rmse"),
    )


def refit_stopped(estimator: Estimator, train: DataFrame, stopped: DataFrame):
    """Fit again with the tree count of the best patience (smallest validation error)."""
    best = stopped.orderBy("val_rmse", "stopped_at").first()
    return estimator.copy({estimator.maxIter: best["stopped_at"]}).fit(train)


# ---- training run -------------------------------------------------------------------


def training_pipeline(columns: Sequence[str], estimator: Estimator) -> Pipeline:
    """Mean imputation, assembly and the learner as one persistable model."""
    filled = [f"{c}_filled" for c in columns]
    return Pipeline(
        stages=[
            Imputer(inputCols=list(columns), outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol=VECTOR),
            estimator,
        ]
    )


def score(
    model: PipelineModel, df: DataFrame, name: str, keep: Sequence[str] = ("bar",)
) -> DataFrame:
    """Forecast table: keys, prediction, model name and time of scoring."""
    return model.transform(df).select(
        *keep,
        PREDICTION,
        F.lit(name).alias("model_name"),
        F.current_timestamp().alias("prediction_timestamp"),
    )


def train_run(
    df: DataFrame,
    columns: Sequence[str],
    estimator: Estimator,
    name: str,
    *,
    label: str = LABEL,
    order: str = "bar",
    store: str | None = None,
    run_date: str | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train rows, measure train and test, optionally publish model and record.

    ``df`` carries a ``split`` column (train, test). Returns the model and the
    one-row history record.
    """
    train = df.where("split = 'train'")
    model = training_pipeline(columns, estimator).fit(train)
    scored = model.transform(df.where("split IN ('train', 'test')"))
    at = lambda s, c: F.when(F.col("split") == s, F.col(c))
    stats = []
    for s in ("train", "test"):
        err = at(s, PREDICTION) - at(s, label)
        mse = F.avg(err * err)
        stats += [
            F.count(at(s, label)).alias(f"{s}_rows"),
            F.sqrt(mse).alias(f"{s}_rmse"),
            F.avg(F.abs(err)).alias(f"{s}_mae"),
            (1.0 - F.try_divide(mse, F.var_pop(at(s, label)))).alias(f"{s}_r2"),
        ]
    day = F.lit(run_date).cast("date") if run_date else F.current_date()
    record = scored.agg(
        F.min(at("train", order)).alias("data_start"),
        F.max(at("train", order)).alias("data_end"),
        *stats,
    ).select(day.alias("training_date"), F.lit(name).alias("model_name"), "*")
    record = df.sparkSession.createDataFrame(record.collect(), record.schema)  # one row, measured once
    if store:
        publish_run(model, record, train, columns, store)
    return model, record


def publish_run(model, record: DataFrame, train: DataFrame, columns, store: str) -> None:
    """Dated and latest model, feature means, and the appended history record."""
    from tidemark.operators.prep import feature_means
    from tidemark.sources.store import append_records

    day = record.first()["training_date"]
    means = feature_means(train, columns)
    means = train.sparkSession.createDataFrame(means.collect(), means.schema)  # one row, averaged once
    for folder in (f"date={day}", "latest"):
        model.write().overwrite().save(f"{store}/models/{folder}/model")
        means.write.mode("overwrite").json(f"{store}/models/{folder}/feature_means")
        record.write.mode("overwrite").json(f"{store}/models/{folder}/benchmark")
    append_records(record, f"{store}/history")

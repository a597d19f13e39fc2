"""Learners as stages: they cost a few passes, do not depend on how rows are dealt, and are read back as saved."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import learners, models, trees
from tidemark.sources import store


def rows_of(spark, n=400):
    df = spark.range(n).select(F.rand(1).alias("a"), F.rand(2).alias("b"), (F.col("id") % 5).cast("double").alias("c"))
    df = store.stored(df.withColumn("y", F.col("a") * F.col("b") + F.when(F.col("c") > 2, 1.0).otherwise(0.0)), "learn")
    return models.assemble(df, ["a", "b", "c"])


def test_a_fit_does_not_depend_on_partitions_and_survives_saving(spark, tmp_path):
    df = rows_of(spark)
    for name, make in (("f", models.forest({"n_estimators": 4, "max_depth": 6}, "y")), ("b", models.boosted({**models.FINAL_PARAMS, "n_estimators": 4, "learning_rate": 0.5}, "y"))):
        model, again = make.fit(df), make.fit(df.repartition(5))
        assert model.rows == again.rows and model.getNumTrees == 4
        model.write().overwrite().save(f"{tmp_path}/{name}")
        read = learners.TreesModel.load(f"{tmp_path}/{name}")
        both = model.transform(df).withColumnRenamed("prediction", "p")
        assert read.transform(both).where("p <> prediction").count() == 0
        mse = [model.evaluateEachIteration(df)[-1], both.agg(F.avg((F.col("p") - F.col("y")) ** 2)).first()[0]]
        assert np.isclose(*mse) and mse[0] < df.agg(F.var_pop("y")).first()[0]
        gains = trees.gains(trees.nodes_of(model, f"{tmp_path}/{name}", name), ["0", "1", "2"])
        shares = [r["importance"] for r in gains.orderBy("feature").collect()]
        assert np.allclose(shares, model.featureImportances.toArray())


def test_the_record_of_a_run_is_measured_once(spark, tmp_path):
    df = rows_of(spark).drop("features").withColumns({"split": F.when(F.rand(3) < 0.8, "train").otherwise("test"), "bar": F.current_date(), "rv_5d": F.col("y")})
    _, record = models.train_run(df, ["a", "b", "c"], models.boosted({**models.FINAL_PARAMS, "n_estimators": 2}), "m", store=str(tmp_path), run_date="2024-06-01")
    assert record.inputFiles() == [] and record.first()["train_rows"] + record.first()["test_rows"] == 400


def test_the_means_of_a_run_are_averaged_once(spark, tmp_path):
    df = rows_of(spark).drop("features").withColumns({"split": F.lit("train"), "bar": F.current_date(), "rv_5d": F.col("y")})
    model = models.training_pipeline(["a", "b", "c"], models.boosted({**models.FINAL_PARAMS, "n_estimators": 1})).fit(df)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    record = spark.createDataFrame([("2024-06-01",)], "training_date string")
    models.publish_run(model, record, df.mapInArrow(counted, df.schema), ["a", "b", "c"], str(tmp_path))
    means = [spark.read.json(f"{tmp_path}/models/{folder}/feature_means").select("a", "b", "c").collect() for folder in ("date=2024-06-01", "latest")]
    assert seen.value == 400 and means[0] == means[1] and np.allclose(means[0][0], df.agg(F.avg("a"), F.avg("b"), F.avg("c")).first())


def test_both_boosted_families_are_fitted_on_one_table(spark, monkeypatch):
    from tidemark.plans import model_queries

    made, table = [], rows_of(spark).drop("features").withColumns({"split": F.when(F.col("a") < 0.8, "train").otherwise("test"), "rv_5d": F.col("y")})
    monkeypatch.setattr(model_queries, "training_table", lambda *a: made.append(a) or table)
    monkeypatch.setattr(model_queries, "COLUMNS", ("a", "b", "c"))
    monkeypatch.setattr(model_queries, "_FITTED", {})
    small = models.boosted
    monkeypatch.setattr(models, "boosted", lambda params=models.FINAL_PARAMS: small({**params, "n_estimators": 3}))
    found = model_queries.boosted_model(spark, "nowhere").collect()
    assert len(made) == 1 and {(r["model"], r["split"]) for r in found} == {(m, s) for m in ("boosted", "boosted_second") for s in ("train", "test")}
    assert all(r["fits"] for r in found if r["split"] == "train")


def test_the_refit_at_the_best_stop_grows_within_tasks(spark, monkeypatch):
    from tidemark.plans import model_queries

    table = rows_of(spark).drop("features").withColumns({"split": F.when(F.col("a") < 0.6, "train").otherwise("val"), "rv_5d": F.col("y")})
    monkeypatch.setattr(model_queries, "training_table", lambda *a: table)
    monkeypatch.setattr(model_queries, "COLUMNS", ("a", "b", "c"))
    monkeypatch.setattr(model_queries, "_FITTED", {})
    monkeypatch.setattr(trees, "_grown", None)  # no job for each level
    found = model_queries.stopped_refit(spark, "nowhere").collect()
    assert [(r["holds"], r["refit"]) for r in found] == [(True, True)] * 3


def test_importance_of_few_rows_needs_no_job_for_each_level(spark, monkeypatch):
    from tidemark.plans import model_queries

    table = rows_of(spark).drop("features").withColumns({"split": F.lit("train"), "rv_5d": F.col("y")})
    monkeypatch.setattr(model_queries, "training_table", lambda *a: table)
    monkeypatch.setattr(model_queries, "COLUMNS", ("a", "b", "c"))
    monkeypatch.setattr(model_queries, "_FITTED", {})
    monkeypatch.setattr(trees, "_grown", None)
    found = {r["feature"]: (r["counted"], r["total"]) for r in model_queries.model_importance(spark, "nowhere").collect()}
    assert found == {c: (True, 1.0) for c in ("a", "b", "c")}

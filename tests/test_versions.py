"""Versioned tables: partition-wise upserts, interrupted and competing writers, listings from the manifest."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental
from tidemark.operators.labels import forward_rv
from tidemark.sources import store, versions

DAY = "date_format(bar, 'yyyy-MM-dd')"
START = datetime.datetime(2024, 1, 1)


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def table(spark):
    rows = [(s, START + datetime.timedelta(days=d), float(10 * s + d)) for s in (1, 2) for d in range(40)]
    df = spark.createDataFrame(rows, "series int, bar timestamp_ntz, x double")
    path = store.scratch_path(spark, "versioned")
    versions.create(df, path, DAY, "bar")
    return path, df


def five_days(spark, add=100.0):
    rows = [(1, START + datetime.timedelta(days=d), add + d) for d in (3, 4, 39, 40, 41)]
    return spark.createDataFrame(rows, "series int, bar timestamp_ntz, x double")


def test_a_merge_writes_only_what_it_touches(spark, table):
    path, df = table
    before = versions.current(spark, path)
    after = versions.merge(five_days(spark), path, DAY, "bar", ["series", "bar"])
    assert after.number == 2 and len(after.parts) == 42
    moved = {p for p in after.parts if after.parts[p]["folder"] != before.parts.get(p, {}).get("folder")}
    assert moved == {f"2024-{m:02d}-{d:02d}" for m, d in ((1, 4), (1, 5), (2, 9), (2, 10), (2, 11))}
    keys = five_days(spark).select("series", "bar")
    want = df.join(keys, ["series", "bar"], "left_anti").unionByName(five_days(spark))
    assert rows_of(versions.read(spark, path)) == rows_of(want)
    assert rows_of(versions.read(spark, path, number=1)) == rows_of(df)
    assert versions.read(spark, path, parts=["2024-01-04", "1999-01-01"]).count() == 2


@pytest.mark.parametrize("step", ["_written", "_commit"])
def test_an_interrupted_merge_changes_nothing(spark, table, monkeypatch, step):
    path, df = table
    original = getattr(versions, step)

    def dying(*args):
        if step == "_written":
            original(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, step, dying)
    with pytest.raises(RuntimeError):
        versions.merge(five_days(spark), path, DAY, "bar", ["series", "bar"])
    monkeypatch.undo()
    assert versions.current(spark, path).number == 1 and rows_of(versions.read(spark, path)) == rows_of(df)
    assert versions.merge(five_days(spark), path, DAY, "bar", ["series", "bar"]).number == 2


def test_the_second_of_two_writers_fails(spark, table, monkeypatch):
    path, df = table
    commit = versions._commit

    def late(spark_, path_, version):
        monkeypatch.undo()
        versions.merge(five_days(spark, 500.0), path, DAY, "bar", ["series", "bar"])
        commit(spark_, path_, version)

    monkeypatch.setattr(versions, "_commit", late)
    with pytest.raises(versions.Conflict):
        versions.merge(five_days(spark, 900.0), path, DAY, "bar", ["series", "bar"])
    assert versions.current(spark, path).number == 2
    assert versions.read(spark, path).where("x >= 900").count() == 0


def test_no_changes_no_version_and_unused_folders_go(spark, table):
    path, df = table
    assert versions.merge(five_days(spark).where("x < 0"), path, DAY, "bar", ["series", "bar"]).number == 1
    versions.merge(five_days(spark), path, DAY, "bar", ["series", "bar"])
    want = rows_of(versions.read(spark, path))
    assert versions.drop_unused(spark, path) == 3  # of version 1, the three days that were replaced
    assert rows_of(versions.read(spark, path)) == want
    with pytest.raises(ValueError):
        versions.read(spark, path, number=1)


def test_listing_scans_no_data(spark, table, monkeypatch):
    path, df = table
    found = versions.partitions(spark, path)
    assert "FileScan" not in found._jdf.queryExecution().toString()
    assert [tuple(r) for r in found.collect()] == [(r["p"], r["n"], r["a"], r["b"]) for r in df.groupBy(F.expr(DAY).alias("p")).agg(F.count("*").alias("n"), F.min("bar").cast("string").alias("a"), F.max("bar").cast("string").alias("b")).orderBy("p").collect()]


def test_odd_partition_names_and_null_keys(spark):
    path = store.scratch_path(spark, "odd")
    df = spark.createDataFrame([("a/b=c", 1, None), ("é ü%", 2, 5), ("x", None, 7)], "name string, k int, v int")
    versions.create(df, path, "name", "k")
    assert rows_of(versions.read(spark, path)) == rows_of(df)
    versions.merge(spark.createDataFrame([("x", None, 9)], df.schema), path, "name", "k", ["name", "k"])
    assert {(r["name"], r["v"]) for r in versions.read(spark, path).collect()} == {("a/b=c", None), ("é ü%", 5), ("x", 9)}


def test_upsert_touches_new_and_settled_partitions(spark):
    days = [START + datetime.timedelta(days=d) for d in range(60)]
    feats = spark.createDataFrame([(s, b, (i % 7 - 3) / 100 * s) for s in (1, 2) for i, b in enumerate(days)], "series int, bar timestamp_ntz, ret double")
    label = lambda df: forward_rv(df, ret="ret", keys=["series"], grain="day")
    old = feats.where(F.col("bar") < F.lit(days[55]))
    path = store.scratch_path(spark, "upsert")
    versions.create(label(old), path, DAY, "bar")
    before = versions.current(spark, path)
    after = incremental.upsert_partitions(path, feats.where(F.col("bar") >= F.lit(days[55])), DAY, ret="ret", keys=["series"], grain="day")
    moved = {p for p in after.parts if after.parts[p]["folder"] != before.parts.get(p, {}).get("folder")}
    assert moved == {f"{d:%Y-%m-%d}" for d in days[50:]}  # five new days and the five whose labels they settle
    assert rows_of(versions.read(spark, path)) == rows_of(label(feats).select(*versions.read(spark, path).columns))

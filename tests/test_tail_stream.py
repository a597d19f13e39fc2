"""A stream whose batches read arrivals and tails only."""

import numpy as np
import pandas as pd
import pytest

from frames_util import days, same
from tidemark.operators import features
from tidemark.streaming import jobs

SCHEMA = "series string, bar timestamp_ntz, adj_close double, ret double, bench double"


def path_rows(name, n, seed):
    rng = np.random.default_rng(seed)
    ret = rng.normal(0, 0.02, n)
    price = 50 * np.exp(np.cumsum(ret))
    bench = np.random.default_rng(99).normal(0, 0.01, n)
    return [(name, t, float(p), float(r), float(b)) for t, p, r, b in zip(days(n), price, ret, bench)]


def update(rows):
    from pyspark.sql import functions as F

    bench = rows.groupBy("bar").agg(F.max("bench").alias("ret"))
    return features.universe_features(rows.drop("bench"), bench, grain="day")


def frame(df):
    return df.select("series", "bar", *features.SERIES_FEATURES).toPandas().sort_values(["series", "bar"]).reset_index(drop=True)


@pytest.fixture
def folders(tmp_path):
    return {k: f"{tmp_path}/{k}" for k in ("arrivals", "out", "state", "mark")}


def test_batches_see_tails_and_arrivals_and_give_the_full_run(spark, folders):
    rows = path_rows("a", 300, 1) + path_rows("b", 300, 2)[::3] + path_rows("new", 300, 3)[240:]
    seen = []

    def watched(df):
        seen.append(df.count())
        return update(df)

    cuts = (0, 120, 121, 230, 300)  # one batch of a single day, and one series that begins in the last
    start = days(1)[0]
    sizes = []
    for lo, hi in zip(cuts, cuts[1:]):
        part = [r for r in rows if lo <= (r[1] - start).days < hi]
        sizes.append(len(part))
        spark.createDataFrame(part[::-1], SCHEMA).coalesce(1).write.mode("append").parquet(folders["arrivals"])
        q = jobs.tail_stream(spark, *(folders[k] for k in ("arrivals", "out", "state", "mark")), SCHEMA, watched)
        q.awaitTermination()
    assert len(seen) == 4
    assert all(n <= size + 70 * 3 for n, size in zip(seen, sizes)) and seen[1] <= 2 + 140
    got = frame(spark.read.parquet(folders["out"]))
    want = frame(update(spark.createDataFrame(rows, SCHEMA)))
    pd.testing.assert_frame_equal(got, want, rtol=1e-9)
    assert spark.read.schema(f"{SCHEMA}, batch long").parquet(f"{folders['state']}/late").count() == 0


def test_a_repeated_batch_changes_nothing_and_late_rows_are_set_aside(spark, folders):
    rows = path_rows("a", 120, 4)
    batches = [rows[:80], rows[80:100], rows[100:] + rows[50:52] + [("a", None, 1.0, 0.0, 0.0)]]
    run = lambda k: jobs.tail_batch(
        spark.createDataFrame(batches[k], SCHEMA), k, folders["out"], folders["state"], update
    )
    for k in (0, 1, 1, 2, 2):
        run(k)
    got = frame(spark.read.parquet(folders["out"]))
    pd.testing.assert_frame_equal(got, frame(update(spark.createDataFrame(rows, SCHEMA))), rtol=1e-9)
    late = spark.read.schema(f"{SCHEMA}, batch long").parquet(f"{folders['state']}/late").toPandas()
    assert len(late) == 3 and set(late.batch) == {2} and late.bar.isna().sum() == 1
    same([spark.read.schema(SCHEMA).parquet(f"{folders['state']}/tails/2").count()], [70])


def test_tails_left_half_written_are_not_read(spark, folders):
    rows = path_rows("a", 90, 5)
    jobs.tail_batch(spark.createDataFrame(rows[:70], SCHEMA), 0, folders["out"], folders["state"], update)
    broken = spark.createDataFrame(path_rows("a", 400, 6), SCHEMA)
    broken.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folders['state']}/tails/1")
    jobs.tail_batch(spark.createDataFrame(rows[70:], SCHEMA), 2, folders["out"], folders["state"], update)
    got = frame(spark.read.parquet(folders["out"]))
    pd.testing.assert_frame_equal(got, frame(update(spark.createDataFrame(rows, SCHEMA))), rtol=1e-9)


def test_an_empty_first_batch(spark, folders):
    jobs.tail_batch(spark.createDataFrame([], SCHEMA), 0, folders["out"], folders["state"], update)
    rows = path_rows("a", 8, 7) + path_rows(None, 8, 8) + [("a", None, 1.0, 0.0, 0.0)]
    jobs.tail_batch(spark.createDataFrame(rows[:5] + rows[8:13] + rows[16:], SCHEMA), 1, folders["out"], folders["state"], update)
    jobs.tail_batch(spark.createDataFrame(rows[5:8] + rows[13:16], SCHEMA), 2, folders["out"], folders["state"], update)
    out = spark.read.schema("series string, bar timestamp_ntz, ret_1 double").parquet(folders["out"])
    assert sorted((r.series or "", r["n"]) for r in out.groupBy("series").agg({"*": "count"}).toDF("series", "n").collect()) == [("", 8), ("a", 8)]
    assert spark.read.schema(f"{SCHEMA}, batch long").parquet(f"{folders['state']}/late").count() == 1

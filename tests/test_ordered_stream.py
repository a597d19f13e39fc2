"""The stream that waits for late rows: several micro-batches, late and lost rows, forgotten series."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import jobs

START = datetime.datetime(2024, 1, 1)


def day(n):
    return START + datetime.timedelta(days=n)


def run(spark, tmp_path, arrivals, **options):
    """(series, day) -> (vol_2, vol_3) after one micro-batch for each arrival."""
    schema, src = "series string, bar timestamp_ntz, ret double", str(tmp_path / "in")
    for rows in arrivals:
        spark.createDataFrame([(s, day(n), r) for s, n, r in rows], schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = jobs.ordered_volatility(stream, (2, 3), **options).writeStream.format("parquet").option("path", str(tmp_path / "out"))
    q = q.option("checkpointLocation", str(tmp_path / "mark")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert len({p["batchId"] for p in q.recentProgress}) >= len(arrivals)
    out = spark.read.parquet(str(tmp_path / "out")).withColumn("n", F.datediff("bar", F.lit(START.date())))
    found = out.collect()
    assert len({(r["series"], r["n"]) for r in found}) == len(found)
    return {(r["series"], r["n"]): tuple(None if r[c] is None or math.isnan(r[c]) else round(r[c], 9) for c in ("vol_2", "vol_3")) for r in found}


def batch(rows):
    """The values of rows in order, as a batch job gives them."""
    out = {}
    for s in {s for s, *_ in rows}:
        mine = sorted((n, r) for t, n, r in rows if t == s)
        for i, (n, _) in enumerate(mine):
            out[s, n] = tuple(round(math.sqrt(sum(r * r for _, r in mine[i - k + 1 : i + 1])), 9) if i >= k - 1 else None for k in (2, 3))
    return out


def test_rows_out_of_order_give_the_batch_result(spark, tmp_path):
    rng = random.Random(6)
    rows = [(s, n, rng.gauss(0, 1)) for s in ("a", "b") for n in range(60)]
    arrivals = [[] for _ in range(4)]
    for row in rows:
        arrivals[min((row[1] + rng.randrange(5)) // 15, 3)].append(row)
    for some in arrivals:
        rng.shuffle(some)
    got = run(spark, tmp_path, arrivals, late="5 days")
    assert got == {k: v for k, v in batch(rows).items() if k[1] <= 59 - 5}


def test_rows_behind_the_watermark_are_ignored(spark, tmp_path):
    arrivals = [[("a", n, 1.0) for n in range(10)], [("a", n, 1.0) for n in range(10, 20)], [("a", 3, 99.0), ("a", 12, 99.0), ("a", 20, 1.0)], [("b", 40, 1.0)]]
    got = run(spark, tmp_path, arrivals, late="2 days")
    assert got == batch([("a", n, 1.0) for n in range(21)])


@pytest.mark.parametrize("idle, again", [(10, True), (1000, False)])
def test_an_idle_series_is_forgotten(spark, tmp_path, idle, again):
    arrivals = [[("a", n, 1.0) for n in range(5)], [("b", 30, 1.0)], [("b", 60, 1.0)], [("a", 70, 1.0), ("b", 70, 1.0)], [("b", 80, 1.0)], [("b", 81, 1.0)]]
    got = run(spark, tmp_path, arrivals, late="1 days", idle_days=idle)
    assert got["a", 70] == ((None, None) if again else (round(math.sqrt(2), 9), round(math.sqrt(3), 9)))

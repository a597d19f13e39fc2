"""Counts and ranges of partitions from file footers."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.sources import store


def test_facts_come_from_footers_without_a_scan(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.range(900).select(F.expr("date'2024-01-30' + CAST(id % 45 AS INT)").alias("day"), F.col("id").cast("double").alias("x"))
    rows = rows.withColumn("x", F.when(F.col("x") > 5, F.col("x")))
    store.write_partitions(rows, path, order="day", by="month", unit="month")
    plan = store.footer_facts(spark, path, "day", "month")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(day), MAX(day)]" in plan and "PushedGroupBy: [month]" in plan
    facts = store.partition_facts(spark, path, "day", "month").collect()
    got = {str(r["month"])[:7]: (r["rows"], r["first"], r["last"]) for r in facts}
    days = [dt.date(2024, 1, 30) + dt.timedelta(days=i % 45) for i in range(900)]
    for month in ("2024-01", "2024-02", "2024-03"):
        own = [d for d in days if d.isoformat().startswith(month)]
        assert got[month] == (len(own), min(own), max(own))
    assert len(got) == 3


def test_ranges_that_footers_do_not_tell_are_scanned(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([("a", "x"), ("a", "z"), ("b", None)], "part string, name string")
    rows.write.partitionBy("part").parquet(path)
    got = {r["part"]: (r["rows"], r["first"], r["last"]) for r in store.partition_facts(spark, path, "name", "part").collect()}
    assert got == {"a": (2, "x", "z"), "b": (1, None, None)}

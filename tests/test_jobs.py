"""Incremental jobs, splits, stores and streams."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from frames_util import bars, days, same, span, table, walk
from test_features import five_series
from tidemark.operators import bars as b
from tidemark.operators import features as f
from tidemark.operators import incremental, labels, prep, split, validate
from tidemark.sources import store
from tidemark.streaming import jobs


def before(df, day):
    return df.where(F.col("bar") < F.lit(day).cast("timestamp_ntz"))


def since(df, day):
    return df.where(F.col("bar") >= F.lit(day).cast("timestamp_ntz"))


CUT = str(days(200)[150])


@pytest.mark.parametrize("options", [{"grain": "day"}, {"rows": 32, "slot": span(4)}])
def test_incremental_returns_equal_full(spark, options):
    _, df = five_series(spark, n=200, gaps=(("SPY", 149), ("TLT", 150)))
    full = since(b.log_returns(df, grain="day"), CUT)
    stored = b.log_returns(before(df, CUT), grain="day")
    got = incremental.incremental_returns(since(df, CUT), stored, **options)
    a, e = table(got, "series", "bar"), table(full, "series", "bar")
    assert a[["series", "bar"]].equals(e[["series", "bar"]])
    same(a["ret"], e["ret"], 0)


def test_incremental_features_equal_full_and_fill_gaps(spark):
    _, df = five_series(spark, n=200)
    curated = b.log_returns(df, grain="day")
    full = f.feature_set(curated, grain="day")
    hole = F.col("bar") == F.lit(str(days(200)[120])).cast("timestamp_ntz")
    existing = before(full, CUT).where(~hole)
    got = table(incremental.incremental_features(curated, existing, grain="day"), "bar")
    want = table(full.where(hole | (F.col("bar") >= F.lit(CUT).cast("timestamp_ntz"))), "bar")
    assert got["bar"].tolist() == want["bar"].tolist()
    for c in f.FEATURE_COLUMNS:
        same(got[c], want[c], 1e-12)
    assert incremental.incremental_features(curated, full, grain="day").count() == 0
    empty = full.where(F.lit(False))
    assert incremental.incremental_features(curated, empty, grain="day").count() == 199


@pytest.mark.parametrize("options", [{"grain": "day"}, {"rows": 16, "slot": span(2)}])
def test_master_upsert_equals_full(spark, options):
    rng = np.random.default_rng(8)
    rows = [(s, t, float(v)) for s in ("a", "b") for t, v in zip(days(60), rng.normal(0, 0.01, 60))]
    feats = spark.createDataFrame(rows, "series string, bar timestamp_ntz, ret double")
    full = labels.forward_rv(feats, ret="ret", keys=["series"], grain="day")
    cut = str(days(60)[40])
    master = labels.forward_rv(before(feats, cut), ret="ret", keys=["series"], grain="day")
    got = incremental.master_upsert(master, since(feats, cut), ret="ret", keys=["series"], **options)
    a, e = table(got, "series", "bar"), table(full, "series", "bar")
    assert a["bar"].equals(e["bar"])
    same(a["rv_5d"], e["rv_5d"], 1e-15)
    late = F.col("bar") == F.lit(str(days(60)[10])).cast("timestamp_ntz")
    patched = incremental.master_upsert(
        labels.forward_rv(feats.where(~late), ret="ret", keys=["series"], grain="day"),
        feats.where(late), ret="ret", keys=["series"], **options,
    )
    same(table(patched, "series", "bar")["rv_5d"][:55], e["rv_5d"][:55], 1e-15)


def test_context_rows_and_days(spark):
    df = bars(spark, {"a": walk(100), "b": walk(100, seed=1)})
    cut = str(days(100)[90])
    got = incremental.with_context(since(df, cut), before(df, cut), 70)
    assert got.where("is_context").groupBy("series").count().collect()[0]["count"] == 70
    assert got.where("NOT is_context").count() == 20
    few = incremental.context_by_days(df, since(df, cut), 10)
    assert few.count() == 40


def test_watermark_and_gap_detection_differ(spark):
    df = bars(spark, {"a": walk(10)})
    done = df.where(F.dayofmonth("bar").isin(1, 2, 4, 5))
    gaps = incremental.dates_to_process(df, done, ["series", "bar"])
    after = incremental.dates_after_watermark(df, done)
    assert gaps.count() == 6 and after.count() == 5
    assert incremental.dates_after_watermark(df, df.where(F.lit(False))).count() == 10


def test_ingest_range_modes(spark):
    day = lambda *d: spark.createDataFrame([(datetime.date(2024, 1, x),) for x in d], "date date")
    none = day()
    today = datetime.date(2024, 1, 20)
    start = datetime.date(2010, 1, 1)
    run = lambda m, p: tuple(incremental.ingest_range(m, p, start, today).first())
    assert run(day(3, 9), day(1)) == (datetime.date(2024, 1, 10), today, "incremental")
    assert run(none, day(5)) == (datetime.date(2024, 1, 6), today, "incremental")
    assert run(none, none) == (start, today, "full")
    assert run(day(19), none) == (None, None, "up_to_date")


@pytest.mark.parametrize("options", [{"grain": "day"}, {"slot": span(3)}])
def test_hold_out_split(spark, options):
    rows = [("a", t, float(i), float(i)) for i, t in enumerate(days(100))]
    df = spark.createDataFrame(rows, "series string, bar timestamp_ntz, x double, rv_5d double")
    df = df.withColumn("rv_5d", F.when(F.col("x") < 95, F.col("rv_5d")))
    df = df.withColumn("x", F.when(F.col("x") != 10, F.col("x")))
    out = split.time_split(df, features=["x"], keys=["series"], **options)
    parts = {r.split: (r.rows, r.start, r.end) for r in split.split_summary(out).collect()}
    assert {k: v[0] for k, v in parts.items()} == {"train": 51, "val": 13, "test": 30}
    assert parts["train"][2] < parts["val"][1] and parts["val"][2] < parts["test"][1]
    prod = split.time_split(df, val_fraction=0.0, keys=["series"], **options)
    assert {r["split"]: r["count"] for r in prod.groupBy("split").count().collect()} == {
        "train": 65, "test": 30,
    }
    assert split.require_rows(df, 100).count() == 1


@pytest.mark.parametrize("n, fraction", [(100, 0.8), (100, 0.7), (100, 0.95), (10, 0.9), (1, 0.8)])
def test_walk_forward_split(spark, n, fraction):
    df = bars(spark, {"a": walk(n)}).orderBy(F.rand(2))
    out = table(split.walk_forward_split(df, fraction, grain="day"), "bar")
    want = ["train"] * int(n * fraction) + ["val"] * (n - int(n * fraction))
    assert out["split"].tolist() == want


def test_expanding_folds(spark):
    df = bars(spark, {"a": walk(23)})
    folds = split.ts_folds(df, 5, keys=["series"], slot=span(4))
    out = table(split.fold_table(folds, ["series"]), "fold")
    assert out["train_rows"].tolist() == [8, 11, 14, 17, 20]
    assert out["test_rows"].tolist() == [3] * 5
    assert (out["train_end"] < out["test_start"]).all()


def test_impute_and_standardize_use_train_rows_only(spark):
    rows = [("a", 1, 1.0, 5.0), ("a", 2, 3.0, 5.0), ("a", 3, None, 7.0)]
    df = spark.createDataFrame(rows, "series string, bar int, x double, c double")
    train = df.where("bar < 3")
    for by in ((), ("series",)):
        means = prep.feature_means(train, ["x", "c"], by)
        out = table(prep.impute_means(df, means, ["x", "c"], by=by), "bar")
        same(out["x"], [1.0, 3.0, 2.0])
        assert out["imputed"].tolist() == [0, 0, 1]
        gone = table(prep.impute_means(df.drop("c"), means, ["x", "c"], by=by), "bar")
        same(gone["c"], [5.0] * 3)
        stats = prep.scale_stats(train, ["x", "c"], by)
        scaled = table(prep.standardize(df, stats, ["x", "c"], by=by), "bar")
        same(scaled["x"], [-1.0, 1.0, None])
        same(scaled["c"], [0.0, 0.0, 2.0])
    report = {r.column: r.imputed for r in prep.impute_report(df, ["x", "c"]).collect()}
    assert report == {"x": 1, "c": 0}


def test_schema_rules(spark):
    good = spark.createDataFrame(
        [("SPY", datetime.date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 0.0)], validate.RAW_SCHEMA
    )
    assert validate.schema_violations(good, validate.RAW_SCHEMA).count() == 0
    assert validate.validate(good, validate.RAW_SCHEMA) is good
    bad = good.drop("volume").withColumn("open", F.lit("x")).withColumn("low", F.lit(None).cast("double"))
    found = {(r.rule, r.column) for r in validate.schema_violations(bad, validate.RAW_SCHEMA).collect()}
    assert found == {("missing_column", "volume"), ("wrong_type", "open"), ("null_value", "low")}
    with pytest.raises(validate.ValidationError, match="volume"):
        validate.validate(bad, validate.RAW_SCHEMA)
    nullable = spark.createDataFrame(
        [("SPY", datetime.date(2024, 1, 2), 1.0, 1.0, None)], validate.CURATED_SCHEMA
    )
    assert validate.schema_violations(nullable, validate.CURATED_SCHEMA).count() == 0


def test_feature_batch_and_partition_rules(spark):
    cols = ", ".join(f"{c} double" for c in f.FEATURE_COLUMNS)
    rows = [(t, *[1.0] * 20) for t in [*days(3), days(3)[0]]]
    df = spark.createDataFrame(rows, f"bar timestamp_ntz, {cols}")
    found = [(r.rule, r.n) for r in validate.feature_rules(df).collect()]
    assert found == [("duplicate_time", 1)]
    wrong = df.drop("vix").withColumn("symbol", F.lit("SPY")).withColumn("more", F.lit(1))
    rules = {r.rule for r in validate.feature_rules(wrong).collect()}
    assert rules == {"column_count", "raw_column", "missing_column", "duplicate_time"}
    assert [r["rows"] for r in validate.partition_rules(df, "bar").collect()] == [2]
    assert validate.scan_partitions(df, "bar").count() == 1


def test_partitions_round_trip_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", datetime.date(2024, 1, d), float(d)) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, "symbol string, date date, close double")
    store.write_partitions(df, path)
    store.write_partitions(df.where("close = 2").withColumn("close", F.lit(20.0)), path)
    back = {str(r.date): r.close for r in store.read_partitions(spark, path).collect()}
    assert back == {"2024-01-01": 1.0, "2024-01-02": 20.0, "2024-01-03": 3.0}
    dates = store.partition_dates(store.read_partitions(spark, path))
    wanted = spark.createDataFrame([(datetime.date(2024, 1, d),) for d in (2, 3, 4)], "date date")
    assert [str(r.date) for r in store.missing_partitions(wanted, dates).collect()] == ["2024-01-04"]
    assert store.read_by_dates(store.read_partitions(spark, path), wanted).count() == 2
    merged = store.merge_manifest(wanted, dates)
    assert merged.count() == 4


def test_folder_names_history_status_and_snapshots(spark, tmp_path):
    folders = spark.createDataFrame(
        [("data/date=2024-01-02",), ("data/date=2024-01-01/",), ("data/other",)], "path string"
    )
    assert sorted(r.date for r in store.folder_dates(folders).collect()) == ["2024-01-01", "2024-01-02"]
    flat = spark.createDataFrame([("2024-01-02", 5, "2024-01-03", 2)], "master_last_date string, master_rows int, predict_last_date string, predict_rows int")
    status = {r.dataset: (r.last_date, r["rows"]) for r in store.legacy_status(flat).collect()}
    assert status == {"master": ("2024-01-02", 5), "predict": ("2024-01-03", 2)}
    log = str(tmp_path / "log")
    run = spark.createDataFrame([("r1", 0.5)], "run string, rmse double")
    store.append_records(run, log)
    store.append_records(run.withColumn("run", F.lit("r2")), log)
    assert store.read_records(spark, log, run.schema).count() == 2
    runs = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-05"), (3, "2024-01-05")], "id int, run_date string")
    assert sorted(r.id for r in store.latest_snapshot(runs).collect()) == [2, 3]
    preds = spark.createDataFrame(
        [("2024-01-02", 0.01, "2024-01-01", "m", "2024-01-01T00:00:00Z")],
        "prediction_date string, predicted_volatility float, features_date string, model_path string, prediction_timestamp string",
    )
    assert dict(store.prediction_history(preds).dtypes) == store.HISTORY_FIELDS


def test_split_export(spark, tmp_path):
    rows = [(t, float(i), float(i), "train" if i < 3 else "test") for i, t in enumerate(days(5))]
    df = spark.createDataFrame(rows, "bar timestamp_ntz, x double, rv_5d double, split string")
    store.export_splits(df, str(tmp_path), order="bar", label="rv_5d")
    assert spark.read.csv(f"{tmp_path}/indices", header=True).where("split = 'test'").count() == 2
    assert set(spark.read.parquet(f"{tmp_path}/x").columns) == {"bar", "x", "split"}


def test_feature_stream_processes_arrivals_once(spark, tmp_path):
    _, df = five_series(spark, n=120)
    curated = b.log_returns(df, grain="day").select("series", "bar", "adj_close", "ret")
    src, out, mark = (str(tmp_path / n) for n in ("curated", "features", "mark"))
    full = f.feature_set(curated, grain="day")
    schema = "series string, bar timestamp_ntz, adj_close double, ret double"
    fschema = "bar timestamp_ntz, " + ", ".join(f"{c} double" for c in f.FEATURE_COLUMNS)
    (tmp_path / "features").mkdir()
    cut = str(days(120)[100])
    for part in (before(curated, cut), since(curated, cut)):
        part.coalesce(1).write.mode("append").parquet(src)
        q = jobs.feature_stream(spark, src, out, mark, schema, fschema, grain="day")
        q.awaitTermination(300)
        assert q.exception() is None
    got, want = table(spark.read.parquet(out), "bar"), table(full, "bar")
    assert got["bar"].tolist() == want["bar"].tolist()
    for c in f.FEATURE_COLUMNS:
        same(got[c], want[c], 1e-12)
    q = jobs.feature_stream(spark, src, out, mark, schema, fschema, grain="day")
    q.awaitTermination(300)
    assert spark.read.parquet(out).count() == len(want)


def test_streaming_bars_ignore_late_ticks(spark, tmp_path):
    t = days(1)[0]
    tick = lambda m, v: ("a", t + datetime.timedelta(minutes=m), float(v))
    schema = "s string, ts timestamp, v double"
    src = str(tmp_path / "ticks")
    batches = [[tick(1, 1), tick(30, 2)], [tick(70, 5), tick(200, 6)], [tick(40, 99), tick(201, 7)], [tick(400, 1)]]
    query = None
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        ticks = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        query = (
            jobs.streaming_bars(ticks, series="s", ts="ts", value="v")
            .writeStream.format("parquet")
            .option("path", str(tmp_path / "bars"))
            .option("checkpointLocation", str(tmp_path / "mark"))
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(300)
        assert query.exception() is None
    got = table(spark.read.parquet(str(tmp_path / "bars")), "bar")
    assert got[["open", "high", "low", "close", "volume"]].values.tolist() == [
        [1, 2, 1, 2, 2],
        [5, 5, 5, 5, 1],
        [6, 7, 6, 7, 2],
    ]


def test_ticks_at_one_time_open_low_and_close_high(spark):
    t = days(1)[0]
    ticks = [("a", t, 3.0), ("a", t, 1.0), ("a", t + datetime.timedelta(minutes=9), 2.0), ("a", t + datetime.timedelta(minutes=9), 5.0)]
    bar = jobs.streaming_bars(spark.createDataFrame(ticks, "s string, ts timestamp, v double"), series="s", ts="ts", value="v").first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (1, 5, 1, 5, 4)


def test_stateful_features_equal_batch(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(s, t, float(v)) for s in ("a", "b") for t, v in zip(days(90), rng.normal(0, 0.01, 90))]
    schema = "series string, bar timestamp_ntz, ret double"
    df = spark.createDataFrame(rows, schema)
    src = str(tmp_path / "rets")
    cut = str(days(90)[65])
    for part in (before(df, cut), since(df, cut)):
        part.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        query = (
            jobs.rolling_state(stream)
            .writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "mark"))
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(300)
        assert query.exception() is None
    got = table(spark.read.parquet(str(tmp_path / "out")), "series", "bar")
    want = table(f.realized_vol(df, (5, 20, 60), grain="day"), "series", "bar")
    for n in (5, 20, 60):
        same(got[f"vol_{n}"], want[f"vol_{n}"], 1e-9)


def test_scratch_is_dropped(spark):
    import os

    first = store.stored(spark.range(3), "probe")
    folder = store._own_scratch(spark).removeprefix("file:")
    assert first.count() == 3 and os.path.isdir(folder)
    store.drop_scratch(spark)
    assert not os.path.exists(folder)
    assert store.stored(spark.range(4), "probe").count() == 4


def test_arrivals_are_batches_of_many_files_and_one_closing_batch(spark, tmp_path):
    from tidemark.plans import stream_queries

    df = spark.range(600).repartition(6).selectExpr("'a' AS series", "timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id AS INT)) AS bar", "1.0D AS ret")
    before, runs, files = spark.conf.get(stream_queries.NO_DATA_BATCHES), [], []
    path = str(tmp_path / "in")

    def start():
        import glob

        files.append(len(glob.glob(f"{path}/*.parquet")))
        stream = jobs.ordered_volatility(spark.readStream.schema(df.schema).parquet(path), late="5 days")
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark"))
        q = q.outputMode("append").trigger(availableNow=True).start()
        runs.append(q)
        return q

    stream_queries.arrive(store.stored(df, "rows"), stream_queries.arrival_of(df, "bar"), path, start)
    batches = [sorted({p["batchId"] for p in q.recentProgress}) for q in runs]
    assert batches == [[0], [1], [2], [3], [4], [5, 6]] and files[0] > 1
    assert spark.conf.get(stream_queries.NO_DATA_BATCHES) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 600 - 5


def test_keys_to_process_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(incremental, "KEYS_A_TASK", 10)
    df = spark.range(100).selectExpr("CAST(id % 7 AS STRING) AS series", "id % 20 AS bar").union(spark.sql("SELECT null, 3L"))
    done = df.where("bar < 15")
    got = incremental.dates_to_process(df, done, ["series", "bar"], keys=df.count())
    assert got.rdd.getNumPartitions() == 11
    want = {(r.series, r.bar) for r in df.collect() if r.series is None or r.bar >= 15}
    assert {(r.series, r.bar) for r in got.collect()} == want and got.count() == len(want)

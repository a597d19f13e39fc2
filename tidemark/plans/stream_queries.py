"""The streaming jobs, run to the end of what is there and read back from their sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features
from tidemark.plans.common import (
    EVENT_ALL,
    GRAIN,
    LINE_GRAIN,
    ROLES,
    SUPPLIER_ALL,
    SUPPLIER_BASE,
    rounded,
    sql_gate,
    sql_round,
    sql_windows,
)
from tidemark.sources import store, tables
from tidemark.streaming import jobs

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


#: Micro-batches of the streams below, and how late a row of the out-of-order stream may be.
ARRIVALS, LATE_DAYS = 6, 28
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def spans(df, order: str) -> tuple[int, int]:
    """(first second, seconds of an arrival): equal spans over the times of ``df``."""
    at = F.col(order).cast("timestamp").cast("long")
    first, last = df.agg(F.min(at), F.max(at)).first()
    return first or 0, max(-(-((last or 0) - (first or 0) + 1) // ARRIVALS), 1)


def arrival_of(df, order: str):
    """The number of the span of time a row lies in."""
    first, span = spans(df, order)
    return ((F.col(order).cast("timestamp").cast("long") - F.lit(first)) / F.lit(span)).cast("int")


def arrive(df, when, path: str, start) -> None:
    """Write the arrivals of ``df`` (rows of one ``when``) below ``path``, and after each run the stream that ``start`` starts.

    An arrival has as many files as tasks write it and is one micro-batch, which goes on from
    the checkpoint of those before; the batch without data that ends a stream follows the last only.
    """
    spark = df.sparkSession
    after = spark.conf.get(NO_DATA_BATCHES)
    try:
        for k in range(ARRIVALS):
            df.where(when == k).write.mode("append").parquet(path)
            spark.conf.set(NO_DATA_BATCHES, after if k == ARRIVALS - 1 else "false")
            start().awaitTermination()
    finally:
        spark.conf.set(NO_DATA_BATCHES, after)


def finished(df, when, name: str, job) -> str:
    """Run ``job`` as a stream over the arrivals of ``df``; gives the path of its output."""
    spark = df.sparkSession
    path = store.scratch_path(spark, name)

    def start():
        return (
            job(spark.readStream.schema(df.schema).parquet(f"{path}/in"))
            .writeStream.format("parquet")
            .option("path", f"{path}/out")
            .option("checkpointLocation", f"{path}/mark")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )

    arrive(df, when, f"{path}/in", start)
    return f"{path}/out"


@query(
    sql_round(
        """SELECT event_type AS series, date_trunc('hour', ts) AS bar, arg_min(value, ts) AS open, max(value) AS high,
                  min(value) AS low, arg_max(value, ts) AS close, CAST(count(*) AS DOUBLE) AS volume
           FROM events GROUP BY 1, 2
           HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES""",
        ("open", "high", "low", "close", "volume"),
    )
)
def stream_bars(spark, sf):
    """Hourly bars of the event stream; a bar is final once the watermark has passed its end."""
    ticks = tables.table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    bars = lambda stream: jobs.streaming_bars(stream, series="event_type", ts="ts", value="value")
    out = finished(ticks, arrival_of(ticks, "ts"), "bars", bars)
    back = spark.read.parquet(out).withColumn("bar", F.col("bar").cast("timestamp_ntz"))
    return rounded(back.select("series", "bar", "open", "high", "low", "close", "volume"))


@query(
    sql_round(
        "SELECT series, bar, "
        + ", ".join(f"{sql_gate(f'sqrt(sum(ret * ret) OVER w{n})', n, 'ret')} AS vol_{n}" for n in (5, 20, 60))
        + f" FROM supplier_curated {sql_windows('series', ns=(5, 20, 60))}",
        ("vol_5", "vol_20", "vol_60"),
        SUPPLIER_BASE,
    )
)
def stream_volatility(spark, sf):
    """Rolling volatility over several micro-batches, the last rows of each series kept as state."""
    curated = store.stored(tables.supplier_curated(spark, sf).select("series", "bar", "ret"), "returns")
    out = finished(curated, arrival_of(curated, "bar"), "volatility", jobs.rolling_state)
    vols = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("vol_5", "vol_20", "vol_60")]
    return rounded(spark.read.parquet(out).select("series", "bar", *vols))


@query(
    sql_round(
        "SELECT * FROM (SELECT series, bar, "
        + ", ".join(f"{sql_gate(f'sqrt(sum(ret * ret) OVER w{n})', n, 'ret')} AS vol_{n}" for n in (5, 20, 60))
        + f" FROM supplier_curated {sql_windows('series', ns=(5, 20, 60))}) v"
        + f" WHERE bar <= (SELECT max(bar) FROM supplier_curated) - INTERVAL {LATE_DAYS} DAY",
        ("vol_5", "vol_20", "vol_60"),
        SUPPLIER_BASE,
    )
)
def stream_out_of_order(spark, sf):
    """Rolling volatility over several micro-batches whose rows are late by up to four weeks: each row once the watermark passed it."""
    curated = store.stored(tables.supplier_curated(spark, sf).select("series", "bar", "ret"), "returns")
    first, span = spans(curated, "bar")
    delay = F.pmod(F.xxhash64("series", "bar"), F.lit(LATE_DAYS * 86_400 - 1))
    when = F.least(((F.col("bar").cast("timestamp").cast("long") + delay - F.lit(first)) / F.lit(span)).cast("int"), F.lit(ARRIVALS - 1))
    late = lambda stream: jobs.ordered_volatility(stream, late=f"{LATE_DAYS} days", idle_days=100_000)
    out = finished(curated, when, "ordered", late)
    vols = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("vol_5", "vol_20", "vol_60")]
    return rounded(spark.read.parquet(out).select("series", F.col("bar").cast("timestamp_ntz").alias("bar"), *vols))


@query(sql_round("SELECT * FROM features", features.FEATURE_COLUMNS, EVENT_ALL))
def stream_features(spark, sf):
    """The feature table kept up to date from arriving curated files."""
    root = store.scratch_path(spark, "feature-stream")
    fields = "bar timestamp_ntz, " + ", ".join(f"{c} double" for c in features.FEATURE_COLUMNS)
    spark.createDataFrame([], f"{fields}, {jobs.BATCH} long").write.parquet(f"{root}/features")
    curated = tables.event_curated(spark, sf)
    curated.write.parquet(f"{root}/curated")
    running = jobs.feature_stream(
        spark, f"{root}/curated", f"{root}/features", f"{root}/mark", curated.schema, fields, ROLES, grain=GRAIN
    )
    running.awaitTermination()
    out = spark.read.schema(fields).parquet(f"{root}/features")
    return rounded(out.drop(jobs.BATCH))


def supplier_update(rows):
    """Features of rows that carry their benchmark's return."""
    bench = rows.groupBy("bar").agg(F.max("bench").alias("ret"))
    return features.universe_features(rows.drop("bench"), bench, grain=LINE_GRAIN)


@query(sql_round("SELECT * FROM supplier_features", features.SERIES_FEATURES, SUPPLIER_ALL))
def stream_tails(spark, sf):
    """All series' features over several micro-batches, each reading its arrivals and the series' last rows only."""
    root = store.scratch_path(spark, "tail-stream")
    market = tables.market_returns(spark, sf).select("bar", F.col("ret").alias("bench"))
    curated = tables.supplier_curated(spark, sf).select("series", "bar", "adj_close", "ret")
    joined = store.stored(curated.join(F.broadcast(market), "bar", "left"), "joined")  # one row per week
    folders = [f"{root}/{name}" for name in ("arrivals", "out", "state", "mark")]
    start = lambda: jobs.tail_stream(spark, *folders, joined.schema, supplier_update, files=None)
    arrive(joined, arrival_of(joined, "bar"), folders[0], start)
    return rounded(spark.read.parquet(f"{root}/out").select("series", "bar", *features.SERIES_FEATURES))

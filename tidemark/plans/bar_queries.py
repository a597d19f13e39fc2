"""Sources, sinks, bars and returns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import bars
from tidemark.operators.frames import last_rows, over_rows, running_sum
from tidemark.functions import rolling
from tidemark.functions.scalars import (
    iso_date,
    percent_text,
    signed_percent_text,
    simple_return,
)
from tidemark.plans.common import (
    EVENT_BARS,
    EVENT_BASE,
    EVENT_RETURNS,
    EVENT_WIDE,
    GRAIN,
    LINE_GRAIN,
    SCORED_ALL,
    SUPPLIER_BARS,
    SUPPLIER_BASE,
    event_wide,
    forecasts,
    rounded,
    sql_round,
)
from tidemark.sources import store
from tidemark.sources.tables import event_bars, event_curated, supplier_bars, supplier_curated, table

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def vendor_frame(spark, sf):
    """Daily event bars under the headers a vendor file carries (no adjusted close)."""
    daily = bars.ohlcv_bars(
        table(spark, sf, "events"), series="event_type", ts="ts", value="value", every="day"
    )
    return daily.select(
        F.col("series").alias("symbol"),
        F.col("bar").alias("Date"),
        *[F.col(c).alias(f"('{c.title()}', 'ANY')") for c in bars.PRICE_COLUMNS],
        F.col("volume").cast("long").alias("Volume"),
    )


_DAILY = """
  SELECT event_type AS symbol, CAST(ts AS DATE) AS date, arg_min(value, ts) AS open,
         max(value) AS high, min(value) AS low, arg_max(value, ts) AS close{adj},
         {volume} AS volume
  FROM events GROUP BY 1, 2"""
_PRICES = ("open", "high", "low", "close")


@query(
    sql_round(
        _DAILY.format(adj=", arg_max(value, ts) AS adj_close", volume="count(*)"),
        (*_PRICES, "adj_close"),
    )
)
def bars_normalised(spark, sf):
    return rounded(bars.normalise_bars(vendor_frame(spark, sf)))


@query(sql_round(_DAILY.format(adj="", volume="CAST(count(*) AS DOUBLE)"), (*_PRICES, "volume")))
def raw_bars(spark, sf):
    return rounded(bars.raw_bars(bars.normalise_bars(vendor_frame(spark, sf))))


@query(sql_round("SELECT * FROM event_bars", (*_PRICES, "adj_close", "volume"), [EVENT_BARS]))
def ohlcv_bars(spark, sf):
    return rounded(event_bars(spark, sf))


@query(
    sql_round(
        "SELECT series, bar, close, adj_close, volume, ret FROM supplier_curated",
        ("ret",),
        SUPPLIER_BASE,
    )
)
def log_returns(spark, sf):
    return rounded(supplier_curated(spark, sf), exact=("close", "adj_close", "volume"))


@query(
    sql_round(
        "SELECT bar, count(*) AS null_rows FROM event_returns WHERE ret IS NULL GROUP BY bar",
        (),
        [EVENT_BARS, EVENT_RETURNS],
    )
)
def null_return_report(spark, sf):
    every = bars.log_returns(event_bars(spark, sf), keep_first=True, grain=GRAIN)
    return bars.null_return_report(every)


_WIDE = ("spy_ret", "spy_adj_close", "tlt_ret", "tlt_adj_close", "hyg_ret", "hyg_adj_close", "vix", "vix3m")


@query(sql_round("SELECT * FROM wide", _WIDE, (*EVENT_BASE, EVENT_WIDE)))
def pivot_wide(spark, sf):
    return rounded(event_wide(spark, sf))


@query("""
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
         round(l_extendedprice, 8) AS l_extendedprice
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) AS rn
        FROM lineitem) r
  WHERE rn = 1""")
def dedupe_bars(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"
    )
    return rounded(
        bars.dedupe_last(
            rows,
            ["l_orderkey", "l_linenumber"],
            ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"],
        )
    )


@query("""
  SELECT l_orderkey, l_linenumber, count(*) AS copies
  FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_dates(spark, sf):
    from tidemark.operators.validate import duplicate_keys

    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    sql_round(
        """SELECT a.bar, a.ret AS ret_purchase, b.ret AS ret_view
           FROM event_curated a JOIN event_curated b ON a.bar = b.bar
           WHERE a.series = 'purchase' AND b.series = 'view'""",
        ("ret_purchase", "ret_view"),
        EVENT_BASE,
    )
)
def pair_returns(spark, sf):
    from tidemark.operators.profile import pair_returns as pairs

    curated = store.stored(event_curated(spark, sf).select("series", "bar", "ret"), "curated")
    return rounded(pairs(curated, "purchase", "view"))


@query(
    sql_round(
        """SELECT series, bar, exp(sum(ret) OVER w) AS growth,
                  sum(CASE WHEN ret > -1 THEN ln(1 + ret) END) OVER w AS log_growth_simple
           FROM supplier_curated
           WINDOW w AS (PARTITION BY series ORDER BY bar
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        ("growth", "log_growth_simple"),
        SUPPLIER_BASE,
    )
)
def cumulative_return(spark, sf):
    from tidemark.operators.profile import cumulative_return as growth

    curated = supplier_curated(spark, sf)
    out = growth(curated, grain=LINE_GRAIN)
    out = growth(out, simple=True, out="growth_simple", grain=LINE_GRAIN)
    log_simple = F.ln("growth_simple").alias("log_growth_simple")
    return rounded(out.select("series", "bar", "growth", log_simple))


@query("""
  WITH """ + ", ".join(SUPPLIER_BASE) + """
  SELECT series, bar, CAST(rn AS INTEGER) AS recency, round(ret, 8) + 0.0 AS ret
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY bar DESC) AS rn
        FROM supplier_curated) r
  WHERE rn <= 35""")
def tail_rows(spark, sf):
    tail = last_rows(supplier_curated(spark, sf), ["series"], "bar", 35)
    return rounded(tail.select("series", "bar", "recency", "ret"))


@query(
    sql_round(
        """SELECT bar, CASE WHEN count(value) OVER w = 60 THEN max(value) OVER w END AS max_60
           FROM (SELECT ts AS bar, value FROM events) e
           WINDOW w AS (ORDER BY bar ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""",
        ("max_60",),
    )
)
def halo_rolling_max(spark, sf):
    """One series holding every event, cut into chunks of 4096 rows with 59 halo rows."""
    events = table(spark, sf, "events").select(F.col("ts").alias("bar"), "value")

    def top(w):
        f = rolling.frame(w, 60)
        return {"max_60": rolling.gated(F.max("value").over(f), f, 60, F.col("value"))}

    out = over_rows(events, [], "bar", [top], back=59, rows=4096)
    return rounded(out.select("bar", "max_60"))


@query(
    sql_round(
        """SELECT ts AS bar, sum(value) OVER (ORDER BY ts) AS running_value FROM events""",
        ("running_value",),
    )
)
def halo_running_sum(spark, sf):
    """Running total of one long series from per-slot totals."""
    events = table(spark, sf, "events").select(F.col("ts").alias("bar"), "value")
    out = running_sum(
        events, [], "bar", F.col("value"), "running_value", slot=timedelta(hours=1)
    )
    return rounded(out.select("bar", "running_value"))


@query("""
  SELECT 'customer' AS layer, c_nationkey AS nation, round(c_acctbal, 8) + 0.0 AS balance FROM customer
  UNION ALL
  SELECT 'supplier', s_nationkey, round(s_acctbal, 8) + 0.0 FROM supplier""")
def union_layers(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.lit("customer").alias("layer"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").alias("nation"),
        F.lit("supplier").alias("layer"),
    )
    return rounded(store.union_layers([customer, supplier]))


@query(
    sql_round(
        """SELECT series, bar, strftime(bar, '%Y-%m-%d') AS day, exp(ret) - 1 AS simple_ret,
                  printf('%.2f percent', ret * 100) AS pct, printf('%+.1f percent', ret * 100) AS signed
           FROM supplier_curated""",
        ("simple_ret",),
        SUPPLIER_BASE,
    )
)
def scalar_formats(spark, sf):
    """Date and percent texts."""
    curated = supplier_curated(spark, sf)
    return rounded(
        curated.select(
            "series",
            "bar",
            iso_date(F.col("bar")).alias("day"),
            simple_return(F.col("ret")).alias("simple_ret"),
            percent_text(F.col("ret")).alias("pct"),
            signed_percent_text(F.col("ret") * 100.0).alias("signed"),
        )
    )


# ---- stores: each query writes below the scratch root and reads back -----------


@query("""
  SELECT strftime(date_trunc('month', bar), '%Y-%m-%d') AS month, count(*) AS rows,
         count(DISTINCT series) AS series, min(bar) AS first_bar, max(bar) AS last_bar
  FROM (SELECT DISTINCT l_suppkey AS series, date_trunc('week', l_shipdate) AS bar FROM lineitem) b
  GROUP BY 1""")
def partition_roundtrip(spark, sf):
    path = store.scratch_path(spark, "bars")
    store.write_partitions(supplier_bars(spark, sf), path, order="bar", by="month", unit="month")
    back = store.read_partitions(spark, path)
    return back.groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("series").alias("series"),
        F.min("bar").alias("first_bar"),
        F.max("bar").alias("last_bar"),
    )


@query("SELECT DISTINCT CAST(ts AS DATE) AS date FROM events")
def partition_dates(spark, sf):
    path = store.scratch_path(spark, "raw")
    store.write_partitions(
        bars.raw_bars(bars.normalise_bars(vendor_frame(spark, sf))), path, order="date", by="date"
    )
    return store.partition_dates(store.read_partitions(spark, path))


@query("""
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS rows,
         CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last
  FROM lineitem GROUP BY 1""")
def partition_facts(spark, sf):
    """Rows and range of every month of a stored table, answered from its files' footers."""
    path = store.scratch_path(spark, "months")
    lines = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("shipped"), "l_quantity")
    store.write_partitions(lines, path, order="shipped", by="month", unit="month")
    facts = store.partition_facts(spark, path, "shipped", by="month")
    return facts.select(F.col("month").cast("date").alias("month"), "rows", "first", "last")


@query("""
  SELECT CAST(o AS DATE) AS date
  FROM (SELECT DISTINCT date_trunc('day', o_orderdate) AS o FROM orders) w
  WHERE CAST(o AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""")
def missing_partitions(spark, sf):
    wanted = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"))
    present = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return store.missing_partitions(wanted, present)


@query("""
  SELECT CAST(o_orderdate AS DATE) AS date FROM orders
  UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem
  UNION SELECT CAST(ts AS DATE) FROM events""")
def manifest_merge(spark, sf):
    day = lambda name, col: table(spark, sf, name).select(F.to_date(col).alias("date"))
    return store.merge_manifest(
        day("orders", "o_orderdate"), day("lineitem", "l_shipdate"), day("events", "ts")
    )


@query("""
  SELECT 'events' AS dataset, min(ts) AS first_date, max(ts) AS last_date, count(*) AS rows,
         count(DISTINCT CAST(ts AS DATE)) AS dates FROM events
  UNION ALL SELECT 'orders', min(o_orderdate), max(o_orderdate), count(*),
         count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders
  UNION ALL SELECT 'lineitem', min(l_shipdate), max(l_shipdate), count(*),
         count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem""")
def dataset_status(spark, sf):
    at = lambda name, col: table(spark, sf, name).select(F.col(col).alias("bar"))
    return store.dataset_status(
        {
            "events": at("events", "ts"),
            "orders": at("orders", "o_orderdate"),
            "lineitem": at("lineitem", "l_shipdate"),
        }
    )


@query("""
  SELECT event_type AS run, count(*) AS n, round(avg(value), 8) AS mean_value
  FROM events GROUP BY 1
  UNION ALL SELECT l_returnflag, count(*), round(avg(l_quantity), 8) FROM lineitem GROUP BY 1""")
def run_log_append(spark, sf):
    path = store.scratch_path(spark, "log")
    first = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("run"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 8).alias("mean_value"))
    )
    second = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_returnflag").alias("run"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 8).alias("mean_value"))
    )
    store.append_records(first, path)
    store.append_records(second, path)
    return store.read_records(spark, path, first.schema)


@query("WITH " + ", ".join(SCORED_ALL) + """
  SELECT strftime(date_trunc('month', bar), '%Y-%m-%d') AS prediction_date,
         count(*) AS n, round(sum(prediction), 6) + 0.0 AS total, max(model) AS model_path,
         strftime(max(bar), '%Y-%m-%d') AS features_date
  FROM scored GROUP BY 1""")
def prediction_history(spark, sf):
    """Publish forecasts by month, consolidate all of them to JSON lines, summarise."""
    published, history = store.scratch_path(spark, "published"), store.scratch_path(spark, "history")
    rows = forecasts(spark, sf).select(
        F.col("prediction").alias("predicted_volatility"),
        iso_date(F.col("bar")).alias("features_date"),
        F.col("model").alias("model_path"),
        F.concat(iso_date(F.col("bar")), F.lit("T00:00:00Z")).alias("prediction_timestamp"),
        "bar",
    )
    store.write_partitions(rows, published, order="bar", by="prediction_date", unit="month")
    lines = store.prediction_history(store.read_partitions(spark, published))
    store.append_records(lines, history)
    back = store.read_records(spark, history, lines.schema)
    return back.groupBy("prediction_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("predicted_volatility"), 6).alias("total"),
        F.max("model_path").alias("model_path"),
        F.max("features_date").alias("features_date"),
    )


@query("WITH " + ", ".join(SUPPLIER_BASE) + """
  SELECT series, bar, round(ret, 8) + 0.0 AS ret FROM supplier_curated
  WHERE date_trunc('month', bar) = (SELECT date_trunc('month', max(bar)) FROM supplier_curated)""")
def latest_snapshot(spark, sf):
    path = store.scratch_path(spark, "runs")
    rows = supplier_curated(spark, sf).select("series", "bar", "ret")
    store.write_partitions(rows, path, order="bar", by="run", unit="month")
    latest = store.latest_snapshot(
        store.read_partitions(spark, path, "series long, bar timestamp_ntz, ret double, run string"),
        "run",
    )
    return rounded(latest.select("series", "bar", "ret"))

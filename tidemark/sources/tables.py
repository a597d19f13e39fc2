"""Readers for the parquet tables and the bars derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import log_returns, ohlcv_bars, vwap_bars

EVENT_GRAIN = "hour"
LINE_GRAIN = "week"
EVENT_ROLES = {
    "spy": "purchase", "tlt": "view", "hyg": "click", "vix": "error", "vix3m": "signup",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of the event values, one series per event type."""
    return ohlcv_bars(
        table(spark, sf_dir, "events"),
        series="event_type",
        ts="ts",
        value="value",
        every=EVENT_GRAIN,
    )


def event_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_returns(event_bars(spark, sf_dir), grain=EVENT_GRAIN).select(
        "series", "bar", "close", "adj_close", "ret"
    )


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly average unit price per supplier."""
    return vwap_bars(
        table(spark, sf_dir, "lineitem"),
        series=F.col("l_suppkey"),
        ts="l_shipdate",
        amount=F.col("l_extendedprice"),
        quantity=F.col("l_quantity"),
        every=LINE_GRAIN,
    )


def supplier_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_returns(supplier_bars(spark, sf_dir), grain=LINE_GRAIN)


def market_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly average unit price over all suppliers: the benchmark series."""
    return vwap_bars(
        table(spark, sf_dir, "lineitem"),
        series=F.lit("market"),
        ts="l_shipdate",
        amount=F.col("l_extendedprice"),
        quantity=F.col("l_quantity"),
        every=LINE_GRAIN,
    )


def market_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_returns(market_bars(spark, sf_dir), grain=LINE_GRAIN)

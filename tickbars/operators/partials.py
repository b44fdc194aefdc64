"""Candles from deliveries that cut buckets anywhere: states that merge.

The state of a bucket is its open and close with their order keys, high, low and volume.
Merging is associative and commutative, so the states of deliveries that have no tick in
common add up to the candle of all of them, without going back to ticks.  A state is
known by its delivery: one that comes again takes the place of itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions import columns as C
from tickbars.functions.timeframes import check_timeframe_name, window_args
from tickbars.schemas import CANDLE_VALUES, require_columns
from tickbars.session import require_utc
from tickbars.sources.versions import VersionedTable

KEY = T.DecimalType(38, 0)
STATE = T.StructType(
    [
        T.StructField("bar_time", T.TimestampType()),
        T.StructField("bar_open", T.DoubleType()),
        T.StructField("open_key", KEY),
        T.StructField("bar_high", T.DoubleType()),
        T.StructField("bar_low", T.DoubleType()),
        T.StructField("bar_close", T.DoubleType()),
        T.StructField("close_key", KEY),
        T.StructField("bar_volume", T.DoubleType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("timeframe", T.StringType()),
        T.StructField("bar_month", T.StringType()),
        T.StructField("delivery", T.StringType()),
    ]
)


def states(ticks: DataFrame, timeframe: str, delivery: str) -> DataFrame:
    """The states of the buckets that clean *ticks* fall in.  One shuffle with map-side partials."""
    require_columns(ticks, ["timestamp_utc", "symbol", "price", "bid_volume", "ask_volume", "seq"], "states")
    price = F.nanvl(F.col("price"), F.lit(None))
    order = F.when(price.isNotNull(), C.order_key(F.col("timestamp_utc"), F.col("seq")))
    return (
        ticks.groupBy("symbol", F.window("timestamp_utc", **window_args(timeframe)).alias("bucket"))
        .agg(
            F.min_by(price, order).alias("bar_open"), F.min(order).cast(KEY).alias("open_key"),
            F.max(price).alias("bar_high"), F.min(price).alias("bar_low"),
            F.max_by(price, order).alias("bar_close"), F.max(order).cast(KEY).alias("close_key"),
            F.sum(F.col("bid_volume") + F.col("ask_volume")).alias("bar_volume"),
        )
        .withColumns({
            "bar_time": F.col("bucket.start"), "timeframe": F.lit(check_timeframe_name(timeframe)),
            "bar_month": F.date_format("bucket.start", "yyyy-MM"), "delivery": F.lit(delivery),
        })
        .select(*STATE.names)
    )


def merge_states(parts: DataFrame) -> DataFrame:
    """One candle for each symbol, timeframe and bucket of any number of states."""
    return (
        parts.groupBy("symbol", "timeframe", "bar_time")
        .agg(
            F.min_by("bar_open", "open_key").alias("bar_open"), F.max("bar_high").alias("bar_high"),
            F.min("bar_low").alias("bar_low"), F.max_by("bar_close", "close_key").alias("bar_close"),
            F.sum("bar_volume").alias("bar_volume"),
        )
        .select("symbol", "timeframe", "bar_time", *CANDLE_VALUES)
    )


def state_table(path: str) -> VersionedTable:
    return VersionedTable(path.rstrip("/"), STATE, ("symbol", "timeframe", "bar_month", "delivery"))


def deliver(spark: SparkSession, ticks: DataFrame, path: str, timeframe: str, delivery: str) -> None:
    """Put the states of one delivery of clean ticks into the table at *path*; the same delivery again replaces them."""
    require_utc(spark)
    state_table(path).replace(states(ticks, timeframe, delivery).hint("rebalance", "symbol", "bar_month"))


def delivered_candles(spark: SparkSession, path: str, timeframe: str) -> DataFrame:
    """Candles of all deliveries."""
    return merge_states(state_table(path).read(spark, F.col("timeframe") == timeframe))

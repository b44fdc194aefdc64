"""Ticks to candles, candles to wider candles, and candles back to ticks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions import columns as C
from tickbars.functions.timeframes import check_divides, window_args
from tickbars.schemas import BARS, CANDLE_VALUES, TICKS, require_columns, series_keys

# Where in a bar its open, high, low and close are placed, in seconds.
TICK_OFFSETS = {"open": 0, "high": 20, "low": 40, "close": 59}


def as_frame(source, spark: SparkSession | None = None) -> DataFrame:
    """A DataFrame as it is, or the Parquet table at a path."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, (str, os.PathLike)):
        spark = spark or SparkSession.active()
        return spark.read.parquet(os.fspath(source))
    raise TypeError(f"expected a DataFrame or a path to Parquet, got {type(source).__name__}")


def resample(source, timeframe: str = "5min", spark: SparkSession | None = None, counts: bool = False) -> DataFrame:
    """Clean ticks to one candle for each symbol and non-empty bucket.

    ``bar_time`` is the left edge.  Open and close follow time, then ``seq``;
    ticks without a price still add their volume.  One shuffle, carrying at
    most one row for each map task, symbol and bucket.  *counts* adds
    ``ticks``, ``first_tick`` and ``last_tick``.
    """
    ticks = as_frame(source, spark)
    require_columns(ticks, ["timestamp_utc", "price", "bid_volume", "ask_volume"], "resample")
    keys = series_keys(ticks)
    seq = F.col("seq") if "seq" in ticks.columns else F.lit(0)
    price = F.nanvl(F.col("price"), F.lit(None))
    # An order key that is NULL keeps a row out of min_by and max_by.
    order = F.when(price.isNotNull(), C.order_key(F.col("timestamp_utc"), seq))
    counted = [
        F.count(F.lit(1)).alias("ticks"),
        F.min("timestamp_utc").alias("first_tick"),
        F.max("timestamp_utc").alias("last_tick"),
    ]
    more = ["ticks", "first_tick", "last_tick"] if counts else []
    return (
        ticks.groupBy(*keys, F.window("timestamp_utc", **window_args(timeframe)).alias("bucket"))
        .agg(
            F.min_by(price, order).alias("bar_open"),
            F.max(price).alias("bar_high"),
            F.min(price).alias("bar_low"),
            F.max_by(price, order).alias("bar_close"),
            F.sum(F.col("bid_volume") + F.col("ask_volume")).alias("bar_volume"),
            *(counted if counts else []),
        )
        .select(*keys, F.col("bucket.start").alias("bar_time"), *CANDLE_VALUES, *more)
    )


def roll_up(candles: DataFrame, fine: str, coarse: str) -> DataFrame:
    """Candles of width *fine* to candles of width *coarse*, without going back to ticks."""
    check_divides(fine, coarse)
    require_columns(candles, ["bar_time", *CANDLE_VALUES], "roll_up")
    keys = [k for k in series_keys(candles) if k != "timeframe"]
    opened = F.when(F.col("bar_open").isNotNull(), F.col("bar_time"))
    closed = F.when(F.col("bar_close").isNotNull(), F.col("bar_time"))
    return (
        candles.groupBy(*keys, F.window("bar_time", **window_args(coarse)).alias("bucket"))
        .agg(
            F.min_by("bar_open", opened).alias("bar_open"),
            F.max("bar_high").alias("bar_high"),
            F.min("bar_low").alias("bar_low"),
            F.max_by("bar_close", closed).alias("bar_close"),
            F.sum("bar_volume").alias("bar_volume"),
        )
        .select(*keys, F.col("bucket.start").alias("bar_time"), *CANDLE_VALUES)
    )


def bars_to_ticks(bars: DataFrame) -> DataFrame:
    """Each bar as four ticks that :func:`resample` turns back into the same bar.

    Bid equals ask.  The close tick carries the volume.  Meant for bars of a
    minute or more.  No shuffle.
    """
    require_columns(bars, BARS.names, "bars_to_ticks")
    zero = F.lit(0.0)
    ticks = [
        F.struct(
            F.lit(second).cast("long").alias("offset"),
            F.col(part).alias("quote"),
            (F.col("volume") if part == "close" else zero).alias("traded"),
            F.lit(seq).cast("long").alias("seq"),
        )
        for seq, (part, second) in enumerate(TICK_OFFSETS.items())
    ]
    at = F.timestamp_millis(F.unix_millis("timestamp_utc") + F.col("offset") * 1000)
    return bars.select("timestamp_utc", F.upper("symbol").alias("symbol"), F.inline(F.array(*ticks))).select(
        at.alias("timestamp_utc"),
        F.col("quote").alias("ask"),
        F.col("quote").alias("bid"),
        zero.alias("ask_volume"),
        F.col("traded").alias("bid_volume"),
        "symbol",
        "seq",
    ).select(*TICKS.names)


def candles_to_bars(candles: DataFrame) -> DataFrame:
    """Candle columns under the names of the live bar frame."""
    return candles.select(
        F.col("bar_time").alias("timestamp_utc"),
        *[F.col(f"bar_{p}").alias(p) for p in ("open", "high", "low", "close", "volume")],
        "symbol",
    )


def latest_price(ticks: DataFrame, source: str = "ticks") -> DataFrame:
    """The newest price of each symbol."""
    require_columns(ticks, ["timestamp_utc", "price"], "latest_price")
    seq = F.col("seq") if "seq" in ticks.columns else F.lit(0)
    price = F.nanvl(F.col("price"), F.lit(None))
    order = F.when(price.isNotNull(), C.order_key(F.col("timestamp_utc"), seq))
    when = F.max(F.when(price.isNotNull(), F.col("timestamp_utc")))
    return (
        ticks.groupBy("symbol")
        .agg(when.alias("timestamp_utc"), F.max_by(price, order).alias("price"))
        .select("timestamp_utc", "symbol", "price", F.lit(source).alias("source"))
    )

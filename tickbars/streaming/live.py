"""Landed bar documents to the ledger, one micro-batch at a time.

Every delivery repeats recent bars, and the newest bar is still forming.  The
merge by key makes that harmless: a batch applied twice gives the same table.

A delivery starts and ends anywhere.  With ``continued`` the bars themselves are kept, each
in its newest revision, and a candle is made anew from all bars of its bucket whenever
one of them comes; its ATR goes on from the candles before (``operators.carry``).  The
ledger then is the same however the bars were cut into deliveries.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions.timeframes import check_divides, window_args
from tickbars.operators.bars import bars_to_ticks, resample
from tickbars.operators.carry import upsert_with_atr
from tickbars.operators.cleaning import clean_ticks
from tickbars.operators.indicators import compute_atr
from tickbars.operators.ledger import Upserted, ledger_rows, upsert_candles
from tickbars.schemas import BARS
from tickbars.session import discard, require_utc, stored
from tickbars.sources.barfeed import document_columns, feed_bars, latest_revision, newest_revision
from tickbars.sources.versions import VersionedTable

FILES_PER_BATCH = 10_000
KEPT_BARS = T.StructType(
    [f for f in BARS.fields if f.name != "symbol"]
    + [T.StructField("delivered_at", T.TimestampType()), T.StructField("symbol", T.StringType()), T.StructField("month", T.StringType())]
)


def document_stream(spark: SparkSession, root: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """New feed documents as they land below *root*, at most *files_per_batch* at a time."""
    reader = spark.readStream.option("wholetext", "true").option("pathGlobFilter", "*.json")
    reader = reader.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
    return document_columns(reader.text(root))


def trim_leading_partial(candles: DataFrame, ticks: DataFrame) -> DataFrame:
    """Drop the first candle of a symbol when its data starts inside the bucket.

    A window of recent bars usually does; upserting that candle would replace a
    full one by a partial one.
    """
    first = ticks.groupBy("symbol").agg(F.min("timestamp_utc").alias("_first"))
    return candles.join(first, "symbol").where("bar_time >= _first").drop("_first")


def live_ticks(documents: DataFrame) -> DataFrame:
    """The newest revision of every delivered bar, as ticks."""
    return bars_to_ticks(stored(latest_revision(feed_bars(documents)), "live-bars"))


def _candles_without_atr(ticks: DataFrame, timeframe: str, trim: bool) -> DataFrame:
    candles = resample(clean_ticks(ticks), timeframe)
    return stored(trim_leading_partial(candles, ticks) if trim else candles, "live-candles")


def live_candles(documents: DataFrame, fetch_interval: str, timeframe: str, period: int = 14,
                 trim: bool = True) -> DataFrame:
    """Feed documents to candles with ATR, through the same chain as history."""
    check_divides(fetch_interval, timeframe)
    return compute_atr(_candles_without_atr(live_ticks(documents), timeframe, trim), period)


def bar_table(ledger_path: str) -> VersionedTable:
    """The bars a feed has delivered, each in its newest revision, by symbol and month."""
    return VersionedTable(f"{ledger_path.rstrip('/')}_bars", KEPT_BARS, ("symbol", "month"))


def keep_bars(spark: SparkSession, bars: DataFrame, ledger_path: str) -> None:
    """Merge delivered bars (with ``delivered_at``) into the bar table; only months they touch are rewritten.

    Taking the newest revision is associative and a repeat changes nothing, so the
    deliveries may overlap, repeat and come in any order.  *bars* is read more than once.
    """
    require_utc(spark)
    table = bar_table(ledger_path)
    month = F.date_format("timestamp_utc", "yyyy-MM")
    fresh = bars.withColumn("month", month).select(*KEPT_BARS.names)
    touched = fresh.select("symbol", "month").distinct()
    edges = touched.agg(F.min("month").alias("a"), F.max("month").alias("b")).first()
    if edges["a"] is None:
        return
    old = table.read(spark, F.col("month").between(edges["a"], edges["b"])).join(touched, ["symbol", "month"], "left_semi")
    both = newest_revision(old.unionByName(fresh)).withColumn("month", month)
    table.replace(both.select(*KEPT_BARS.names).hint("rebalance", "symbol", "month"))


def touched_candles(spark: SparkSession, bars: DataFrame, ledger_path: str, timeframe: str, trim: bool = True) -> DataFrame:
    """Candles of every bucket that *bars* fall in, from all kept bars of those buckets.

    With *trim* a bucket that begins before the first bar ever kept of its symbol is left
    out: only history knows all of it.
    """
    bucket = F.window("timestamp_utc", **window_args(timeframe))
    buckets = stored(bars.select("symbol", bucket.alias("_bucket")).distinct(), "live-buckets")
    edges = buckets.agg(
        F.date_format(F.min("_bucket.start"), "yyyy-MM").alias("a"), F.date_format(F.max("_bucket.end"), "yyyy-MM").alias("b")
    ).first()
    table = bar_table(ledger_path)
    within = table.read(spark, F.col("month").between(edges["a"], edges["b"])).withColumn("_bucket", bucket)
    ticks = bars_to_ticks(within.join(buckets, ["symbol", "_bucket"], "left_semi").select(*BARS.names))
    candles = resample(clean_ticks(ticks), timeframe)
    if not trim:
        return candles
    symbols = buckets.select("symbol").distinct()
    oldest = table.manifest(spark).join(symbols, "symbol", "left_semi").groupBy("symbol").agg(F.min("month").alias("month"))
    first = table.read(spark).join(oldest, ["symbol", "month"], "left_semi").groupBy("symbol").agg(
        F.min("timestamp_utc").alias("_first")
    )
    return candles.join(first, "symbol").where("bar_time >= _first").drop("_first")


def apply_documents(spark: SparkSession, documents: DataFrame, ledger_path: str, fetch_interval: str,
                    timeframe: str, period: int, now_ms: int, trim: bool = True, continued: bool = False) -> Upserted:
    """One batch of documents into the ledger.

    By default a batch is taken as all there is: candles and ATR come from its own bars
    only.  With *continued* the bars join those kept before, touched candles are made anew
    from all of them, and ATR goes on from the candles before.
    """
    check_divides(fetch_interval, timeframe)
    if not continued:
        ticks = live_ticks(documents)
        candles = _candles_without_atr(ticks, timeframe, trim)
        rows = stored(ledger_rows(compute_atr(candles, period), timeframe), "live-ledger-rows")
        written = upsert_candles(spark, ledger_path, rows, now_ms)
        discard(ticks, candles, rows)
        return written
    bars = stored(newest_revision(feed_bars(documents)), "live-bars")
    if bars.isEmpty():
        return Upserted(0, 0)
    keep_bars(spark, bars, ledger_path)
    rows = stored(ledger_rows(touched_candles(spark, bars, ledger_path, timeframe, trim), timeframe), "live-ledger-rows")
    written = upsert_with_atr(spark, ledger_path, rows, period, now_ms)
    discard(bars, rows)
    return written


def write_live(documents: DataFrame, ledger_path: str, checkpoint: str, fetch_interval: str = "1min",
               timeframe: str = "5min", period: int = 14, trim: bool = True, clock=time.time, continued: bool = False):
    """Start the query that keeps the ledger up to date with a document stream.

    *continued* makes the ledger independent of how bars were cut into batches (see
    :func:`apply_documents`).
    """
    check_divides(fetch_interval, timeframe)

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_documents(
            batch.sparkSession, batch, ledger_path, fetch_interval, timeframe, period, int(clock() * 1000), trim, continued
        )

    return (
        documents.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

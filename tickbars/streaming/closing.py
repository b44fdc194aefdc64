"""Closed candles from the archive, with repair of what came late.

A stream that forms candles in state must drop a tick that comes after the watermark.
Here every tick goes to the archive, late or not, and candles come from the archive:
each micro-batch makes the candles whose end the watermark has passed since the batch
before, and makes anew those closed ones that late ticks fall in.  Duplicates are
settled over all that has ever arrived, and ATR goes on over all closed candles, so the
ledger equals a batch run over the same ticks.

How far a query has come is one small file for each batch.  A batch that runs again reads
the files of the batches before it, so it finds the same watermark, closes the same
candles and writes the same rows.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions.timeframes import check_timeframe_name, timeframe_seconds, window_args
from tickbars.operators.bars import resample
from tickbars.operators.carry import upsert_with_atr
from tickbars.operators.cleaning import clean_ticks
from tickbars.operators.ledger import ledger_rows, upsert_candles, valid_candle
from tickbars.session import discard, files_of, stored
from tickbars.sources.bronze import add_to_archive, fold_archive, read_archive

LATE = "batch BIGINT, symbol STRING, bar_time TIMESTAMP, ticks BIGINT"
LISTED_DAYS = 1000


@dataclass(frozen=True)
class Closing:
    """A query that closes candles of one timeframe; its state lies beside the ledger.  No period, no ATR."""

    archive_path: str
    ledger_path: str
    timeframe: str
    delay_seconds: int
    period: int | None = 14

    @property
    def folder(self) -> str:
        return f"{self.ledger_path.rstrip('/')}_closing/{check_timeframe_name(self.timeframe)}"

    def seen_before(self, spark: SparkSession, batch: int) -> int | None:
        """The newest tick, in epoch microseconds, of all batches before *batch*."""
        files, pattern = files_of(spark, f"{self.folder}/seen/*.json")
        done = [f.getPath() for f in files.globStatus(pattern) or []]
        done = [p for p in done if int(p.getName().split(".")[0]) < batch]
        if not done:
            return None
        stream = files.open(max(done, key=lambda p: p.getName()))
        try:
            return json.loads(bytes(stream.readAllBytes()))["seen"]
        finally:
            stream.close()

    def remember(self, spark: SparkSession, batch: int, seen: int | None) -> None:
        files, path = files_of(spark, f"{self.folder}/seen/{batch:012d}.json")
        out = files.create(path, True)
        try:
            out.write(bytearray(json.dumps({"seen": seen}).encode()))
        finally:
            out.close()

    def late(self, spark: SparkSession) -> DataFrame:
        """The closed candles that late ticks fell in, batch by batch, and how many ticks that were."""
        return spark.read.schema(LATE).option("recursiveFileLookup", "true").parquet(f"{self.folder}/late")

    def apply(self, batch: DataFrame, batch_id: int, now_ms: int) -> None:
        """One micro-batch of ticks."""
        spark = batch.sparkSession
        ticks = stored(batch, "closing-ticks")
        newest = ticks.agg(F.max(F.unix_micros("timestamp_utc")).alias("t")).first()["t"]
        before = self.seen_before(spark, batch_id)
        seen = max((t for t in (before, newest) if t is not None), default=None)
        if newest is not None:
            add_to_archive(ticks, self.archive_path)
            fold_archive(spark, self.archive_path)
            self._close(spark, ticks, batch_id, before, seen, now_ms)
        self.remember(spark, batch_id, seen)
        discard(ticks)

    def _close(self, spark, ticks: DataFrame, batch_id: int, before: int | None, seen: int, now_ms: int) -> None:
        delay = self.delay_seconds * 1_000_000
        width = timeframe_seconds(self.timeframe)
        bucket = F.window("timestamp_utc", **window_args(self.timeframe))
        end = F.unix_micros(F.col("_bucket.end"))
        passed = F.lit(seen - delay)
        closed = end <= passed
        if before is not None:
            closed &= end > F.lit(before - delay)
        dirty = ticks.select("symbol", bucket.alias("_bucket")).where(end <= F.lit((before or 0) - delay))
        dirty = dirty.groupBy("symbol", "_bucket").agg(F.count(F.lit(1)).alias("ticks"))
        late = dirty.select(F.lit(batch_id).cast("long").alias("batch"), "symbol", F.col("_bucket.start").alias("bar_time"), "ticks")
        late.write.mode("overwrite").parquet(f"{self.folder}/late/batch={batch_id:012d}")
        late = spark.read.schema(LATE).parquet(f"{self.folder}/late/batch={batch_id:012d}")

        now_closed = self._candles(self._ticks(spark, before, seen, width).withColumn("_bucket", bucket).where(closed))
        rows = [now_closed]
        days = self._days(late, width)
        if days:
            named = late.select("symbol", F.col("bar_time").alias("_start"))
            again = read_archive(spark, self.archive_path, days=days).withColumn("_bucket", bucket)
            again = again.withColumn("_start", F.col("_bucket.start")).join(named, ["symbol", "_start"], "left_semi")
            rows.append(self._candles(again))
        both = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
        good = stored(ledger_rows(both.where(valid_candle()), self.timeframe), "closing-rows")
        if self.period is None:
            upsert_candles(spark, self.ledger_path, good, now_ms)
        else:
            upsert_with_atr(spark, self.ledger_path, good, self.period, now_ms)
        discard(good)

    def _candles(self, ticks: DataFrame) -> DataFrame:
        return resample(clean_ticks(ticks.drop("_bucket", "_start")), self.timeframe)

    def _ticks(self, spark: SparkSession, before: int | None, seen: int, width: int) -> DataFrame:
        """Archived ticks of the days that candles closed by now can lie in."""
        day = lambda us: time.strftime("%Y-%m-%d", time.gmtime(us // 1_000_000))
        if before is None:
            return read_archive(spark, self.archive_path)
        return read_archive(spark, self.archive_path, day(before - (self.delay_seconds + width) * 1_000_000), day(seen))

    @staticmethod
    def _days(late: DataFrame, width: int) -> list[str]:
        """The days that the late candles cover; from the first to the last where they are too many to list."""
        last = F.timestamp_seconds(F.unix_seconds("bar_time") + width - 1)
        found = late.select(F.explode(F.sequence(F.to_date("bar_time"), F.to_date(last))).alias("day"))
        found = found.select(F.col("day").cast("string").alias("day"))
        listed = [r.day for r in found.distinct().limit(LISTED_DAYS + 1).collect()]
        if len(listed) <= LISTED_DAYS:
            return listed
        ends = found.agg(F.min("day").alias("a"), F.max("day").alias("b"))
        every = ends.select(F.explode(F.sequence(F.to_date("a"), F.to_date("b"))).alias("day"))
        return [r.day.isoformat() for r in every.collect()]


def write_closed_candles(ticks: DataFrame, closing: Closing, checkpoint: str, clock=time.time):
    """Start the query that archives *ticks* and keeps the ledger's closed candles right."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        closing.apply(batch, batch_id, int(clock() * 1000))

    return (
        ticks.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

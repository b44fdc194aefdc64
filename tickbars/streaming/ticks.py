"""The tick chain as Structured Streaming: clean, bars, ATR and gaps as data arrives.

Each function takes and returns a streaming DataFrame, so a job is one chain of
``transform`` calls.  Bars leave in append mode, once the watermark has passed
their end; ATR and gaps run on those closed bars.  Ticks later than the
watermark are dropped and counted by Spark; a batch run of the day repairs it.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tickbars.functions.timeframes import timeframe_seconds
from tickbars.operators.bars import resample
from tickbars.operators.cleaning import TICK_IDENTITY, derive_price
from tickbars.operators.gaps import LONG_STEP, classify_gaps, runs_in_holes
from tickbars.operators.ledger import ledger_rows, upsert_candles
from tickbars.schemas import CANDLES, TICKS, with_fields
from tickbars.session import discard, stored
from tickbars.sources.bronze import add_to_archive, fold_archive

FILES_PER_BATCH = 1000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_keyed_state(spark: SparkSession) -> None:
    """Choose the state store that the ATR and gap processors need.  Call before a query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def tick_stream(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """New raw ticks as they land in a table written by ``bronze.land_hours``, a bounded number of files at a time."""
    return spark.readStream.schema(TICKS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def clean_stream(ticks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Mid price and duplicates, with state bounded by the watermark.

    The first duplicate to arrive stays.  Price is part of the key, so open,
    high, low and close equal the batch result.
    """
    return derive_price(ticks).withWatermark("timestamp_utc", delay).dropDuplicates(list(TICK_IDENTITY))


def settled_stream(ticks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Mid price and duplicates as batch has them: of equal ticks the one delivered first, volumes included.

    A tick leaves once the watermark has passed its time, when no duplicate can come any
    more, so the choice does not depend on which one arrived first.  State holds one
    tick for each identity of the last *delay*.  For append mode; bars that are still
    forming need :func:`clean_stream`, which lets a tick through at once.
    """
    priced = derive_price(ticks).withWatermark("timestamp_utc", delay)
    rest = sorted((c for c in priced.columns if c not in TICK_IDENTITY), key=lambda c: (c != "seq", c))
    first = priced.groupBy(*TICK_IDENTITY).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*[c if c in TICK_IDENTITY else F.col(f"_first.{c}").alias(c) for c in priced.columns])


def bar_stream(clean: DataFrame, timeframe: str) -> DataFrame:
    """Clean ticks to bars; the same plan as in batch."""
    return resample(clean, timeframe)


def _wilder(period: int):
    # Defined here so that it reaches the tasks by value.
    from pyspark.sql.streaming import StatefulProcessor

    class Wilder(StatefulProcessor):
        def init(self, handle):
            self.state = handle.getValueState("wilder_v1", "bars BIGINT, last_close DOUBLE, level DOUBLE")

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            bars = pd.concat(rows).sort_values("bar_time")
            count, last, level = self.state.get() if self.state.exists() else (0, None, 0.0)
            out = []
            for high, low, close in zip(bars["bar_high"], bars["bar_low"], bars["bar_close"]):
                if pd.isna(high) or pd.isna(low) or pd.isna(close):
                    out.append(None)  # as in batch: no average, and the level stays
                    continue
                reach = high - low if last is None else max(high - low, abs(high - last), abs(low - last))
                count, last = count + 1, close
                # Up to the first full window the level is a running mean share.
                level = level + reach / period if count <= period else (level * (period - 1) + reach) / period
                out.append(level if count >= period else None)
            self.state.update((count, last, level))
            yield bars.assign(atr=pd.Series(out, index=bars.index, dtype="float64"))

        def close(self):
            pass

    return Wilder()


def atr_stream(bars: DataFrame, period: int = 14) -> DataFrame:
    """Closed bars with Wilder's ATR carried across batches, one small state for each symbol."""
    return bars.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=_wilder(period),
        outputStructType=with_fields(CANDLES, atr=DoubleType()),
        outputMode="Append",
        timeMode="None",
    )


def _last_seen(step: int):
    from pyspark.sql.streaming import StatefulProcessor

    class LastSeen(StatefulProcessor):
        def init(self, handle):
            self.state = handle.getValueState("last_seen_v1", "bucket BIGINT")

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np
            import pandas as pd

            seen = np.unique(np.concatenate([chunk["bucket"].to_numpy("int64") for chunk in rows]))
            if self.state.exists():
                seen = np.concatenate([[self.state.get()[0]], seen])
            gap = np.flatnonzero(np.diff(seen) > step)
            self.state.update((int(seen[-1]),))
            yield pd.DataFrame({"symbol": key[0], "last_seen": seen[gap], "resumed": seen[gap + 1]})

        def close(self):
            pass

    return LastSeen()


def gap_stream(bars: DataFrame, timeframe: str) -> DataFrame:
    """Gaps between closed bars, labelled, reported when data resumes.

    Python only remembers the last bucket of a symbol; the runs inside a hole
    are found by the same columns as in batch.
    """
    step = timeframe_seconds(timeframe)
    if step > LONG_STEP:
        raise ValueError(f"streaming gaps need a timeframe of two days or less, got {timeframe!r}")
    seconds = F.unix_seconds("bar_time")
    found = (
        bars.select("symbol", (seconds - F.pmod(seconds, F.lit(step))).alias("bucket"))
        .groupBy("symbol")
        .transformWithStateInPandas(
            statefulProcessor=_last_seen(step),
            outputStructType="symbol STRING, last_seen BIGINT, resumed BIGINT",
            outputMode="Append",
            timeMode="None",
        )
    )
    return classify_gaps(runs_in_holes(found, timeframe))


def _silence(step: int, limit: int):
    from pyspark.sql.streaming import StatefulProcessor

    class Silence(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.state = handle.getValueState("silence_v1", "bucket BIGINT, told BOOLEAN")

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np
            import pandas as pd

            last, told = self.state.get() if self.state.exists() else (None, False)
            # Chunk by chunk only the distinct buckets are held: one for each step of the batch's time.
            seen = np.empty(0, np.int64)
            for chunk in rows:
                seen = np.union1d(seen, chunk["bucket"].to_numpy("int64"))
            if last is not None:
                seen = np.concatenate([[last], seen[seen > last]])
            gap = np.flatnonzero(np.diff(seen) > step + limit)
            if len(seen) > 1 or last is None:
                told = False
            newest = int(seen[-1])
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            if not told:
                self.handle.registerTimer((newest + step + limit) * 1000)
            self.state.update((newest, told))
            yield pd.DataFrame(
                {"symbol": key[0], "last_seen": seen[gap], "resumed": seen[gap + 1].astype("float64"), "state": "closed"}
            )

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            import pandas as pd

            last, _ = self.state.get()
            self.state.update((last, True))
            yield pd.DataFrame({"symbol": [key[0]], "last_seen": [last], "resumed": [float("nan")], "state": ["open"]})

        def close(self):
            pass

    return Silence()


def silence_stream(ticks: DataFrame, timeframe: str, limit: str) -> DataFrame:
    """Gaps longer than *limit*, told while they last: symbol, last_seen, resumed, state.

    *ticks* have a watermark on ``timestamp_utc``.  A symbol without data is ``open`` as soon
    as the watermark is *limit* past the end of its last bucket, by a timer, though none
    of its own rows come; it is ``closed`` when data resumes.  A gap that begins and ends
    between two micro-batches is told once, as closed.  Only the time of the last bucket is state.
    """
    step, wait = timeframe_seconds(timeframe), timeframe_seconds(limit)
    seconds = F.unix_seconds("timestamp_utc")
    found = (
        ticks.select("symbol", "timestamp_utc", (seconds - F.pmod(seconds, F.lit(step))).alias("bucket"))
        .groupBy("symbol")
        .transformWithStateInPandas(
            statefulProcessor=_silence(step, wait),
            outputStructType="symbol STRING, last_seen BIGINT, resumed DOUBLE, state STRING",
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    resumed = F.timestamp_seconds(F.nanvl("resumed", F.lit(None)).cast("long"))
    return found.select("symbol", F.timestamp_seconds("last_seen").alias("last_seen"), resumed.alias("resumed"), "state")


def write_open_bars(bars: DataFrame, ledger_path: str, checkpoint: str, timeframe: str, clock=time.time):
    """Keep the ledger current with bars that are still forming.

    In update mode a bar leaves every time it changes; the merge by key corrects
    the row.  ATR needs closed bars, so it comes from :func:`atr_stream` or a
    batch run, and the merge never clears it.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = stored(ledger_rows(batch, timeframe), "open-bars")
        upsert_candles(batch.sparkSession, ledger_path, rows, int(clock() * 1000))
        discard(rows)

    return (
        bars.writeStream.foreachBatch(apply)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_archive(ticks: DataFrame, path: str, checkpoint: str):
    """Add arriving ticks to the day archive, a piece a batch; days of many pieces are folded to one.

    A batch applied twice adds the same ticks twice, which readers of the archive drop.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        add_to_archive(batch, path)
        fold_archive(batch.sparkSession, path)

    return (
        ticks.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query) -> int:
    """Rows a query dropped because they came after the watermark, in the progress it still holds.

    Spark keeps the last hundred reports only; ``streaming.progress`` counts all of them.
    """
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def write_stream(stream: DataFrame, path: str, checkpoint: str):
    """Append a stream to Parquet, processing what has arrived and stopping."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )

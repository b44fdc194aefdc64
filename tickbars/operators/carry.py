"""ATR that goes on where an earlier run stopped.

Beside the ledger lies a small table of carries: for each series and month how many
candles it has had, its last close and the level of the recurrence.  A run that adds or
corrects candles starts from the carry of the month before the first one changed, reads
that month and the ones after it, and nothing earlier.  A change loses its weight as the
series goes on, ``((n - 1) / n) ** candles``; months that begin after it has fallen below
rounding keep their averages, and only the candle counts of their carries move.

Ledger first, carries second: a run that is lost between the two leaves carries of the
months it changed behind, and the same run again replaces both.  One writer at a time.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.operators.indicators import atr_levels
from tickbars.operators.ledger import PARTITIONS, READ_SCHEMA, Upserted, bar_month, ledger_table, merge_candles
from tickbars.schemas import LEDGER, LEDGER_KEY
from tickbars.session import discard, require_utc, stored
from tickbars.sources.versions import VersionedTable

SERIES = ["symbol", "timeframe"]
CARRY = T.StructType(
    [
        T.StructField("bar_month", T.StringType()),
        T.StructField("bars", T.LongType()),
        T.StructField("last_close", T.DoubleType()),
        T.StructField("level", T.DoubleType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("timeframe", T.StringType()),
    ]
)
# A change counts until its weight is below 2 ** -LOST_BITS.
LOST_BITS = 100


def carry_table(ledger_path: str, period: int) -> VersionedTable:
    return VersionedTable(f"{ledger_path.rstrip('/')}_carry/period={period}", CARRY, tuple(SERIES))


def read_carry(spark: SparkSession, ledger_path: str, period: int) -> DataFrame:
    """Where each series stood at the end of each month."""
    return carry_table(ledger_path, period).read(spark)


def weightless_after(period: int) -> int:
    """Candles after which a change of one range can't be told from rounding any more."""
    return 1 if period == 1 else math.ceil(LOST_BITS * math.log(2) / -math.log((period - 1) / period))


def _spans(changed: DataFrame, carry: DataFrame, period: int) -> DataFrame:
    """For each changed series: its first and last month to compute, and where it stood before."""
    month = bar_month(F.col("bar_time"))
    spans = changed.groupBy(*SERIES).agg(
        F.min(month).alias("first_month"), F.max(month).alias("last_change"), F.min("bar_time").alias("first_change")
    )
    both = carry.join(spans, SERIES)
    stood = F.struct("bars", "last_close", "level")
    before = F.when(F.col("bar_month") < F.col("first_month"), F.col("bar_month"))
    known = F.col("bar_month") <= F.col("last_change")
    ends = both.groupBy(*SERIES).agg(
        F.max_by(stood, before).alias("stood"),
        F.max(F.when(known, F.col("bars"))).alias("bars_then"),
        F.sort_array(F.collect_list(F.when(~known, F.struct("bar_month", "bars")))).alias("later"),
    )
    settled = F.filter("later", lambda m: m["bars"] - F.coalesce("bars_then", F.lit(0)) >= weightless_after(period))
    return spans.join(ends, SERIES, "left").select(
        *SERIES, "first_month", "first_change", "stood.*",
        F.try_element_at(settled, F.lit(1))["bar_month"].alias("until"),
    )


def refresh_atr(spark: SparkSession, ledger_path: str, changed: DataFrame, period: int, now_ms: int) -> Upserted:
    """Bring the ledger's ATR up to date after the candles named in *changed* (its keys) came or changed.

    The result is that of the full recurrence over each series.  *changed* is read more
    than once: pass a stored table.
    """
    return _write(spark, ledger_path, changed.select(*LEDGER_KEY), None, period, now_ms)


def upsert_with_atr(spark: SparkSession, ledger_path: str, updates: DataFrame, period: int, now_ms: int) -> Upserted:
    """Merge ledger rows into the ledger, as ``ledger.upsert_candles`` does, and carry ATR on, in one write.

    *updates* is read more than once: pass a stored table.
    """
    return _write(spark, ledger_path, updates.select(*LEDGER_KEY), updates, period, now_ms)


def _write(spark, ledger_path: str, changed: DataFrame, updates: DataFrame | None, period: int, now_ms: int) -> Upserted:
    require_utc(spark)
    if changed.isEmpty():
        return Upserted(0, 0)
    table, ledger = carry_table(ledger_path, period), ledger_table(ledger_path)
    series = changed.select(*SERIES).distinct()
    old = stored(table.read(spark).join(series, SERIES, "left_semi"), "carry-before")
    spans = stored(_spans(changed, old, period), "carry-spans")

    first = spans.agg(F.min("first_month").alias("m")).first()["m"]
    month = bar_month(F.col("bar_time"))
    within = month.between(F.col("first_month"), F.coalesce("until", month))
    current = ledger.read(spark, F.col("bar_month") >= first).join(
        spans.select(*SERIES, "first_month", "until"), SERIES
    ).where(within).select(*LEDGER.names)
    rows = current.withColumn("change", F.lit("kept")) if updates is None else merge_candles(current, updates, now_ms)
    timed = rows.join(spans.select(*SERIES, "first_change"), SERIES).withColumns(
        {"_ms": F.col("bar_time"), "bar_time": F.timestamp_millis("bar_time")}
    )
    timed = stored(timed, "carry-candles")
    carry_in = spans.where("bars IS NOT NULL").select(*SERIES, "bars", "last_close", "level")
    levels = stored(atr_levels(timed, period, carry_in).drop("bar_time").withColumnRenamed("_ms", "bar_time"), "carry-levels")

    # From the first change on; what stands before it is as it was, and an ATR is never cleared.
    atr = F.when((F.col("position") >= period) & (F.col("bar_time") >= F.col("first_change")), F.col("level"))
    atr = F.coalesce(atr, F.col("atr"))
    moved = (F.col("change") == "kept") & ~atr.eqNullSafe(F.col("atr"))
    stamp = F.when(moved, F.lit(now_ms)).otherwise(F.col("last_updated_at"))
    counts = Observation()
    out = levels.withColumns({"_atr": atr, "last_updated_at": stamp, "_moved": moved}).drop("atr").withColumnRenamed("_atr", "atr")
    out = out.observe(
        counts, F.count_if(F.col("change") == "inserted").alias("inserted"),
        F.count_if((F.col("change") == "updated") | F.col("_moved")).alias("updated"),
    ).select(*LEDGER.names, month.alias("bar_month"))
    ledger.replace(
        out.select(*READ_SCHEMA.names).hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "bar_time")
    )

    ends = levels.groupBy(*SERIES, month.alias("bar_month")).agg(
        F.max("position").alias("bars"), F.max_by("bar_close", "position").alias("last_close"),
        F.max_by("level", "position").alias("level"),
    )
    now = ends.groupBy(*SERIES).agg(F.max("bars").alias("_now"))
    kept = old.join(spans.select(*SERIES, "first_month", "until"), SERIES)
    was = kept.where(F.col("bar_month") <= F.col("until")).groupBy(*SERIES).agg(F.max("bars").alias("_was"))
    earlier = kept.where(F.col("bar_month") < F.col("first_month"))
    later = kept.where(F.col("bar_month") > F.col("until")).join(now, SERIES, "left").join(was, SERIES, "left").withColumn(
        "bars", F.col("bars") + F.coalesce(F.col("_now") - F.col("_was"), F.lit(0))
    )
    whole = [part.select(*CARRY.names) for part in (earlier, later, ends)]
    table.replace(reduce(DataFrame.unionByName, whole).hint("rebalance", *SERIES))
    discard(old, spans, timed, levels)
    return Upserted(counts.get["inserted"], counts.get["updated"])

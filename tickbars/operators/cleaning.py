"""Raw ticks to clean ticks: UTC, mid price, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.functions import columns as C
from tickbars.functions.sessions import is_weekday
from tickbars.schemas import SOURCE_TICKS, require_columns, series_keys
from tickbars.session import stored

TICK_IDENTITY = ("timestamp_utc", "symbol", "price")


def normalise_utc(df: DataFrame, column: str = "timestamp_utc") -> DataFrame:
    """Make *column* a UTC instant whatever form it arrives in."""
    return df.withColumn(column, C.utc(F.col(column)))


def derive_price(ticks: DataFrame) -> DataFrame:
    """Add ``price``, the mid of bid and ask.  NaN becomes NULL."""
    require_columns(ticks, ["bid", "ask"], "derive_price")
    return ticks.withColumn("price", F.nanvl(C.mid_price(F.col("bid"), F.col("ask")), F.lit(None)))


def deduplicate_ticks(ticks: DataFrame, subset=TICK_IDENTITY) -> DataFrame:
    """Keep one row for each distinct *subset*: the one delivered first.

    First means lowest ``seq``; the remaining columns settle what is left, so
    the result does not depend on partitioning.  Spark keeps only the best row
    of each key before the shuffle, which is what makes a key repeated millions
    of times harmless.
    """
    require_columns(ticks, subset, "deduplicate_ticks")
    rest = [c for c in ticks.columns if c not in subset]
    order = sorted(rest, key=lambda c: (c != "seq", c)) or list(subset)
    first = Window.partitionBy(*subset).orderBy(*order)
    return ticks.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def drop_repeated_rows(ticks: DataFrame) -> DataFrame:
    """Collapse rows equal in every source column, keeping the lowest ``seq``.

    Ticks that share a millisecond but differ anywhere stay.
    """
    if "seq" not in ticks.columns:
        return ticks.dropDuplicates()
    rest = [c for c in ticks.columns if c != "seq"]
    return ticks.groupBy(*rest).agg(F.min("seq").alias("seq")).select(*ticks.columns)


def with_known_time(df: DataFrame, column: str) -> DataFrame:
    """Drop rows without a timestamp.  An empty input keeps its schema."""
    return df.where(F.col(column).isNotNull())


def weekdays_only(df: DataFrame, column: str) -> DataFrame:
    """Keep Monday to Friday, UTC."""
    return df.where(is_weekday(F.col(column)))


def in_time_order(df: DataFrame) -> DataFrame:
    """Rows by series and time, for a result that is shown or exported.

    The transforms themselves promise no order; sort once, at the end.
    """
    time = next(c for c in ("timestamp_utc", "bar_time", "gap_start") if c in df.columns)
    return df.orderBy(*series_keys(df), time, *[c for c in ("seq",) if c in df.columns])


def with_places(df: DataFrame) -> DataFrame:
    """Rows by series and time with their ``place`` from 1 on, numbered without gathering them.

    Partitions of a global sort follow each other; the driver only sees how many rows each has.
    """
    low = 33  # monotonically_increasing_id has the partition above these bits
    numbered = stored(in_time_order(df).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", low)
    sizes = sorted(numbered.groupBy(part.alias("part")).count().collect())
    before, total = [], 0
    for row in sizes:
        before.append((row["part"], total))
        total += row["count"]
    starts = numbered.sparkSession.createDataFrame(before, "_part long, _before long")
    at = F.col("_at").bitwiseAND(F.lit((1 << low) - 1))
    placed = numbered.join(starts, part == F.col("_part")).withColumn("place", F.col("_before") + at + 1)
    return placed.select(*df.columns, "place")


def clean_ticks(raw: DataFrame, subset=TICK_IDENTITY) -> DataFrame:
    """The whole cleaning chain: UTC, mid price, one row for each tick."""
    require_columns(raw, SOURCE_TICKS.names, "clean_ticks")
    return deduplicate_ticks(derive_price(normalise_utc(raw)), subset)

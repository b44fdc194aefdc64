"""Coverage that is kept up to date: bitmaps of the buckets present, which merge.

A bitmap stands for 32,768 neighbouring buckets of a series.  Or-ing bitmaps is
associative and a repeat changes nothing, so deliveries may overlap, repeat and come in
any order, and none is ever scanned again.  Deliveries are added as pieces; pieces are
or-ed when they are read, and folded when they are many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions.sessions import DAY, SATURDAY, weekday_of_seconds
from tickbars.functions.timeframes import timeframe_seconds
from tickbars.operators.gaps import MONDAY, WEEK, timestamp_column
from tickbars.operators.cleaning import with_known_time
from tickbars.schemas import require_columns
from tickbars.session import discard, require_utc, stored
from tickbars.sources.versions import VersionedTable

FOLD_AT = 16
BITMAPS = T.StructType(
    [
        T.StructField("part", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("weekday_bits", T.BinaryType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("freq", T.StringType()),
    ]
)
KEYS = ["symbol", "freq", "part"]


def bitmaps(df: DataFrame, freq: str, timestamp_col: str | None = None) -> DataFrame:
    """The buckets that *df* has rows in, as bitmaps by symbol; ``first`` and ``last`` are bucket numbers.

    Buckets are counted from the epoch.  Rows without a time are left out.  One shuffle
    with map-side partials: a task sends a bitmap at most for each symbol and part.
    """
    require_columns(df, ["symbol"], "bitmaps")
    step, column = timeframe_seconds(freq), timestamp_column(df, timestamp_col)
    number = F.floor(F.unix_seconds(F.col(column).cast("timestamp")) / F.lit(step))
    rows = with_known_time(df, column).select("symbol", number.alias("number"))
    on_weekday = weekday_of_seconds(F.col("number") * step) < SATURDAY
    bit = F.bitmap_bit_position("number")
    return rows.groupBy("symbol", F.bitmap_bucket_number("number").alias("part")).agg(
        F.bitmap_construct_agg(bit).alias("bits"),
        F.bitmap_construct_agg(F.when(on_weekday, bit)).alias("weekday_bits"),
        F.min("number").alias("first"),
        F.max("number").alias("last"),
    ).withColumn("freq", F.lit(freq)).select(*BITMAPS.names)


def merged(pieces: DataFrame) -> DataFrame:
    """One bitmap for each symbol, width and part of any number of them."""
    return pieces.groupBy(*KEYS).agg(
        F.bitmap_or_agg("bits").alias("bits"), F.bitmap_or_agg("weekday_bits").alias("weekday_bits"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    ).select(*BITMAPS.names)


def _weekday_buckets(first: Column, last: Column, step: int) -> Column:
    """How many buckets from number *first* to *last* begin on a weekday: summed over weeks, no bucket is listed."""
    week = lambda number: F.floor((number * step - F.lit(MONDAY)) / F.lit(WEEK))
    at_or_after = lambda seconds: -F.floor(-seconds / F.lit(step))

    def within(w: Column) -> Column:
        monday = w * F.lit(WEEK) + F.lit(MONDAY)
        low = F.greatest(at_or_after(monday), first)
        high = F.least(at_or_after(monday + F.lit(5 * DAY)) - 1, last)
        return F.greatest(high - low + 1, F.lit(0).cast("long"))

    return F.aggregate(F.sequence(week(first), week(last)), F.lit(0).cast("long"), lambda n, w: n + within(w))


def coverage_of(pieces: DataFrame, freq: str) -> DataFrame:
    """For each symbol: buckets present, weekday buckets expected between the first and last, missing, minutes missing."""
    step = timeframe_seconds(freq)
    whole = merged(pieces.where(F.col("freq") == freq)).groupBy("symbol").agg(
        F.sum(F.bitmap_count("bits")).alias("present"), F.sum(F.bitmap_count("weekday_bits")).alias("on_weekdays"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    )
    expected = _weekday_buckets(F.col("first"), F.col("last"), step)
    return whole.select("symbol", "present", expected.alias("expected"), "on_weekdays").select(
        "symbol", "present", "expected", (F.col("expected") - F.col("on_weekdays")).alias("missing"),
        ((F.col("expected") - F.col("on_weekdays")) * step / 60.0).alias("gap_minutes"),
    )


def coverage_table(path: str) -> VersionedTable:
    return VersionedTable(path.rstrip("/"), BITMAPS, ("symbol", "freq"))


def add_coverage(spark: SparkSession, df: DataFrame, path: str, freq: str, timestamp_col: str | None = None) -> None:
    """Add what a delivery has to the bitmaps at *path*; symbols of many pieces are folded.  One writer at a time."""
    require_utc(spark)
    table = coverage_table(path)
    table.add(bitmaps(df, freq, timestamp_col))
    many = table.manifest(spark).groupBy("symbol", "freq").count().where(F.col("count") >= FOLD_AT)
    many = stored(many.select("symbol", "freq"), "coverage-fold")
    if not many.isEmpty():
        table.replace(merged(table.read(spark).join(many, ["symbol", "freq"], "left_semi")))
    discard(many)


def read_coverage(spark: SparkSession, path: str, freq: str) -> DataFrame:
    """:func:`coverage_of` of all that was ever added at *path*."""
    return coverage_of(coverage_table(path).read(spark, F.col("freq") == freq), freq)

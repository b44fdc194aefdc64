"""Missing periods in a time series, and what they mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars.functions.sessions import DAY, SATURDAY, expected_gap, weekday_of_seconds
from tickbars.functions.timeframes import timeframe_seconds
from tickbars.operators.cleaning import with_known_time
from tickbars.operators.segments import known_keys, with_previous
from tickbars.schemas import require_columns, series_keys

WEEK = 7 * DAY
MONDAY = 4 * DAY  # 1970-01-05, the first Monday of the epoch
LONG_STEP = 2 * DAY


def timestamp_column(df: DataFrame, override: str | None = None) -> str:
    """The column that holds time: *override*, else ``timestamp_utc``, else ``bar_time``."""
    for name in [override] if override is not None else ["timestamp_utc", "bar_time"]:
        if name in df.columns:
            return name
    wanted = repr(override) if override is not None else "timestamp_utc or bar_time"
    raise ValueError(f"no timestamp column {wanted} among {df.columns}")


def _on_grid(seconds: Column, step: int, origin: int) -> Column:
    return seconds - F.pmod(seconds - F.lit(origin), F.lit(step))


def present_buckets(df: DataFrame, freq: str, timestamp_col: str | None = None, origin: int = 0) -> DataFrame:
    """Distinct ``bucket`` starts (epoch seconds) that hold at least one row.

    *origin* is where the grid counts from: the epoch, or
    ``timeframes.BAR_ORIGIN`` to line up with bars of any width.
    """
    column = timestamp_column(df, timestamp_col)
    bucket = _on_grid(F.unix_seconds(F.col(column).cast("timestamp")), timeframe_seconds(freq), origin)
    known = with_known_time(df, column)
    # Rows without a time are gone, so coalesce() only tells the optimizer that
    # no bucket is NULL.  All readers of the distinct buckets then have one
    # plan, and share one scan.
    return known.select(*series_keys(df), F.coalesce(bucket, F.lit(0)).alias("bucket")).distinct()


def holes(present: DataFrame, freq: str) -> DataFrame:
    """Pairs of neighbouring present buckets with something missing between them."""
    step = timeframe_seconds(freq)
    keys = series_keys(present)
    rows = with_previous(present, keys, "bucket", F.col("bucket"), ["bucket"])
    return rows.where(F.col("bucket") - F.col("previous_bucket") > step).select(
        *keys, F.col("previous_bucket").alias("last_seen"), F.col("bucket").alias("resumed")
    )


def runs_in_holes(found: DataFrame, freq: str, origin: int = 0) -> DataFrame:
    """Contiguous runs of missing weekday buckets inside each hole.

    A weekend is longer than any step up to two days, so it always ends a run:
    the runs of a hole are its Monday-to-Friday stretches, and one row is made
    for each week, never one for each bucket.  Longer steps can jump a weekend;
    there the (few) buckets are listed and joined to runs.
    """
    step = timeframe_seconds(freq)
    keys = series_keys(found)
    first, last = F.col("last_seen") + F.lit(step), F.col("resumed") - F.lit(step)

    if step <= LONG_STEP:
        weeks = F.sequence(*[F.floor((edge - F.lit(MONDAY)) / F.lit(WEEK)) for edge in (first, last)])
        monday = F.col("week") * F.lit(WEEK) + F.lit(MONDAY)
        opening = _on_grid(monday + F.lit(step - 1), step, origin)
        closing = _on_grid(monday + F.lit(5 * DAY - 1), step, origin)
        runs = found.select(
            *keys, first.alias("first"), last.alias("last"),
            F.explode(weeks).alias("week"),
        ).select(*keys, F.greatest("first", opening).alias("first"), F.least("last", closing).alias("last"))
        runs = runs.where("first <= last")
    else:
        inside = Window.partitionBy(*keys, "last_seen").orderBy("missing")
        runs = (
            found.select(*keys, "last_seen", F.explode(F.sequence(first, last, F.lit(step))).alias("missing"))
            .where(weekday_of_seconds(F.col("missing")) < SATURDAY)
            .withColumn("island", F.col("missing") - F.row_number().over(inside) * F.lit(step))
            .groupBy(*keys, "last_seen", "island")
            .agg(F.min("missing").alias("first"), F.max("missing").alias("last"))
        )
    end = F.col("last") + F.lit(step)
    return runs.select(
        *keys,
        F.timestamp_seconds("first").alias("gap_start"),
        F.timestamp_seconds(end).alias("gap_end"),
        ((end - F.col("first")) / F.lit(60.0)).alias("duration_minutes"),
    )


def detect_gaps(df: DataFrame, freq: str = "1min", timestamp_col: str | None = None, origin: int = 0) -> DataFrame:
    """Runs of weekday buckets without data between the first and last row of each series.

    ``gap_end`` is the end of the last missing bucket.  Weekend buckets are
    never missing, but data in them extends the span.
    """
    return runs_in_holes(holes(present_buckets(df, freq, timestamp_col, origin), freq), freq, origin)


def classify_gaps(gaps: DataFrame) -> DataFrame:
    """Add ``expected``: true for a known closure, false for likely data loss."""
    require_columns(gaps, ["gap_start", "gap_end"], "classify_gaps")
    return gaps.withColumn(
        "expected", expected_gap(F.col("gap_start").cast("timestamp"), F.col("gap_end").cast("timestamp"))
    )


def coverage(df: DataFrame, freq: str = "1min", timestamp_col: str | None = None, origin: int = 0) -> DataFrame:
    """For each series: buckets present, expected and missing, runs, and minutes missing.

    Expected buckets are those present on weekdays plus those missing, so no
    grid is built to count them.
    """
    step = timeframe_seconds(freq)
    present = present_buckets(df, freq, timestamp_col, origin)
    keys = series_keys(df)
    on_weekday = F.count_if(weekday_of_seconds(F.col("bucket")) < SATURDAY)
    seen = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("present"), on_weekday.alias("weekday_present"))
    length = F.unix_seconds("gap_end") - F.unix_seconds("gap_start")
    lost = (
        runs_in_holes(holes(present, freq), freq, origin)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("gaps"), F.sum(length).alias("gap_seconds"))
    )
    missing = F.coalesce(F.expr(f"gap_seconds div {step}"), F.lit(0).cast("long"))
    both = [x.withColumns(known_keys(keys)) for x in (seen, lost)]
    private = list(known_keys(keys))
    joined = both[0].join(both[1].drop(*keys), private, "left") if keys else seen.crossJoin(lost)  # one row each
    return joined.select(
        *keys,
        "present",
        (F.col("weekday_present") + missing).alias("expected"),
        missing.alias("missing"),
        F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"),
        (F.coalesce("gap_seconds", F.lit(0)) / 60.0).alias("gap_minutes"),
    )

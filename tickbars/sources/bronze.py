"""Raw tick tables: reading hour files, the landing plan, and the three layouts written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType, TimestampType

from tickbars.functions.sessions import is_weekday
from tickbars.operators.cleaning import drop_repeated_rows
from tickbars.schemas import SOURCE_TICKS, TICKS, with_fields
from tickbars.session import discard, files_of, require_utc, stored
from tickbars.sources.versions import VersionedTable

# Fixed value: an hour file's name.  The compacted file beside it must not be read with it.
HOUR_FILE = "[0-9][0-9]_[0-9][0-9].parquet"
DAYS = ["symbol", "year", "month", "day"]
# Pieces of an archived day that are joined to one.
FOLD_AT = 16


def read_hour_files(
    spark: SparkSession, root: str, symbol: str | list[str] | None, start: str, end: str
) -> DataFrame:
    """Ticks of inclusive days from ``<root>/<SYMBOL>/year=/month=/DD_HH.parquet``, repeats dropped.

    *symbol* is one, a list, or None for all there are: one scan in any case.
    Only the months of the range are opened.  No files give an empty frame.
    """
    names = "*" if symbol is None else symbol if isinstance(symbol, str) else "{" + ",".join(symbol) + "}"
    store, pattern = files_of(spark, f"{root}/{names}/year=*/month=*")
    first, last = (int(day[:7].replace("-", "")) for day in (start, end))
    folders = []
    for found in store.globStatus(pattern) or []:
        year, month = (int(part.split("=")[1]) for part in found.getPath().toString().split("/")[-2:])
        if first <= year * 100 + month <= last:
            folders.append(found.getPath().toString())
    if not folders:
        return drop_repeated_rows(spark.createDataFrame([], SOURCE_TICKS))
    reader = spark.read.schema(SOURCE_TICKS).option("recursiveFileLookup", "true").option("pathGlobFilter", HOUR_FILE)
    return drop_repeated_rows(in_days(reader.parquet(*folders), start, end))


def in_days(ticks: DataFrame, start: str, end: str, column: str = "timestamp_utc") -> DataFrame:
    """Rows from *start* 00:00 to the end of *end*, UTC.  The filter reaches the Parquet scan."""
    stop = dt.date.fromisoformat(end) + dt.timedelta(days=1)
    low = F.lit(f"{start}T00:00:00Z").cast("timestamp")
    high = F.lit(f"{stop.isoformat()}T00:00:00Z").cast("timestamp")
    return ticks.where((F.col(column) >= low) & (F.col(column) < high))


def calendar_days(ranges: DataFrame) -> DataFrame:
    """One row for each day of ``(symbol, start_date, end_date)``, both ends included."""
    return ranges.select("symbol", F.explode(F.sequence("start_date", "end_date")).alias("day"))


def plan_hours(ranges: DataFrame) -> DataFrame:
    """Every weekday hour of ``(symbol, start_date, end_date)``, both days included."""
    first = F.col("start_date").cast("timestamp")
    last = F.date_add("end_date", 1).cast("timestamp") - F.expr("INTERVAL 1 HOUR")
    hours = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR")))
    return ranges.select("symbol", hours.alias("hour")).where(is_weekday(F.col("hour")))


def landed_hours(ticks: DataFrame) -> DataFrame:
    """The hours that hold at least one tick."""
    return ticks.select("symbol", F.date_trunc("HOUR", "timestamp_utc").alias("hour")).distinct()


def hours_to_fetch(ranges: DataFrame, landed: DataFrame) -> DataFrame:
    """Planned hours that have not landed: what a resumed run still has to get."""
    return plan_hours(ranges).join(landed, ["symbol", "hour"], "left_anti")


def hour_manifest(ranges: DataFrame, landed_before: DataFrame, decoded: DataFrame) -> DataFrame:
    """Status and tick count of each planned hour after a run.

    ``resumed`` had landed before, ``written`` gave ticks now, ``skipped`` gave none.
    """
    counts = decoded.groupBy("symbol", F.date_trunc("HOUR", "timestamp_utc").alias("hour")).agg(
        F.count(F.lit(1)).alias("ticks")
    )
    return manifest_of_counts(ranges, landed_before, counts)


def manifest_of_counts(ranges: DataFrame, landed_before: DataFrame, counts: DataFrame) -> DataFrame:
    """:func:`hour_manifest` from the ticks counted by hour: ``(symbol, hour, ticks)``."""
    before = landed_before.select("symbol", "hour", F.lit(True).alias("before"))
    known = plan_hours(ranges).join(before, ["symbol", "hour"], "left").join(counts, ["symbol", "hour"], "left")
    status = F.when(F.col("before"), "resumed").when(F.col("ticks").isNotNull(), "written").otherwise("skipped")
    fetched = F.when(status == "written", F.col("ticks")).otherwise(F.lit(0))
    return known.select("symbol", "hour", status.alias("status"), fetched.cast("long").alias("ticks"))


def download_summary(manifest: DataFrame) -> DataFrame:
    """Per symbol: ticks saved, files written, hours skipped and resumed."""

    def hours(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return manifest.groupBy("symbol").agg(
        F.sum("ticks").alias("ticks_saved"),
        hours("written").alias("files_written"),
        hours("skipped").alias("hours_skipped"),
        hours("resumed").alias("hours_resumed"),
    )


def _day(ts: Column) -> Column:
    return F.to_date(ts)


def _sorted_write(ticks: DataFrame, path: str, partitions: list[str], mode: str) -> None:
    # Whole days go to a task and are sorted there.  Adaptive execution splits a
    # day that is too large over several tasks and files, and merges small ones.
    # Unlike range partitioning this needs no sampling pass over the data.
    order = ["timestamp_utc", "seq"]
    (
        ticks.withColumn("_day", _day(F.col("timestamp_utc")))
        .hint("rebalance", "symbol", "_day")
        .sortWithinPartitions(*partitions, *order)
        .drop("_day")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partitions)
        .parquet(path)
    )


def land_hours(ticks: DataFrame, path: str) -> None:
    """Append newly fetched hours to the raw table, one directory for each symbol and day.

    The hour is a column: 24 directories for each day and symbol would leave
    only tiny files.  Fetch what :func:`hours_to_fetch` lists and nothing is
    landed twice.
    """
    hour = F.date_trunc("HOUR", "timestamp_utc")
    dated = ticks.select(*TICKS.names, hour.alias("hour"), _day(F.col("timestamp_utc")).alias("date"))
    _sorted_write(dated, path, ["symbol", "date"], "append")


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(with_fields(TICKS, hour=TimestampType(), date=DateType())).parquet(path)


def compact_months(ticks: DataFrame, path: str) -> None:
    """Rewrite raw ticks by month: exact repeats dropped, sorted by time, in a table of its own.

    Ticks that share a millisecond and differ are kept.
    """
    at = F.col("timestamp_utc")
    dated = drop_repeated_rows(ticks.select(*TICKS.names)).select(
        "*", F.date_format(at, "yyyy").alias("year"), F.date_format(at, "MM").alias("month")
    )
    _sorted_write(dated, path, ["symbol", "year", "month"], "overwrite")


def archive_table(path: str) -> VersionedTable:
    schema = with_fields(TICKS, year=StringType(), month=StringType(), day=StringType())
    return VersionedTable(path.rstrip("/"), StructType([f for f in schema if f.name != "symbol"] + [schema["symbol"]]),
                          tuple(DAYS))


def archive_days(ticks: DataFrame, path: str) -> None:
    """Write the day archive ``symbol=/year=/month=/day=``.  A day written again is replaced, all at once."""
    require_utc(ticks.sparkSession)
    dated = _dated(drop_repeated_rows(ticks.select(*TICKS.names)))
    archive_table(path).replace(dated.hint("rebalance", *DAYS).sortWithinPartitions(*DAYS, "timestamp_utc", "seq"))


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`compact_months`, without its directory columns."""
    return spark.read.schema(TICKS).parquet(path).select(*TICKS.names)


def _dates(start: str | None, end: str | None) -> Column:
    date = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    return date.between(start, end) if start and end else F.lit(True)


def read_archive(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None, days: list[str] | None = None
) -> DataFrame:
    """The day archive, or the days from *start* to *end*, or the *days* listed.  Other directories are not opened.

    Days that ticks were added to are freed of repeats as they are read; days in one
    piece are read as they are.
    """
    wanted = _dates(start, end) if days is None else F.concat_ws("-", "year", "month", "day").isin(days)
    rows = archive_table(path).pieces(spark, wanted)
    plain, added = F.col("pieces") == 1, F.col("pieces") > 1
    mended = drop_repeated_rows(rows.where(added).select(*TICKS.names)).select(*TICKS.names)
    return rows.where(plain).select(*TICKS.names).unionByName(mended)


def archived_days(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The (symbol, day) pairs of the archive, from its manifest: no ticks are read."""
    days = archive_table(path).manifest(spark).where(_dates(start, end)).drop("version", "added").distinct()
    return days.select("symbol", F.to_date(F.concat_ws("-", "year", "month", "day")).alias("day"))


def _dated(ticks: DataFrame) -> DataFrame:
    at = F.col("timestamp_utc")
    return ticks.select(
        *TICKS.names, F.date_format(at, "yyyy").alias("year"), F.date_format(at, "MM").alias("month"),
        F.date_format(at, "dd").alias("day"),
    )


def add_to_archive(ticks: DataFrame, path: str) -> None:
    """Add ticks to the archive as a piece beside what their days hold: no day is read or rewritten.

    Exact repeats, within the piece and across pieces, are dropped by :func:`read_archive`, so
    adding the same ticks again changes nothing there.  :func:`fold_archive` joins pieces.
    """
    require_utc(ticks.sparkSession)
    archive_table(path).add(_dated(ticks).hint("rebalance", *DAYS).sortWithinPartitions(*DAYS, "timestamp_utc", "seq"))


def fold_archive(spark: SparkSession, path: str, pieces: int = FOLD_AT) -> int:
    """Rewrite days of *pieces* pieces or more as one; returns how many days that were."""
    table = archive_table(path)
    many = table.manifest(spark).groupBy(*DAYS).count().where(F.col("count") >= pieces)
    many = stored(many.select(*DAYS), "archive-fold")
    found = many.count()
    if found:
        edges = many.agg(*[f(F.concat("year", "month", "day")) for f in (F.min, F.max)]).first()
        rows = table.read(spark, F.concat("year", "month", "day").between(edges[0], edges[1]))
        whole = drop_repeated_rows(rows.join(many, DAYS, "left_semi").select(*TICKS.names))
        table.replace(_dated(whole).hint("rebalance", *DAYS).sortWithinPartitions(*DAYS, "timestamp_utc", "seq"))
    discard(many)
    return found


def merge_into_archive(spark: SparkSession, ticks: DataFrame, path: str) -> None:
    """Add part of a day to the archive without losing the rest of it.

    The days touched are read, joined with the new ticks, and replaced all at
    once.  Merging the same ticks again changes nothing.  *ticks* is read more than
    once: pass a stored table.
    """
    require_utc(spark)
    day = _day(F.col("timestamp_utc"))
    edges = ticks.agg(F.min(day).cast("string").alias("first"), F.max(day).cast("string").alias("last")).first()
    if edges["first"] is None:
        return
    touched = ticks.select("symbol", day.alias("_day")).distinct()
    old = read_archive(spark, path, edges["first"], edges["last"]).withColumn("_day", day)
    kept = old.join(touched, ["symbol", "_day"], "left_semi").select(*TICKS.names)
    archive_days(kept.unionByName(ticks.select(*TICKS.names)), path)

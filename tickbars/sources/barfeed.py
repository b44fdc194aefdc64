"""JSON bar documents landed by a feed: ``<root>/<SYMBOL>/<anything>.json``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.schemas import BARS, FEED_DOCUMENT


def document_columns(raw: DataFrame) -> DataFrame:
    """``symbol`` (from the path), ``body`` and ``delivered_at`` of whole-file text rows."""
    path = F.col("_metadata.file_path")
    return raw.select(
        F.upper(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)).alias("symbol"),
        F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("delivered_at"),
    )


def read_documents(spark: SparkSession, paths) -> DataFrame:
    """Every landed document as ``(symbol, body, delivered_at)``."""
    reader = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
    return document_columns(reader.option("pathGlobFilter", "*.json").text(paths))


def _number(text: Column) -> Column:
    return text.try_cast("double")


def _problem(doc: Column) -> Column:
    """Why a document cannot be used, or NULL."""
    unreadable = F.exists(
        doc["values"],
        lambda v: v["datetime"].try_cast("timestamp").isNull()
        | _number(v["open"]).isNull()
        | _number(v["high"]).isNull()
        | _number(v["low"]).isNull()
        | _number(v["close"]).isNull()
        | (v["volume"].isNotNull() & _number(v["volume"]).isNull()),
    )
    return (
        F.when(doc.isNull() | doc["_corrupt_record"].isNotNull(), "not a JSON object")
        .when(doc["status"] == "error", F.concat(F.lit("feed error: "), F.coalesce(doc["message"], F.lit(""))))
        .when(F.coalesce(F.size(doc["values"]), F.lit(0)) <= 0, "no values")
        .when(unreadable, "a value is not a number or a time")
    )


def _parsed(documents: DataFrame) -> DataFrame:
    # explode() of one element: a projection would parse again for each use of the document
    parsed = documents.select("*", F.explode(F.array(F.from_json("body", FEED_DOCUMENT))).alias("_doc"))
    return parsed.withColumn("problem", _problem(F.col("_doc")))


def rejected_documents(documents: DataFrame) -> DataFrame:
    """Documents that give no bars, with the reason: the quarantine."""
    return _parsed(documents).where("problem IS NOT NULL").drop("_doc")


def feed_bars(documents: DataFrame) -> DataFrame:
    """Usable documents as typed bars; a missing volume is 0.

    Columns other than ``symbol`` and ``body`` (such as ``delivered_at``) come along.
    """
    extra = [c for c in documents.columns if c not in ("symbol", "body")]
    rows = _parsed(documents).where("problem IS NULL").select("symbol", *extra, F.inline("_doc.values"))
    time = F.date_trunc("MILLISECOND", F.col("datetime").cast("timestamp"))
    return rows.select(
        time.alias("timestamp_utc"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.coalesce(F.col("volume").cast("double"), F.lit(0.0)).alias("volume"),
        F.upper("symbol").alias("symbol"),
        *extra,
    ).select(*BARS.names, *extra)


def newest_revision(bars: DataFrame) -> DataFrame:
    """One row for each (symbol, time): the bar delivered last, with its ``delivered_at``.

    Overlapping deliveries repeat bars, and a bar that was still forming comes
    again with other values.
    """
    values = [c for c in BARS.names if c not in ("timestamp_utc", "symbol")]
    # Within one delivery time the bar that saw more trading wins.
    newest = F.struct("delivered_at", "volume", "high", F.negate("low").alias("low"), "close", "open")
    return (
        bars.groupBy("symbol", "timestamp_utc")
        .agg(F.max_by(F.struct(*values), newest).alias("bar"), F.max("delivered_at").alias("delivered_at"))
        .select("timestamp_utc", *[F.col(f"bar.{c}").alias(c) for c in values], "symbol", "delivered_at")
    )


def latest_revision(bars: DataFrame) -> DataFrame:
    """:func:`newest_revision` as plain bars."""
    return newest_revision(bars).select(*BARS.names)

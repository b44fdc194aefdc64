"""Hour files as they land, to the raw tick table, each once.

A checkpointed file stream hands every file to one micro-batch.  A batch writes a folder of
its own, named by its number, and beside it how many ticks each hour gave: a batch that
runs again after a lost driver overwrites both, so nothing is landed twice and the
counts need no second look at the ticks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.schemas import TICKS, with_fields
from tickbars.session import require_utc
from tickbars.sources.bronze import manifest_of_counts
from tickbars.sources.tickfiles import decode_ticks, in_few_tasks

FILES_PER_BATCH = 10_000
FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
HOURS = "symbol STRING, hour TIMESTAMP, ticks BIGINT"


def hour_file_stream(spark: SparkSession, root: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """New hour files below *root*, at most *files_per_batch* at a time."""
    reader = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", "*h_ticks.bi5")
    return in_few_tasks(reader.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(root))


def land_batch(files: DataFrame, batch_id: int, raw_path: str) -> None:
    """Decode one micro-batch of files into its own part of the raw table."""
    spark = files.sparkSession
    require_utc(spark)
    folder = f"batch={batch_id:012d}"
    dated = decode_ticks(files).withColumn("date", F.to_date("timestamp_utc"))
    dated.hint("rebalance", "symbol", "date").sortWithinPartitions("symbol", "date", "timestamp_utc", "seq").write.mode(
        "overwrite"
    ).partitionBy("symbol", "date").parquet(f"{raw_path}/ticks/{folder}")
    landed = read_streamed_ticks(spark, f"{raw_path}/ticks/{folder}")
    hours = landed.groupBy("symbol", F.date_trunc("HOUR", "timestamp_utc").alias("hour")).agg(F.count(F.lit(1)).alias("ticks"))
    hours.write.mode("overwrite").parquet(f"{raw_path}/hours/{folder}")


def write_hours(files: DataFrame, raw_path: str, checkpoint: str):
    """Start the query that lands hour files as ticks."""
    return (
        files.writeStream.foreachBatch(lambda batch, batch_id: land_batch(batch, batch_id, raw_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_streamed_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks of the raw table's ``ticks`` folder, or of one batch of it."""
    return spark.read.schema(with_fields(TICKS, date=T.DateType())).parquet(folder).select(*TICKS.names)


def streamed_hours(spark: SparkSession, raw_path: str) -> DataFrame:
    """The hours that have landed, and the ticks in each: from the counts the batches kept."""
    each = spark.read.schema(HOURS).option("recursiveFileLookup", "true").parquet(f"{raw_path}/hours")
    return each.groupBy("symbol", "hour").agg(F.sum("ticks").alias("ticks"))


def streamed_manifest(spark: SparkSession, ranges: DataFrame, raw_path: str, landed_before: DataFrame | None = None) -> DataFrame:
    """Status and tick count of each planned hour (see ``bronze.hour_manifest``), from the kept counts."""
    if landed_before is None:
        landed_before = spark.createDataFrame([], "symbol STRING, hour TIMESTAMP")
    return manifest_of_counts(ranges, landed_before, streamed_hours(spark, raw_path))

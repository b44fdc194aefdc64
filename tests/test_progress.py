import datetime as dt

from helpers import at
from pyspark.sql import functions as F

from tickbars.streaming.progress import ProgressLog
from tickbars.streaming.ticks import late_rows, write_stream


def test_more_batches_than_spark_remembers(spark, tmp_path):
    """A late row in each of 110 micro-batches but the first: Spark's own reports have lost some, the log has all.

    A watermark drops rows from the second batch on after the one it comes from.
    """
    start, source = at("2024-01-15T00:00:00"), tmp_path / "in"
    rows = [(start + dt.timedelta(hours=i), i) for i in range(110)]
    for i, (time, x) in enumerate(rows):
        late = [(start - dt.timedelta(days=30), -x)] if i else []
        spark.createDataFrame([(time, x), *late], "at timestamp, x int").coalesce(1).write.mode("append").parquet(str(source))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    log = ProgressLog(spark, str(tmp_path / "log"))
    try:
        stream = spark.readStream.schema("at timestamp, x int").option("maxFilesPerTrigger", 1).parquet(str(source))
        counted = stream.observe("in", F.count(F.lit(1)).alias("rows")).withWatermark("at", "1 minute").groupBy("at").count()
        with log:
            query = write_stream(counted, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
            query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    total = log.totals().first()
    assert total.batches >= 110 and total.rows == 219 and total.late == 108 > late_rows(query)
    assert {r["name"]: r["total"] for r in log.observed().collect()} == {"in.rows": 219}
    assert log.reports().select("query", "batch").distinct().count() == total.batches

"""Hourly binary tick files: ``<root>/<SYMBOL>/<YYYY>/<MM>/<DD>/<HH>h_ticks.bi5``.

The month directory counts from 00.  A file is an LZMA stream of 20-byte
big-endian records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions import columns as C
from tickbars.schemas import TICKS

# The record layout and the path of a file.
RECORD = [("delta_ms", ">u4"), ("ask", ">u4"), ("bid", ">u4"), ("ask_volume", ">f4"), ("bid_volume", ">f4")]
PATH_PATTERN = r"([^/]+)/(\d{4})/(\d{2})/(\d{2})/(\d{2})h_ticks\.bi5$"
SCAN_TASKS = 1000

_RAW = "symbol STRING, hour_ms BIGINT, seq BIGINT, delta_ms BIGINT, ask BIGINT, bid BIGINT, ask_volume FLOAT, bid_volume FLOAT"


def in_few_tasks(files: DataFrame) -> DataFrame:
    """A scan of hour files in at most ``SCAN_TASKS`` tasks, or as many as there are cores.

    Spark counts opening a file as 4 MB, so it makes a task for every few small files, however many
    there are.  A task reads one file after the other and keeps none, so it may read many.
    """
    return files.coalesce(max(SCAN_TASKS, files.sparkSession.sparkContext.defaultParallelism))


def read_tick_files(spark: SparkSession, paths) -> DataFrame:
    """The files under *paths* as ``(path, modificationTime, length, content)``.

    Give the month or day directories of a run rather than the whole root, so
    that only they are listed.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*h_ticks.bi5")
    return in_few_tasks(reader.option("recursiveFileLookup", "true").load(paths))


def tick_file_path(symbol: str, year: int, month: int, day: int, hour: int) -> str:
    """Path of an hour's file below the root; *month* counts from 1."""
    return f"{symbol}/{year}/{month - 1:02d}/{day:02d}/{hour:02d}h_ticks.bi5"


def symbol_of_path(path: Column) -> Column:
    return F.upper(F.regexp_extract(path, PATH_PATTERN, 1))


def hour_of_path(path: Column) -> Column:
    """Start of the hour a file covers, as a UTC instant."""
    year, month, day, hour = [F.regexp_extract(path, PATH_PATTERN, i).cast("int") for i in range(2, 6)]
    return F.make_timestamp(year, month + 1, day, hour, F.lit(0), F.lit(0), F.lit("UTC"))


def _decoder(record, rows_per_batch=100_000):
    # Self-contained: it is shipped to the tasks by value.
    def decode(batches):
        import lzma

        import numpy as np
        import pyarrow as pa

        layout = np.dtype(record)
        for batch in batches:
            for symbol, hour_ms, content in zip(*(batch.column(i) for i in range(3))):
                try:
                    data = lzma.decompress(content.as_py())
                except lzma.LZMAError:
                    continue
                ticks = np.frombuffer(data, layout, count=len(data) // layout.itemsize)
                for start in range(0, len(ticks), rows_per_batch):
                    part = ticks[start : start + rows_per_batch]
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(symbol, n),
                            pa.repeat(hour_ms, n),
                            pa.array(np.arange(start, start + n, dtype="int64")),
                            pa.array(part["delta_ms"].astype("int64")),
                            pa.array(part["ask"].astype("int64")),
                            pa.array(part["bid"].astype("int64")),
                            pa.array(part["ask_volume"].astype("float32")),
                            pa.array(part["bid_volume"].astype("float32")),
                        ],
                        names=["symbol", "hour_ms", "seq", "delta_ms", "ask", "bid", "ask_volume", "bid_volume"],
                    )

    return decode


def _inspector(record_bytes: int):
    def inspect(batches):
        import lzma

        import pyarrow as pa

        for batch in batches:
            paths, problems = [], []
            for path, content in zip(batch.column("path"), batch.column("content")):
                try:
                    data = lzma.decompress(content.as_py())
                    over = len(data) % record_bytes
                    problem = f"{over} bytes after the last record" if over else None
                except lzma.LZMAError as error:
                    problem = f"does not decode: {error}"
                if problem:
                    paths.append(path.as_py())
                    problems.append(problem)
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "problem": pa.array(problems, pa.string())})

    return inspect


def rejected_files(files: DataFrame) -> DataFrame:
    """``(path, problem)`` of files that give no ticks, or fewer than their bytes: the quarantine.

    An empty file is an hour without ticks, not a problem.
    """
    known = F.col("path").rlike(PATH_PATTERN)
    unnamed = files.where(~known).select("path", F.lit("not the path of an hour file").alias("problem"))
    named = files.where(known & (F.octet_length("content") > 0)).select("path", "content")
    size = sum(int(kind[2:]) for _, kind in RECORD)
    return unnamed.unionAll(named.mapInArrow(_inspector(size), "path string, problem string"))


def decode_ticks(files: DataFrame) -> DataFrame:
    """Files to ticks.  Bytes that do not decode, and a partial last record, give no rows: see :func:`rejected_files`.

    Python only unpacks; prices, volumes and times are scaled in the JVM.
    Every file is decoded on its own, in Arrow batches of bounded size.
    """
    named = files.where(F.col("path").rlike(PATH_PATTERN)).select(
        symbol_of_path(F.col("path")).alias("symbol"),
        F.unix_millis(hour_of_path(F.col("path"))).alias("hour_ms"),
        "content",
    )
    raw = named.mapInArrow(_decoder(RECORD), _RAW)
    divisor = C.point_divisor(F.col("symbol"))
    return raw.select(
        C.event_time(F.col("hour_ms"), F.col("delta_ms")).alias("timestamp_utc"),
        (F.col("ask") / divisor).alias("ask"),
        (F.col("bid") / divisor).alias("bid"),
        C.real_volume(F.col("ask_volume")).alias("ask_volume"),
        C.real_volume(F.col("bid_volume")).alias("bid_volume"),
        "symbol",
        "seq",
    ).select(*TICKS.names)

"""Landed files as the sources would find them, made from ticks and candles by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.functions import columns as C
from tickbars.schemas import SOURCE_TICKS
from tickbars.sources.tickfiles import RECORD

FILE_ROWS = 4096


def _encoder(record):
    # Self-contained: it is shipped to the tasks by value.
    def encode(batches):
        import lzma

        import numpy as np
        import pyarrow as pa

        layout = np.dtype(record)
        # The window of a file, not the 8 MB of the default, which takes 90 MB and most of the time.
        filters = [{"id": lzma.FILTER_LZMA2, "preset": 6, "dict_size": 1 << 17}]

        def files(ended):
            paths = pa.array([key[0] for key, _ in ended], pa.string())
            stray = b"\x00\x01"  # two stray bytes at the end
            contents = [lzma.compress(b"".join(parts) + stray, filters=filters) for _, parts in ended]
            return pa.RecordBatch.from_arrays([paths, pa.array(contents, pa.binary())], names=["path", "content"])

        def codes(column):
            return column.dictionary_encode(null_encoding="encode").indices.to_numpy()

        key, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            data = np.zeros(batch.num_rows, layout)
            for name in layout.names:
                kind = layout[name].newbyteorder("=").name
                # A null or an integer out of range is an error; a volume may be null.
                data[name] = batch.column(name).cast(kind).to_numpy(zero_copy_only=kind != "float32")
            keys = [batch.column(name) for name in ("path", "hour_ms", "chunk")]
            new = np.any([np.diff(codes(column)) != 0 for column in keys], axis=0)
            starts = [0, *(np.flatnonzero(new) + 1).tolist(), len(data)]
            ended = []
            for start, stop in zip(starts, starts[1:]):
                own = tuple(column[start].as_py() for column in keys)
                if parts and own != key:
                    ended.append((key, parts))
                    parts = []
                key = own
                parts.append(data[start:stop].tobytes())
            yield files(ended)
        if parts:
            yield files([(key, parts)])

    return encode


def tick_files(ticks: DataFrame) -> DataFrame:
    """``(path, content)`` of hourly tick files.

    An hour is cut by ``seq`` in files of at most 4096 ticks, so no file grows with the data.
    A task gets its ticks in the order of its files, in Arrow batches, and holds one file at a time.
    """
    named = ticks.replace({"CLICK": "XAUUSD", "ERROR": "USDJPY"}, subset=["symbol"])
    at, divisor = F.col("timestamp_utc"), C.point_divisor(F.col("symbol"))
    hour = F.date_trunc("HOUR", at)
    record = [
        (F.unix_millis(at) - F.unix_millis(hour)).alias("delta_ms"),
        F.col("seq").alias("id"),
        F.round(F.col("ask") * divisor).cast("long").alias("ask"),
        F.round(F.col("bid") * divisor).cast("long").alias("bid"),
        (F.col("ask_volume") * 0.5).alias("ask_volume"),
        (F.col("bid_volume") * 0.25).alias("bid_volume"),
    ]
    chunk = F.floor(F.col("seq") / FILE_ROWS)
    path = F.concat(
        F.format_string("landing/%d/", "chunk"), "symbol", F.date_format("hour", "/yyyy/"),
        F.format_string("%02d", F.month("hour") - 1), F.date_format("hour", "/dd/HH"), F.lit("h_ticks.bi5"),
    )
    file, fields = ["symbol", "hour", "chunk"], ["delta_ms", "id", "ask", "bid", "ask_volume", "bid_volume"]
    records = named.select("symbol", hour.alias("hour"), chunk.alias("chunk"), *record)
    in_order = records.repartition(*file).sortWithinPartitions(*file, *fields)
    rows = in_order.select(path.alias("path"), F.unix_millis("hour").alias("hour_ms"), "chunk", *fields).drop("id")
    return rows.mapInArrow(_encoder(RECORD), "path STRING, content BINARY")


def write_files(files: DataFrame, folder: str) -> None:
    """Each ``(path, content)`` as a file below *folder*, which all executors share."""

    def write(batches):
        import posixpath

        from pyarrow import RecordBatch, fs, int64, schema

        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                name = f"{root}/{path.as_py()}"
                store.create_dir(posixpath.dirname(name), recursive=True)
                with store.open_output_stream(name) as out:
                    out.write(content.as_py())
            yield RecordBatch.from_pydict({"files": [batch.num_rows]}, schema([("files", int64())]))

    files.select("path", "content").mapInArrow(write, "files BIGINT").agg(F.sum("files")).first()


def write_hour_files(ticks: DataFrame, folder: str) -> None:
    """Ticks as ``<folder>/<SYMBOL>/year=/month=/DD_HH.parquet``, and beside them a compacted file that must not be read."""

    def write(table):
        import pyarrow as pa
        from pyarrow import fs, parquet

        store, root = fs.FileSystem.from_uri(folder)
        place, name = table.column("place")[0].as_py(), table.column("name")[0].as_py()
        store.create_dir(f"{root}/{place}", recursive=True)
        for file in (name, "compacted.parquet"):
            with store.open_output_stream(f"{root}/{place}/{file}") as out:
                parquet.write_table(table.drop_columns(["place", "name"]).sort_by("timestamp_utc"), out)
        return pa.table({"files": pa.array([1], pa.int64())})

    at = F.col("timestamp_utc")
    named = ticks.select(
        *SOURCE_TICKS.names, F.concat("symbol", F.date_format(at, "'/year='yyyy'/month='MM")).alias("place"),
        F.date_format(at, "dd_HH'.parquet'").alias("name"),
    )
    named.groupBy("place", "name").applyInArrow(write, "files BIGINT").agg(F.sum("files")).first()


def documents(candles: DataFrame) -> DataFrame:
    """Feed documents of hourly candles: one good and one unusable for each symbol and day.

    A day holds at most 24 values.  Every third day leaves the volume out.
    """
    day = F.to_date("bar_time")
    volume = F.when(F.dayofmonth("bar_time") % 3 != 0, F.col("bar_volume").cast("string"))
    value = F.struct(
        F.date_format("bar_time", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        *[F.col(f"bar_{part}").cast("string").alias(part) for part in ("open", "high", "low", "close")],
        volume.alias("volume"),
    )
    days = candles.groupBy("symbol", day.alias("day")).agg(F.sort_array(F.collect_list(value)).alias("values"))
    good = F.to_json(F.struct(F.lit("ok").alias("status"), F.col("values")))
    kind = F.dayofmonth("day") % 4
    bad = (
        F.when(kind == 0, '{"status": "error", "code": 429, "message": "out of credits"}')
        .when(kind == 1, '{"status": "ok", "values": []}')
        .when(kind == 2, '{"values": [{"datetime": "2024-01-01 00:00:00", "open": "x", "high": "1", "low": "1", "close": "1"}]}')
        .otherwise("gateway timeout")
    )
    return days.select(
        "symbol", F.explode(F.array(good, bad)).alias("body"), F.col("day").cast("timestamp").alias("delivered_at")
    )

"""Files made from ticks, and hour files read in few tasks."""

import collections
import lzma

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from checks import landing
from helpers import at, plan
from tickbars.schemas import TICKS
from tickbars.sources import tickfiles
from tickbars.sources.tickfiles import RECORD
from tickbars.streaming import hours


def row(second, symbol, seq, ask=2.0, volume=1.0):
    when = at(f"2024-01-17T{10 + second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}")
    return (when, ask, 1.0, volume, 4.0, symbol, seq)


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_files_are_made_from_ticks_in_batches(spark, small_batches):
    """No more than one file is held at a time, whatever a task gets; files that span batches and batches of many files are whole."""
    rows = [row(i * 37 % 9000, "EURUSD", i + 4000, 2 + i / 1000) for i in range(200)]
    rows += [row(5, "CLICK", i) for i in range(20)] + [row(i, f"S{i:02d}", 1) for i in range(30)]
    rows += [row(3, "EURUSD", None), row(4, "EURUSD", 9, volume=None), row(1, None, 1), row(2, None, 1), row(3601, None, 1)]
    files = landing.tick_files(spark.createDataFrame(rows, TICKS))
    assert "collect_list" not in plan(files)
    want = collections.defaultdict(list)
    for when, ask, bid, ask_volume, bid_volume, symbol, seq in rows:
        name = {"CLICK": "XAUUSD"}.get(symbol, symbol)
        chunk = "null" if seq is None else seq // landing.FILE_ROWS
        path = f"landing/{chunk}/{name}/2024/00/17/{when.hour}h_ticks.bi5" if name else None
        scale = 1000 if name == "XAUUSD" else 100_000
        ms = (when.minute * 60 + when.second) * 1000
        sizes = (np.nan if ask_volume is None else ask_volume / 2, bid_volume / 4)
        want[path, when.hour, chunk].append((ms, -1 if seq is None else seq, round(ask * scale), round(bid * scale), *sizes))
    made = [(f.path, f.content) for f in files.collect()]
    expected = [
        (path, np.array([(tick[0], *tick[2:]) for tick in sorted(ticks)], RECORD).tobytes() + b"\x00\x01")
        for (path, _, _), ticks in want.items()
    ]
    order = lambda file: (file[0] or "", file[1])
    assert len(made) == len(expected) == 38
    assert sorted(((p, lzma.decompress(c)) for p, c in made), key=order) == sorted(expected, key=order)


@pytest.mark.parametrize("bad", [{"ask": None}, {"ask": -1.0}, {"ask": 1e6}])
def test_a_price_that_is_no_record_is_an_error(spark, bad):
    files = landing.tick_files(spark.createDataFrame([row(1, "EURUSD", 1), row(2, "EURUSD", 2, **bad)], TICKS))
    with pytest.raises(PythonException):
        files.select(F.octet_length("content")).collect()


def test_many_small_files_are_read_in_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tickfiles, "SCAN_TASKS", 2, raising=False)
    cores = spark.sparkContext.defaultParallelism
    rows = [row(i, f"S{i:02d}", i, 2 + i / 1000) for i in range(5 * cores)]
    root, raw = (f"file://{tmp_path}/{name}" for name in ("landing", "raw"))
    landing.write_files(landing.tick_files(spark.createDataFrame(rows, TICKS)), root)
    tasks = []

    def land(batch, batch_id):
        tasks.append(batch.rdd.getNumPartitions())
        hours.land_batch(batch, batch_id, raw)

    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a file each
    try:
        found = tickfiles.read_tick_files(spark, root)
        assert found.rdd.getNumPartitions() <= cores
        assert found.count() == len(rows)
        stream = hours.hour_file_stream(spark, root, 4 * cores).writeStream.foreachBatch(land)
        stream.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(tasks) == 2 and max(tasks) <= cores
    landed = hours.read_streamed_ticks(spark, f"{raw}/ticks")
    got = {(r.symbol, r.seq, round(r.ask, 3), r.ms) for r in landed.select("*", F.unix_millis("timestamp_utc").alias("ms")).collect()}
    assert landed.count() == len(rows)
    assert got == {(symbol, 0, ask, int(when.timestamp() * 1000)) for when, ask, _, _, _, symbol, _ in rows}

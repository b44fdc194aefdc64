import json
import lzma
import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import at, plan
from tickbars.schemas import SOURCE_TICKS, TICKS
from tickbars.sources import barfeed, bronze, tickfiles


def tick_file(root, symbol, hour, records, tail=b"", raw=None):
    path = root / tickfiles.tick_file_path(symbol, hour.year, hour.month, hour.day, hour.hour)
    path.parent.mkdir(parents=True, exist_ok=True)
    data = b"".join(struct.pack(">IIIff", *r) for r in records) + tail
    path.write_bytes(lzma.compress(data) if raw is None else raw)
    return path


def test_decode(spark, tmp_path):
    hour = at("2024-01-17T13:00:00")
    many = [(i * 3, 4_500_000 + i, 4_499_000 + i, 0.5, 1.5) for i in range(1000)]
    assert str(tick_file(tmp_path, "XAUUSD", hour, many, tail=b"xy")).endswith("XAUUSD/2024/00/17/13h_ticks.bi5")
    tick_file(tmp_path, "GBPJPY", at("2024-12-31T23:00:00"), [(3_599_999, 187_450, 187_440, 0.25, 0.0)])
    tick_file(tmp_path, "EURUSD", hour, [(0, 2**32 - 1, 108_345, 1.25, 2.0)], tail=b"z" * 19)
    tick_file(tmp_path, "AUDUSD", hour, [], raw=b"not lzma")
    tick_file(tmp_path, "NZDUSD", hour, [], raw=b"")
    tick_file(tmp_path, "CADCHF", hour, [], tail=b"q" * 19)
    tick_file(tmp_path, "USDCHF", hour, [], raw=lzma.compress(b"x" * 400)[:-8])

    ticks = tickfiles.decode_ticks(tickfiles.read_tick_files(spark, str(tmp_path)))
    assert ticks.schema.names == TICKS.names
    got = {s: rows for s in ("XAUUSD", "GBPJPY", "EURUSD") if (rows := ticks.where(F.col("symbol") == s).orderBy("seq").collect())}
    assert ticks.count() == 1002 and len(got["XAUUSD"]) == 1000
    first, last = got["XAUUSD"][0], got["XAUUSD"][-1]
    assert (first.ask, first.bid, first.ask_volume, first.bid_volume, first.seq) == (4500.0, 4499.0, 500_000.0, 1_500_000.0, 0)
    ms = ticks.where("symbol = 'XAUUSD'").select(F.max(F.unix_millis("timestamp_utc"))).first()[0]
    assert last.seq == 999 and ms == int(hour.timestamp() * 1000) + 2997
    assert got["GBPJPY"][0].ask == 187.45
    year_end = ticks.where("symbol = 'GBPJPY'").select(F.unix_millis("timestamp_utc")).first()[0]
    assert year_end == int(at("2024-12-31T23:59:59").timestamp() * 1000) + 999
    assert got["EURUSD"][0].ask == (2**32 - 1) / 100_000 and got["EURUSD"][0].bid == 1.08345


def test_hour_files_are_read_without_the_compacted_one(spark, tmp_path):
    def hour_file(name, *seconds):
        folder = tmp_path / "XAUUSD" / "year=2024" / "month=01"
        folder.mkdir(parents=True, exist_ok=True)
        times = pa.array([at(f"2024-01-17T13:00:{s:02d}") for s in seconds], pa.timestamp("ms", tz="UTC"))
        quotes = {"ask": 2.0, "bid": 1.0, "ask_volume": 0.0, "bid_volume": 1.0, "symbol": "XAUUSD"}
        table = pa.table({"timestamp_utc": times, **{k: pa.repeat(v, len(seconds)) for k, v in quotes.items()}})
        pq.write_table(table, folder / name)

    hour_file("17_13.parquet", 1, 2)
    hour_file("17_14.parquet", 2, 3)
    hour_file("ticks.parquet", 1, 2, 3)
    read = lambda a, b: bronze.read_hour_files(spark, str(tmp_path), "XAUUSD", a, b)
    assert read("2024-01-17", "2024-01-17").count() == 3
    assert read("2024-01-18", "2024-02-20").count() == 0
    assert read("2023-01-01", "2023-01-31").columns == SOURCE_TICKS.names


def test_plan_hours(spark):
    ranges = spark.sql("SELECT 'X' AS symbol, DATE'2024-01-19' AS start_date, DATE'2024-01-22' AS end_date")
    hours = bronze.plan_hours(ranges)
    assert hours.count() == 48  # Friday and Monday
    landed = hours.where("hour(hour) < 5")
    assert bronze.hours_to_fetch(ranges, landed).count() == 38
    assert bronze.calendar_days(ranges).count() == 4
    ticks = hours.where("hour(hour) = 7 OR hour(hour) = 3").select("symbol", F.col("hour").alias("timestamp_utc"))
    summary = bronze.download_summary(bronze.hour_manifest(ranges, landed, ticks)).first()
    assert tuple(summary) == ("X", 2, 2, 36, 10)


def raw_ticks(spark, *rows):
    return spark.createDataFrame([(at(t), 2.0, 1.0, 0.0, v, s, q) for t, v, s, q in rows], TICKS)


def test_day_is_replaced_or_extended(spark, tmp_path):
    path = str(tmp_path / "archive")
    bronze.archive_days(raw_ticks(spark, ("2024-01-17T10:00:00", 1.0, "X", 0), ("2024-01-18T10:00:00", 1.0, "X", 0), ("2024-01-17T10:00:00", 1.0, "Y", 0)), path)
    bronze.archive_days(raw_ticks(spark, ("2024-01-17T11:00:00", 2.0, "X", 0)), path)  # writing a day replaces it
    days = lambda: sorted((r.symbol, r.timestamp_utc.day, r.bid_volume) for r in bronze.read_archive(spark, path).collect())
    assert days() == [("X", 17, 2.0), ("X", 18, 1.0), ("Y", 17, 1.0)]
    part = raw_ticks(spark, ("2024-01-17T12:00:00", 3.0, "X", 0), ("2024-01-17T11:00:00", 2.0, "X", 5), ("2024-01-19T12:00:00", 4.0, "X", 0))
    bronze.merge_into_archive(spark, part, path)  # merging part of a day keeps the rest
    assert days() == [("X", 17, 2.0), ("X", 17, 3.0), ("X", 18, 1.0), ("X", 19, 4.0), ("Y", 17, 1.0)]
    assert list((tmp_path / "archive").glob("version=*/symbol=X/year=2024/month=01/day=17"))
    assert bronze.archived_days(spark, path, "2024-01-18", "2024-01-19").count() == 2
    text = plan(bronze.read_archive(spark, path, "2024-01-18", "2024-01-18"))
    assert "make_date" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_compaction_sorts_and_keeps_distinct_ticks(spark, tmp_path):
    path = str(tmp_path / "months")
    rows = [(f"2024-01-{d:02d}T10:00:00", float(v), "X", q) for d in range(1, 29) for v, q in ((1, 0), (1, 3), (2, 1))]
    bronze.compact_months(raw_ticks(spark, *rows), path)
    assert bronze.read_months(spark, path).count() == 56
    for file in (tmp_path / "months").rglob("*.parquet"):
        times = [r.timestamp_utc for r in spark.read.parquet(str(file)).select("timestamp_utc").collect()]
        assert times == sorted(times)


def test_hot_day_is_split_over_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        hot = spark.range(0, 100_000, 1, 16).select(
            F.timestamp_millis(F.lit(1_705_449_600_000) + F.col("id") * 800).alias("timestamp_utc"),
            F.rand(1).alias("ask"), F.rand(2).alias("bid"), F.rand(3).alias("ask_volume"), F.rand(4).alias("bid_volume"),
            F.lit("X").alias("symbol"), F.col("id").alias("seq"),
        )
        bronze.land_hours(hot, str(tmp_path / "raw"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "raw" / "symbol=X" / "date=2024-01-17").glob("*.parquet"))
    assert len(files) > 4
    assert bronze.read_landed(spark, str(tmp_path / "raw")).count() == 100_000


def test_landing_appends(spark, tmp_path):
    path = str(tmp_path / "raw")
    bronze.land_hours(raw_ticks(spark, ("2024-01-17T10:30:00", 1.0, "X", 0)), path)
    bronze.land_hours(raw_ticks(spark, ("2024-01-17T11:30:00", 1.0, "X", 0)), path)
    landed = bronze.read_landed(spark, path)
    assert landed.count() == 2 and bronze.landed_hours(landed).count() == 2
    assert sorted(p.name for p in (tmp_path / "raw" / "symbol=X").iterdir()) == ["date=2024-01-17"]


def bar(minute, close, **more):
    return {"datetime": f"2024-01-17 10:{minute:02d}:00", "open": "1.0", "high": "9", "low": "0.5", "close": str(close), **more}


def write_doc(root, symbol, name, body):
    folder = root / symbol
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(body if isinstance(body, str) else json.dumps(body))


def test_documents(spark, tmp_path):
    write_doc(tmp_path, "xauusd", "a.json", {"status": "ok", "values": [bar(1, 2.5, volume="7"), bar(0, 1.5)]})
    bad = {
        "b": ({"status": "error", "code": 429, "message": "slow down"}, "feed error: slow down"),
        "c": ({"status": "ok", "values": []}, "no values"),
        "d": ({"status": "ok"}, "no values"),
        "e": ("<html>", "not a JSON object"),
        "f": ({"values": [bar(0, "n/a")]}, "a value is not a number or a time"),
        "g": ({"values": [bar(0, 1, volume="much")]}, "a value is not a number or a time"),
        "h": ({"values": [{"open": "1"}]}, "a value is not a number or a time"),
    }
    for name, (body, _) in bad.items():
        write_doc(tmp_path, "EURUSD", f"{name}.json", body)
    docs = barfeed.read_documents(spark, str(tmp_path))
    bars = barfeed.feed_bars(docs).orderBy("timestamp_utc").collect()
    assert [(r.symbol, r.close, r.volume) for r in bars] == [("XAUUSD", 1.5, 0.0), ("XAUUSD", 2.5, 7.0)]
    problems = sorted(r.problem for r in barfeed.rejected_documents(docs).collect())
    assert problems == sorted(reason for _, reason in bad.values())


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_last_delivery_of_a_bar_wins(spark, order):
    times = [at("2024-01-17T10:05:00"), at("2024-01-17T10:20:00")]
    deliveries = [json.dumps({"values": [bar(0, 1.5, volume="3")]}), json.dumps({"values": [bar(0, 2.5, volume="2"), bar(1, 4)]})]
    docs = spark.createDataFrame([("X", deliveries[i], times[i]) for i in order], "symbol string, body string, delivered_at timestamp")
    got = barfeed.latest_revision(barfeed.feed_bars(docs)).orderBy("timestamp_utc").collect()
    assert [(r.close, r.volume) for r in got] == [(2.5, 2.0), (4.0, 0.0)]


def test_hour_files_of_all_symbols_and_days_come_back(spark, sf_dir):
    from checks import adapters as A
    from checks.catalog import QUERIES

    names = [c for c in A.ticks_dirty(spark, sf_dir).columns if c != "seq"]
    assert QUERIES["hour_files_whole"](spark, sf_dir).count() == A.ticks_dirty(spark, sf_dir).select(names).distinct().count()

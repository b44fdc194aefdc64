import json
import os

import pytest
from pyspark.sql import functions as F

from checks import adapters
from helpers import at
from tickbars.operators import bars as B
from tickbars.operators import cleaning, gaps, indicators, ledger
from tickbars.schemas import TICKS
from tickbars.session import shared_dir
from tickbars.sources.bronze import read_archive
from tickbars.streaming import live
from tickbars.streaming import ticks as S


@pytest.fixture(scope="module")
def pieces(spark, sf_dir):
    """Three overlapping deliveries of the same ticks, in time order."""
    when = F.col("timestamp_utc")
    ticks = adapters.ticks(spark, sf_dir).cache()
    yield ticks, [
        ticks.where(when < F.lit(at("2024-01-11T12:30:00"))),
        ticks.where(when.between(F.lit(at("2024-01-10T06:10:00")), F.lit(at("2024-01-21T07:45:00")))),
        ticks.where(when > F.lit(at("2024-01-20T05:05:00"))),
    ]
    ticks.unpersist()


def rounded(df):
    cols = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return {tuple(r) for r in df.select(*cols).collect()}


def run(spark, tmp_path, pieces, chain):
    """Deliver the pieces one by one, each in a new run of the query over one checkpoint."""
    S.use_keyed_state(spark)
    land, out, checkpoint = (str(tmp_path / n) for n in ("land", "out", "checkpoint"))
    for piece in pieces:
        piece.coalesce(1).write.mode("append").parquet(land)
        stream = chain(S.clean_stream(S.tick_stream(spark, land, 1), "3 days"))
        S.write_stream(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def closed_before(ticks):
    return ticks.agg(F.max("timestamp_utc") - F.expr("INTERVAL 3 DAYS")).first()[0]


def test_stream_equals_batch(spark, tmp_path, pieces):
    ticks, parts = pieces
    got = run(spark, tmp_path, parts, lambda clean: S.atr_stream(S.bar_stream(clean, "1h"), 5))
    batch = indicators.compute_atr(B.resample(cleaning.clean_ticks(ticks), "1h"), 5)
    want = batch.where(F.col("bar_time") + F.expr("INTERVAL 1 HOUR") <= F.lit(closed_before(ticks)))
    assert got.count() > 200
    assert rounded(got) == rounded(want.select(*got.columns))


def test_stream_gaps_equal_batch(spark, tmp_path, pieces):
    ticks, parts = pieces
    got = run(spark, tmp_path, parts, lambda clean: S.gap_stream(S.bar_stream(clean, "1h"), "1h"))
    closed = B.resample(cleaning.clean_ticks(ticks), "1h").where(
        F.col("bar_time") + F.expr("INTERVAL 1 HOUR") <= F.lit(closed_before(ticks))
    )
    want = gaps.classify_gaps(gaps.detect_gaps(closed, "1h", "bar_time"))
    assert got.count() > 50 and rounded(got) == rounded(want.select(*got.columns))
    with pytest.raises(ValueError):
        S.gap_stream(closed, "3d")


def test_late_ticks_are_dropped_and_counted(spark, tmp_path):
    def piece(*times):
        return spark.createDataFrame([(at(t), 2.0, 1.0, 0.0, 1.0, "X", i) for i, t in enumerate(times)], TICKS)

    land, out, checkpoint = (str(tmp_path / n) for n in ("land", "out", "checkpoint"))
    dropped = 0
    for part in (piece("2024-01-17T10:00:00", "2024-01-17T12:00:00"), piece("2024-01-17T10:30:00", "2024-01-17T14:00:00")):
        part.coalesce(1).write.mode("append").parquet(land)
        query = S.write_stream(S.bar_stream(S.clean_stream(S.tick_stream(spark, land, 1), "10 minutes"), "1h"), out, checkpoint)
        query.awaitTermination()
        dropped += S.late_rows(query)
    got = spark.read.parquet(out).orderBy("bar_time").collect()
    assert dropped == 1
    assert [(r.bar_time.hour, r.bar_volume) for r in got] == [(10, 1.0), (12, 1.0)]


def test_open_bars_are_corrected(spark, tmp_path, pieces):
    ticks, parts = pieces
    land, table, checkpoint = (str(tmp_path / n) for n in ("land", "ledger", "checkpoint"))
    for i, piece in enumerate(parts):
        piece.coalesce(1).write.mode("append").parquet(land)
        bars = S.bar_stream(S.clean_stream(S.tick_stream(spark, land, 1), "3 days"), "1d")
        S.write_open_bars(bars, table, checkpoint, "1d", clock=lambda: i).awaitTermination()
    got = ledger.read_ledger(spark, table)
    want = ledger.ledger_rows(B.resample(cleaning.clean_ticks(ticks), "1d"), "1d")
    assert rounded(got.select(*want.columns)) == rounded(want)
    assert got.where("last_updated_at > ingested_at").count() > 0  # days cut by the end of a delivery


def test_archive_stream_keeps_whole_days(spark, tmp_path, pieces):
    ticks, parts = pieces
    land, table, checkpoint = (str(tmp_path / n) for n in ("land", "archive", "checkpoint"))
    for piece in parts:
        piece.coalesce(1).write.mode("append").parquet(land)
        S.write_archive(S.tick_stream(spark, land), table, checkpoint).awaitTermination()
    assert rounded(read_archive(spark, table)) == rounded(ticks.select(*TICKS.names))


def documents(root, name, minutes, closes, delivered):
    values = [
        {"datetime": f"2024-01-17 10:{m:02d}:00", "open": str(c), "high": str(c + 1), "low": str(c - 1), "close": str(c), "volume": "1"}
        for m, c in zip(minutes, closes)
    ]
    folder = root / "XAUUSD"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(json.dumps({"status": "ok", "values": values}))
    os.utime(path, (delivered, delivered))


def test_live_windows_into_the_ledger(spark, tmp_path):
    land, table, checkpoint = tmp_path / "land", str(tmp_path / "ledger"), str(tmp_path / "checkpoint")

    def deliver(name, minutes, closes, delivered):
        documents(land, name, minutes, closes, delivered)
        query = live.write_live(
            live.document_stream(spark, str(land)), table, checkpoint, "1min", "5min", 2, clock=lambda: delivered
        )
        query.awaitTermination()
        return {r.bar_time // 60000 % 60: r for r in ledger.read_ledger(spark, table).collect()}

    first = deliver("a.json", range(0, 13), [10.0 + m for m in range(13)], 1_705_500_000)
    assert {m: r.bar_volume for m, r in first.items()} == {0: 5.0, 5: 5.0, 10: 3.0}
    assert first[0].atr is None and first[5].atr is not None
    # The next window starts inside the bucket of minute 5 and corrects minute 12.
    second = deliver("b.json", range(7, 18), [10.0 + m for m in range(7, 12)] + [50.0] + [10.0 + m for m in range(13, 18)], 1_705_500_900)
    assert {m: r.bar_volume for m, r in second.items()} == {0: 5.0, 5: 5.0, 10: 5.0, 15: 3.0}
    assert (second[5].bar_open, second[5].atr) == (first[5].bar_open, first[5].atr)
    assert second[10].bar_high == 51.0 and second[10].bar_close == 24.0
    assert second[10].atr == first[10].atr  # warm-up of the new window keeps the old ATR
    assert {m: r.ingested_at for m, r in second.items()} == {0: 1705500000000, 5: 1705500000000, 10: 1705500000000, 15: 1705500900000}


def test_partial_candle_is_kept_on_request(spark, tmp_path):
    from tickbars.sources import barfeed

    documents(tmp_path, "a.json", range(7, 18), [10.0] * 11, 1_705_500_000)
    docs = barfeed.read_documents(spark, str(tmp_path))
    assert live.live_candles(docs, "1min", "5min", 2).count() == 2
    assert live.live_candles(docs, "1min", "5min", 2, trim=False).count() == 3
    with pytest.raises(ValueError):
        live.live_candles(docs, "2min", "5min")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_batches_leave_no_scratch_tables(spark, tmp_path, pieces, monkeypatch):
    monkeypatch.setattr("tickbars.session.shared_dir", lambda spark: str(tmp_path / "shared"))
    ticks, parts = pieces
    land, table, checkpoint = (str(tmp_path / n) for n in ("land", "archive", "checkpoint"))
    for piece in parts:
        piece.coalesce(1).write.mode("append").parquet(land)
    S.write_archive(S.tick_stream(spark, land, 1), table, checkpoint).awaitTermination()
    assert len(parts) > 1 and not list((tmp_path / "shared" / "tickbars").iterdir())

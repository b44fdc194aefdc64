import json

import pytest
from pyspark.sql import functions as F

from checks import adapters
from helpers import at
from tickbars.operators import ledger
from tickbars.plans.market_run import STAGES, backfill, live


def run(spark, tmp_path, ticks, **options):
    paths = {"archive_path": str(tmp_path / "archive"), "ledger_path": str(tmp_path / "ledger")}
    return backfill(spark, ticks, "2024-01-03", "2024-01-12", timeframe="1h", now_ms=5, **{**paths, **options}).orderBy("symbol").collect()


def test_backfill_twice(spark, sf_dir, tmp_path):
    ticks = adapters.ticks_dirty(spark, sf_dir)
    report = run(spark, tmp_path, ticks)
    assert [r.symbol for r in report] == ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
    for first in report:
        assert (first.result, first.reconcile) == ("PASS", "OK")
        assert [(s.name, s.status) for s in first.stages] == [(n, "ok") for n in STAGES]
        assert first.archive_rows == first.ticks_ingested > first.ticks_clean > 0
        assert first.archive_days == 10 and first.gaps_found == first.gaps_expected + first.gaps_real
    before = ledger.read_ledger(spark, str(tmp_path / "ledger")).orderBy("symbol", "bar_time").collect()
    again = run(spark, tmp_path, ticks)
    skip = ("elapsed_s", "stages")
    counts = lambda rows: [{k: v for k, v in r.asDict().items() if k not in skip} for r in rows]
    assert counts(again) == counts(report)
    assert ledger.read_ledger(spark, str(tmp_path / "ledger")).orderBy("symbol", "bar_time").collect() == before
    assert len(before) == sum(r.candles_produced for r in report)


def test_a_run_counts_its_own_symbols_only(spark, sf_dir, tmp_path):
    ticks = adapters.ticks(spark, sf_dir)
    run(spark, tmp_path, ticks.where("symbol <> 'VIEW'"))
    path = str(tmp_path / "ledger")
    before = ledger.read_ledger(spark, path).where("symbol <> 'VIEW'").orderBy("symbol", "bar_time").collect()
    (second,) = run(spark, tmp_path, ticks.where("symbol = 'VIEW'").withColumn("symbol", F.lower("symbol")))
    assert second.symbol == "VIEW" and second.ticks_ingested == second.archive_rows > 0
    table = ledger.read_ledger(spark, path)
    assert table.where("symbol <> 'VIEW'").orderBy("symbol", "bar_time").collect() == before
    assert table.where("symbol = 'VIEW'").count() == second.candles_produced == second.ledger_rows


def test_a_bad_candle_holds_back_itself_only(spark, sf_dir, tmp_path):
    ticks = adapters.ticks(spark, sf_dir)
    nan = F.when(F.col("symbol") == "VIEW", F.lit(float("nan")))
    got = {r.symbol: r for r in run(spark, tmp_path, ticks.withColumns({c: F.coalesce(nan, F.col(c)) for c in ("ask", "bid")}))}
    bad, good = got.pop("VIEW"), got
    assert bad.candles_rejected == bad.candles_produced > 0 and bad.ledger_rows == 0 and bad.reconcile.startswith("MISMATCH 0 written")
    assert all(r.result == "PASS" and r.ledger_rows == r.candles_produced > 0 and r.reconcile == "OK" for r in good.values())


def test_dry_run_writes_nothing(spark, sf_dir, tmp_path):
    got = run(spark, tmp_path, adapters.ticks_dirty(spark, sf_dir), dry_run=True)[0]
    assert got.result == "PASS" and got.candles_produced > 0 and got.reconcile == ""
    assert got.stages[-1].status == "skipped" and got.ledger_rows == got.archive_rows == 0
    assert not (tmp_path / "ledger").exists() and not (tmp_path / "archive").exists()


def test_failure_skips_the_rest_and_reports(spark, sf_dir, tmp_path):
    nothing = adapters.ticks(spark, sf_dir).where(F.lit(False))
    (got,) = run(spark, tmp_path, nothing)
    assert got.symbol is None
    assert got.result == "FAIL"
    assert [s.status for s in got.stages] == ["ok", "fail", "skipped", "skipped", "skipped", "skipped"]
    assert "no ticks" in got.stages[1].detail


def test_parameters_are_checked_first(spark, sf_dir, tmp_path):
    ticks = adapters.ticks(spark, sf_dir)
    for start, end, timeframe in (("2024-01-03", None, "1h"), ("x", "y", "1h"), ("2024-01-03", "2024-01-04", "1 H"), ("2024-01-03", "2024-01-04", "1x")):
        with pytest.raises(ValueError):
            backfill(spark, ticks, start, end, timeframe=timeframe, archive_path="a", ledger_path="b")


def documents(spark, *closes):
    values = [{"datetime": f"2024-01-17 10:{i:02d}:00", "open": str(c), "high": "99", "low": "0", "close": str(c)} for i, c in closes]
    rows = [("XAUUSD", json.dumps({"values": values}), at("2024-01-17T10:30:00"))]
    return spark.createDataFrame(rows, "symbol string, body string, delivered_at timestamp")


def test_live_run(spark, tmp_path):
    path = str(tmp_path / "ledger")
    got = live(spark, documents(spark, *[(i, 10.0 + i) for i in range(3, 20)]), ledger_path=path, now_ms=5).first()
    assert (got.mode, got.start, got.end, got.result, got.reconcile) == ("live", "2024-01-17", "2024-01-17", "PASS", "OK")
    assert (got.ticks_ingested, got.candles_produced, got.ledger_rows, got.archive_rows) == (68, 3, 3, 0)
    assert [s.status for s in got.stages] == ["ok", "skipped", "ok", "ok", "ok", "ok"]
    bars = ledger.latest_candles(ledger.read_ledger(spark, path), "XAUUSD", "5min").collect()
    assert [(b.bar_open, b.bar_close) for b in bars] == [(15.0, 19.0), (20.0, 24.0), (25.0, 29.0)]


def test_live_run_without_bars_fails(spark, tmp_path):
    got = live(spark, documents(spark), ledger_path=str(tmp_path / "ledger")).first()
    assert got.result == "FAIL" and [s.status for s in got.stages] == ["fail"] + ["skipped"] * 5
    with pytest.raises(ValueError):
        live(spark, documents(spark), ledger_path="x", fetch_interval="2min", timeframe="5min")

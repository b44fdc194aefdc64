import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import at, plan
from tickbars.operators import ledger
from tickbars.schemas import LEDGER

HOUR = 3_600_000
BASE = 1_705_312_800_000  # 2024-01-15 10:00 UTC


def rows(spark, *bars, symbol="XAUUSD", timeframe="1h"):
    """Ledger rows of (hour index, close, atr)."""
    data = [(symbol, timeframe, BASE + HOUR * i, 1.0, 9.0, 0.5, c, 2.0, atr) for i, c, atr in bars]
    return spark.createDataFrame(
        data, "symbol string, timeframe string, bar_time bigint, bar_open double, bar_high double, bar_low double, "
        "bar_close double, bar_volume double, atr double",
    )


def state(df):
    return {(r.symbol, (r.bar_time - BASE) // HOUR): (r.bar_close, r.atr, r.ingested_at, r.last_updated_at) for r in df.collect()}


def test_upsert_rules(spark, tmp_path):
    path = str(tmp_path / "ledger")
    first = ledger.upsert_candles(spark, path, rows(spark, (0, 1.0, 0.1), (1, 2.0, None), (2, 3.0, 0.3)), 100)
    second = ledger.upsert_candles(spark, path, rows(spark, (1, 5.0, 0.5), (2, 6.0, None), (3, 7.0, None)), 200)
    assert (first.inserted, first.updated, first.rows) == (3, 0, 3)
    assert (second.inserted, second.updated, second.rows) == (1, 2, 3)
    assert state(ledger.read_ledger(spark, path)) == {
        ("XAUUSD", 0): (1.0, 0.1, 100, 100),
        ("XAUUSD", 1): (5.0, 0.5, 100, 200),  # the new ATR replaces NULL
        ("XAUUSD", 2): (6.0, 0.3, 100, 200),  # a NULL ATR keeps the old one
        ("XAUUSD", 3): (7.0, None, 200, 200),
    }


def test_upsert_twice_is_upsert_once(spark, tmp_path):
    path = str(tmp_path / "ledger")
    batch = rows(spark, (0, 1.0, 0.1), (800, 2.0, None))
    ledger.upsert_candles(spark, path, batch, 100)
    before = state(ledger.read_ledger(spark, path))
    again = ledger.upsert_candles(spark, path, batch, 100)
    assert (again.inserted, again.updated) == (0, 2)
    assert state(ledger.read_ledger(spark, path)) == before


def test_other_series_and_months_stay(spark, tmp_path):
    path = str(tmp_path / "ledger")
    old = rows(spark, (0, 1.0, None), (800, 2.0, None), (1600, 3.0, None))
    for symbol in ("AAA", "MMM", "ZZZ"):
        ledger.upsert_candles(spark, path, old.withColumn("symbol", F.lit(symbol)), 100)
    ledger.upsert_candles(spark, path, old.withColumn("timeframe", F.lit("5min")).withColumn("symbol", F.lit("MMM")), 100)
    both = rows(spark, (0, 9.0, None), symbol="AAA").unionByName(rows(spark, (1600, 9.0, None), symbol="ZZZ"))
    got = ledger.upsert_candles(spark, path, both, 200)
    assert (got.inserted, got.updated) == (0, 2)
    table = ledger.read_ledger(spark, path)
    assert table.count() == 12 and table.where("last_updated_at = 200").count() == 2
    assert {k: v[0] for k, v in state(table.where("symbol = 'AAA'")).items()} == {("AAA", 0): 9.0, ("AAA", 800): 2.0, ("AAA", 1600): 3.0}


def test_empty_update_and_empty_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger.upsert_candles(spark, path, rows(spark).limit(0), 1).rows == 0
    empty = ledger.read_ledger(spark, path)
    assert empty.count() == 0
    health = ledger.ledger_health(empty, 1_000).first()
    assert tuple(health) == ("ok", 0, None, None, None)


def test_numeric_looking_symbols_stay_text(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.upsert_candles(spark, path, rows(spark, (0, 1.0, None), symbol="007"), 1)
    assert ledger.read_ledger(spark, path).first().symbol == "007"


def lose_driver(monkeypatch, at):
    """Let the next write of a table fail: before its rows, after them, or with a manifest that is not committed."""
    from pyspark.sql import DataFrameWriter

    real = DataFrameWriter.parquet

    def parquet(writer, path, *args, **options):
        is_manifest = "_manifests" in path
        if at == "rows" and not is_manifest:
            raise KeyboardInterrupt
        if at != "rows" and is_manifest:
            if at == "commit":
                real(writer, path, *args, **options)
                os.remove(os.path.join(path, "_SUCCESS"))
            raise KeyboardInterrupt
        return real(writer, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)


@pytest.mark.parametrize("at", ["rows", "manifest", "commit"])
def test_lost_driver_loses_no_row(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "ledger")
    ledger.upsert_candles(spark, path, rows(spark, (0, 1.0, 0.1), (1, 2.0, 0.2), (2, 3.0, 0.3)), 100)
    want = state(ledger.read_ledger(spark, path))
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        lose_driver(patch, at)
        ledger.upsert_candles(spark, path, rows(spark, (1, 9.0, None)), 200)
    assert state(ledger.read_ledger(spark, path)) == want
    got = ledger.upsert_candles(spark, path, rows(spark, (1, 9.0, None)), 300)  # no call in between
    assert (got.inserted, got.updated) == (0, 1)
    table = ledger.read_ledger(spark, path)
    assert table.count() == 3 and table.where("bar_close = 9.0 AND atr = 0.2").count() == 1


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "ledger")
    for now in range(6):
        ledger.upsert_candles(spark, path, rows(spark, (0, float(now), None)), now)
    assert len(list((tmp_path / "ledger").glob("version=*"))) == 2
    assert len([p for p in (tmp_path / "ledger" / "_manifests").iterdir() if p.is_dir()]) == 2


def test_one_candle_twice_fails(spark, tmp_path):
    with pytest.raises(PySparkException, match="twice"):
        ledger.upsert_candles(spark, str(tmp_path / "ledger"), rows(spark, (0, 1.0, None), (0, 2.0, None)), 1)


def candle(spark, **change):
    bar = {"symbol": "XAUUSD", "bar_time": at("2024-01-15T10:00:00"), "bar_open": 1.0, "bar_high": 1.0, "bar_low": 1.0,
           "bar_close": 1.0, "bar_volume": 1.0, "atr": 1.0, **change}
    ddl = "symbol string, bar_time timestamp, " + ", ".join(f"{c} double" for c in list(bar)[2:])
    return spark.createDataFrame([tuple(bar.values())], ddl)


def test_valid_rows(spark):
    got = ledger.ledger_rows(candle(spark), "1h").first()
    assert got.bar_time == BASE and got.timeframe == "1h" and got.atr == 1.0
    for atr in (float("nan"), float("inf"), None):
        assert ledger.ledger_rows(candle(spark, atr=atr), "1h").first().atr is None
    assert ledger.ledger_rows(candle(spark).drop("atr"), "1h").first().atr is None


@pytest.mark.parametrize(
    "change", [{"bar_open": float("nan")}, {"bar_high": float("inf")}, {"bar_volume": None}, {"symbol": "XAU/USD"}, {"symbol": "xauusd"}]
)
def test_invalid_rows_fail(spark, change):
    with pytest.raises(PySparkException):
        ledger.ledger_rows(candle(spark, **change), "1h").collect()
    with pytest.raises(ValueError):
        ledger.ledger_rows(candle(spark), "1 H")


def test_latest_candles(spark, tmp_path):
    path = str(tmp_path / "ledger")
    bars = [(i, float(i), None) for i in range(1200)]
    ledger.upsert_candles(spark, path, rows(spark, *bars), 1)
    table = ledger.read_ledger(spark, path)
    closes = lambda df: [r.bar_close for r in df.collect()]
    assert closes(ledger.latest_candles(table, "xauusd", "1h", 3)) == [1197.0, 1198.0, 1199.0]
    assert len(closes(ledger.latest_candles(table, "XAUUSD", "1h"))) == 200
    assert len(closes(ledger.latest_candles(table, "XAUUSD", "1h", 5000))) == 1000
    assert closes(ledger.latest_candles(table, "EURUSD", "1h")) == []
    with pytest.raises(ValueError):
        ledger.latest_candles(table, "XAU/USD", "1h")
    text = plan(ledger.latest_candles(table, "XAUUSD", "1h", 3))
    assert "TakeOrderedAndProject" in text
    scan = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "symbol" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "WindowGroupLimit" in plan(ledger.latest_per_series(table, 3))


def test_chart_points(spark):
    page = spark.createDataFrame(
        [(1999, 1.0, 2.0, 0.5, 1.5, 3.0, None), (None, 1.0, 2.0, 0.5, 1.5, 3.0, 0.7), (5000, 1.0, 2.0, 0.5, 1.5, 3.0, 0.9)],
        "bar_time bigint, bar_open double, bar_high double, bar_low double, bar_close double, bar_volume double, atr double",
    )
    assert [tuple(r) for r in ledger.candle_points(page).collect()] == [(1, 1.0, 2.0, 0.5, 1.5), (5, 1.0, 2.0, 0.5, 1.5)]
    assert [tuple(r) for r in ledger.atr_points(page).collect()] == [(5, 0.9)]


def test_merge_needs_one_shuffle_and_no_sort(spark):
    current = spark.createDataFrame([], LEDGER)
    text = plan(ledger.merge_candles(current, rows(spark, (0, 1.0, None)), 1))
    assert text.count("Exchange") == 1 and "Sort" not in text

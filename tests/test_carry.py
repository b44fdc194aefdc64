import datetime as dt
import random

import pytest
from helpers import UTC, wilder
from pyspark.sql import functions as F

from tickbars.operators import carry, ledger

DDL = "symbol string, timeframe string, bar_time bigint, bar_open double, bar_high double, bar_low double, bar_close double, bar_volume double, atr double"
START = dt.datetime(2024, 1, 1, tzinfo=UTC)


def ms(day):
    return int((START + dt.timedelta(days=day)).timestamp() * 1000)


def candle(symbol, day, seed):
    rnd = random.Random(f"{symbol}{day}{seed}")
    low = rnd.uniform(90, 100)
    high = low + rnd.uniform(0, 10)
    return (symbol, "1d", ms(day), low, high, low, rnd.uniform(low, high), 1.0, None)


def apply(spark, path, rows, period, now=1):
    return carry.upsert_with_atr(spark, path, spark.createDataFrame(rows, DDL), period, now)


def check(spark, path, held, period):
    got = {(r.symbol, r.bar_time): r.atr for r in ledger.read_ledger(spark, path).collect()}
    assert got.keys() == held.keys()
    for symbol in {s for s, _ in held}:
        rows = [held[k] for k in sorted(k for k in held if k[0] == symbol)]
        for row, want in zip(rows, wilder([(r[4], r[5], r[6]) for r in rows], period)):
            have = got[row[0], row[2]]
            assert have == want if want is None else abs(have - want) < 1e-9 * max(1, want)


@pytest.mark.parametrize("period", [1, 7])
def test_any_order_of_candles_and_corrections_equals_the_plain_recurrence(spark, tmp_path, period):
    path, held = str(tmp_path / "ledger"), {}
    deliveries = [
        [candle("AAA", d, 0) for d in range(100) if d not in (5, 44)] + [candle("BBB", d, 0) for d in range(2)],
        [candle("AAA", 5, 0), candle("AAA", 44, 0), candle("BBB", 200, 0)],  # missing ones, one of them in the warm-up
        [candle("AAA", 31, 1), candle("AAA", 120, 0), candle("BBB", 0, 1)],  # corrections, and a candle after a pause
        [candle("AAA", -20, 0)],  # before all others
    ]
    for rows in deliveries:
        fresh = [r for r in rows if (r[0], r[2]) not in held]
        got = apply(spark, path, rows, period)
        held |= {(r[0], r[2]): r for r in rows}
        assert got.inserted == len(fresh) and got.updated >= len(rows) - len(fresh)
        check(spark, path, held, period)


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "ledger")
    apply(spark, path, [candle("AAA", d, 0) for d in range(50)], 14)
    more = [candle("AAA", d, 0) for d in range(50, 70)]
    apply(spark, path, more, 14)
    columns = ["symbol", "bar_time", "bar_close", "atr"]
    before = sorted(ledger.read_ledger(spark, path).select(*columns).collect())
    apply(spark, path, more, 14)
    assert sorted(ledger.read_ledger(spark, path).select(*columns).collect()) == before


def test_months_before_the_change_are_not_read(spark, tmp_path):
    path = str(tmp_path / "ledger")
    held = {(r[0], r[2]): r for r in (candle("AAA", d, 0) for d in range(100))}
    apply(spark, path, list(held.values()), 14)
    wrong = [(*r[:4], 10_000.0, *r[5:]) for r in list(held.values())[:20]]
    ledger.upsert_candles(spark, path, spark.createDataFrame(wrong, DDL), 2)  # January, behind the carry's back
    new = candle("AAA", 100, 0)
    apply(spark, path, [new], 14)
    held[new[0], new[2]] = new
    rows = [held[k] for k in sorted(held)]
    last = ledger.read_ledger(spark, path).where(F.col("bar_time") == new[2]).first().atr
    assert abs(last - wilder([(r[4], r[5], r[6]) for r in rows], 14)[-1]) < 1e-9


def test_a_change_without_weight_left_stops(spark, tmp_path):
    path, days = str(tmp_path / "ledger"), 400
    apply(spark, path, [candle("AAA", d, 0) for d in range(days)], 2, now=1)
    apply(spark, path, [candle("AAA", 3, 1)], 2, now=2)
    touched = ledger.read_ledger(spark, path).where("last_updated_at = 2").agg(F.max("bar_time")).first()[0]
    assert carry.weightless_after(2) == 100 and touched < ms(3 + 100 + 62)
    held = {("AAA", ms(d)): candle("AAA", d, 1 if d == 3 else 0) for d in range(days)}
    check(spark, path, held, 2)

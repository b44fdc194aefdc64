import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, wilder
from tickbars.operators import indicators
from tickbars.operators.segments import with_previous

START = 1_704_067_200


def candles(spark, bars, spacing=3600, symbol="X"):
    rows = [(symbol, START + spacing * i, h, l, c) for i, (h, l, c) in enumerate(bars)]
    df = spark.createDataFrame(rows, "symbol string, t bigint, bar_high double, bar_low double, bar_close double")
    return df.withColumn("bar_time", F.timestamp_seconds("t")).drop("t")


def walk(n, seed=1):
    rng, level, out = random.Random(seed), 1000.0, []
    for _ in range(n):
        level += rng.uniform(-5, 5)
        low, high = level - rng.uniform(0, 3), level + rng.uniform(0, 3)
        out.append((high, low, rng.uniform(low, high)))
    return out


def atr(df, period):
    return [r.atr for r in indicators.compute_atr(df, period).orderBy("symbol", "bar_time").collect()]


def close_to(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert (a is None) == (b is None)
        assert a is None or math.isclose(a, b, rel_tol=1e-11, abs_tol=1e-12)


@pytest.mark.parametrize("period", [1, 2, 3, 14, 100])
@pytest.mark.parametrize("spacing", [60, 86400 * 3])
def test_atr_equals_a_plain_loop(spark, period, spacing):
    bars = walk(3000)
    close_to(atr(candles(spark, bars, spacing).repartition(7), period), wilder(bars, period))


def test_atr_over_many_blocks(spark):
    # 256 candles a block at period 2: weights of old blocks underflow, and must do so exactly.
    bars = walk(6000, 2)
    bars[10] = (1e12, 1.0, 2.0)
    close_to(atr(candles(spark, bars), 2), wilder(bars, 2))


def test_atr_warm_up(spark):
    assert atr(candles(spark, walk(13)), 14) == [None] * 13
    got = atr(candles(spark, walk(14)), 14)
    assert got[:13] == [None] * 13 and got[13] is not None


def test_flat_market_keeps_zero(spark):
    got = atr(candles(spark, [(5.0, 5.0, 5.0)] * 20), 14)
    assert got[13:] == [0.0] * 7


def test_series_do_not_touch(spark):
    one, two = walk(400, 3), walk(50, 4)
    both = candles(spark, one, symbol="A").unionByName(candles(spark, two, symbol="B"))
    close_to(atr(both, 14), wilder(one, 14) + wilder(two, 14))


def test_atr_column_name_and_bad_period(spark):
    df = indicators.compute_atr(candles(spark, walk(20)), 3, col="range_3")
    assert df.columns[-1] == "range_3"
    again = indicators.compute_atr(df, 3, col="range_3")
    assert again.columns == df.columns
    with pytest.raises(ValueError):
        indicators.compute_atr(df, 0)


def test_no_window_holds_a_whole_series_of_candles(spark):
    # Windows over candles are cut by segment or block; those by symbol alone run on summaries.
    text = plan(indicators.compute_atr(candles(spark, walk(50)), 14))
    for line in text.splitlines():
        if "Window " in line and "bar_high" in line:
            assert "_segment" in line or "_block" in line


def test_previous_across_segments(spark):
    df = spark.range(0, 5000, 1, 13).select(F.lit("X").alias("symbol"), (F.col("id") * 40_000).alias("t"), F.col("id").alias("v"))
    got = with_previous(df, ["symbol"], "t", F.col("t"), ["v"])
    assert got.count() == 5000
    assert got.where("position != v + 1 OR NOT previous_v <=> nullif(v - 1, -1)").count() == 0


def test_price_change(spark):
    df = candles(spark, [(1.0, 1.0, 10.0), (1.0, 1.0, 8.0), (1.0, 1.0, 10.0)])
    df = df.unionByName(candles(spark, [(1.0, 1.0, 3.0)], symbol="Y"))
    got = {r.symbol: (r.last_close, r["abs"], r.pct, r.up) for r in indicators.price_change(df).collect()}
    assert got == {"X": (10.0, 2.0, 25.0, True), "Y": (3.0, None, None, None)}
    assert "WindowGroupLimit" in plan(indicators.price_change(df))

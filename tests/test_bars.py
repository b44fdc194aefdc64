import pytest
from pyspark.sql import functions as F

from helpers import at, plan
from tickbars.operators import bars as B
from tickbars.operators import cleaning
from tickbars.schemas import BARS, CANDLE_VALUES, TICKS


def priced(spark, rows):
    """Rows of (time, price, bid_volume, seq, symbol)."""
    full = [(at(t), p, p, 0.0, v, s, q) for t, p, v, q, s in rows]
    return cleaning.derive_price(spark.createDataFrame(full, TICKS))


def values(row):
    return tuple(row[c] for c in CANDLE_VALUES)


def test_same_millisecond_follows_seq(spark):
    df = priced(spark, [("2024-01-16T10:00:00", p, 1.0, s, "X") for s, p in ((7, 3.0), (2, 9.0), (5, 1.0))])
    for n in (1, 5):
        assert values(B.resample(df.repartition(n), "1min").first()) == (9.0, 9.0, 1.0, 3.0, 3.0)


def test_missing_price_still_counts_volume(spark):
    df = priced(spark, [
        ("2024-01-16T10:00:01", None, 5.0, 1, "X"), ("2024-01-16T10:00:02", 2.0, 1.0, 2, "X"),
        ("2024-01-16T10:00:03", float("nan"), 7.0, 3, "X"), ("2024-01-16T10:00:04", 4.0, None, 4, "X"),
    ])
    assert values(B.resample(df, "1min").first()) == (2.0, 4.0, 2.0, 4.0, 13.0)


@pytest.mark.parametrize("timeframe, start", [("7min", "2024-01-17T13:36:00"), ("7d", "2024-01-15T00:00:00"), ("1h", "2024-01-17T13:00:00")])
def test_bucket_origin(spark, timeframe, start):
    df = priced(spark, [("2024-01-17T13:37:11", 1.0, 1.0, 1, "X")])
    got = B.resample(df, timeframe).select(F.unix_seconds("bar_time")).first()[0]
    assert got == int(at(start).timestamp())


def test_symbols_do_not_mix_and_symbol_is_optional(spark):
    df = priced(spark, [("2024-01-16T10:00:00", 1.0, 1.0, 1, "X"), ("2024-01-16T10:00:30", 2.0, 1.0, 2, "Y")])
    assert B.resample(df, "1min").count() == 2
    one = B.resample(df.drop("symbol", "seq"), "1min")
    assert one.columns == ["bar_time", *CANDLE_VALUES] and values(one.first()) == (1.0, 2.0, 1.0, 2.0, 2.0)


def test_source_may_be_a_path(spark, tmp_path):
    df = priced(spark, [("2024-01-16T10:00:00", 1.0, 1.0, 1, "X")])
    df.write.parquet(str(tmp_path / "ticks"))
    assert B.resample(tmp_path / "ticks", "1min", spark).count() == 1
    with pytest.raises(TypeError):
        B.resample(42)
    with pytest.raises(ValueError, match="price"):
        B.resample(df.drop("price"))


def random_bars(spark, n=600):
    rows = []
    for i in range(n):
        low, spread = 100 + (i * 37 % 41), 1 + i % 7
        o, c = low + spread * 0.25, low + spread * 0.75
        when = at("2024-01-15T00:00:00").timestamp() + 60 * i
        rows.append((when, o, float(low + spread), float(low), c, float(i % 13), "x"))
    df = spark.createDataFrame(rows, "t double, open double, high double, low double, close double, volume double, symbol string")
    return df.withColumn("timestamp_utc", F.timestamp_seconds("t")).select(*BARS.names)


def test_bars_survive_the_trip_through_ticks(spark):
    bars = random_bars(spark)
    back = B.resample(cleaning.clean_ticks(B.bars_to_ticks(bars)), "1min")
    got = [(r.bar_time, *values(r)) for r in back.orderBy("bar_time").collect()]
    want = [(r.timestamp_utc, r.open, r.high, r.low, r.close, r.volume) for r in bars.orderBy("timestamp_utc").collect()]
    assert got == want


def test_roll_up_equals_direct(spark):
    ticks = cleaning.clean_ticks(B.bars_to_ticks(random_bars(spark)))
    rolled = B.roll_up(B.resample(ticks, "1min"), "1min", "5min")
    direct = B.resample(ticks, "5min")
    assert rolled.count() == 120 and rolled.exceptAll(direct).count() == 0
    with pytest.raises(ValueError):
        B.roll_up(direct, "5min", "7min")


def test_empty_bars_to_ticks(spark):
    got = B.bars_to_ticks(spark.createDataFrame([], BARS))
    assert got.schema.names == TICKS.names and got.count() == 0


def test_bar_invariants(spark):
    bars = B.resample(cleaning.clean_ticks(B.bars_to_ticks(random_bars(spark))), "15min")
    bad = bars.where("bar_low > least(bar_open, bar_close) OR bar_high < greatest(bar_open, bar_close)")
    assert bad.count() == 0
    assert bars.agg(F.sum("bar_volume")).first()[0] == random_bars(spark).agg(F.sum("volume")).first()[0]


def test_plan_stays_in_hash_aggregates(spark, sf_dir):
    from checks import adapters

    ticks = cleaning.derive_price(adapters.ticks(spark, sf_dir))
    for df in (B.resample(ticks, "1h"), B.roll_up(B.resample(ticks, "1h"), "1h", "4h"), B.latest_price(ticks)):
        text = plan(df)
        assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHash" not in text
    assert plan(B.resample(ticks, "1h")).count("Exchange") == 1
    # Only the columns needed are read.
    assert "user_id" not in plan(B.resample(ticks, "1h")).split("ReadSchema")[1]


def test_latest_price(spark):
    df = priced(spark, [
        ("2024-01-16T10:00:00", 1.0, 1.0, 1, "X"), ("2024-01-16T10:00:00", 2.0, 1.0, 2, "X"),
        ("2024-01-16T11:00:00", None, 1.0, 3, "X"), ("2024-01-16T09:00:00", 5.0, 1.0, 9, "Y"),
    ])
    got = {r.symbol: (r.price, r.source) for r in B.latest_price(df, "feed").collect()}
    assert got == {"X": (2.0, "feed"), "Y": (5.0, "feed")}

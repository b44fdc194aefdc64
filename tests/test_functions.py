import pytest
from pyspark.sql import functions as F

from helpers import at
from tickbars.functions import columns as C
from tickbars.functions import sessions as S


def one(spark, column, **values):
    """Evaluate a column over one row of named values."""
    ddl = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], ddl).select(column).first()[0]


@pytest.mark.parametrize("symbol, raw, price", [("XAUUSD", 4500000, 4500.0), ("GBPJPY", 187450, 187.45), ("EURUSD", 108345, 1.08345)])
def test_point_divisor(spark, symbol, raw, price):
    got = one(spark, F.col("raw") / C.point_divisor(F.col("s")), s=("string", symbol), raw=("bigint", raw))
    assert got == pytest.approx(price, abs=1e-12)


@pytest.mark.parametrize(
    "symbol, name",
    [("XAUUSD", "XAU/USD"), ("EURUSD", "EUR/USD"), ("A/B", "A/B"), ("AB1", "AB1"), (" xageur ", "XAG/EUR"), ("ABC123", "ABC123")],
)
def test_feed_symbol(spark, symbol, name):
    assert one(spark, C.feed_symbol(F.col("s")), s=("string", symbol)) == name


@pytest.mark.parametrize(
    "text, ms",
    [("2024-01-17 13:00:00", 1705496400000), ("2024-01-17T13:00:00Z", 1705496400000), ("2024-01-17T15:00:00+02:00", 1705496400000)],
)
def test_utc(spark, text, ms):
    assert one(spark, F.unix_millis(C.utc(F.col("s"))), s=("string", text)) == ms


@pytest.mark.parametrize("value, kept", [(1.5, 1.5), (float("nan"), None), (float("inf"), None), (float("-inf"), None), (None, None)])
def test_finite(spark, value, kept):
    assert one(spark, C.finite(F.col("x")), x=("double", value)) == kept


@pytest.mark.parametrize("ms, tenths, clamped", [(-15000, -0.2, 0.0), (0, 0.0, 0.0), (45000, 0.8, 0.75), (3_600_000, 60.0, 60.0)])
def test_minutes_since(spark, ms, tenths, clamped):
    now = 1_700_000_000_000
    args = {"t": ("bigint", now - ms), "n": ("bigint", now)}
    assert one(spark, C.minutes_since_tenths(F.col("t"), F.col("n")), **args) == tenths
    assert one(spark, C.minutes_since(F.col("t"), F.col("n")), **args) == clamped


def test_times_are_null_safe(spark):
    args = {"t": ("bigint", None), "n": ("bigint", 1)}
    for column in (C.minutes_since(F.col("t"), F.col("n")), C.minutes_since_tenths(F.col("t"), F.col("n")), C.iso_utc(F.col("t"))):
        assert one(spark, column, **args) is None


def test_change(spark):
    change = C.change(F.col("c"), F.col("p"))
    assert tuple(one(spark, change, c=("double", 11.0), p=("double", 10.0))) == (1.0, 10.0, True)
    assert tuple(one(spark, change, c=("double", -1.0), p=("double", 0.0))) == (-1.0, 0.0, False)
    assert one(spark, change, c=("double", None), p=("double", 0.0)) is None


# 2024-01-19 is a Friday, 2024-01-16 a Tuesday.
@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2024-01-19T22:00", "2024-01-20T00:00", True),
        ("2024-01-19T22:00", "2024-01-21T22:00", True),
        ("2024-01-19T22:00", "2024-01-22T00:00", False),
        ("2024-01-19T21:45", "2024-01-20T00:00", True),
        ("2024-01-19T21:44", "2024-01-20T00:00", False),
        ("2024-01-19T22:15", "2024-01-20T00:00", True),
        ("2024-01-19T22:16", "2024-01-20T00:00", False),
        ("2024-01-19T22:00", "2024-01-27T00:00", True),  # any weekend counts
        ("2024-01-16T22:01", "2024-01-16T23:00", True),
        ("2024-01-16T21:44", "2024-01-16T23:00", False),
        ("2024-01-16T21:45", "2024-01-16T23:15", True),
        ("2024-01-16T22:16", "2024-01-16T23:00", False),
        ("2024-01-16T22:00", "2024-01-16T23:16", False),
        ("2024-01-16T22:00", "2024-01-17T23:00", False),
        ("2024-01-16T04:07", "2024-01-16T04:08", False),
        (None, "2024-01-16T04:08", False),
        ("2024-01-19T22:00", None, False),
    ],
)
def test_expected_gap(spark, start, end, expected):
    args = {"a": ("timestamp", start and at(start)), "b": ("timestamp", end and at(end))}
    assert one(spark, S.expected_gap(F.col("a"), F.col("b")), **args) is expected


@pytest.mark.parametrize(
    "now, is_open",
    [
        ("2024-01-19T21:59", True), ("2024-01-19T22:00", False), ("2024-01-20T12:00", False),
        ("2024-01-21T21:59", False), ("2024-01-21T22:00", True), ("2024-01-16T22:30", True),
    ],
)
def test_market_open(spark, now, is_open):
    status = one(spark, S.market_status(F.col("t")), t=("timestamp", at(now)))
    assert status["open"] is is_open
    assert (status["label"], bool(status["detail"])) == (("Live", False) if is_open else ("Markets closed", True))


def test_calendar_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, S.weekday(F.col("t")), t=("timestamp", at("2024-01-19T21:59"))) == 4
        assert one(spark, S.minute_of_day(F.col("t")), t=("timestamp", at("2024-01-19T21:59"))) == 1319
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "minutes, is_open, level",
    [(19.9, True, "healthy"), (20.0, True, "delayed"), (60.0, True, "delayed"), (60.1, True, "stale"), (None, True, "unknown"), (1.0, False, "closed")],
)
def test_health_level(spark, minutes, is_open, level):
    assert one(spark, S.health_level(F.col("m"), F.col("o")), m=("double", minutes), o=("boolean", is_open)) == level


def test_near_wraps_midnight(spark):
    got = [one(spark, S.near(F.col("m"), 5), m=("int", m)) for m in (1430, 1429, 20, 21)]
    assert got == [True, False, True, False]

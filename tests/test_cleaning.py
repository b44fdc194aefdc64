import pytest
from pyspark.sql import functions as F

from checks import adapters as A
from checks.catalog import QUERIES
from helpers import at, plan
from tickbars.operators import cleaning
from tickbars.schemas import TICKS

T0 = at("2024-01-16T10:00:00")


def ticks(spark, *rows):
    """Rows of (ask, bid, ask_volume, bid_volume, seq) at one millisecond."""
    return spark.createDataFrame([(T0, a, b, av, bv, "X", s) for a, b, av, bv, s in rows], TICKS)


def test_first_delivery_stays(spark):
    df = ticks(spark, (2.0, 1.0, 0.0, 9.0, 5), (2.0, 1.0, 0.0, 7.0, 3), (3.0, 1.0, 0.0, 1.0, 8))
    got = cleaning.clean_ticks(df).orderBy("price").collect()
    assert [(r.price, r.bid_volume, r.seq) for r in got] == [(1.5, 7.0, 3), (2.0, 1.0, 8)]


def test_ties_do_not_depend_on_partitioning(spark):
    rows = [(2.0, 1.0, float(i % 5), float(i % 7), 1) for i in range(200)]
    results = {
        tuple(cleaning.clean_ticks(ticks(spark, *order).repartition(n)).first())
        for order in (rows, rows[::-1]) for n in (1, 3, 16)
    }
    assert len(results) == 1


def test_missing_values_are_equal(spark):
    df = ticks(spark, (float("nan"), 1.0, 0.0, 0.0, 1), (float("nan"), 1.0, 0.0, 0.0, 2), (None, 1.0, 0.0, 0.0, 3))
    got = cleaning.clean_ticks(df).collect()
    assert [(r.price, r.seq) for r in got] == [(None, 1)]
    assert cleaning.drop_repeated_rows(df).count() == 2


def test_row_dedup_ignores_seq_only(spark):
    df = ticks(spark, (2.0, 1.0, 0.0, 9.0, 5), (2.0, 1.0, 0.0, 9.0, 3), (2.0, 1.0, 0.0, 7.0, 4))
    assert sorted(r.seq for r in cleaning.drop_repeated_rows(df).collect()) == [3, 4]
    assert cleaning.drop_repeated_rows(df.drop("seq")).count() == 2


def test_duplicates_are_dropped_before_the_shuffle(spark):
    text = plan(cleaning.deduplicate_ticks(cleaning.derive_price(ticks(spark, (2.0, 1.0, 0.0, 9.0, 5)))))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="bid_volume"):
        cleaning.clean_ticks(spark.range(1).select(F.current_timestamp().alias("timestamp_utc")))


def test_empty_input_keeps_schema(spark):
    empty = spark.createDataFrame([], TICKS)
    assert cleaning.clean_ticks(empty).columns == [*TICKS.names, "price"]
    assert cleaning.with_known_time(empty, "timestamp_utc").count() == 0


def test_weekdays(spark):
    days = spark.createDataFrame([(at(f"2024-01-{d}T23:59:59"),) for d in range(15, 22)], "t timestamp")
    assert cleaning.weekdays_only(days, "t").count() == 5


def test_time_order(spark):
    rows = [(at(f"2024-01-16T10:00:{s:02d}"), 1.0, 1.0, 0.0, 0.0, sym, s) for s in (5, 1, 3) for sym in "BA"]
    got = cleaning.in_time_order(spark.createDataFrame(rows, TICKS)).collect()
    assert [(r.symbol, r.seq) for r in got] == [("A", 1), ("A", 3), ("A", 5), ("B", 1), ("B", 3), ("B", 5)]


def test_every_row_has_its_place_in_time_order(spark, sf_dir):
    rows = QUERIES["time_places"](spark, sf_dir).collect()
    assert len(rows) == A.ticks_dirty(spark, sf_dir).distinct().count() > 1000
    rows.sort(key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(1, len(rows) + 1))
    assert [(r.symbol, r.timestamp_utc, r.seq) for r in rows] == sorted((r.symbol, r.timestamp_utc, r.seq) for r in rows)

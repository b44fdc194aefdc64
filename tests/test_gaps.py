import random

import pytest
from pyspark.sql import functions as F

from helpers import at, missing_runs, plan
from tickbars.functions.timeframes import BAR_ORIGIN, timeframe_seconds
from tickbars.operators import gaps


def series(spark, seconds, symbol="X", column="timestamp_utc"):
    df = spark.createDataFrame([(symbol, int(s)) for s in seconds], "symbol string, t bigint")
    return df.select("symbol", F.timestamp_seconds("t").alias(column))


def found(df):
    rows = df.select(F.unix_seconds("gap_start").alias("a"), F.unix_seconds("gap_end").alias("b"), "duration_minutes").orderBy("a").collect()
    assert all(r.duration_minutes == (r.b - r.a) / 60 for r in rows)
    return [(r.a, r.b) for r in rows]


def sparse(seed, n, span):
    rng = random.Random(seed)
    start = int(at("2024-01-03T05:06:07").timestamp())
    return [start + rng.randrange(span) for _ in range(n)]


@pytest.mark.parametrize("origin", [0, BAR_ORIGIN])
@pytest.mark.parametrize(
    "freq, n, days",
    [("1min", 300, 20), ("7min", 300, 20), ("1h", 200, 60), ("5h", 60, 90), ("1d", 40, 200), ("36h", 30, 200),
     ("2d", 30, 300), ("50h", 30, 300), ("3d", 30, 500), ("5d", 20, 900), ("7d", 20, 900)],
)
def test_gaps_equal_a_full_grid(spark, freq, n, days, origin):
    seconds = sparse(n, n, days * 86400)
    got = found(gaps.detect_gaps(series(spark, seconds), freq, origin=origin))
    assert got == missing_runs(seconds, timeframe_seconds(freq), origin)


def test_long_outage_makes_one_row_a_week(spark):
    # Ten years without data at one second: 313 million missing buckets, never listed.
    ends = [at("2010-01-05T00:00:00").timestamp(), at("2020-01-07T00:00:00").timestamp()]
    got = found(gaps.detect_gaps(series(spark, ends), "1s"))
    assert len(got) == 523 and got[0][0] == ends[0] + 1 and got[-1][1] == ends[1]


def test_weekend_is_never_missing(spark):
    friday, monday = at("2024-01-19T23:59:00").timestamp(), at("2024-01-22T00:00:00").timestamp()
    assert found(gaps.detect_gaps(series(spark, [friday, monday]), "1min")) == []
    # Data on a Sunday extends the span but opens no gap.
    sunday = at("2024-01-21T22:00:00").timestamp()
    got = found(gaps.detect_gaps(series(spark, [friday, sunday, monday + 120]), "1min"))
    assert got == [(monday, monday + 120)]


def test_weekly_close_ends_at_saturday(spark):
    last, first = at("2024-01-19T21:59:00").timestamp(), at("2024-01-21T22:00:00").timestamp()
    labelled = gaps.classify_gaps(gaps.detect_gaps(series(spark, [last, first]), "1min"))
    assert found(labelled) == [(last + 60, at("2024-01-20T00:00:00").timestamp())]
    assert [r.expected for r in labelled.collect()] == [True]


def test_no_data_no_gaps(spark):
    empty = spark.createDataFrame([("X", None)], "symbol string, timestamp_utc timestamp")
    result = gaps.classify_gaps(gaps.detect_gaps(empty, "1min"))
    assert result.columns == ["symbol", "gap_start", "gap_end", "duration_minutes", "expected"] and result.count() == 0


def test_timestamp_column(spark):
    ticks, bars = series(spark, [0]), series(spark, [0], column="bar_time")
    assert gaps.timestamp_column(ticks) == "timestamp_utc" and gaps.timestamp_column(bars) == "bar_time"
    assert gaps.timestamp_column(ticks.withColumn("when", F.lit(1)), "when") == "when"
    for df, name in ((ticks, "nope"), (spark.range(1), None)):
        with pytest.raises(ValueError):
            gaps.timestamp_column(df, name)


def test_symbols_are_separate(spark):
    day = int(at("2024-01-16T00:00:00").timestamp())
    both = series(spark, [day, day + 180], "X").unionByName(series(spark, [day + 60, day + 120], "Y"))
    got = gaps.detect_gaps(both, "1min").collect()
    assert [(r.symbol, r.duration_minutes) for r in got] == [("X", 2.0)]


def test_coverage_adds_up(spark):
    seconds = sparse(5, 400, 25 * 86400)
    row = gaps.coverage(series(spark, seconds), "5min").first()
    runs = missing_runs(seconds, 300)
    assert row.present == len({s // 300 for s in seconds})
    assert row.gaps == len(runs) and row.missing == sum(b - a for a, b in runs) // 300
    assert row.gap_minutes == row.missing * 5
    full = gaps.coverage(series(spark, [0, 300, 600]), "5min").first()
    assert (full.present, full.expected, full.missing, full.gaps, full.gap_minutes) == (3, 3, 0, 0, 0.0)


def test_ticks_are_scanned_once(spark, sf_dir):
    from checks import adapters

    ticks = adapters.ticks(spark, sf_dir)
    for df in (gaps.detect_gaps(ticks, "1h"), gaps.coverage(ticks, "1h")):
        df.collect()
        final = plan(df).split("Initial Plan")[0]
        assert final.count("FileScan") == 1 and "ReusedExchange" in final
        assert "CartesianProduct" not in final and "NestedLoop" not in final

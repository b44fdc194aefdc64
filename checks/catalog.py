"""Every registered query, beside the SQL that must give the same rows.

Times come out as epoch milliseconds and doubles rounded to six places, so that
neither timestamp types nor the order of a sum can cause a false difference.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import adapters as A
from checks import landing
from tickbars.functions import columns as C
from tickbars.functions import sessions as S
from tickbars.operators import bars as B
from tickbars.operators import carry, cleaning, gaps, indicators, ledger, partials
from tickbars.operators import coverage as merging
from tickbars.plans.market_run import backfill
from tickbars.plans.market_run import live as live_run
from tickbars.session import configure, scratch_path, stored
from tickbars.sources import barfeed, bronze, tickfiles
from tickbars.streaming import hours, live
from tickbars.streaming import ticks as streaming
from tickbars.streaming.closing import Closing, write_closed_candles
from tickbars.streaming.progress import ProgressLog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CANDLE_OUT = (
    "epoch_ms(bar_time) AS bar_time, round(bar_open, 6) AS bar_open, round(bar_high, 6) AS bar_high, "
    "round(bar_low, 6) AS bar_low, round(bar_close, 6) AS bar_close, round(bar_volume, 6) AS bar_volume"
)
GAP_OUT = "symbol, epoch_ms(gap_start) AS gap_start, epoch_ms(gap_end) AS gap_end, round(duration_minutes, 6) AS duration_minutes"
TICK_OUT = (
    "epoch_ms(timestamp_utc) AS timestamp_utc, round(ask, 6) AS ask, round(bid, 6) AS bid, "
    "round(ask_volume, 6) AS ask_volume, round(bid_volume, 6) AS bid_volume, symbol, seq"
)


def shaped(df: DataFrame) -> DataFrame:
    """Timestamps to epoch milliseconds, doubles to six places."""
    cols = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            col = F.unix_millis(col)
        elif isinstance(field.dataType, T.DoubleType):
            col = F.round(col, 6)
        cols.append(col.alias(field.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    """Register a query and its SQL under *name*."""

    def add(make):
        QUERIES[name] = lambda spark, sf_dir: shaped(make(configure(spark), sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return make

    return add


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_ticks(A.ticks_dirty(spark, sf_dir))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_ticks(A.ticks_shipments(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(B.resample(clean(spark, sf_dir), "1h"), "bars-1h")


CLEAN_SQL = A.DIRTY_SQL + "," + A.clean_sql("ticks_dirty")
SHIPMENTS_SQL = A.SHIPMENTS_SQL + "," + A.clean_sql("ticks_shipments")
HOURLY_SQL = CLEAN_SQL + "," + A.bars_sql("1 hour")


# --- cleaning ---------------------------------------------------------------------------------

INSTRUMENTS = ["XAUUSD", "xagusd", "USDJPY", "EURUSD", "GBPJPY", "AB1", "EUR/USD", " eurusd ", "XPTUSD", "A" * 21, ""]
TIMEFRAMES = ["5min", "5MIN", "1h", "15 min", "12345min", "4h"]


def pick(values: list[str], by) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))


def pick_sql(values: list[str], by: str = "event_id") -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{by} % {len(values)} + 1]"


@query("mid_price", f"WITH {A.TICKS_SQL} SELECT {TICK_OUT}, round((bid + ask) / 2, 6) AS price FROM ticks")
def _(spark, sf_dir):
    return cleaning.derive_price(A.ticks(spark, sf_dir))


@query(
    "utc_normalise",
    """SELECT event_id, epoch_ms(date_trunc('millisecond', ts)) - CASE WHEN event_id % 3 = 2 THEN 7200000 ELSE 0 END AS timestamp_utc
    FROM events""",
)
def _(spark, sf_dir):
    text = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS")
    zone = pick(["", "Z", "+02:00"], F.col("event_id"))
    raw = A.table(spark, sf_dir, "events").select("event_id", F.concat(text, zone).alias("timestamp_utc"))
    return cleaning.normalise_utc(raw)


@query(
    "point_divisor",
    f"""SELECT event_id, s AS symbol, round(CAST(round(value * 1000) AS BIGINT) /
      CASE WHEN s IN ('XAUUSD','XAGUSD','XAUEUR','XAGEUR','XPTUSD','XPDUSD') OR s LIKE '%JPY' THEN 1000.0 ELSE 100000.0 END, 6) AS price
    FROM (SELECT *, {pick_sql(INSTRUMENTS)} AS s FROM events)""",
)
def _(spark, sf_dir):
    rows = A.table(spark, sf_dir, "events").withColumn("symbol", pick(INSTRUMENTS, F.col("event_id")))
    raw = F.round(F.col("value") * 1000).cast("long")
    return rows.select("event_id", "symbol", (raw / C.point_divisor(F.col("symbol"))).alias("price"))


@query(
    "feed_symbol",
    f"""SELECT event_id, s AS symbol, CASE WHEN contains(u, '/') THEN u WHEN regexp_full_match(u, '[A-Z]{{6}}') THEN u[1:3] || '/' || u[4:6]
      ELSE u END AS feed_name FROM (SELECT event_id, s, upper(trim(s)) AS u FROM (SELECT event_id, {pick_sql(INSTRUMENTS)} AS s FROM events))""",
)
def _(spark, sf_dir):
    rows = A.table(spark, sf_dir, "events").withColumn("symbol", pick(INSTRUMENTS, F.col("event_id")))
    return rows.select("event_id", "symbol", C.feed_symbol(F.col("symbol")).alias("feed_name"))


@query(
    "symbol_whitelist",
    f"""SELECT event_id, s AS symbol, t AS timeframe, regexp_full_match(s, '[A-Z0-9]{{1,20}}') AS symbol_ok,
      regexp_full_match(t, '[0-9]{{1,4}}[a-z]{{1,10}}') AS timeframe_ok
    FROM (SELECT event_id, {pick_sql(INSTRUMENTS)} AS s, {pick_sql(TIMEFRAMES)} AS t FROM events)""",
)
def _(spark, sf_dir):
    by = F.col("event_id")
    rows = A.table(spark, sf_dir, "events").select(
        "event_id", pick(INSTRUMENTS, by).alias("symbol"), pick(TIMEFRAMES, by).alias("timeframe")
    )
    return rows.select(
        "*",
        C.valid_symbol(F.col("symbol")).alias("symbol_ok"),
        C.valid_timeframe(F.col("timeframe")).alias("timeframe_ok"),
    )


@query("dedup_ticks", f"WITH {CLEAN_SQL} SELECT {TICK_OUT}, round(price, 6) AS price FROM clean")
def _(spark, sf_dir):
    return clean(spark, sf_dir)


@query(
    "dedup_rows",
    f"""WITH {A.DIRTY_SQL}, kept AS (SELECT timestamp_utc, ask, bid, ask_volume, bid_volume, symbol, min(seq) AS seq
      FROM ticks_dirty GROUP BY ALL) SELECT {TICK_OUT} FROM kept""",
)
def _(spark, sf_dir):
    return cleaning.drop_repeated_rows(A.ticks_dirty(spark, sf_dir))


@query(
    "dedup_subset",
    f"""WITH {A.DIRTY_SQL}, firsts AS (SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER
      (PARTITION BY timestamp_utc, symbol ORDER BY seq, ask, ask_volume, bid, bid_volume) AS nth FROM ticks_dirty) WHERE nth = 1)
    SELECT {TICK_OUT} FROM firsts""",
)
def _(spark, sf_dir):
    return cleaning.deduplicate_ticks(A.ticks_dirty(spark, sf_dir), ["timestamp_utc", "symbol"])


@query("weekday_ticks", f"WITH {A.TICKS_SQL} SELECT {TICK_OUT} FROM ticks WHERE isodow(timestamp_utc) <= 5")
def _(spark, sf_dir):
    return cleaning.weekdays_only(A.ticks(spark, sf_dir), "timestamp_utc")


# --- candles ----------------------------------------------------------------------------------


def _bar_query(name: str, timeframe: str, width: str) -> None:
    sql = f"WITH {CLEAN_SQL},{A.bars_sql(width)} SELECT symbol, {CANDLE_OUT} FROM bars"
    query(name, sql)(lambda spark, sf_dir: B.resample(clean(spark, sf_dir), timeframe))


_bar_query("bars_5min", "5min", "5 minutes")
_bar_query("bars_1h", "1h", "1 hour")
_bar_query("bars_1d", "1d", "1 day")
_bar_query("bars_7min", "7min", "7 minutes")
_bar_query("bars_7d", "7d", "7 days")


@query("bars_shipments_1d", f"WITH {SHIPMENTS_SQL},{A.bars_sql('1 day')} SELECT symbol, {CANDLE_OUT} FROM bars")
def _(spark, sf_dir):
    return B.resample(shipments(spark, sf_dir), "1d")


NULL_PRICE_SQL = A.TICKS_SQL + """,
holed AS (SELECT *, CASE WHEN bid_volume > 60 THEN NULL ELSE (bid + ask) / 2 END AS price FROM ticks)"""


@query("bars_missing_prices", f"WITH {NULL_PRICE_SQL},{A.bars_sql('5 minutes', 'holed')} SELECT symbol, {CANDLE_OUT} FROM bars")
def _(spark, sf_dir):
    holed = cleaning.derive_price(A.ticks(spark, sf_dir)).withColumn(
        "price", F.when(F.col("bid_volume") <= 60, F.col("price"))
    )
    return B.resample(holed, "5min")


@query("rollup_1h_to_4h", f"WITH {CLEAN_SQL},{A.bars_sql('4 hours')} SELECT symbol, {CANDLE_OUT} FROM bars")
def _(spark, sf_dir):
    return B.roll_up(B.resample(clean(spark, sf_dir), "1h"), "1h", "4h")


@query(
    "bars_to_ticks",
    f"""WITH {HOURLY_SQL}, quotes AS (
      SELECT symbol, bar_time, bar_volume, unnest([0, 1, 2, 3]) AS seq, unnest([bar_open, bar_high, bar_low, bar_close]) AS quote FROM bars)
    SELECT epoch_ms(bar_time) + [0, 20000, 40000, 59000][seq + 1] AS timestamp_utc, round(quote, 6) AS ask, round(quote, 6) AS bid,
      CAST(0 AS DOUBLE) AS ask_volume, CASE WHEN seq = 3 THEN round(bar_volume, 6) ELSE CAST(0 AS DOUBLE) END AS bid_volume,
      symbol, CAST(seq AS BIGINT) AS seq FROM quotes""",
)
def _(spark, sf_dir):
    return B.bars_to_ticks(B.candles_to_bars(B.resample(clean(spark, sf_dir), "1h")))


def _roundtrip(spark, sf_dir, timeframe):
    back = B.bars_to_ticks(B.candles_to_bars(B.resample(clean(spark, sf_dir), "1h")))
    return B.resample(cleaning.clean_ticks(back), timeframe)


@query("bars_same_ms", f"WITH {A.TICKS_SQL},{A.FINE_SQL},{A.clean_sql('fine')},{A.bars_sql('1 minute')} SELECT symbol, {CANDLE_OUT} FROM bars")
def _(spark, sf_dir):
    return B.resample(cleaning.clean_ticks(A.ticks_fine(spark, sf_dir)), "1min")


@query("bars_roundtrip", f"WITH {HOURLY_SQL} SELECT symbol, {CANDLE_OUT} FROM bars")
def _(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "1h")


@query("bars_roundtrip_1d", f"WITH {CLEAN_SQL},{A.bars_sql('1 day')} SELECT symbol, {CANDLE_OUT} FROM bars")
def _(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "1d")


@query(
    "latest_price",
    f"""WITH {CLEAN_SQL} SELECT symbol, epoch_ms(max(timestamp_utc)) AS timestamp_utc,
      round(arg_max(price, row(timestamp_utc, seq)), 6) AS price, 'ticks' AS source FROM clean GROUP BY symbol""",
)
def _(spark, sf_dir):
    return B.latest_price(clean(spark, sf_dir))


# --- indicators -------------------------------------------------------------------------------


@query("true_range", f"WITH RECURSIVE {HOURLY_SQL},{A.atr_sql(14)} SELECT symbol, epoch_ms(bar_time) AS bar_time, rn AS position, round(tr, 6) AS true_range FROM with_atr")
def _(spark, sf_dir):
    return indicators.true_range(hourly(spark, sf_dir)).select("symbol", "bar_time", "position", "true_range")


def _atr_query(name: str, period: int, ctes: str, candles, places: int = 6) -> None:
    sql = f"WITH RECURSIVE {ctes},{A.atr_sql(period)} SELECT symbol, {CANDLE_OUT}, round(atr, {places}) AS atr FROM with_atr"

    def run(spark, sf_dir):
        return indicators.compute_atr(candles(spark, sf_dir), period).withColumn("atr", F.round("atr", places))

    query(name, sql)(run)


def _daily(spark, sf_dir):
    return stored(B.resample(clean(spark, sf_dir), "1d"), "bars-1d")


def _shipments_daily(spark, sf_dir):
    return stored(B.resample(shipments(spark, sf_dir), "1d"), "bars-shipments")


_atr_query("atr_14", 14, HOURLY_SQL, hourly)
_atr_query("atr_1", 1, HOURLY_SQL, hourly)
_atr_query("atr_3", 3, HOURLY_SQL, hourly)
_atr_query("atr_short_series", 40, CLEAN_SQL + "," + A.bars_sql("1 day"), _daily)
_atr_query("atr_shipments", 21, SHIPMENTS_SQL + "," + A.bars_sql("1 day"), _shipments_daily, places=4)  # values near 10^5: ten digits agree

# Every fifth hour has volume only.
HOLLOW_SQL = f"""{HOURLY_SQL},
hollow AS (SELECT symbol, bar_time, CASE WHEN hour(bar_time) % 5 <> 0 THEN bar_open END AS bar_open, CASE WHEN hour(bar_time) % 5 <> 0 THEN bar_high END AS bar_high,
  CASE WHEN hour(bar_time) % 5 <> 0 THEN bar_low END AS bar_low, CASE WHEN hour(bar_time) % 5 <> 0 THEN bar_close END AS bar_close, bar_volume FROM bars),
priced AS (SELECT * FROM hollow WHERE bar_close IS NOT NULL)"""


def hollow(candles: DataFrame) -> DataFrame:
    return candles.withColumns({c: F.when(F.hour("bar_time") % 5 != 0, F.col(c)) for c in ("bar_open", "bar_high", "bar_low", "bar_close")})


@query(
    "atr_missing_prices",
    f"WITH RECURSIVE {HOLLOW_SQL},{A.atr_sql(14, 'priced')} SELECT symbol, {CANDLE_OUT}, round(a.atr, 6) AS atr "
    "FROM hollow h LEFT JOIN (SELECT symbol, bar_time, atr FROM with_atr) a USING (symbol, bar_time)",
)
def _(spark, sf_dir):
    return indicators.compute_atr(stored(hollow(hourly(spark, sf_dir)), "hollow"), 14)


CHANGE_SQL = """, newest AS (SELECT symbol, bar_time, bar_close, row_number() OVER w AS nth, lead(bar_close) OVER w AS prev
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY bar_time DESC))
SELECT symbol, epoch_ms(bar_time) AS bar_time, round(bar_close, 6) AS last_close, round(bar_close - prev, 6) AS abs,
  round(CASE WHEN prev <> 0 THEN (bar_close - prev) / prev * 100 ELSE 0 END, 6) AS pct, bar_close - prev >= 0 AS up
FROM newest WHERE nth = 1"""


@query("price_change", f"WITH {HOURLY_SQL}{CHANGE_SQL}")
def _(spark, sf_dir):
    return indicators.price_change(B.resample(clean(spark, sf_dir), "1h"))


# --- gaps and the trading week ----------------------------------------------------------------


def _gap_query(name: str, freq: str, step: int) -> None:
    sql = f"WITH {A.TICKS_SQL},{A.gaps_sql(step, 'ticks', 'timestamp_utc')} SELECT {GAP_OUT} FROM gaps"
    query(name, sql)(lambda spark, sf_dir: gaps.detect_gaps(A.ticks(spark, sf_dir), freq))


_gap_query("gaps_1min", "1min", 60)
_gap_query("gaps_7min", "7min", 420)
_gap_query("gaps_1h", "1h", 3600)
_gap_query("gaps_5h", "5h", 18000)


@query(
    "gaps_shipments_1h",
    f"WITH {A.SHIPMENTS_SQL},{A.gaps_sql(3600, 'ticks_shipments', 'timestamp_utc')} SELECT {GAP_OUT} FROM gaps",
)
def _(spark, sf_dir):
    return gaps.detect_gaps(A.ticks_shipments(spark, sf_dir), "1h")


@query(
    "gaps_shipments_5h",
    f"WITH {A.SHIPMENTS_SQL},{A.gaps_sql(18000, 'ticks_shipments', 'timestamp_utc')} SELECT {GAP_OUT} FROM gaps",
)
def _(spark, sf_dir):
    return gaps.detect_gaps(A.ticks_shipments(spark, sf_dir), "5h")


_NEAR = "least(abs({m} - {t}), 1440 - abs({m} - {t})) <= 15"
_MINUTE = "(hour({c}) * 60 + minute({c}))"
_START, _END = _MINUTE.format(c="gap_start"), _MINUTE.format(c="gap_end")
EXPECTED_SQL = f"""((isodow(gap_start) = 5 AND {_NEAR.format(m=_START, t=1320)} AND isodow(gap_end) >= 6)
  OR (CAST(gap_start AS DATE) = CAST(gap_end AS DATE) AND {_NEAR.format(m=_START, t=1320)} AND {_NEAR.format(m=_END, t=1380)}))"""


@query(
    "gaps_classified",
    f"WITH {CLEAN_SQL},{A.bars_sql('5 minutes')},{A.gaps_sql(300, 'bars', 'bar_time')} SELECT {GAP_OUT}, {EXPECTED_SQL} AS expected FROM gaps",
)
def _(spark, sf_dir):
    return gaps.classify_gaps(gaps.detect_gaps(B.resample(clean(spark, sf_dir), "5min"), "5min", "bar_time"))


def _coverage_query(name: str, freq: str, step: int) -> None:
    sql = f"""WITH {A.TICKS_SQL},{A.gaps_sql(step, 'ticks', 'timestamp_utc')},
    p AS (SELECT symbol, count(*) AS present FROM gaps_present GROUP BY symbol),
    e AS (SELECT symbol, count(*) AS expected FROM gaps_expected GROUP BY symbol),
    m AS (SELECT symbol, count(*) AS missing FROM gaps_missing GROUP BY symbol),
    g AS (SELECT symbol, count(*) AS gaps FROM gaps GROUP BY symbol)
    SELECT symbol, present, expected, coalesce(missing, 0) AS missing, coalesce(gaps, 0) AS gaps,
      round(coalesce(missing, 0) * {step} / 60.0, 6) AS gap_minutes
    FROM p JOIN e USING (symbol) LEFT JOIN m USING (symbol) LEFT JOIN g USING (symbol)"""
    query(name, sql)(lambda spark, sf_dir: gaps.coverage(A.ticks(spark, sf_dir), freq))


_coverage_query("coverage", "5min", 300)
_coverage_query("coverage_10s", "10s", 10)
_coverage_query("coverage_1s", "1s", 1)


def _merged_coverage_query(name: str, freq: str, step: int):
    """Three deliveries that overlap, the second one twice, against one scan of everything."""
    sql = f"""WITH {A.TICKS_SQL},{A.gaps_sql(step, 'ticks', 'timestamp_utc')},
      p AS (SELECT symbol, count(*) AS present FROM gaps_present GROUP BY 1), e AS (SELECT symbol, count(*) AS expected FROM gaps_expected GROUP BY 1),
      m AS (SELECT symbol, count(*) AS missing FROM gaps_missing GROUP BY 1)
      SELECT p.symbol, present, expected, coalesce(missing, 0) AS missing, coalesce(missing, 0) * {step} / 60.0 AS gap_minutes
      FROM p JOIN e USING (symbol) LEFT JOIN m USING (symbol)"""

    @query(name, sql)
    def _(spark, sf_dir):
        ticks, path = A.ticks(spark, sf_dir), scratch_path(spark, "coverage")
        parts = ["timestamp_utc >= '2024-01-18'", "timestamp_utc >= '2024-01-08' AND timestamp_utc < '2024-01-22'", "timestamp_utc < '2024-01-10'"]
        for part in [parts[0], parts[1], parts[2], parts[1]]:
            merging.add_coverage(spark, ticks.where(part), path, freq)
        return merging.read_coverage(spark, path, freq)


_merged_coverage_query("coverage_merged", "1min", 60)
_merged_coverage_query("coverage_merged_7min", "7min", 420)


OPEN_SQL = """(isodow(ts) <> 6 AND NOT (isodow(ts) = 5 AND hour(ts) >= 22) AND NOT (isodow(ts) = 7 AND hour(ts) < 22))"""


@query(
    "market_open",
    f"""SELECT event_id, isodow(ts) - 1 AS weekday, hour(ts) * 60 + minute(ts) AS minute, {OPEN_SQL} AS open,
      CASE WHEN {OPEN_SQL} THEN 'Live' ELSE 'Markets closed' END AS label,
      CASE WHEN {OPEN_SQL} THEN '' ELSE 'XAUUSD reopens Sunday 22:00 UTC' END AS detail FROM events""",
)
def _(spark, sf_dir):
    now = F.col("ts").cast("timestamp")
    rows = A.table(spark, sf_dir, "events").select(
        "event_id", S.weekday(now).alias("weekday"), S.minute_of_day(now).alias("minute"), S.market_status(now).alias("s")
    )
    return rows.select("event_id", "weekday", "minute", "s.open", "s.label", "s.detail")


@query(
    "health_level",
    f"""SELECT event_id, minutes, CASE WHEN NOT {OPEN_SQL} THEN 'closed' WHEN minutes IS NULL THEN 'unknown' WHEN minutes < 20 THEN 'healthy'
      WHEN minutes <= 60 THEN 'delayed' ELSE 'stale' END AS level
    FROM (SELECT *, CASE WHEN user_id % 13 <> 0 THEN CAST(event_id % 85 AS DOUBLE) END AS minutes FROM events)""",
)
def _(spark, sf_dir):
    now = F.unix_millis(F.col("ts").cast("timestamp"))
    last = F.when(F.col("user_id") % 13 != 0, now - F.col("event_id") % 85 * 60000)
    minutes = C.minutes_since(last, now)
    level = S.health_level(minutes, S.market_open(F.col("ts").cast("timestamp")))
    return A.table(spark, sf_dir, "events").select("event_id", minutes.alias("minutes"), level.alias("level"))


@query(
    "minutes_since",
    """SELECT event_id, round(greatest(0.0, shift / 60000.0), 6) AS minutes, floor(shift / 60000.0 * 10 + 0.5) / 10 AS tenths,
      strftime(make_timestamp((epoch_ms(ts) - shift) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso
    FROM (SELECT *, (event_id % 9 - 3) * 15000 + user_id AS shift FROM (SELECT event_id, user_id, date_trunc('millisecond', ts) AS ts FROM events))""",
)
def _(spark, sf_dir):
    now = F.unix_millis(F.col("ts").cast("timestamp"))
    last = now - ((F.col("event_id") % 9 - 3) * 15000 + F.col("user_id"))
    return A.table(spark, sf_dir, "events").select(
        "event_id",
        C.minutes_since(last, now).alias("minutes"),
        C.minutes_since_tenths(last, now).alias("tenths"),
        C.iso_utc(last).alias("iso"),
    )


# --- ledger -----------------------------------------------------------------------------------

FIRST_WRITE, SECOND_WRITE = 1_706_000_000_000, 1_707_000_000_000
LEDGER_COLUMNS = "symbol, timeframe, bar_time, bar_open, bar_high, bar_low, bar_close, bar_volume, atr, ingested_at, last_updated_at"

# Two overlapping deliveries: clean ticks up to the 20th, redelivered ticks from the 11th.
LEDGER_SQL = f"""{A.DIRTY_SQL},{A.clean_sql('ticks_dirty')},
first_ticks AS (SELECT *, (bid + ask) / 2 AS price FROM ticks WHERE timestamp_utc < TIMESTAMP '2024-01-21'),
second_ticks AS (SELECT * FROM clean WHERE timestamp_utc >= TIMESTAMP '2024-01-11'),
{A.bars_sql('1 hour', 'first_ticks', 'first_bars')},{A.bars_sql('1 hour', 'second_ticks', 'second_bars')},
{A.atr_sql(14, 'first_bars', 'old')},{A.atr_sql(14, 'second_bars', 'new')},
merged AS (
  SELECT coalesce(n.symbol, o.symbol) AS symbol, '1h' AS timeframe, coalesce(n.bar_time, o.bar_time) AS bar_time,
    coalesce(n.bar_open, o.bar_open) AS bar_open, coalesce(n.bar_high, o.bar_high) AS bar_high, coalesce(n.bar_low, o.bar_low) AS bar_low,
    coalesce(n.bar_close, o.bar_close) AS bar_close, coalesce(n.bar_volume, o.bar_volume) AS bar_volume, coalesce(n.atr, o.atr) AS atr,
    CAST(CASE WHEN o.symbol IS NULL THEN {SECOND_WRITE} ELSE {FIRST_WRITE} END AS BIGINT) AS ingested_at,
    CAST(CASE WHEN n.symbol IS NULL THEN {FIRST_WRITE} ELSE {SECOND_WRITE} END AS BIGINT) AS last_updated_at
  FROM new n FULL OUTER JOIN old o ON n.symbol = o.symbol AND n.bar_time = o.bar_time)"""


def _deliveries(spark, sf_dir):
    early = cleaning.derive_price(A.ticks(spark, sf_dir)).where(F.col("timestamp_utc") < F.lit("2024-01-21").cast("timestamp"))
    late = clean(spark, sf_dir).where(F.col("timestamp_utc") >= F.lit("2024-01-11").cast("timestamp"))
    for ticks in (early, late):
        candles = indicators.compute_atr(stored(B.resample(ticks, "1h"), "delivery"), 14)
        yield stored(ledger.ledger_rows(candles, "1h"), "delivery-rows")


def _ledger_path(spark, sf_dir):
    path = scratch_path(spark, "ledger")
    for rows, now_ms in zip(_deliveries(spark, sf_dir), (FIRST_WRITE, SECOND_WRITE)):
        ledger.upsert_candles(spark, path, rows, now_ms)
    return path


def _ledger(spark, sf_dir):
    return ledger.read_ledger(spark, _ledger_path(spark, sf_dir))


@query("ledger_upsert", f"WITH RECURSIVE {LEDGER_SQL} SELECT symbol, timeframe, {CANDLE_OUT}, round(atr, 6) AS atr, ingested_at, last_updated_at FROM merged")
def _(spark, sf_dir):
    return _ledger(spark, sf_dir).select(*[c.strip() for c in LEDGER_COLUMNS.split(",")])


@query(
    "ledger_changes",
    f"""WITH RECURSIVE {LEDGER_SQL} SELECT CASE WHEN last_updated_at = {FIRST_WRITE} THEN 'kept' WHEN ingested_at = {SECOND_WRITE}
      THEN 'inserted' ELSE 'updated' END AS change, count(*) AS candles FROM merged GROUP BY 1""",
)
def _(spark, sf_dir):
    old, new = _deliveries(spark, sf_dir)
    current = ledger.merge_candles(spark.createDataFrame([], ledger.LEDGER), old, FIRST_WRITE).drop("change")
    return ledger.merge_candles(current, new, SECOND_WRITE).groupBy("change").agg(F.count("*").alias("candles"))


def _lose_driver(rows: DataFrame, path: str) -> None:
    """What a writer leaves that is lost before its commit: rows of a version, and half a manifest."""
    version = "0000000009-lost"
    table = ledger.ledger_table(path)
    lost = rows.withColumn("bar_month", ledger.bar_month(F.col("bar_time"))).limit(5)
    lost = lost.withColumns({"version": F.lit(version), "ingested_at": F.lit(0), "last_updated_at": F.lit(0)})
    lost.write.mode("append").partitionBy("version", *table.partitions).parquet(path)
    half = lost.select(*table.partitions, "version", F.lit(False).alias("added")).distinct()
    half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/_manifests/{version}")


@query("ledger_after_crash", f"WITH RECURSIVE {LEDGER_SQL} SELECT symbol, timeframe, {CANDLE_OUT}, round(atr, 6) AS atr, ingested_at, last_updated_at FROM merged")
def _(spark, sf_dir):
    path = scratch_path(spark, "ledger")
    old, new = _deliveries(spark, sf_dir)
    ledger.upsert_candles(spark, path, old, FIRST_WRITE)
    _lose_driver(new, path)
    ledger.upsert_candles(spark, path, new, SECOND_WRITE)
    return ledger.read_ledger(spark, path).select(*[c.strip() for c in LEDGER_COLUMNS.split(",")])


HEALTH_NOW = SECOND_WRITE + 1_234_567


@query(
    "ledger_health",
    f"""WITH RECURSIVE {LEDGER_SQL} SELECT 'ok' AS status, count(*) AS row_count, max(ingested_at) AS last_ingested_at,
      strftime(make_timestamp(max(ingested_at) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS last_ingested_at_iso,
      floor(({HEALTH_NOW} - max(ingested_at)) / 60000.0 * 10 + 0.5) / 10 AS minutes_since_last_update FROM merged""",
)
def _(spark, sf_dir):
    return ledger.ledger_health(_ledger(spark, sf_dir), HEALTH_NOW)


PAGE_OUT = CANDLE_OUT + ", round(atr, 6) AS atr"


@query(
    "latest_candles",
    f"WITH RECURSIVE {LEDGER_SQL} SELECT {PAGE_OUT} FROM merged WHERE symbol = 'CLICK' AND timeframe = '1h' ORDER BY merged.bar_time DESC LIMIT 200",
)
def _(spark, sf_dir):
    return ledger.latest_candles(_ledger(spark, sf_dir), "click", "1h")


@query(
    "latest_per_symbol",
    f"""WITH RECURSIVE {LEDGER_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol, timeframe ORDER BY bar_time DESC) AS nth FROM merged)
    SELECT symbol, timeframe, {PAGE_OUT} FROM ranked WHERE nth <= 50""",
)
def _(spark, sf_dir):
    return ledger.latest_per_series(_ledger(spark, sf_dir), 50)


@query(
    "candle_points",
    f"""WITH RECURSIVE {LEDGER_SQL} SELECT symbol, timeframe, epoch_ms(bar_time) // 1000 AS time, round(bar_open, 6) AS open,
      round(bar_high, 6) AS high, round(bar_low, 6) AS low, round(bar_close, 6) AS close FROM merged""",
)
def _(spark, sf_dir):
    return ledger.candle_points(_ledger(spark, sf_dir))


@query(
    "atr_points",
    f"""WITH RECURSIVE {LEDGER_SQL} SELECT symbol, timeframe, epoch_ms(bar_time) // 1000 AS time, round(atr, 6) AS value
    FROM merged WHERE atr IS NOT NULL""",
)
def _(spark, sf_dir):
    return ledger.atr_points(_ledger(spark, sf_dir))


# --- landing and storage ----------------------------------------------------------------------

TICK_OUT_DECODED = (
    "epoch_ms(timestamp_utc) AS timestamp_utc, round(ask, 6) AS ask, round(bid, 6) AS bid, ask_volume, bid_volume, symbol, seq"
)


@query(
    "bi5_ingest",
    f"""WITH {A.TICKS_SQL}, named AS (
      SELECT timestamp_utc, ask, bid, ask_volume * 0.5 * 1000000 AS ask_volume, bid_volume * 0.25 * 1000000 AS bid_volume,
        CASE symbol WHEN 'CLICK' THEN 'XAUUSD' WHEN 'ERROR' THEN 'USDJPY' ELSE symbol END AS symbol, seq AS id FROM ticks),
    scaled AS (SELECT *, CASE WHEN symbol IN ('XAUUSD', 'USDJPY') THEN 1000.0 ELSE 100000.0 END AS divisor FROM named),
    decoded AS (SELECT timestamp_utc, round(ask * divisor) / divisor AS ask, round(bid * divisor) / divisor AS bid, ask_volume, bid_volume, symbol,
      row_number() OVER (PARTITION BY symbol, date_trunc('hour', timestamp_utc), id // {landing.FILE_ROWS} ORDER BY timestamp_utc, id) - 1 AS seq
      FROM scaled)
    SELECT {TICK_OUT_DECODED} FROM decoded""",
)
def _(spark, sf_dir):
    return tickfiles.decode_ticks(landing.tick_files(A.ticks(spark, sf_dir)))


@query("bi5_files", ORACLES["bi5_ingest"])
def _(spark, sf_dir):
    """The same, from files on disk."""
    folder = scratch_path(spark, "landing")
    landing.write_files(landing.tick_files(A.ticks(spark, sf_dir)), folder)
    return tickfiles.decode_ticks(tickfiles.read_tick_files(spark, folder))


@query(
    "bi5_rejected",
    f"""WITH {A.TICKS_SQL} SELECT DISTINCT CASE symbol WHEN 'CLICK' THEN 'XAUUSD' WHEN 'ERROR' THEN 'USDJPY' ELSE symbol END AS symbol,
      strftime(timestamp_utc, '%Y-%m-%d %H') AS hour, seq // {landing.FILE_ROWS} AS chunk,
      CASE WHEN hour(timestamp_utc) % 3 = 0 THEN 'does not decode' ELSE '2 bytes after the last record' END AS problem FROM ticks""",
)
def _(spark, sf_dir):
    """Every file ends in two stray bytes; every third hour is cut short."""
    files = landing.tick_files(A.ticks(spark, sf_dir))
    cut = F.hour(tickfiles.hour_of_path(F.col("path"))) % 3 == 0
    files = files.withColumn("content", F.when(cut, F.col("content").substr(F.lit(1), F.octet_length("content") - 9)).otherwise(F.col("content")))
    at = tickfiles.hour_of_path(F.col("path"))
    return tickfiles.rejected_files(files).select(
        tickfiles.symbol_of_path(F.col("path")).alias("symbol"), F.date_format(at, "yyyy-MM-dd HH").alias("hour"),
        F.regexp_extract("path", r"landing/(\d+)/", 1).cast("long").alias("chunk"),
        F.substring_index("problem", ":", 1).alias("problem"),
    )


DAYS_SQL = """ranges AS (SELECT symbol, CAST(min(timestamp_utc) AS DATE) AS start_date, CAST(max(timestamp_utc) AS DATE) AS end_date FROM ticks GROUP BY symbol)"""


def ranges(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("symbol").agg(
        F.to_date(F.min("timestamp_utc")).alias("start_date"), F.to_date(F.max("timestamp_utc")).alias("end_date")
    )


@query(
    "calendar_days",
    f"""WITH {A.TICKS_SQL}, {DAYS_SQL}, days AS (SELECT symbol, unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS d FROM ranges)
    SELECT symbol, strftime(d, '%Y-%m-%d') AS day FROM days""",
)
def _(spark, sf_dir):
    days = bronze.calendar_days(ranges(A.ticks(spark, sf_dir)))
    return days.select("symbol", F.date_format("day", "yyyy-MM-dd").alias("day"))


MANIFEST_SQL = f"""{A.TICKS_SQL}, {DAYS_SQL},
planned AS (SELECT symbol, unnest(generate_series(CAST(start_date AS TIMESTAMP), end_date + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS hour FROM ranges),
landed AS (SELECT DISTINCT symbol, date_trunc('hour', timestamp_utc) AS hour FROM ticks WHERE timestamp_utc < TIMESTAMP '2024-01-10'),
fresh AS (SELECT symbol, date_trunc('hour', timestamp_utc) AS hour, count(*) AS ticks FROM ticks GROUP BY 1, 2),
manifest AS (SELECT p.symbol, p.hour, CASE WHEN l.symbol IS NOT NULL THEN 'resumed' WHEN f.symbol IS NOT NULL THEN 'written' ELSE 'skipped' END AS status,
  CASE WHEN l.symbol IS NULL THEN coalesce(f.ticks, 0) ELSE 0 END AS ticks
  FROM planned p LEFT JOIN landed l ON p.symbol = l.symbol AND p.hour = l.hour LEFT JOIN fresh f ON p.symbol = f.symbol AND p.hour = f.hour
  WHERE isodow(p.hour) <= 5)"""


def _manifest(spark, sf_dir):
    ticks = A.ticks(spark, sf_dir)
    before = bronze.landed_hours(ticks.where(F.col("timestamp_utc") < F.lit("2024-01-10").cast("timestamp")))
    return bronze.hour_manifest(ranges(ticks), before, ticks)


@query("hour_manifest", f"WITH {MANIFEST_SQL} SELECT symbol, epoch_ms(hour) AS hour, status, ticks FROM manifest")
def _(spark, sf_dir):
    return _manifest(spark, sf_dir)


@query(
    "download_summary",
    f"""WITH {MANIFEST_SQL} SELECT symbol, CAST(sum(ticks) AS BIGINT) AS ticks_saved, count(*) FILTER (status = 'written') AS files_written,
      count(*) FILTER (status = 'skipped') AS hours_skipped, count(*) FILTER (status = 'resumed') AS hours_resumed FROM manifest GROUP BY symbol""",
)
def _(spark, sf_dir):
    return bronze.download_summary(_manifest(spark, sf_dir))


@query(
    "hours_to_fetch",
    f"WITH {MANIFEST_SQL} SELECT symbol, epoch_ms(hour) AS hour FROM manifest WHERE status <> 'resumed'",
)
def _(spark, sf_dir):
    ticks = A.ticks(spark, sf_dir)
    before = bronze.landed_hours(ticks.where(F.col("timestamp_utc") < F.lit("2024-01-10").cast("timestamp")))
    return bronze.hours_to_fetch(ranges(ticks), before)


KEPT_ROWS_SQL = f"""{A.DIRTY_SQL}, kept AS (SELECT timestamp_utc, ask, bid, ask_volume, bid_volume, symbol, min(seq) AS seq
  FROM ticks_dirty GROUP BY ALL)"""


@query("hourly_landing", f"WITH {A.DIRTY_SQL} SELECT {TICK_OUT}, epoch_ms(date_trunc('hour', timestamp_utc)) AS hour FROM ticks_dirty")
def _(spark, sf_dir):
    path = scratch_path(spark, "landed")
    bronze.land_hours(A.ticks_dirty(spark, sf_dir), path)
    return bronze.read_landed(spark, path).drop("date")


@query("compaction", f"WITH {KEPT_ROWS_SQL} SELECT {TICK_OUT} FROM kept")
def _(spark, sf_dir):
    path = scratch_path(spark, "months")
    bronze.compact_months(A.ticks_dirty(spark, sf_dir), path)
    return bronze.read_months(spark, path)


def _archive(spark, sf_dir, times: int = 1) -> str:
    """An archive in two deliveries that meet within a day, the second delivered *times* times."""
    path = scratch_path(spark, "archive")
    ticks = stored(A.ticks_dirty(spark, sf_dir), "ticks")
    noon = F.lit("2024-01-15T12:00:00Z").cast("timestamp")
    bronze.archive_days(ticks.where(F.col("timestamp_utc") < noon), path)
    for _ in range(times):
        bronze.merge_into_archive(spark, ticks.where(F.col("timestamp_utc") >= noon), path)
    return path


@query("archive_roundtrip", f"WITH {KEPT_ROWS_SQL} SELECT {TICK_OUT} FROM kept")
def _(spark, sf_dir):
    return bronze.read_archive(spark, _archive(spark, sf_dir))


@query("archive_range", f"WITH {KEPT_ROWS_SQL} SELECT {TICK_OUT} FROM kept WHERE timestamp_utc >= TIMESTAMP '2024-01-08'")
def _(spark, sf_dir):
    return bronze.read_archive(spark, _archive(spark, sf_dir), "2024-01-08", "2024-12-31")


@query("archive_replay", f"WITH {KEPT_ROWS_SQL} SELECT {TICK_OUT} FROM kept")
def _(spark, sf_dir):
    return bronze.read_archive(spark, _archive(spark, sf_dir, times=2))


@query("archive_days", f"WITH {KEPT_ROWS_SQL} SELECT DISTINCT symbol, CAST(CAST(timestamp_utc AS DATE) AS VARCHAR) AS day FROM kept")
def _(spark, sf_dir):
    return bronze.archived_days(spark, _archive(spark, sf_dir)).select("symbol", F.col("day").cast("string").alias("day"))


SOURCE_OUT = TICK_OUT.removesuffix(", seq")


@query("hour_files_range", f"WITH {A.DIRTY_SQL} SELECT DISTINCT {SOURCE_OUT} FROM ticks_dirty WHERE timestamp_utc >= TIMESTAMP '2024-01-05' AND timestamp_utc < TIMESTAMP '2024-01-26'")
def _(spark, sf_dir):
    """Hour files on disk, read for a range of days and a list of symbols."""
    folder = scratch_path(spark, "hours")
    landing.write_hour_files(A.ticks_dirty(spark, sf_dir), folder)
    names = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
    return bronze.read_hour_files(spark, folder, names, "2024-01-05", "2024-01-25")


@query("hour_files_whole", f"WITH {A.DIRTY_SQL} SELECT DISTINCT {SOURCE_OUT} FROM ticks_dirty")
def _(spark, sf_dir):
    """Hour files on disk, all symbols and days there are in one scan."""
    folder = scratch_path(spark, "hours")
    ticks = A.ticks_dirty(spark, sf_dir)
    landing.write_hour_files(ticks, folder)
    day = F.to_date("timestamp_utc").cast("string")
    ends = ticks.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    return bronze.read_hour_files(spark, folder, None, ends["first"], ends["last"])


@query("bars_of_path", f"WITH {HOURLY_SQL} SELECT symbol, {CANDLE_OUT} FROM bars")
def _(spark, sf_dir):
    """Candles of a table given by its path."""
    path = scratch_path(spark, "clean")
    clean(spark, sf_dir).write.parquet(path)
    return B.resample(path, "1h")


@query("known_times", f"WITH {A.TICKS_SQL} SELECT {TICK_OUT} FROM ticks WHERE seq % 4 <> 0")
def _(spark, sf_dir):
    """Ticks of which every fourth has lost its time."""
    lost = A.ticks(spark, sf_dir).withColumn("timestamp_utc", F.when(F.col("seq") % 4 != 0, F.col("timestamp_utc")))
    return cleaning.with_known_time(lost, "timestamp_utc")


@query("time_order", f"WITH {A.DIRTY_SQL} SELECT {TICK_OUT} FROM (SELECT DISTINCT * FROM ticks_dirty) ORDER BY symbol, timestamp_utc, seq")
def _(spark, sf_dir):
    """All ticks by series and time."""
    return cleaning.in_time_order(A.ticks_dirty(spark, sf_dir).distinct())


@query("time_places", f"WITH {A.DIRTY_SQL} SELECT {TICK_OUT}, row_number() OVER (ORDER BY symbol, timestamp_utc, seq) AS place FROM (SELECT DISTINCT * FROM ticks_dirty)")
def _(spark, sf_dir):
    """All ticks by series and time, with their place."""
    return cleaning.with_places(A.ticks_dirty(spark, sf_dir).distinct())


# --- the bar feed -----------------------------------------------------------------------------


@query(
    "bars_json",
    f"""WITH {CLEAN_SQL},{A.bars_sql('1 hour')} SELECT symbol, epoch_ms(bar_time) AS timestamp_utc, round(bar_open, 6) AS open, round(bar_high, 6) AS high,
      round(bar_low, 6) AS low, round(bar_close, 6) AS close, CASE WHEN day(bar_time) % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE round(bar_volume, 6) END AS volume
    FROM bars""",
)
def _(spark, sf_dir):
    return barfeed.feed_bars(landing.documents(hourly(spark, sf_dir))).drop("delivered_at")


@query(
    "bars_json_rejected",
    f"""WITH {CLEAN_SQL}, docs AS (SELECT DISTINCT symbol, CAST(timestamp_utc AS DATE) AS d FROM clean),
    bad AS (SELECT symbol, day(d) % 4 AS kind FROM docs)
    SELECT symbol, CASE kind WHEN 0 THEN 'feed error: out of credits' WHEN 1 THEN 'no values' WHEN 2 THEN 'a value is not a number or a time'
      ELSE 'not a JSON object' END AS problem, count(*) AS documents FROM bad GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    bad = barfeed.rejected_documents(landing.documents(hourly(spark, sf_dir)))
    return bad.groupBy("symbol", "problem").agg(F.count("*").alias("documents"))


LIVE_SQL = f"""{CLEAN_SQL},{A.bars_sql('1 hour')},
fed AS (SELECT * EXCLUDE (bar_volume), CASE WHEN day(bar_time) % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE bar_volume END AS bar_volume FROM bars),
wide AS (SELECT symbol, time_bucket(INTERVAL '4 hours', bar_time) AS b, arg_min(bar_open, bar_time) AS bar_open, max(bar_high) AS bar_high,
  min(bar_low) AS bar_low, arg_max(bar_close, bar_time) AS bar_close, sum(bar_volume) AS bar_volume, min(bar_time) AS first_bar FROM fed GROUP BY 1, 2),
first_run AS (SELECT * EXCLUDE (b, first_bar), b AS bar_time FROM wide WHERE b < TIMESTAMP '2024-01-21'
  AND b >= (SELECT min(bar_time) FROM fed f WHERE f.symbol = wide.symbol)),
second_run AS (SELECT * EXCLUDE (b, first_bar), b AS bar_time FROM wide WHERE b >= TIMESTAMP '2024-01-16'
  AND b >= (SELECT min(bar_time) FROM fed f WHERE f.symbol = wide.symbol AND f.bar_time >= TIMESTAMP '2024-01-16')),
{A.atr_sql(14, 'first_run', 'old')},{A.atr_sql(14, 'second_run', 'new')},
merged AS (
  SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.bar_time, o.bar_time) AS bar_time,
    coalesce(n.bar_open, o.bar_open) AS bar_open, coalesce(n.bar_high, o.bar_high) AS bar_high, coalesce(n.bar_low, o.bar_low) AS bar_low,
    coalesce(n.bar_close, o.bar_close) AS bar_close, coalesce(n.bar_volume, o.bar_volume) AS bar_volume, coalesce(n.atr, o.atr) AS atr
  FROM new n FULL OUTER JOIN old o ON n.symbol = o.symbol AND n.bar_time = o.bar_time)"""


@query("live_ledger", f"WITH RECURSIVE {LIVE_SQL} SELECT symbol, '4h' AS timeframe, {PAGE_OUT} FROM merged")
def _(spark, sf_dir):
    path = scratch_path(spark, "live-ledger")
    bars = hourly(spark, sf_dir)
    until, since = F.lit("2024-01-21").cast("timestamp"), F.lit("2024-01-16").cast("timestamp")
    for window, now_ms in ((F.col("bar_time") < until, FIRST_WRITE), (F.col("bar_time") >= since, SECOND_WRITE)):
        docs = landing.documents(bars.where(window))
        live.apply_documents(spark, docs, path, "1h", "4h", 14, now_ms)
    return ledger.read_ledger(spark, path).select("symbol", "timeframe", *ledger.CANDLE_PAGE)


# However bars are cut into deliveries: candles of all bars, the first one only if whole, and one ATR over all of them.
WHOLE_LIVE_SQL = f"""{CLEAN_SQL},{A.bars_sql('1 hour')},
fed AS (SELECT * EXCLUDE (bar_volume), CASE WHEN day(bar_time) % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE bar_volume END AS bar_volume FROM bars),
wide AS (SELECT symbol, time_bucket(INTERVAL '4 hours', bar_time) AS bar_time, arg_min(bar_open, bar_time) AS bar_open, max(bar_high) AS bar_high,
  min(bar_low) AS bar_low, arg_max(bar_close, bar_time) AS bar_close, sum(bar_volume) AS bar_volume FROM fed GROUP BY 1, 2),
kept AS (SELECT * FROM wide WHERE bar_time >= (SELECT min(bar_time) FROM fed f WHERE f.symbol = wide.symbol)),
{A.atr_sql(14, 'kept')}"""


def _live_deliveries(spark, sf_dir, *windows) -> DataFrame:
    """The ledger after bars came in the given windows (SQL conditions on ``bar_time``), one after the other."""
    path, bars = scratch_path(spark, "live-ledger"), stored(hourly(spark, sf_dir), "hourly")
    for i, window in enumerate(windows):
        docs = landing.documents(bars.where(window))
        live.apply_documents(spark, docs, path, "1h", "4h", 14, FIRST_WRITE + i, continued=True)
    return ledger.read_ledger(spark, path).select("symbol", "timeframe", *ledger.CANDLE_PAGE)


@query("live_ledger_continued", f"WITH RECURSIVE {WHOLE_LIVE_SQL} SELECT symbol, '4h' AS timeframe, {PAGE_OUT} FROM with_atr")
def _(spark, sf_dir):
    """Overlapping deliveries; the second goes on with the first one's ATR, and the first comes again at the end."""
    first, second = "bar_time < '2024-01-21'", "bar_time >= '2024-01-16'"
    return _live_deliveries(spark, sf_dir, first, second, first)


@query("live_ledger_cut_buckets", f"WITH RECURSIVE {WHOLE_LIVE_SQL} SELECT symbol, '4h' AS timeframe, {PAGE_OUT} FROM with_atr")
def _(spark, sf_dir):
    """Deliveries that do not overlap and end within a bucket, the last two in the wrong order."""
    edges = ["2024-01-08 02:00", "2024-01-15 21:00", "2024-01-22 07:00"]
    low = [f"bar_time >= '{e}'" for e in edges]
    high = [f"bar_time < '{e}'" for e in edges]
    return _live_deliveries(spark, sf_dir, high[0], f"{low[0]} AND {high[1]}", low[2], f"{low[1]} AND {high[2]}")


CORRECTED_SQL = f"""{CLEAN_SQL},{A.bars_sql('1 hour')},
corrected AS (SELECT * REPLACE (CASE WHEN dayofmonth(bar_time) IN (3, 17) AND hour(bar_time) = 9 THEN bar_high + 100 ELSE bar_high END AS bar_high)
  FROM bars),
{A.atr_sql(14, 'corrected')}"""


@query("atr_after_correction", f"WITH RECURSIVE {CORRECTED_SQL} SELECT symbol, '1h' AS timeframe, {PAGE_OUT} FROM with_atr")
def _(spark, sf_dir):
    """Candles missing at first and candles corrected later; ATR is brought up to date from the month of the change on."""
    path = scratch_path(spark, "corrected-ledger")
    rows = stored(ledger.ledger_rows(hourly(spark, sf_dir), "1h"), "ledger-rows")
    at = F.timestamp_millis("bar_time")
    late = (F.dayofmonth(at) == 10) & (F.hour(at) == 5)
    wrong = F.dayofmonth(at).isin(3, 17) & (F.hour(at) == 9)
    right = rows.where(wrong).withColumn("bar_high", F.col("bar_high") + 100)
    for i, part in enumerate([rows.where(~late), rows.where(late), stored(right, "corrections")]):
        ledger.upsert_candles(spark, path, part, FIRST_WRITE + i)
        carry.refresh_atr(spark, path, part.select("symbol", "timeframe", "bar_time"), 14, FIRST_WRITE + i)
    return ledger.read_ledger(spark, path).select("symbol", "timeframe", *ledger.CANDLE_PAGE)


@query(
    "atr_correction_over_years",
    f"""WITH RECURSIVE {A.SHIPMENTS_SQL},{A.clean_sql('ticks_shipments')},{A.bars_sql('1 day')},
    corrected AS (SELECT * REPLACE (CASE WHEN month(bar_time) = 2 AND day(bar_time) = 11 AND year(bar_time) IN (1993, 1997) THEN bar_low / 2 ELSE bar_low END AS bar_low)
      FROM bars WHERE day(bar_time) <> 20 OR year(bar_time) <> 1995),
    {A.atr_sql(3, 'corrected')} SELECT symbol, '1d' AS timeframe, {PAGE_OUT} FROM with_atr""",
)
def _(spark, sf_dir):
    """Seven years of daily candles; a change of years ago is carried on only as far as it has weight."""
    path = scratch_path(spark, "corrected-ledger")
    daily = B.resample(cleaning.clean_ticks(A.ticks_shipments(spark, sf_dir)), "1d")
    rows = stored(ledger.ledger_rows(daily.where("day(bar_time) <> 20 OR year(bar_time) <> 1995"), "1d"), "ledger-rows")
    at = F.timestamp_millis("bar_time")
    wrong = (F.month(at) == 2) & (F.dayofmonth(at) == 11) & F.year(at).isin(1993, 1997)
    right = stored(rows.where(wrong).withColumn("bar_low", F.col("bar_low") / 2), "corrections")
    second = F.year(at) == 1994
    for i, part in enumerate([rows.where(~second), rows.where(second), right.where(F.year(at) == 1993), right.where(F.year(at) == 1997)]):
        carry.upsert_with_atr(spark, path, part, 3, FIRST_WRITE + i)
    return ledger.read_ledger(spark, path).select("symbol", "timeframe", *ledger.CANDLE_PAGE)


# --- whole runs -------------------------------------------------------------------------------

REPORT_SQL = """SELECT t.symbol, '{timeframe}' AS timeframe, '{mode}' AS mode, {start} AS start, {stop} AS end, false AS dry_run,
      ticks_ingested, ticks_clean, archive_days, archive_rows, candles_produced, CAST(0 AS BIGINT) AS candles_rejected,
      coalesce(gaps_found, 0) AS gaps_found, coalesce(gaps_expected, 0) AS gaps_expected, coalesce(gaps_real, 0) AS gaps_real,
      candles_produced AS ledger_rows, 'OK' AS reconcile, 'PASS' AS result
    FROM (SELECT symbol, count(*) AS ticks_ingested, {archive} FROM {ticks} GROUP BY symbol) t
    JOIN (SELECT symbol, count(*) AS ticks_clean FROM {clean} GROUP BY symbol) USING (symbol)
    JOIN (SELECT symbol, count(*) AS candles_produced FROM {candles} GROUP BY symbol) USING (symbol)
    LEFT JOIN (SELECT symbol, count(*) AS gaps_found, count_if(expected) AS gaps_expected, count_if(NOT expected) AS gaps_real
      FROM labelled GROUP BY symbol) USING (symbol)"""


@query(
    "run_report",
    f"""WITH {KEPT_ROWS_SQL},{A.clean_sql('kept')},{A.bars_sql('15 minutes')},{A.gaps_sql(900, 'bars', 'bar_time')},
    labelled AS (SELECT *, {EXPECTED_SQL} AS expected FROM gaps)
    {REPORT_SQL.format(timeframe='15min', mode='backfill', start="'2024-01-01'", stop="'2024-01-31'", ticks='kept', clean='clean',
      archive="count(DISTINCT CAST(timestamp_utc AS DATE)) AS archive_days, count(*) AS archive_rows", candles='bars')}""",
)
def _(spark, sf_dir):
    report = backfill(
        spark, A.ticks_dirty(spark, sf_dir), "2024-01-01", "2024-01-31", timeframe="15min", now_ms=FIRST_WRITE,
        archive_path=scratch_path(spark, "run-archive"), ledger_path=scratch_path(spark, "run-ledger"),
    )
    return report.drop("elapsed_s", "stages")


@query(
    "run_report_shared_archive",
    f"""WITH {KEPT_ROWS_SQL.replace('kept AS', 'all_kept AS')}, kept AS (SELECT * FROM all_kept WHERE symbol IN ('CLICK', 'VIEW')),
    {A.clean_sql('kept')},{A.bars_sql('15 minutes')},{A.gaps_sql(900, 'bars', 'bar_time')},
    labelled AS (SELECT *, {EXPECTED_SQL} AS expected FROM gaps)
    {REPORT_SQL.format(timeframe='15min', mode='backfill', start="'2024-01-01'", stop="'2024-01-31'", ticks='kept', clean='clean',
      archive="count(DISTINCT CAST(timestamp_utc AS DATE)) AS archive_days, count(*) AS archive_rows", candles='bars')}""",
)
def _(spark, sf_dir):
    """Two runs on one archive and one ledger; the second, of two symbols in lower case, counts its own data only."""
    paths = {"archive_path": scratch_path(spark, "run-archive"), "ledger_path": scratch_path(spark, "run-ledger")}
    ticks, two = A.ticks_dirty(spark, sf_dir), F.col("symbol").isin("CLICK", "VIEW")
    backfill(spark, ticks.where(~two), "2024-01-01", "2024-01-31", timeframe="15min", now_ms=FIRST_WRITE, **paths)
    own = ticks.where(two).withColumn("symbol", F.lower("symbol"))
    report = backfill(spark, own, "2024-01-01", "2024-01-31", timeframe="15min", now_ms=SECOND_WRITE, **paths)
    return report.drop("elapsed_s", "stages")


@query(
    "live_report",
    f"""WITH {CLEAN_SQL},{A.bars_sql('1 hour')}, four AS (SELECT DISTINCT symbol, time_bucket(INTERVAL '4 hours', bar_time) AS bar_time FROM bars),
    kept AS (SELECT * FROM four WHERE bar_time >= (SELECT min(bar_time) FROM bars b WHERE b.symbol = four.symbol)),
    {A.gaps_sql(14400, 'kept', 'bar_time')}, labelled AS (SELECT *, {EXPECTED_SQL} AS expected FROM gaps),
    prices AS (SELECT symbol, bar_time, unnest([bar_open, bar_high, bar_low, bar_close]) AS price, unnest([0, 1, 2, 3]) AS seq FROM bars)
    {REPORT_SQL.format(timeframe='4h', mode='live', start="(SELECT strftime(min(bar_time), '%Y-%m-%d') FROM bars)",
      stop="(SELECT strftime(max(bar_time), '%Y-%m-%d') FROM bars)", ticks='prices', clean='prices',
      archive="CAST(0 AS BIGINT) AS archive_days, CAST(0 AS BIGINT) AS archive_rows", candles='kept')}""",
)
def _(spark, sf_dir):
    report = live_run(
        spark, landing.documents(hourly(spark, sf_dir)), ledger_path=scratch_path(spark, "live-run-ledger"),
        fetch_interval="1h", timeframe="4h", now_ms=FIRST_WRITE,
    )
    return report.drop("elapsed_s", "stages")


# --- streams ----------------------------------------------------------------------------------

DELAY_MINUTES = 10
# Closed bars: those whose end the watermark has passed.
STREAM_SQL = f"""{A.TICKS_SQL},
redelivered AS (SELECT * FROM ticks UNION ALL SELECT * FROM ticks WHERE seq % 10 = 0
  UNION ALL SELECT timestamp_utc, ask + 1, bid, ask_volume, bid_volume, symbol, seq + 500000 FROM ticks WHERE seq % 15 = 0),
{A.clean_sql('redelivered')},{A.bars_sql('1 hour', 'clean', 'all_bars')},
bars AS (SELECT * FROM all_bars WHERE bar_time + INTERVAL 1 HOUR <=
  (SELECT max(timestamp_utc) FROM ticks) - INTERVAL {DELAY_MINUTES} MINUTE)"""


BATCHES = 4


def _in_parts(parts: list[DataFrame]) -> DataFrame:
    """The rows of *parts* as a stream, a part to a micro-batch; each part is as many files as its scan has tasks."""
    spark, schema, path = parts[0].sparkSession, parts[0].schema, scratch_path(parts[0].sparkSession, "arriving")
    files = max(2, *[part.rdd.getNumPartitions() for part in parts])
    for part in parts:
        part.repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _arriving(spark, sf_dir, late: bool = False) -> DataFrame:
    """``events`` as a stream of BATCHES micro-batches, each with the last five minutes of the one before again.

    *late* adds a last batch, of every fiftieth event of the first.
    """
    events = A.table(spark, sf_dir, "events")
    ends = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    step = (ends["b"] - ends["a"]) / BATCHES
    parts = []
    for i in range(BATCHES):
        low, high = F.lit(ends["a"] + i * step), F.lit(ends["a"] + (i + 1) * step)
        parts.append(events.where((F.col("ts") >= low - F.expr("INTERVAL 5 MINUTES")) & ((F.col("ts") < high) if i < BATCHES - 1 else F.lit(True))))
    if late:
        parts.append(events.where((F.col("ts") < F.lit(ends["a"] + step)) & (F.col("event_id") % 50 == 0)))
    return _in_parts(parts)


def _stream_ticks(spark, sf_dir) -> DataFrame:
    streaming.use_keyed_state(spark)
    return A.redelivered(A.ticks_of_events(_arriving(spark, sf_dir)), other_volumes=False)


def _run_stream(spark, sf_dir, chain):
    """Stream ``events`` through *chain* into a table in the shared folder, and read that."""
    out = chain(streaming.clean_stream(_stream_ticks(spark, sf_dir), f"{DELAY_MINUTES} minutes"))
    path = scratch_path(spark, "stream-out")
    streaming.write_stream(out, path, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


@query("stream_bars", f"WITH {STREAM_SQL} SELECT symbol, {CANDLE_OUT} FROM bars")
def _(spark, sf_dir):
    return _run_stream(spark, sf_dir, lambda clean: streaming.bar_stream(clean, "1h"))


@query("stream_atr", f"WITH RECURSIVE {STREAM_SQL},{A.atr_sql(14)} SELECT symbol, {PAGE_OUT} FROM with_atr")
def _(spark, sf_dir):
    return _run_stream(spark, sf_dir, lambda clean: streaming.atr_stream(streaming.bar_stream(clean, "1h"), 14))


@query(
    "stream_gaps",
    f"WITH {STREAM_SQL},{A.gaps_sql(3600, 'bars', 'bar_time')} SELECT {GAP_OUT}, {EXPECTED_SQL} AS expected FROM gaps",
)
def _(spark, sf_dir):
    return _run_stream(spark, sf_dir, lambda clean: streaming.gap_stream(streaming.bar_stream(clean, "1h"), "1h"))


@query(
    "stream_atr_missing_prices",
    f"""WITH RECURSIVE {STREAM_SQL}, hollow AS (SELECT * REPLACE (CASE WHEN hour(bar_time) % 5 <> 0 THEN bar_open END AS bar_open,
      CASE WHEN hour(bar_time) % 5 <> 0 THEN bar_high END AS bar_high, CASE WHEN hour(bar_time) % 5 <> 0 THEN bar_low END AS bar_low,
      CASE WHEN hour(bar_time) % 5 <> 0 THEN bar_close END AS bar_close) FROM bars),
    priced AS (SELECT * FROM hollow WHERE bar_close IS NOT NULL),{A.atr_sql(14, 'priced')}
    SELECT symbol, {PAGE_OUT} FROM hollow h LEFT JOIN (SELECT symbol, bar_time, atr FROM with_atr) a USING (symbol, bar_time)""",
)
def _(spark, sf_dir):
    return _run_stream(spark, sf_dir, lambda clean: streaming.atr_stream(hollow(streaming.bar_stream(clean, "1h")), 14))


@query("stream_archive", f"WITH {A.TICKS_SQL} SELECT {TICK_OUT} FROM ticks")
def _(spark, sf_dir):
    """Overlapping deliveries merged into the day archive, batch by batch."""
    path = scratch_path(spark, "stream-archive")
    ticks = A.ticks_of_events(_arriving(spark, sf_dir))
    streaming.write_archive(ticks, path, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return bronze.read_archive(spark, path)


@query("stream_open_bars", f"WITH {A.TICKS_SQL},{A.clean_sql('ticks')},{A.bars_sql('1 hour')} SELECT symbol, '1h' AS timeframe, {CANDLE_OUT}, CAST(NULL AS DOUBLE) AS atr FROM bars")
def _(spark, sf_dir):
    """In update mode the ledger has every bar, those still forming too."""
    path = scratch_path(spark, "stream-ledger")
    clean_ticks = streaming.clean_stream(A.ticks_of_events(_arriving(spark, sf_dir)), f"{DELAY_MINUTES} minutes")
    bars = streaming.bar_stream(clean_ticks, "1h")
    streaming.write_open_bars(bars, path, scratch_path(spark, "stream-checkpoint"), "1h").awaitTermination()
    return ledger.read_ledger(spark, path).select("symbol", "timeframe", *ledger.CANDLE_PAGE)


@query(
    "stream_live_ledger",
    f"""WITH RECURSIVE {CLEAN_SQL},{A.bars_sql('1 hour')}, fed AS (SELECT * EXCLUDE (bar_volume),
      CASE WHEN day(bar_time) % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE bar_volume END AS bar_volume FROM bars),
    {A.atr_sql(14, 'fed')} SELECT symbol, '1h' AS timeframe, {PAGE_OUT} FROM with_atr""",
)
def _(spark, sf_dir):
    """Documents of single days land in four batches; ATR goes on from batch to batch."""
    path = scratch_path(spark, "stream-live")
    docs = stored(landing.documents(hourly(spark, sf_dir)), "documents")
    ends = docs.agg(F.min("delivered_at").alias("a"), F.max("delivered_at").alias("b")).first()
    step = (ends["b"] - ends["a"]) / BATCHES
    low = [F.col("delivered_at") >= F.lit(ends["a"] + i * step) for i in range(BATCHES)]
    parts = [docs.where(low[i] & (~low[i + 1] if i + 1 < BATCHES else F.lit(True))) for i in range(BATCHES)]
    live.write_live(
        _in_parts(parts), path, scratch_path(spark, "stream-checkpoint"), "1h", "1h", period=14, trim=False, continued=True
    ).awaitTermination()
    return ledger.read_ledger(spark, path).select("symbol", "timeframe", *ledger.CANDLE_PAGE)


@query(
    "stream_late_rows",
    """SELECT count(*) AS late FROM events, (SELECT min(ts) AS a, max(ts) AS b FROM events)
    WHERE event_id % 50 = 0 AND epoch_us(ts) < epoch_us(a) + (epoch_us(b) - epoch_us(a)) // 4""",
)
def _(spark, sf_dir):
    """Ticks after the watermark are dropped, and counted."""
    streaming.use_keyed_state(spark)
    ticks = A.ticks_of_events(_arriving(spark, sf_dir, late=True))
    bars = streaming.bar_stream(streaming.clean_stream(ticks, f"{DELAY_MINUTES} minutes"), "1h")
    written = streaming.write_stream(bars, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-checkpoint"))
    written.awaitTermination()
    return spark.createDataFrame([(streaming.late_rows(written),)], "late BIGINT")


VOLUMES_SQL = f"""{A.DIRTY_SQL},{A.clean_sql('ticks_dirty')},{A.bars_sql('1 hour', 'clean', 'all_bars')},
bars AS (SELECT * FROM all_bars WHERE bar_time + INTERVAL 1 HOUR <= (SELECT max(timestamp_utc) FROM ticks) - INTERVAL {DELAY_MINUTES} MINUTE)"""


@query("stream_bars_volumes", f"WITH {VOLUMES_SQL} SELECT symbol, {CANDLE_OUT} FROM bars")
def _(spark, sf_dir):
    """Duplicates that differ in volume only: the stream keeps the one that batch keeps."""
    streaming.use_keyed_state(spark)
    ticks = A.redelivered(A.ticks_of_events(_arriving(spark, sf_dir)))
    out = streaming.bar_stream(streaming.settled_stream(ticks, f"{DELAY_MINUTES} minutes"), "1h")
    path = scratch_path(spark, "stream-out")
    streaming.write_stream(out, path, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


def _events_by_quarter(spark, sf_dir) -> tuple[DataFrame, list]:
    events = A.table(spark, sf_dir, "events")
    ends = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    step = (ends["b"] - ends["a"]) / BATCHES
    return events, [F.lit(ends["a"] + i * step) for i in range(BATCHES)]


def _late_ticks(spark, sf_dir) -> DataFrame:
    """Events in four micro-batches; every twentieth of the first quarter comes with the last one only."""
    events, starts = _events_by_quarter(spark, sf_dir)
    late = (F.col("ts") < starts[1]) & (F.col("event_id") % 20 == 0)
    after = [F.col("ts") >= s for s in starts]
    parts = [events.where(after[i] & (~after[i + 1] if i + 1 < BATCHES else F.lit(True)) & ~late) for i in range(BATCHES)]
    parts[-1] = parts[-1].unionByName(events.where(late))
    return A.redelivered(A.ticks_of_events(_in_parts(parts)))


def _closed(spark, sf_dir, period: int | None) -> Closing:
    paths = scratch_path(spark, "closing-archive"), scratch_path(spark, "closing-ledger")
    closing = Closing(*paths, "1h", DELAY_MINUTES * 60, period)
    write_closed_candles(_late_ticks(spark, sf_dir), closing, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return closing


@query("stream_late_repair", f"WITH RECURSIVE {VOLUMES_SQL},{A.atr_sql(14)} SELECT symbol, '1h' AS timeframe, {PAGE_OUT} FROM with_atr")
def _(spark, sf_dir):
    """Late ticks change candles closed long ago; ledger and ATR after the repair equal batch."""
    return ledger.read_ledger(spark, _closed(spark, sf_dir, 14).ledger_path).select("symbol", "timeframe", *ledger.CANDLE_PAGE)


QUARTER_SQL = f"""quarters AS (SELECT *, least(floor((epoch_us(timestamp_utc) - a) / ((b - a) / {BATCHES}.0)), {BATCHES - 1}) AS quarter
  FROM ticks_dirty, (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events))"""


@query(
    "stream_late_candles",
    f"""WITH {A.DIRTY_SQL}, late AS (SELECT * FROM ticks_dirty, (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events)
      WHERE seq % 10000000 % 20 = 0 AND epoch_us(timestamp_utc) < a + (b - a) // {BATCHES})
    SELECT symbol, epoch_ms(time_bucket(INTERVAL 1 HOUR, timestamp_utc)) AS bar_time, count(*) AS ticks FROM late GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    """The candles that were made anew, and the late ticks in each."""
    return _closed(spark, sf_dir, None).late(spark).drop("batch")


SILENT_SQL = f"""{A.TICKS_SQL}, edges AS (SELECT epoch_us(min(ts)) AS a, (epoch_us(max(ts)) - epoch_us(min(ts))) // {BATCHES} AS step FROM events),
placed AS (SELECT symbol, epoch_us(ts) AS us, least((epoch_us(ts) - a) // step, {BATCHES - 1}) AS quarter
  FROM (SELECT upper(event_type) AS symbol, ts FROM events), edges),
heard AS (SELECT symbol, us, quarter, us // 3600000000 * 3600 AS bucket FROM placed WHERE NOT (symbol = 'PURCHASE' AND quarter IN (1, 2)
  OR symbol = 'VIEW' AND quarter >= 2 OR symbol = 'SIGNUP' AND quarter = 3)),
cut AS (SELECT q AS quarter, (SELECT max(us) FROM heard WHERE quarter < q) / 1e6 - {DELAY_MINUTES * 60} AS watermark FROM range(1, {BATCHES + 1}) t(q)),
stand AS (SELECT c.quarter, c.watermark, h.symbol, max(h.bucket) FILTER (h.quarter < c.quarter) AS last_seen, count(*) FILTER (h.quarter = c.quarter) AS rows_now
  FROM cut c, heard h GROUP BY ALL),
silent AS (
  SELECT DISTINCT symbol, last_seen, CAST(NULL AS BIGINT) AS resumed, 'open' AS state FROM stand WHERE rows_now = 0 AND last_seen + 3600 + 86400 <= watermark
  UNION ALL SELECT symbol, last_seen, bucket, 'closed' FROM (SELECT symbol, bucket, lag(bucket) OVER (PARTITION BY symbol ORDER BY bucket) AS last_seen
    FROM (SELECT DISTINCT symbol, bucket FROM heard)) WHERE bucket - last_seen > 3600 + 86400)"""


@query("stream_silence", f"WITH {SILENT_SQL} SELECT symbol, last_seen * 1000 AS last_seen, CAST(resumed * 1000 AS DOUBLE) AS resumed, state FROM silent")
def _(spark, sf_dir):
    """One symbol pauses for half the time, two fall silent: open gaps are told by timers, closed ones when data resumes."""
    streaming.use_keyed_state(spark)
    events, starts = _events_by_quarter(spark, sf_dir)
    after, kind = [F.col("ts") >= s for s in starts], F.col("event_type")
    silent = (kind == "purchase") & after[1] & ~after[3] | (kind == "view") & after[2] | (kind == "signup") & after[3]
    parts = [events.where(after[i] & (~after[i + 1] if i + 1 < BATCHES else F.lit(True)) & ~silent) for i in range(BATCHES)]
    ticks = A.ticks_of_events(_in_parts(parts)).withWatermark("timestamp_utc", f"{DELAY_MINUTES} minutes")
    out = streaming.silence_stream(ticks, "1h", "1d")
    path = scratch_path(spark, "stream-out")
    streaming.write_stream(out, path, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.schema(out.schema).parquet(path).withColumn("resumed", F.unix_millis("resumed").cast("double"))


@query(
    "stream_totals",
    f"""WITH {STREAM_SQL} SELECT {BATCHES + 1} AS batches, (SELECT count(*) FROM events) + late + again AS rows, late,
      (SELECT count(*) FROM events) + late + again AS ticks, (SELECT count(*) FROM bars) AS candles
    FROM (SELECT count(*) AS late FROM events, (SELECT min(ts) AS a, max(ts) AS b FROM events)
      WHERE event_id % 50 = 0 AND epoch_us(ts) < epoch_us(a) + (epoch_us(b) - epoch_us(a)) // 4),
    (SELECT count(*) AS again FROM events, (SELECT min(ts) AS a, max(ts) AS b FROM events), range(1, {BATCHES}) t(i)
      WHERE epoch_us(ts) >= epoch_us(a) + i * ((epoch_us(b) - epoch_us(a)) // {BATCHES}) - 300000000
        AND epoch_us(ts) < epoch_us(a) + i * ((epoch_us(b) - epoch_us(a)) // {BATCHES}))""",
)
def _(spark, sf_dir):
    """Rows, late rows, ticks and candles of all micro-batches, from the reports that the log kept."""
    streaming.use_keyed_state(spark)
    log = ProgressLog(spark, scratch_path(spark, "progress"))
    ticks = A.ticks_of_events(_arriving(spark, sf_dir, late=True)).observe("in", F.count(F.lit(1)).alias("ticks"))
    bars = streaming.bar_stream(streaming.clean_stream(ticks, f"{DELAY_MINUTES} minutes"), "1h")
    bars = bars.observe("out", F.count(F.lit(1)).alias("candles"))
    with log:
        streaming.write_stream(bars, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-checkpoint")).awaitTermination()
    counts = log.observed().agg(
        F.sum(F.when(F.col("name") == "in.ticks", F.col("total"))).alias("ticks"),
        F.sum(F.when(F.col("name") == "out.candles", F.col("total"))).alias("candles"),
    )
    return log.totals().join(counts)


@query("bars_of_deliveries", f"WITH {CLEAN_SQL},{A.bars_sql('4 hours')} SELECT symbol, '4h' AS timeframe, {CANDLE_OUT} FROM bars")
def _(spark, sf_dir):
    """Three deliveries that cut buckets, in any order and one of them twice, merged without their ticks."""
    path, ticks = scratch_path(spark, "states"), stored(clean(spark, sf_dir), "clean")
    first, second = "timestamp_utc < '2024-01-09 06:31:07'", "timestamp_utc < '2024-01-20 17:00:01'"
    cuts = {"c": f"NOT ({second})", "a": first, "b": f"NOT ({first}) AND {second}"}
    for delivery in ["c", "a", "b", "a"]:
        partials.deliver(spark, ticks.where(cuts[delivery]), path, "4h", delivery)
    return partials.delivered_candles(spark, path, "4h")


def _hours_streamed(spark, sf_dir) -> str:
    """Hour files in three micro-batches, the second of which runs twice; the raw table."""
    folder, raw = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    files = landing.tick_files(A.ticks(spark, sf_dir))
    landing.write_files(files, folder)
    third = -(-tickfiles.read_tick_files(spark, folder).select("path").count() // 3)

    def land(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2 if batch_id == 1 else 1):
            hours.land_batch(batch, batch_id, raw)

    arriving = hours.hour_file_stream(spark, folder, third).writeStream.foreachBatch(land)
    arriving.option("checkpointLocation", scratch_path(spark, "stream-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return raw


@query("hours_streamed", ORACLES["bi5_ingest"])
def _(spark, sf_dir):
    return hours.read_streamed_ticks(spark, f"{_hours_streamed(spark, sf_dir)}/ticks")


@query(
    "hours_streamed_manifest",
    f"""WITH {A.TICKS_SQL}, {DAYS_SQL},
    planned AS (SELECT symbol, unnest(generate_series(CAST(start_date AS TIMESTAMP), end_date + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS hour FROM ranges),
    fresh AS (SELECT symbol, date_trunc('hour', timestamp_utc) AS hour, count(*) AS ticks FROM ticks GROUP BY 1, 2)
    SELECT CASE symbol WHEN 'CLICK' THEN 'XAUUSD' WHEN 'ERROR' THEN 'USDJPY' ELSE symbol END AS symbol, epoch_ms(hour) AS hour,
      CASE WHEN ticks IS NULL THEN 'skipped' ELSE 'written' END AS status, coalesce(ticks, 0) AS ticks
    FROM planned LEFT JOIN fresh USING (symbol, hour) WHERE isodow(hour) <= 5""",
)
def _(spark, sf_dir):
    planned = ranges(A.ticks(spark, sf_dir)).replace({"CLICK": "XAUUSD", "ERROR": "USDJPY"}, subset=["symbol"])
    return hours.streamed_manifest(spark, planned, _hours_streamed(spark, sf_dir))


# --- what a run does not take -----------------------------------------------------------------

BARRED_SQL = f"""barred AS (SELECT * REPLACE (CASE WHEN symbol = 'VIEW' THEN 'VIEW/X' ELSE symbol END AS symbol,
  CASE WHEN symbol = 'ERROR' AND hour(timestamp_utc) % 6 = 0 THEN NULL ELSE bid END AS bid) FROM kept)"""


def _barred(spark, sf_dir) -> DataFrame:
    """Ticks of which one symbol is not allowed in the ledger, and one has hours without a price."""
    ticks = A.ticks_dirty(spark, sf_dir)
    hollow_hours = (F.col("symbol") == "ERROR") & (F.hour("timestamp_utc") % 6 == 0)
    return ticks.replace({"VIEW": "VIEW/X"}, subset=["symbol"]).withColumn("bid", F.when(~hollow_hours, F.col("bid")))


def _barred_run(spark, sf_dir) -> tuple[DataFrame, str]:
    rejected = scratch_path(spark, "run-rejected")
    report = backfill(
        spark, _barred(spark, sf_dir), "2024-01-01", "2024-01-31", timeframe="1h", now_ms=FIRST_WRITE, rejected_path=rejected,
        archive_path=scratch_path(spark, "run-archive"), ledger_path=scratch_path(spark, "run-ledger"),
    )
    return report, rejected


BARS_OF_BARRED = f"""WITH {KEPT_ROWS_SQL},{BARRED_SQL},{A.clean_sql('barred')},{A.bars_sql('1 hour')},
judged AS (SELECT *, CASE WHEN symbol LIKE '%/%' THEN 'symbol not allowed' WHEN bar_open IS NULL THEN 'bar_open must be finite' END AS problem FROM bars)"""


@query(
    "run_report_mismatch",
    BARS_OF_BARRED + """ SELECT symbol, count(*) AS candles_produced, count(problem) AS candles_rejected, count(*) - count(problem) AS ledger_rows,
      CASE WHEN count(problem) = 0 THEN 'OK' ELSE printf('MISMATCH %d written, %d produced (%d)', count(*) - count(problem), count(*), -count(problem)) END AS reconcile,
      'PASS' AS result FROM judged GROUP BY symbol""",
)
def _(spark, sf_dir):
    """Candles the ledger does not take are told in the report and do not fail the run."""
    return _barred_run(spark, sf_dir)[0].select("symbol", "candles_produced", "candles_rejected", "ledger_rows", "reconcile", "result")


@query("run_rejected", BARS_OF_BARRED + f" SELECT symbol, '1h' AS timeframe, {CANDLE_OUT}, problem FROM judged WHERE problem IS NOT NULL")
def _(spark, sf_dir):
    """The candles the ledger did not take, with the reason."""
    _, rejected = _barred_run(spark, sf_dir)
    return spark.read.parquet(rejected).select("symbol", "timeframe", "bar_time", *ledger.CANDLE_PAGE[1:-1], "problem")

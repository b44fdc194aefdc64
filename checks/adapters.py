"""The given tables as market data, once in Spark and once in SQL.

``events`` become ticks of five symbols over a month; ``lineitem`` becomes
ticks of six symbols over seven years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.schemas import TICKS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks_of_events(events: DataFrame) -> DataFrame:
    value, seq = F.col("value"), F.col("event_id")
    return events.select(
        F.date_trunc("MILLISECOND", F.col("ts").cast("timestamp")).alias("timestamp_utc"),
        (value + 0.25).alias("ask"),
        value.alias("bid"),
        (seq % 7).cast("double").alias("ask_volume"),
        F.get_json_object("props", "$.k").cast("double").alias("bid_volume"),
        F.upper("event_type").alias("symbol"),
        seq.alias("seq"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of_events(table(spark, sf_dir, "events"))


def ticks_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ticks in each millisecond: out of order in ``seq``, which is large, some of them in one microsecond."""
    base, k = F.col("timestamp_utc"), F.col("k")
    tens = (F.col("seq") * 7 % 3 + k * (F.col("seq") % 2)) * 300
    return ticks(spark, sf_dir).select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k")).select(
        F.timestamp_micros(F.unix_micros(base) + tens).alias("timestamp_utc"),
        (F.col("ask") + k).alias("ask"), (F.col("bid") + k).alias("bid"), "ask_volume", "bid_volume", "symbol",
        (F.col("seq") + (2 - k).cast("long") * 1_000_000_000_000 + 999_999).alias("seq"),
    )


FINE_SQL = """fine AS (SELECT make_timestamp(epoch_us(timestamp_utc) + (seq * 7 % 3 + k * (seq % 2)) * 300) AS timestamp_utc,
  ask + k AS ask, bid + k AS bid, ask_volume, bid_volume, symbol, seq + (2 - k) * 1000000000000 + 999999 AS seq
  FROM ticks, unnest([0, 1, 2]) AS u(k))"""


def ticks_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redelivered(ticks(spark, sf_dir))


def redelivered(clean: DataFrame, other_volumes: bool = True) -> DataFrame:
    """Ticks with repeats: exact ones, other prices in the same millisecond, other volumes."""
    seq = F.col("seq")

    def copy(on, ask_up, vol_up, later):
        return F.struct(
            on.alias("on"), F.lit(ask_up).alias("ask_up"), F.lit(vol_up).alias("vol_up"), F.lit(later).alias("later")
        )

    wanted = [copy(F.lit(True), 0.0, 0.0, 0), copy(seq % 10 == 0, 0.0, 0.0, 0), copy(seq % 15 == 0, 1.0, 0.0, 500000)]
    if other_volumes:
        wanted.append(copy(seq % 20 == 0, 0.0, 5.0, 250000))
    copies = F.filter(F.array(*wanted), lambda c: c["on"])
    return clean.select("*", F.inline(copies)).select(
        "timestamp_utc",
        (F.col("ask") + F.col("ask_up")).alias("ask"),
        "bid",
        "ask_volume",
        (F.col("bid_volume") + F.col("vol_up")).alias("bid_volume"),
        "symbol",
        (seq + F.col("later")).alias("seq"),
    ).select(*TICKS.names)


def ticks_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    day_ms = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    in_day = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 86400 * 1000 + F.col("l_partkey") % 1000
    return lines.select(
        F.timestamp_millis(day_ms + in_day).alias("timestamp_utc"),
        (F.col("l_extendedprice") + 0.5).alias("ask"),
        F.col("l_extendedprice").alias("bid"),
        F.lit(0.0).alias("ask_volume"),
        F.col("l_quantity").alias("bid_volume"),
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        (F.col("l_partkey") * 1000 + F.col("l_suppkey") % 1000).alias("seq"),
    ).select(*TICKS.names)


TICKS_SQL = """
ticks AS (
  SELECT date_trunc('millisecond', ts) AS timestamp_utc, value + 0.25 AS ask, value AS bid,
         CAST(event_id % 7 AS DOUBLE) AS ask_volume, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS bid_volume,
         upper(event_type) AS symbol, event_id AS seq
  FROM events)"""

DIRTY_SQL = TICKS_SQL + """,
ticks_dirty AS (
  SELECT * FROM ticks
  UNION ALL SELECT * FROM ticks WHERE seq % 10 = 0
  UNION ALL SELECT timestamp_utc, ask + 1, bid, ask_volume, bid_volume, symbol, seq + 500000 FROM ticks WHERE seq % 15 = 0
  UNION ALL SELECT timestamp_utc, ask, bid, ask_volume, bid_volume + 5, symbol, seq + 250000 FROM ticks WHERE seq % 20 = 0)"""

SHIPMENTS_SQL = """
ticks_shipments AS (
  SELECT make_timestamp((epoch_ms(l_shipdate) + (l_orderkey * 7 + l_linenumber) % 86400 * 1000 + l_partkey % 1000) * 1000) AS timestamp_utc,
         l_extendedprice + 0.5 AS ask, l_extendedprice AS bid, CAST(0 AS DOUBLE) AS ask_volume, l_quantity AS bid_volume,
         l_returnflag || l_linestatus AS symbol, l_partkey * 1000 + l_suppkey % 1000 AS seq
  FROM lineitem)"""


def clean_sql(source: str) -> str:
    """CTE ``clean``: mid price, one row for each (time, symbol, price)."""
    return f"""
clean AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY timestamp_utc, symbol, price ORDER BY seq, ask, ask_volume, bid, bid_volume) AS nth
    FROM (SELECT *, (bid + ask) / 2 AS price FROM {source}))
  WHERE nth = 1)"""


def bars_sql(width: str, source: str = "clean", name: str = "bars") -> str:
    """CTE of candles; *width* is an interval such as ``5 minutes``."""
    key = "row(timestamp_utc, seq)"
    return f"""
{name} AS (
  SELECT symbol, time_bucket(INTERVAL '{width}', timestamp_utc) AS bar_time,
         arg_min(price, {key}) AS bar_open, max(price) AS bar_high, min(price) AS bar_low,
         arg_max(price, {key}) AS bar_close, sum(bid_volume + ask_volume) AS bar_volume
  FROM {source} GROUP BY 1, 2)"""


def atr_sql(period: int, source: str = "bars", name: str = "with_atr") -> str:
    """CTEs that end in *name*: the candles of *source* with ``tr`` and ``atr``, by recursion."""
    return f"""
{name}_r AS (
  SELECT *, row_number() OVER w AS rn,
         greatest(bar_high - bar_low, abs(bar_high - lag(bar_close) OVER w), abs(bar_low - lag(bar_close) OVER w)) AS tr
  FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY bar_time)),
{name}_a AS (
  SELECT symbol, CAST({period} AS BIGINT) AS rn, avg(tr) AS atr FROM {name}_r WHERE rn <= {period}
  GROUP BY symbol HAVING count(*) >= {period}
  UNION ALL
  SELECT r.symbol, r.rn, (a.atr * ({period} - 1) + r.tr) / {period}
  FROM {name}_a a JOIN {name}_r r ON r.symbol = a.symbol AND r.rn = a.rn + 1),
{name} AS (SELECT r.*, a.atr FROM {name}_r r LEFT JOIN {name}_a a USING (symbol, rn))"""


def gaps_sql(step: int, source: str, column: str, name: str = "gaps") -> str:
    """CTEs that end in *name*: a full grid of *step* seconds less the buckets present."""
    return f"""
{name}_present AS (
  SELECT DISTINCT symbol, CAST(floor(epoch({column}) / {step}) * {step} AS BIGINT) AS b FROM {source}),
{name}_grid AS (
  SELECT symbol, unnest(generate_series(lo, hi, {step})) AS b
  FROM (SELECT symbol, min(b) AS lo, max(b) AS hi FROM {name}_present GROUP BY symbol)),
{name}_expected AS (
  SELECT symbol, b FROM {name}_grid WHERE isodow(make_timestamp(b * 1000000)) <= 5),
{name}_missing AS (
  SELECT e.symbol, e.b, e.b - {step} * row_number() OVER (PARTITION BY e.symbol ORDER BY e.b) AS island
  FROM {name}_expected e ANTI JOIN {name}_present p ON e.symbol = p.symbol AND e.b = p.b),
{name} AS (
  SELECT symbol, make_timestamp(min(b) * 1000000) AS gap_start,
         make_timestamp((max(b) + {step}) * 1000000) AS gap_end,
         (max(b) + {step} - min(b)) / 60.0 AS duration_minutes
  FROM {name}_missing GROUP BY symbol, island)"""

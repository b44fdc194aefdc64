"""The keyed candle table: validated rows, merge, upsert and the queries served from it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tickbars.functions import columns as C
from tickbars.functions.timeframes import DEFAULT_LIMIT, check_symbol, check_timeframe_name, clamp_limit
from tickbars.schemas import CANDLE_VALUES, LEDGER, LEDGER_KEY, require_columns, series_keys, with_fields
from tickbars.session import require_utc
from tickbars.sources.versions import VersionedTable

PARTITIONS = ["symbol", "timeframe", "bar_month"]
READ_SCHEMA = with_fields(LEDGER, bar_month=StringType())
LISTED_SYMBOLS = 1000
CANDLE_PAGE = ["bar_time", *CANDLE_VALUES, "atr"]


@dataclass(frozen=True)
class Upserted:
    """Logical rows an upsert wrote."""

    inserted: int
    updated: int

    @property
    def rows(self) -> int:
        return self.inserted + self.updated


def _or_fail(value: Column, ok: Column, message: str) -> Column:
    failed = F.raise_error(F.concat(F.lit(message + ": "), F.coalesce(value.cast("string"), F.lit("NULL"))))
    return F.when(F.coalesce(ok, F.lit(False)), value).otherwise(failed)


def valid_candle() -> Column:
    """Whether the ledger takes a candle: a symbol that passes the whitelist, finite prices and volume."""
    finite = [C.finite(F.col(c)).isNotNull() for c in CANDLE_VALUES]
    return F.coalesce(reduce(lambda a, b: a & b, finite, C.valid_symbol(F.col("symbol"))), F.lit(False))


def rejected_candles(candles: DataFrame) -> DataFrame:
    """Candles the ledger does not take, with the reason as ``problem``: the quarantine beside :func:`ledger_rows`.

    The first reason counts: the symbol, then open, high, low, close and volume in turn.
    """
    problem = F.when(~C.valid_symbol(F.col("symbol")), "symbol not allowed")
    for c in CANDLE_VALUES:
        problem = problem.when(C.finite(F.col(c)).isNull(), f"{c} must be finite")
    return candles.withColumn("problem", problem).where(F.col("problem").isNotNull())


def ledger_rows(candles: DataFrame, timeframe: str) -> DataFrame:
    """Candles as ledger rows.

    Open, high, low, close and volume must be finite and the symbol must pass
    the whitelist, or the job fails; an ATR that is not finite becomes NULL;
    ``bar_time`` becomes epoch milliseconds.
    """
    require_columns(candles, ["symbol", "bar_time", *CANDLE_VALUES], "ledger_rows")
    atr = F.col("atr") if "atr" in candles.columns else F.lit(None).cast("double")
    symbol = F.col("symbol")
    return candles.select(
        _or_fail(symbol, C.valid_symbol(symbol), "symbol not allowed").alias("symbol"),
        F.lit(check_timeframe_name(timeframe)).alias("timeframe"),
        C.epoch_ms(F.col("bar_time")).alias("bar_time"),
        *[
            _or_fail(F.col(c), C.finite(F.col(c)).isNotNull(), f"{c} must be finite").cast("double").alias(c)
            for c in CANDLE_VALUES
        ],
        C.finite(atr).alias("atr"),
    )


def merge_candles(current: DataFrame, updates: DataFrame, now_ms: int) -> DataFrame:
    """*current* with *updates* applied by key, and a ``change`` column.

    Prices and volume take the new value; ATR takes it unless it is NULL;
    ``ingested_at`` is set when a row is inserted and then stays;
    ``last_updated_at`` is the time of the last write.

    Both sides are stacked and aggregated by key: one shuffle, no sort, and
    ``bar_time`` in the key spreads a symbol of any size over all tasks.
    """
    stamp = F.lit(now_ms).cast("long")
    old = current.select(*LEDGER.names, F.lit(0).alias("_new"))
    new = updates.select(
        *LEDGER_KEY, *CANDLE_VALUES, "atr", stamp.alias("ingested_at"), stamp.alias("last_updated_at"),
        F.lit(1).alias("_new"),
    )
    newest = F.col("_new")
    merged = old.unionByName(new).groupBy(*LEDGER_KEY).agg(
        *[F.max_by(c, newest).alias(c) for c in CANDLE_VALUES],
        F.max_by("atr", F.when(F.col("atr").isNotNull(), newest)).alias("atr"),
        F.min_by("ingested_at", newest).alias("ingested_at"),
        F.max("last_updated_at").alias("last_updated_at"),
        F.min(newest).alias("_first"),
        F.sum(newest).alias("_writes"),
    )
    change = (
        F.when(F.col("_writes") > 1, F.raise_error(F.lit("an update holds one candle twice")))
        .when(F.col("_writes") == 0, "kept")
        .when(F.col("_first") == 1, "inserted")
        .otherwise("updated")
    )
    return merged.select(*LEDGER.names, change.alias("change"))


def bar_month(bar_time_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(bar_time_ms), "yyyy-MM")


def ledger_table(path: str) -> VersionedTable:
    return VersionedTable(path.rstrip("/"), READ_SCHEMA, tuple(PARTITIONS))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at *path*; empty when nothing has been written yet."""
    return ledger_table(path).read(spark)


def _touched(spark: SparkSession, table: VersionedTable, updates: DataFrame) -> DataFrame:
    """The rows of *table* in the partitions of *updates*.

    Literal filters skip whole directories: the months and timeframes between
    the outermost ones, and the symbols themselves while they can be listed.
    """
    parts = updates.select(*PARTITIONS).distinct()
    edges = parts.agg(
        *[F.min(c).alias(f"low_{c}") for c in PARTITIONS], *[F.max(c).alias(f"high_{c}") for c in PARTITIONS]
    ).first()
    where = reduce(lambda a, b: a & b, [F.col(c).between(edges[f"low_{c}"], edges[f"high_{c}"]) for c in PARTITIONS])
    symbols = [r.symbol for r in parts.select("symbol").distinct().limit(LISTED_SYMBOLS + 1).collect()]
    if len(symbols) <= LISTED_SYMBOLS:  # only pruning: the join below decides
        where &= F.col("symbol").isin(symbols)
    return table.read(spark, where).join(parts, PARTITIONS, "left_semi")


def upsert_candles(spark: SparkSession, path: str, updates: DataFrame, now_ms: int) -> Upserted:
    """Merge ledger rows into the table at *path*; returns the rows inserted and updated.

    Only the months the update touches are read and rewritten, and they change
    all at once: a driver lost before the end leaves the ledger as it was.  One
    writer at a time.  *updates* is read more than once: pass a stored table.
    """
    require_utc(spark)
    if updates.isEmpty():
        return Upserted(0, 0)
    updates = updates.withColumn("bar_month", bar_month(F.col("bar_time")))
    table = ledger_table(path)
    counts = Observation()
    merged = merge_candles(_touched(spark, table, updates), updates, now_ms).observe(
        counts,
        F.count_if(F.col("change") == "inserted").alias("inserted"),
        F.count_if(F.col("change") == "updated").alias("updated"),
    )
    rows = merged.select(*LEDGER.names, bar_month(F.col("bar_time")).alias("bar_month"))
    table.replace(
        rows.select(*READ_SCHEMA.names).hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "bar_time")
    )
    return Upserted(counts.get["inserted"], counts.get["updated"])


def latest_candles(ledger: DataFrame, symbol: str, timeframe: str, limit=None) -> DataFrame:
    """The newest *limit* candles of one series, oldest first.

    The limit defaults to 200 and never exceeds 1000.  Each task keeps its own
    newest rows; only those travel.
    """
    series = ledger.where(
        (F.col("symbol") == check_symbol(symbol)) & (F.col("timeframe") == check_timeframe_name(timeframe))
    )
    return series.select(*CANDLE_PAGE).orderBy(F.col("bar_time").desc()).limit(clamp_limit(limit)).orderBy("bar_time")


def latest_per_series(ledger: DataFrame, limit=None) -> DataFrame:
    """The newest *limit* candles (200 unless given) of every series at once.

    This is no page: the limit is taken as it is.
    """
    limit = DEFAULT_LIMIT if limit is None else int(limit)
    newest = Window.partitionBy("symbol", "timeframe").orderBy(F.col("bar_time").desc())
    return (
        ledger.select("symbol", "timeframe", *CANDLE_PAGE, F.row_number().over(newest).alias("_nth"))
        .where(F.col("_nth") <= limit)
        .drop("_nth")
    )


def ledger_health(ledger: DataFrame, now_ms: int) -> DataFrame:
    """One row: how many candles, when the newest was inserted, and how long ago."""
    newest = F.col("last_ingested_at")
    return ledger.agg(
        F.count(F.lit(1)).alias("row_count"), F.max("ingested_at").alias("last_ingested_at")
    ).select(
        F.lit("ok").alias("status"),
        "row_count",
        "last_ingested_at",
        C.iso_utc(newest).alias("last_ingested_at_iso"),
        C.minutes_since_tenths(newest, F.lit(now_ms)).alias("minutes_since_last_update"),
    )


def candle_points(page: DataFrame) -> DataFrame:
    """Candles as chart points, time in seconds."""
    return page.where(F.col("bar_time").isNotNull()).select(
        *series_keys(page),
        F.floor(F.col("bar_time") / 1000).alias("time"),
        *[F.col(f"bar_{part}").alias(part) for part in ("open", "high", "low", "close")],
    )


def atr_points(page: DataFrame) -> DataFrame:
    """The ATR line as chart points; candles without an ATR are left out."""
    return page.where(F.col("bar_time").isNotNull() & F.col("atr").isNotNull()).select(
        *series_keys(page), F.floor(F.col("bar_time") / 1000).alias("time"), F.col("atr").alias("value")
    )

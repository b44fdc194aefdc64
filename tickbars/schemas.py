"""Fixed table layouts shared by readers, transforms and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TIME, _DOUBLE, _TEXT, _LONG = T.TimestampType(), T.DoubleType(), T.StringType(), T.LongType()

# What a tick file holds, in contract order.
SOURCE_TICKS = _struct(
    timestamp_utc=_TIME, ask=_DOUBLE, bid=_DOUBLE, ask_volume=_DOUBLE, bid_volume=_DOUBLE, symbol=_TEXT
)
# ``seq`` is ours: the position of the tick in its delivery, the tie-break for
# ticks stamped to one millisecond.
TICKS = T.StructType([*SOURCE_TICKS.fields, T.StructField("seq", _LONG)])

BARS = _struct(
    timestamp_utc=_TIME, open=_DOUBLE, high=_DOUBLE, low=_DOUBLE, close=_DOUBLE, volume=_DOUBLE, symbol=_TEXT
)

CANDLE_VALUES = ["bar_open", "bar_high", "bar_low", "bar_close", "bar_volume"]
CANDLES = T.StructType(
    [T.StructField("symbol", _TEXT), T.StructField("bar_time", _TIME), *[T.StructField(c, _DOUBLE) for c in CANDLE_VALUES]]
)

LEDGER_KEY = ["symbol", "timeframe", "bar_time"]
LEDGER = T.StructType(
    [
        T.StructField("symbol", _TEXT),
        T.StructField("timeframe", _TEXT),
        T.StructField("bar_time", _LONG),
        *[T.StructField(c, _DOUBLE) for c in CANDLE_VALUES],
        T.StructField("atr", _DOUBLE),
        T.StructField("ingested_at", _LONG),
        T.StructField("last_updated_at", _LONG),
    ]
)

# One document of the JSON bar feed.  Numbers arrive as strings.
_VALUE = _struct(datetime=_TEXT, open=_TEXT, high=_TEXT, low=_TEXT, close=_TEXT, volume=_TEXT)
FEED_DOCUMENT = _struct(
    status=_TEXT, code=T.IntegerType(), message=_TEXT, values=T.ArrayType(_VALUE), _corrupt_record=_TEXT
)


def with_fields(schema: T.StructType, **fields: T.DataType) -> T.StructType:
    """*schema* with more columns at its end."""
    return T.StructType([*schema.fields, *_struct(**fields).fields])


def require_columns(df: DataFrame, needed, who: str) -> None:
    """Raise ``ValueError`` naming the columns *df* lacks."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{who}: missing required columns {missing}; got {sorted(df.columns)}")


def series_keys(df: DataFrame) -> list[str]:
    """The columns that tell one time series from another in *df*."""
    return [c for c in ("symbol", "timeframe") if c in df.columns]

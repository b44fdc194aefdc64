"""Column expressions for ticks, candles and the ledger.  All JVM-side."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickbars.functions.timeframes import SYMBOL_PATTERN, TIMEFRAME_PATTERN

# Raw integer prices are divided by these.
METAL_SYMBOLS = ["XAUUSD", "XAGUSD", "XAUEUR", "XAGEUR", "XPTUSD", "XPDUSD"]
METAL_DIVISOR = 1_000.0
YEN_DIVISOR = 1_000.0
FX_DIVISOR = 100_000.0
# Fixed value: raw volumes are in millions of units.
VOLUME_SCALE = 1_000_000.0

# Feed names of the metals quoted there.
FEED_SYMBOLS = {"XAUUSD": "XAU/USD", "XAGUSD": "XAG/USD", "XAUEUR": "XAU/EUR", "XAGEUR": "XAG/EUR"}

# Larger than any position a BIGINT can hold.
SEQ_SPAN = Decimal(10**19)


def utc(value: Column) -> Column:
    """Any timestamp-like column as a UTC instant; naive values are taken as UTC.

    Strings with an offset are converted.  Needs the UTC session of
    :func:`tickbars.session.configure` for naive input.
    """
    return value.cast("timestamp")


def mid_price(bid: Column, ask: Column) -> Column:
    return (bid + ask) / F.lit(2.0)


def finite(value: Column) -> Column:
    """*value*, or NULL where it is NaN or infinite."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def order_key(ts: Column, seq: Column) -> Column:
    """Time to the microsecond, then position in the delivery (NULL counts as 0), in one number.

    A fixed-width key keeps ``min_by``/``max_by`` in a hash aggregate with
    map-side partials; a struct key would force a sort aggregate.
    """
    micros = F.unix_micros(ts).cast("decimal(18,0)") * F.lit(SEQ_SPAN)
    return (micros + F.coalesce(seq, F.lit(0)).cast("decimal(19,0)")).cast("decimal(38,0)")


def point_divisor(symbol: Column) -> Column:
    """What a raw integer price of *symbol* is divided by."""
    return (
        F.when(symbol.isin(METAL_SYMBOLS), F.lit(METAL_DIVISOR))
        .when(symbol.endswith("JPY"), F.lit(YEN_DIVISOR))
        .otherwise(F.lit(FX_DIVISOR))
    )


def real_volume(raw: Column) -> Column:
    return raw.cast("double") * F.lit(VOLUME_SCALE)


def event_time(hour_ms: Column, delta_ms: Column) -> Column:
    return F.timestamp_millis(hour_ms + delta_ms)


def feed_symbol(symbol: Column) -> Column:
    """Internal symbol to the name the bar feed uses (``EURUSD`` -> ``EUR/USD``)."""
    name = F.upper(F.trim(symbol))
    mapped = F.when(name.contains("/"), name)
    for ours, theirs in FEED_SYMBOLS.items():
        mapped = mapped.when(name == ours, F.lit(theirs))
    pair = F.concat_ws("/", F.substring(name, 1, 3), F.substring(name, 4, 3))
    return mapped.when(name.rlike(r"^\p{L}{6}$"), pair).otherwise(name)


def valid_symbol(symbol: Column) -> Column:
    return F.coalesce(symbol.rlike(SYMBOL_PATTERN), F.lit(False))


def valid_timeframe(timeframe: Column) -> Column:
    return F.coalesce(timeframe.rlike(TIMEFRAME_PATTERN), F.lit(False))


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def iso_utc(ms: Column) -> Column:
    """Epoch milliseconds as ISO-8601 with a ``Z``; NULL stays NULL."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def minutes_since(ms: Column, now_ms: Column) -> Column:
    """Minutes from *ms* to *now_ms*, never negative; NULL stays NULL."""
    minutes = (now_ms - ms) / F.lit(60_000.0)
    return F.when(ms.isNotNull(), F.greatest(F.lit(0.0), minutes))


def minutes_since_tenths(ms: Column, now_ms: Column) -> Column:
    """Minutes from *ms* to *now_ms* to one decimal, halves rounded up, sign kept."""
    return F.floor((now_ms - ms) / F.lit(60_000.0) * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)


def change(current: Column, previous: Column) -> Column:
    """``struct(abs, pct, up)`` from *previous* to *current*; NULL without both."""
    diff = current - previous
    pct = F.when(previous != 0, diff / previous * F.lit(100.0)).otherwise(F.lit(0.0))
    return F.when(diff.isNotNull(), F.struct(diff.alias("abs"), pct.alias("pct"), (diff >= 0).alias("up")))

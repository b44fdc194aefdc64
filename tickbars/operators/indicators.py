"""True range, average true range and price change over candles."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.functions import columns as C
from tickbars.operators.segments import known_keys, with_previous
from tickbars.schemas import require_columns, series_keys

# exp(-745) is the last power of e a double can hold above zero.
_UNDERFLOW = 745.0


def true_range(candles: DataFrame, col: str = "true_range") -> DataFrame:
    """Add the true range and the candle's ``position`` in its series.

    The first candle of a series has no previous close, so its range is high - low.
    A candle without prices (all its ticks had none) has neither range nor
    position, and the next one is measured against the last close there is.
    """
    require_columns(candles, ["bar_time", "bar_high", "bar_low", "bar_close"], "true_range")
    total = F.col("bar_high") + F.col("bar_low") + F.col("bar_close")
    priced = total.isNotNull() & ~F.isnan(total)
    empty = candles.where(~priced).withColumn("position", F.lit(None).cast("long"))
    rows = with_previous(
        candles.where(priced), series_keys(candles), "bar_time", F.unix_seconds(F.col("bar_time")), ["bar_close"]
    )
    high, low, last = F.col("bar_high"), F.col("bar_low"), F.col("previous_bar_close")
    # greatest() skips NULL, which is what the first candle needs.
    ranged = rows.withColumn(col, F.greatest(high - low, F.abs(high - last), F.abs(low - last)))
    return ranged.drop("previous_bar_close").unionByName(empty.withColumn(col, F.lit(None).cast("double")))


def atr_levels(candles: DataFrame, period: int = 14, carry: DataFrame | None = None) -> DataFrame:
    """Candles with prices, their ``position`` in the series and the ``level`` of Wilder's recurrence there.

    The recurrence ``y = a * y' + TR / n`` with ``a = (n - 1) / n``, started from
    the mean of the first n ranges, is the weighted sum

        y_i = sum over k <= i of TR_k / n * a ** (e_i - e_k),  e_i = max(0, position_i - n)

    because the first n candles share exponent 0.  Before position n the level is
    that sum so far, and no average yet.  It is summed in blocks of
    exponents: a running sum inside the block, plus what earlier blocks hand
    over.  A block holds at most ``length + n`` candles, so no task holds a
    whole series.  A block ``reach`` back has a weight below the smallest
    double, so folding the last ``reach`` block totals is exact.

    *carry* continues series that began before *candles*: for each (``bars``,
    ``last_close``, ``level``), where it stood at the candle before.  It takes part in
    the sum as one more candle, at position ``bars`` and with the level as its share.

    *candles* is read several times: pass a stored table of bars.
    """
    if period < 1:
        raise ValueError(f"period must be positive, got {period}")
    columns = candles.columns
    series = series_keys(candles)
    rows = true_range(candles, "_tr").where(F.col("position").isNotNull()).withColumns(known_keys(series))
    keys = list(known_keys(series))
    if carry is not None:
        stood = carry.withColumns(known_keys(series)).select(
            *keys, F.col("bars").alias("_bars"), F.col("last_close").alias("_close"), F.col("level").alias("_level")
        )
        first = (F.col("position") == 1) & F.col("_close").isNotNull()
        high, low, last = F.col("bar_high"), F.col("bar_low"), F.col("_close")
        joined = F.greatest(high - low, F.abs(high - last), F.abs(low - last))
        rows = rows.join(stood, keys, "left").select(
            *columns, *keys, F.when(first, joined).otherwise(F.col("_tr")).alias("_tr"),
            (F.col("position") + F.coalesce("_bars", F.lit(0))).alias("position"),
        )
    if period == 1:
        return rows.select(*columns, "position", F.col("_tr").alias("level"))
    rows = rows.select(*columns, *keys, "position", (F.col("_tr") / period).alias("_share"), F.lit(True).alias("_own"))
    if carry is not None:
        before = stood.where("_bars > 0").select(
            *keys, F.col("_bars").cast("long").alias("position"), F.col("_level").alias("_share"), F.lit(False).alias("_own")
        )
        rows = rows.unionByName(before, allowMissingColumns=True)

    decay = (period - 1) / period
    length = max(256, 64 * period)
    reach = math.ceil(_UNDERFLOW / (length * -math.log(decay)))
    step = F.greatest(F.col("position") - period, F.lit(0))
    rows = rows.select(
        "*", F.floor(step / length).alias("_block"), (step % length).cast("double").alias("_power")
    )

    running = Window.partitionBy(*keys, "_block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    grown = F.sum(F.col("_share") * F.pow(F.lit(decay), -F.col("_power"))).over(running)
    local = rows.withColumn("_local", grown * F.pow(F.lit(decay), F.col("_power"))).where("_own")

    total = F.sum(F.col("_share") * F.pow(F.lit(decay), F.lit(length - 1.0) - F.col("_power")))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(-reach, -1)
    weight = decay**length
    handed = (
        rows.groupBy(*keys, "_block")
        .agg(F.coalesce(total, F.lit(0.0)).alias("_total"))
        .select(
            *keys,
            "_block",
            F.aggregate(
                F.collect_list("_total").over(earlier), F.lit(0.0), lambda kept, x: kept * F.lit(weight) + x
            ).alias("_handed"),
        )
    )
    value = F.col("_local") + F.pow(F.lit(decay), F.col("_power") + 1) * F.col("_handed")
    return local.join(handed, [*keys, "_block"]).select(*columns, "position", value.alias("level"))


def compute_atr(candles: DataFrame, period: int = 14, col: str = "atr", carry: DataFrame | None = None) -> DataFrame:
    """Add Wilder's average true range; NULL for the first ``period - 1`` candles with prices.

    A candle without prices has no average and leaves the recurrence as it is.  *carry*
    continues a series (see :func:`atr_levels`).  *candles* is read several times: pass a
    stored table of bars.
    """
    columns = [c for c in candles.columns if c != col]
    plain = candles.select(*columns)
    ready = F.when(F.col("position") >= period, F.col("level"))
    total = F.col("bar_high") + F.col("bar_low") + F.col("bar_close")
    empty = plain.where(total.isNull() | F.isnan(total)).select(*columns, F.lit(None).cast("double").alias(col))
    return atr_levels(plain, period, carry).select(*columns, ready.alias(col)).unionByName(empty)


def price_change(candles: DataFrame) -> DataFrame:
    """Last close of each series and its change from the candle before.

    The change is NULL with fewer than two candles.  Only the two newest
    candles of a series leave a map task.
    """
    keys = series_keys(candles)
    newest = Window.partitionBy(*keys).orderBy(F.col("bar_time").desc())
    nth = F.row_number().over(newest)
    pair = candles.select(*keys, "bar_time", "bar_close", nth.alias("_nth")).where("_nth <= 2")
    return (
        pair.groupBy(*keys)
        .agg(
            F.max("bar_time").alias("bar_time"),
            F.max(F.when(F.col("_nth") == 1, F.col("bar_close"))).alias("last_close"),
            F.max(F.when(F.col("_nth") == 2, F.col("bar_close"))).alias("previous_close"),
        )
        .select(
            *keys, "bar_time", "last_close", C.change(F.col("last_close"), F.col("previous_close")).alias("change")
        )
        .select(*keys, "bar_time", "last_close", "change.abs", "change.pct", "change.up")
    )

"""Neighbours and positions in a long series, without one task per series.

A plain ``lag`` over ``partitionBy(symbol)`` puts a whole symbol in one task.
Here a series is cut in segments of fixed time: windows run inside a segment,
and one summary row for each segment hands its tail and row count to the next.
A segment holds at most one row a second (604,800); the summary table holds 52
rows for each year and series, so its window is small whatever the row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_SECONDS = 7 * 86400
# Stands for a NULL key, so that the rows of no symbol are a series of their own.
NO_KEY = "\u0000"


def known_keys(keys: list[str]) -> dict[str, Column]:
    """Columns under private names that are never NULL, one for each key."""
    return {f"_key_{k}": F.coalesce(F.col(k), F.lit(NO_KEY)) for k in keys}


def with_previous(rows: DataFrame, keys: list[str], order: str, at_seconds: Column, carry: list[str]) -> DataFrame:
    """Add ``position`` (1 for the first row of a series) and ``previous_<c>`` for each carried column.

    *order* is unique within a series and agrees with *at_seconds*.  Rows with a
    NULL key are a series of their own; rows without a time are left out.
    *rows* is read twice: pass a stored table, or a plan that ends in an
    exchange of the columns used, which both readers then share.
    """
    columns, keys = rows.columns, list(known_keys(keys))
    part = [*keys, "_segment"]
    rows = rows.withColumns(known_keys([k.removeprefix("_key_") for k in keys])).where(F.col(order).isNotNull())
    # coalesce() only tells the optimizer that no segment is NULL: the join below
    # would else add that filter to one reader, and so stop the sharing.
    segment = F.coalesce(F.floor(at_seconds / F.lit(SEGMENT_SECONDS)), F.lit(0))
    rows = rows.withColumn("_segment", segment)

    inside = Window.partitionBy(*part).orderBy(order)
    local = rows.select(
        "*",
        F.row_number().over(inside).alias("_local"),
        *[F.lag(c).over(inside).alias(f"_lag_{c}") for c in carry],
    )

    along = Window.partitionBy(*keys).orderBy("_segment")
    before = F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, -1))
    edges = (
        rows.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("_rows"), *[F.max_by(c, order).alias(f"_tail_{c}") for c in carry])
        .select(
            *part,
            F.coalesce(before, F.lit(0)).alias("_before"),
            *[F.lag(f"_tail_{c}").over(along).alias(f"_edge_{c}") for c in carry],
        )
    )

    first = F.col("_local") == 1
    return local.join(edges, part).select(
        *columns,
        (F.col("_before") + F.col("_local")).alias("position"),
        *[F.when(first, F.col(f"_edge_{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"previous_{c}") for c in carry],
    )

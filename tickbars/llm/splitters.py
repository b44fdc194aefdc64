"""Histogram sort: exact splitters of a weighted, ordered table, and shards cut at them.

Keys are pairs of longs.  In each round a few candidate keys are placed inside
every interval that still holds a wanted boundary; all partitions count the exact
weight, and the smallest and largest key, between neighbouring candidates; the
driver narrows the intervals.  It sees counts between candidates only.  When a
candidate is near enough, or an interval holds a single key or a small group of one
text, the splitter stands.
Then rows are exchanged once.

Shards hold near equal bytes (law ``bytes``).  The key is a hash of the text and
then the id, so equal texts are neighbours and stay in one shard unless a boundary
must cut their group to keep the shards even.

Defined results: a null text has no bytes; a null id sorts first.  Rows alike in id
and text have one key and stay in one shard, in any order among themselves.  An empty
table gives an empty result.  Columns of the input named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars.session import stored

HALF = 1 << 63
PROBES = 32
SHARDS = 24
TOLERANCE = 0.002
GROUP_SHARE = 0.02  # of a part: rows of one high key that weigh no more are never cut apart
LANE_BYTES = 32 << 20

Key = tuple[int, int]


def _number(high: int, low: int) -> int:
    return ((high + HALF) << 64) | (low + HALF)


def _pair(number: int) -> Key:
    return (number >> 64) - HALF, (number & ((1 << 64) - 1)) - HALF


def _as_bytes(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Pairs as 16 bytes that compare like the pairs."""
    both = np.empty((len(high), 2), ">u8")
    both[:, 0] = high.view(np.uint64) ^ np.uint64(HALF)
    both[:, 1] = low.view(np.uint64) ^ np.uint64(HALF)
    return both.view("S16").ravel()


def count_between(keys: DataFrame, probes: list[int]) -> list:
    """Weight, rows and outermost keys of each gap between neighbouring *probes*, over all partitions."""
    pairs = np.array([_pair(p) for p in probes], np.int64).reshape(-1, 2)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _as_bytes(pairs[:, 0].copy(), pairs[:, 1].copy())
        for batch in batches:
            if not batch.num_rows:
                continue
            high, low, weight = (np.ascontiguousarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(3))
            gap = np.searchsorted(edges, _as_bytes(high, low), side="right")
            order = np.lexsort((low, high, gap))
            first = np.flatnonzero(np.concatenate([[True], np.diff(gap[order]) > 0]))
            last = np.append(first[1:], len(order)) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (
                    gap[order][first].astype(np.int64), np.add.reduceat(weight[order], first),
                    high[order][first], low[order][first], high[order][last], low[order][last],
                )],
                names=["gap", "weight", "h0", "l0", "h1", "l1"],
            )

    counted = keys.select("high", "low", "weight").mapInArrow(
        count, "gap long, weight long, h0 long, l0 long, h1 long, l1 long"
    )
    return counted.groupBy("gap").agg(
        F.sum("weight").alias("weight"),
        F.min(F.struct("h0", "l0")).alias("least"),
        F.max(F.struct("h1", "l1")).alias("most"),
    ).collect()  # at most a row for each gap between probes


@dataclass
class _Open:
    """Interval of keys that holds a wanted boundary; *below* is the weight under *low*."""

    want: float
    low: int
    high: int
    below: int
    inside: int


def splitters(keys: DataFrame, parts: int, tolerance: float = TOLERANCE) -> tuple[list[Key], int]:
    """Keys that cut the table (high, low, weight) into *parts* of near equal weight, and the whole weight.

    A row belongs to the part numbered by how many splitters are not above its
    key.  Each splitter is within *tolerance* of a part's weight of its place, or
    at the nearest edge of a group of one high key (GROUP_SHARE at most), or of a key.
    """
    found = count_between(keys, [])
    if not found or parts < 2:
        return [], found[0]["weight"] if found else 0
    total = found[0]["weight"]
    least, most = _number(*found[0]["least"]), _number(*found[0]["most"])
    allowed, whole = tolerance * total / parts, GROUP_SHARE * total / parts
    intervals = [_Open(total * i / parts, least, most, 0, total) for i in range(1, parts)]
    result: dict[int, int] = {}
    while len(result) < len(intervals):
        probes: set[int] = set()
        for i, x in enumerate(intervals):
            if i not in result:
                span = x.high + 1 - x.low
                probes.update(x.low + span * j // PROBES for j in range(PROBES + 1))
        edges = sorted(probes)
        gaps = {row["gap"]: row for row in count_between(keys, edges)}
        below = np.cumsum([gaps[g]["weight"] if g in gaps else 0 for g in range(len(edges))]).tolist()
        for i, x in enumerate(intervals):
            if i in result:
                continue
            # edges[g] has below[g] under it
            g = int(np.searchsorted(below, x.want, side="right")) - 1
            near = [k for k in (g, g + 1) if 0 <= k < len(edges)]
            best = min(near, key=lambda k: abs(below[k] - x.want))
            row = gaps.get(g + 1)
            one_key = row is None or row["least"] == row["most"]
            # neighbours of one high key stay together while they weigh little
            one_group = row is not None and row["least"][0] == row["most"][0] and row["weight"] <= whole
            if abs(below[best] - x.want) <= allowed or one_key:
                result[i] = edges[best] if best == g else _number(*row["most"]) + 1 if row else edges[best]
            elif one_group:
                after = below[g] + row["weight"] - x.want < x.want - below[g]
                result[i] = _number(*row["most"]) + 1 if after else _number(*row["least"])
            else:
                x.low, x.high, x.below = _number(*row["least"]), _number(*row["most"]), below[g]
    return [_pair(result[i]) for i in range(len(intervals))], total


def part_of(high: Column, low: Column, cuts: list[Key]) -> Column:
    """Number of *cuts* not above the key."""
    part = F.lit(0)
    for h, l in cuts:  # noqa: E741
        part = part + F.when((high > h) | ((high == h) & (low >= l)), 1).otherwise(0)
    return part.cast("int")


def shard(
    docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", tolerance: float = TOLERANCE
) -> DataFrame:
    """*docs* with ``shard`` and ``slot``, its gapless place there.

    A shard is dealt over lanes (by a hash of the id, about LANE_BYTES each), so
    that no task holds a whole shard; slots count lane after lane, in key order.
    """
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    body = F.coalesce(F.col(text), F.lit(""))
    high, low = F.xxhash64(body), F.coalesce(F.col(doc_id).cast("long"), F.lit(-HALF))
    size = (F.octet_length(body) + 8).cast("long")
    keys = stored(docs.select(high.alias("high"), low.alias("low"), size.alias("weight")), "keys")
    cuts, total = splitters(keys, shards, tolerance)
    lanes = max(1, -(-total // shards // LANE_BYTES))
    lane = lambda h, l: F.pmod(F.xxhash64(l), F.lit(lanes)).cast("int")  # noqa: E731, E741
    counts = keys.groupBy(
        part_of(F.col("high"), F.col("low"), cuts).alias("_shard"), lane(F.col("high"), F.col("low")).alias("_lane")
    ).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("_shard").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_shard", "_lane", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    placed = docs.select(
        F.struct(*own).alias("_own"), high.alias("_high"), low.alias("_low"),
    ).withColumn("_shard", part_of(F.col("_high"), F.col("_low"), cuts)).withColumn(
        "_lane", lane(F.col("_high"), F.col("_low"))
    )
    order = Window.partitionBy("_shard", "_lane").orderBy("_high", "_low")
    return placed.withColumn("_at", F.row_number().over(order)).join(starts, ["_shard", "_lane"]).select(
        "_own.*", F.col("_shard").alias("shard"), (F.col("_start") + F.col("_at") - 1).cast("long").alias("slot")
    )

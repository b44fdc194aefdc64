"""Near-duplicates by SetSketch registers.

A document is the set of its distinct shingles of five words (64-bit keys).  Each
register holds the truncated minimum of an exponential hash of the shingles,
``floor(1 - log_b(minimum))``: sketches of parts merge by the larger register, and
two registers are equal about as often as the sets are alike.

1. Documents with one set are a class; its sketch stands for all.
2. Bands of three registers are hashed; classes that share a band are candidates.
   A bucket gives one pair for each member, with the bucket's centre.
3. The joint likelihood of the registers and the known set sizes bounds the
   similarity from above; what may reach the threshold is verified on full sets.
4. Verified links give components.  Classes in buckets that still hold several are
   paired across components where they share one of their rarest shingles (a link
   needs that, see ``pairs_across``) and tested alike, so that no link between
   candidates is lost; then components are final.

At similarity 0.75 a pair shares none of the 32 bands with probability 3e-8, and
the bound on the estimate (0.5) lies over five standard errors below.

Defined results: words are maximal runs of bytes that are not white space, A-Z in
lower case.  Under five words the whole sequence is the one shingle; without words
the set is empty and the document stands alone.  Rows with a null id take part; the
smallest id that is there names the component.  Of rows alike in id and text one is
kept.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm import rows, words
from tickbars.llm.graph import components
from tickbars.session import settled, stored

SHINGLE = 5
BANDS, BAND = 32, 3
REGISTERS = BANDS * BAND
BASE, RATE, TOP = 1.001, 20.0, 65534  # b, a and q + 1 of the registers
BOUND = 0.5
BROADCAST_NODES = 4_000_000
PERCENT = 75  # linked when 100 * intersection >= PERCENT * union
SKETCH = "row long, n_shingles long, set_a long, set_b long, sketch binary, packed binary"


def _odd(seed: int, n: int) -> np.ndarray:
    return words.mixed(np.arange(seed, seed + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle keys of each text (lower case already)."""
    starts, ends, first = words.word_ranges(data, offsets)
    keys = words.range_keys(data, starts, ends - starts)
    factors = _odd(77, SHINGLE)
    n = len(keys)
    sums = np.zeros(max(n - SHINGLE + 1, 0), np.uint64)
    for j in range(SHINGLE):
        sums += keys[j : n - SHINGLE + 1 + j] * factors[j] if len(sums) else 0
    sums = words.mixed(sums)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            sets.append(np.unique(sums[a : b - SHINGLE + 1]))
        elif b > a:
            whole = (keys[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(words.mixed(np.array([whole], np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set; all 0 for the empty set."""
    if not len(shingles):
        return np.zeros(REGISTERS, np.uint16)
    factors = _odd(1, REGISTERS)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        x = shingles[at : at + 1024, None] * factors[None, :]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, x.min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 1) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(one, other)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = words.text_bytes(batch.column("text"))
        for at, to in words.blocks(offsets):
            block = words.LOWER[data[offsets[at] : offsets[to]]]
            edges = offsets[at : to + 1] - offsets[at]
            sets = shingle_sets(block, edges)
            flat = block.tobytes()
            cuts = edges.tolist()
            sums = [words.mixed(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64) for s in sets]
            both = [np.bitwise_xor.reduce(s) if len(s) else np.uint64(0) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").slice(at, to - at),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array(sums, np.uint64).view(np.int64)),
                    pa.array(np.array(both, np.uint64).view(np.int64)),
                    pa.array([registers(s).tobytes() for s in sets], pa.binary()),
                    pa.array([words.pack(flat[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                ],
                names=["row", "n_shingles", "set_a", "set_b", "sketch", "packed"],
            )


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Stored ids (row, id, text_key) and sketches (SKETCH), numbered by row."""
    ids = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"),
        rows.text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"),
    )
    schema = f"id {ids.schema['id'].dataType.simpleString()}, text_key long, {SKETCH}"

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for out in _sketch_batches(iter([batch])):
                part = batch.slice(at, out.num_rows)
                at += out.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("text_key"), *out.columns], names=["id", "text_key", *out.schema.names]
                )

    table = stored(ids.mapInArrow(both, schema), "sketches")
    return table.select("row", "id", "text_key"), table


def may_be_linked(one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray) -> np.ndarray:
    """Whether the likelihood of two sketches still rises at BOUND, and the set sizes allow a link.

    With sizes known, the likelihood of the counts of larger, smaller and equal
    registers has one maximum in the similarity; a rising one lies above BOUND.
    """
    larger = (one > other).sum(axis=1)
    smaller = (one < other).sum(axis=1)
    equal = REGISTERS - larger - smaller
    u, v = n_one / (n_one + n_other), n_other / (n_one + n_other)
    step, log = (BASE - 1) / BASE, np.log(BASE)
    at = np.minimum(BOUND, np.minimum(u / v, v / u) * 0.999)
    chance = lambda x: -np.log1p(-x * step) / log
    slope = lambda x: step / ((1 - x * step) * log)
    x, y = u - v * at, v - u * at
    rise = (
        -larger * v * slope(x) / chance(x) - smaller * u * slope(y) / chance(y)
        + equal * (v * slope(x) + u * slope(y)) / (1 - chance(x) - chance(y))
    )
    return (rise >= 0) & (100 * np.minimum(n_one, n_other) >= PERCENT * np.maximum(n_one, n_other))


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        pair = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("su", "sv")]
        sizes = [batch.column(c).to_numpy().astype(float) for c in ("nu", "nv")]
        good = pa.array(may_be_linked(*pair, *sizes))
        yield batch.select(["u", "v"]).filter(good)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, np.ndarray] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            us, vs = part.column("u").to_pylist(), part.column("v").to_pylist()
            if len(known) > 64:
                known.clear()
            fresh = {n: t for c, ns in (("tu", us), ("tv", vs)) for n, t in zip(ns, part.column(c), strict=True) if n not in known}
            texts = [words.unpack(t.as_py()) for t in fresh.values()]
            offsets = np.cumsum([0, *map(len, texts)])
            known.update(zip(fresh, shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets), strict=True))
            linked = []
            for u, v in zip(us, vs, strict=True):
                a, b = known[u], known[v]
                common = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * common >= PERCENT * (len(a) + len(b) - common))
            yield part.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))


def _texts_of(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of *texts* of some nodes.  Numbers of nodes are counted before they are broadcast; more than
    BROADCAST_NODES (64 MB) are joined by a shuffle, of all texts then."""
    nodes = stored(nodes.select("node").distinct(), "nodes")
    return texts.join(F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes, "node", "left_semi")


def links(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) of classes that are linked: estimated from sketches, then verified on full sets."""
    side = lambda x: classes.select(
        F.col("node").alias(x), F.col("sketch").alias(f"s{x}"), F.col("n_shingles").alias(f"n{x}")
    )
    with_sketches = pairs.join(side("u"), "u").join(side("v"), "v")
    likely = stored(with_sketches.mapInArrow(_promising, "u long, v long"), "pairs")
    nodes = likely.select(F.col("u").alias("node")).unionAll(likely.select(F.col("v").alias("node")))
    needed = stored(_texts_of(texts, nodes), "texts")
    text = lambda x: needed.select(F.col("node").alias(x), F.col("packed").alias(f"t{x}"))
    return likely.join(text("v"), "v").join(text("u"), "u").mapInArrow(_verified, "u long, v long")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            bodies = [words.unpack(t.as_py()) for t in part.column("packed")]
            sets = shingle_sets(np.frombuffer(b"".join(bodies), np.uint8), np.cumsum([0, *map(len, bodies)]))
            sizes = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part.column("node").to_numpy(), sizes)), pa.array(np.concatenate(sets).view(np.int64))],
                names=["node", "shingle"],
            )


def pairs_across(rest: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """All pairs (u, v) of nodes in different components of *rest* (key, node, component) that can be linked.

    A link asks for PERCENT (|A| + |B|) / (100 + PERCENT) shingles in common, with
    |B| at least that of the smallest node in A's buckets and at least PERCENT |A|
    / 100.  A node that shares too few of its shingles with any other is out.  Of the
    others, linked ones share one of their rarest shingles, so many that fewer than
    asked for remain: copies of one text, changed here and there, have the changes in
    front, and meet only where they were changed alike.
    """
    sizes = classes.select("node", "n_shingles")
    least = rest.join(sizes, "node").groupBy("key").agg(F.min("n_shingles").alias("_least"))
    nodes = rest.join(least, "key").groupBy("node").agg(
        F.min("_least").alias("_least"), F.first("component").alias("component")
    )
    n = F.col("n_shingles")
    partner = F.greatest(100 * F.col("_least"), PERCENT * n)  # in hundredths
    asked = F.ceil(PERCENT * (100 * n + partner) / (100 * (100 + PERCENT))).cast("long")
    bounded = stored(
        nodes.join(sizes, "node").select("node", "component", "n_shingles", (n - asked).alias("spare")), "bounded"
    )
    shingles = _texts_of(texts, bounded).mapInArrow(_exploded, "node long, shingle long")
    counts = shingles.groupBy("shingle").agg(F.min("node").alias("node"), F.count("*").alias("_n"))
    own = counts.where("_n = 1").groupBy("node").agg(F.count("*").alias("_own"))
    left = F.col("spare") - F.coalesce("_own", F.lit(0))
    able = bounded.join(own, "node", "left").where(left >= 0).select(
        "node", "component", "n_shingles", (left + 1).alias("front"), F.coalesce("_own", F.lit(0)).alias("_own")
    )
    found = shingles.join(counts.where("_n > 1").select("shingle", "_n"), "shingle").join(able, "node")
    rarest = F.row_number().over(Window.partitionBy("node").orderBy("_n", "shingle"))
    front = found.withColumn("_at", rarest).where(F.col("_at") <= F.col("front")).select(
        "shingle", "node", "component", "n_shingles", (n - F.col("_own") - F.col("_at")).alias("after")
    )
    front = stored(front, "fronts")
    ends = front.groupBy("shingle").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a < _b")
    front = front.join(ends.select("shingle"), "shingle", "left_semi")
    other = front.toDF("shingle", "b", "cb", "nb", "after_b")
    # from the first common one on, at most the shingles after it can be common
    most = 1 + F.least("after", "after_b")
    possible = (100 + PERCENT) * most >= PERCENT * (n + F.col("nb"))
    return front.join(other, "shingle").where((F.col("component") < F.col("cb")) & possible).select(
        F.least("node", "b").alias("u"), F.greatest("node", "b").alias("v")
    ).distinct()


def _several(labelled: DataFrame) -> DataFrame:
    """The rows in buckets of several components."""
    ends = labelled.groupBy("key").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a < _b")
    return labelled.join(ends.select("key"), "key", "left_semi")


def _placed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, id, text_key, n_shingles, component) of each document."""
    _, table = sketches(docs, doc_id, text)
    some = table.where("n_shingles > 0")
    same = ["set_a", "set_b", "n_shingles"]
    classes = stored(
        some.groupBy(*same).agg(F.min("row").alias("node")).join(
            some.select(F.col("row").alias("node"), "sketch"), "node"
        ),
        "classes",
    )
    texts = some.select(F.col("row").alias("node"), "packed")
    width = 2 * BAND
    band = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.col("sketch").substr(i * width + 1, F.lit(width))),
    )
    banded = classes.select("node", F.explode(band).alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    members = stored(banded.join(shared, "key").select("key", "node", "_n"), "buckets")
    # the centre of a bucket is the member with most company in all its buckets: near copies of
    # one text are nearest to the least changed of them
    company = members.groupBy("node").agg(F.sum("_n").alias("_company"))
    centre = members.select("key", "node").join(company, "node").groupBy("key").agg(
        F.max(F.struct("_company", F.negate("node").alias("u"))).alias("_best")
    ).select("key", (-F.col("_best.u")).alias("centre"))
    spokes = members.join(centre, "key").where("node <> centre")
    stars = stored(
        spokes.select(F.least("node", "centre").alias("u"), F.greatest("node", "centre").alias("v")).distinct(), "stars"
    )
    found = settled(lambda: links(stars, classes, texts), "links")

    labelled = settled(
        lambda: members.select("key", "node").join(components(found), "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component")
        ),
        "labelled",
    )
    rest = stored(_several(labelled), "several")
    more = settled(
        lambda: links(pairs_across(rest, classes, texts).join(stars, ["u", "v"], "left_anti"), classes, texts), "more"
    )
    labels = components(found.unionAll(more))

    member = some.select("row", *same).join(classes.select(*same, "node"), same).join(labels, "node", "left").select(
        "row", F.coalesce("component", "node").alias("component")
    )
    return table.select("row", "id", "text_key", "n_shingles").join(member, "row", "left").select(
        "row", "id", "text_key", "n_shingles", F.coalesce("component", "row").alias("component")
    )


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and its text_key.

    Sketches and packed texts are deleted when every document has its component.
    """
    placed = settled(lambda: _placed(docs, doc_id, text), "placed")
    best = placed.groupBy("component").agg(
        F.min("id").alias("component_id"),
        F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))).alias("_best"),
    )
    return placed.join(best, "component").select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("row") == F.col("_best.row")).alias("kept"),
        "text_key",
    )


def keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near-duplicates (the smallest id), with the columns of *docs*."""
    kept = dedup(docs, doc_id, text).where("kept").select(F.col("doc_id").alias("id"), "text_key")
    return rows.rows_kept(docs, kept, doc_id, text)

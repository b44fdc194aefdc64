"""Context-tree weighting over bytes: code lengths of texts under a model of the whole corpus.

A text is its words in lower case, each with a space after it, then one end byte.
Each byte is eight binary decisions; a decision (the bits so far) has a tree of
contexts, the last 0 to DEPTH bytes.  A node estimates its bit by Krichevsky and
Trofimov from the training counts, and weighs its own estimate against the product
of its children; so every depth has its share in each prediction.  A context that
training never saw leaves the prediction where its parent stops.

Base: a unigram model of the tokens (words and one end for each text) with 0.1
added to each count.

How it runs.  Texts are read once, in chunks of about CHUNK_BYTES; a chunk gives its
distinct contexts and words with their training counts as sorted runs, one for each
bucket of keys, and keeps a small copy of its texts.  A bucket holds whole subtrees
(everything under a two-byte context).  Chunks are dealt over salts, SALT_CHUNKS to
each: runs are merged and answered for a bucket and salt, then merged for the bucket,
so a frequent key is met at most SALT_CHUNKS times in one task.  The nodes above (at most
65,535 numbers for each statistic) are summed and finished on the driver.  Buckets
then answer every run with log-probabilities, and chunks look their texts up.
Nothing else is broadcast; what is gathered grows with the corpus.

Defined results: a null text counts as empty: one token, the end.  A row whose id is
null takes part in training.  Training on no text predicts 1/256 for each byte.  Rows
alike are scored each.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm import units, words
from tickbars.session import stored

DEPTH = 5
CHUNK_BYTES = 64 << 20
SALT_CHUNKS = 1024
SPACE, END = 0x20, 0x0A
END_KEY = np.uint64(1)
GRAMS, WORDS = 0, 1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word keys with an end after each text, their offsets, the canonical bytes of the texts, their offsets."""
    data = words.LOWER[data]
    starts, ends, first = words.word_ranges(data, offsets)
    keys = np.insert(words.range_keys(data, starts, ends - starts), first[1:], END_KEY)
    lengths = np.insert(ends - starts, first[1:], 0)
    starts = np.insert(starts, first[1:], 0)
    edges = first + np.arange(len(first))
    closed = np.append(data, np.uint8(0))[units.spread(starts, lengths + 1)]
    stops = np.cumsum(lengths + 1)
    closed[stops - 1] = SPACE
    byte_edges = np.concatenate([[0], stops])[edges]
    closed[byte_edges[1:] - 1] = END
    return keys, edges, closed, byte_edges


def grams(closed: np.ndarray, edges: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For each byte: its context, last byte first, and the byte itself, in one number; texts start after ends."""
    key = np.zeros(len(closed), np.uint64)
    place = np.arange(len(closed)) - np.repeat(edges[:-1], np.diff(edges))
    for back in range(1, depth + 1):
        before = np.full(len(closed), END, np.uint8)
        before[back:] = closed[:-back]
        before[place < back] = END
        key = (key << np.uint64(8)) | before
    return (key << np.uint64(8)) | closed


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
    return every[first], np.add.reduceat(np.concatenate(counts)[order], first) if len(first) else np.empty(0, np.int64)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: Stirling's series after eight steps up."""
    low = np.ones_like(x)
    for j in range(8):
        low *= np.where(x < 1e6, x + j, 1.0)
    x = np.where(x < 1e6, x + 8, x)
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7) + 1 / (1188 * x**9)
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series - np.log(low)


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Level:
    """Nodes of one depth for one bit: their keys, counts, weights, and the node of each one below."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, inside: np.ndarray | None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = kt(zeros, ones)
        if inside is None:
            self.weighted, self.share = own, np.ones(len(own))
        else:
            self.weighted = math.log(0.5) + np.logaddexp(own, inside)
            self.share = 1 / (1 + np.exp(np.clip(inside - own, -700, 700)))
        self.one = (ones + 0.5) / (zeros + ones + 1.0)

    def above(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys one byte of context shorter with summed counts and weights, and the parent of each node."""
        context, bits = self.keys >> np.uint64(8), self.keys & np.uint64(255)
        keys, up = np.unique((context >> np.uint64(8) << np.uint64(8)) | bits, return_inverse=True)
        total = lambda x: np.bincount(up, weights=x, minlength=len(keys))
        return keys, total(self.zeros), total(self.ones), total(self.weighted), up


def _levels(keys: np.ndarray, counts: np.ndarray, bit: int, depth: int, top: int) -> tuple[list[Level], list[np.ndarray], np.ndarray]:
    """Levels *depth* to *top* of one bit of the grams; parents between them; the deepest node of each gram.

    A node is its context (d bytes) and the bits so far under a leading one.
    """
    symbol = keys & np.uint64(255)
    bits = (symbol >> np.uint64(8 - bit)) | np.uint64(1 << bit)
    one = ((symbol >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
    nodes, which = np.unique((keys >> np.uint64(8) << np.uint64(8)) | bits, return_inverse=True)
    ones = np.bincount(which, weights=np.where(one, counts, 0), minlength=len(nodes))
    zeros = np.bincount(which, weights=np.where(one, 0, counts), minlength=len(nodes))
    levels, parents = [Level(nodes, zeros, ones, None)], []
    for _ in range(depth - top):
        above = levels[-1].above()
        parents.append(above[4])
        levels.append(Level(*above[:4]))
    return levels, parents, which


def _down(level: Level, held: np.ndarray, weight: np.ndarray, below: Level, up: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prediction gathered and weight left at the nodes below; what training never saw stays at its parent."""
    seen = below.zeros + below.ones > 0
    share = np.where(seen, level.share[up], 1.0)
    return held[up] + weight[up] * share * level.one[up], np.where(seen, weight[up] * (1 - share), 0.0)


def bucket_top(keys: np.ndarray, counts: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, ...]:
    """Sums over the two-byte contexts of a bucket, for the nodes of one byte: key, zeros, ones, weight."""
    out = []
    for bit in range(8):
        levels, _, _ = _levels(keys, counts, bit, depth, 2)
        out.append(levels[-1].above()[:4])
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def finish_top(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, inside: np.ndarray) -> dict[int, tuple[float, float, float, float]]:
    """State of each one-byte node from which its children go on: prediction held, weight, share, own estimate."""
    order = np.argsort(key)
    one_byte = Level(key[order], zeros[order], ones[order], inside[order])
    keys, z, o, w, up = one_byte.above()
    root = Level(keys, z, o, w)
    held, weight = _down(root, np.zeros(len(keys)), np.ones(len(keys)), one_byte, up)
    return dict(zip(one_byte.keys.tolist(), zip(held.tolist(), weight.tolist(), one_byte.share.tolist(), one_byte.one.tolist(), strict=True), strict=True))


def bucket_values(keys: np.ndarray, counts: np.ndarray, top: dict[int, tuple[float, float, float, float]], depth: int = DEPTH) -> np.ndarray:
    """log10 of the probability of each gram's byte in its context."""
    value = np.zeros(len(keys))
    symbol = keys & np.uint64(255)
    for bit in range(8):
        levels, parents, which = _levels(keys, counts, bit, depth, 2)
        two = levels[-1]
        above_keys, _, _, _, up = two.above()
        state = np.array([top[k] for k in above_keys.tolist()]).reshape(-1, 4)
        held, weight, share, one = state.T
        seen = two.zeros + two.ones > 0
        share = np.where(seen, share[up], 1.0)
        held, weight = held[up] + weight[up] * share * one[up], np.where(seen, weight[up] * (1 - share), 0.0)
        for k in range(len(levels) - 1, 0, -1):
            held, weight = _down(levels[k], held, weight, levels[k - 1], parents[k - 1])
        chance = (held + weight * levels[0].one)[which]
        is_one = ((symbol >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        value += np.log10(np.where(is_one, chance, 1 - chance))
    return value


def _bucket(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key; grams that share their last two bytes of context share a bucket."""
    whole = keys >> np.uint64(8 * (DEPTH - 1)) if kind == GRAMS else keys
    return (words.mixed(whole) % np.uint64(buckets)).astype(np.int64) + kind * buckets


def chunked(docs: DataFrame, buckets: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Stored runs (chunk, bucket, keys, counts) and texts (chunk, doc_id, held_out, packed)."""
    kind = docs.schema[doc_id].dataType.simpleString()
    held = F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(False))
    slim = docs.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))
    names = ["chunk", "bucket", "keys", "counts", "doc_id", "held_out", "packed"]

    def runs(chunk: int, found: dict[int, tuple[list, list]], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        for which, (keys, counts) in found.items():
            keys, counts = _counted(keys, counts)
            if not len(keys):
                continue
            bucket = _bucket(which, keys, buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            for part in np.split(order, cuts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk], pa.int64()), pa.array([int(bucket[part[0]])], pa.int32()),
                        pa.array([words.pack(keys[part].tobytes())], pa.binary()),
                        pa.array([words.pack(counts[part].astype(np.uint32).tobytes())], pa.binary()),
                        pa.nulls(1, id_type), pa.nulls(1, pa.bool_()), pa.nulls(1, pa.binary()),
                    ],
                    names=names,
                )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, size = TaskContext.get().partitionId() << 24, 0, 0
        found: dict[int, tuple[list, list]] = {GRAMS: ([], []), WORDS: ([], [])}
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            data, offsets = words.text_bytes(batch.column("text"))
            held_out = np.array(batch.column("held_out").to_pylist(), bool)
            for at, to in words.blocks(offsets):
                keys, edges, closed, byte_edges = tokens(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
                trains = ~held_out[at:to]
                for which, every, cuts in ((GRAMS, grams(closed, byte_edges), byte_edges), (WORDS, keys, edges)):
                    use = np.repeat(trains, np.diff(cuts))
                    distinct, counts = np.unique(every[use], return_counts=True)
                    rest = np.unique(every[~use])
                    found[which][0].extend([distinct, rest])
                    found[which][1].extend([counts, np.zeros(len(rest), np.int64)])
                flat, cuts = closed.tobytes(), byte_edges.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([base + number] * (to - at), pa.int64()), pa.nulls(to - at, pa.int32()),
                        pa.nulls(to - at, pa.binary()), pa.nulls(to - at, pa.binary()),
                        batch.column("doc_id").slice(at, to - at), batch.column("held_out").slice(at, to - at),
                        pa.array([words.pack(flat[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                    ],
                    names=names,
                )
                size += int(offsets[to] - offsets[at])
                if size >= CHUNK_BYTES:
                    yield from runs(base + number, found, id_type)
                    found, number, size = {GRAMS: ([], []), WORDS: ([], [])}, number + 1, 0
        if size or found[WORDS][0]:
            yield from runs(base + number, found, id_type)

    table = stored(
        slim.mapInArrow(work, f"chunk long, bucket int, keys binary, counts binary, doc_id {kind}, held_out boolean, packed binary"),
        "chunks",
    )
    return (
        table.where("bucket is not null").select("chunk", "bucket", "keys", "counts"),
        table.where("bucket is null").select("chunk", "doc_id", "held_out", "packed"),
    )


def _run(keys: pa.Scalar, counts: pa.Scalar, kind: str) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(words.unpack(keys.as_py()), np.uint64), np.frombuffer(words.unpack(counts.as_py()), kind)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: held_out, token counts, base_score and score (log10 of probabilities)."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs, texts = chunked(docs, buckets, doc_id, text)
    salts = max(1, -(-texts.select("chunk").distinct().count() // SALT_CHUNKS))
    salted = runs.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)))

    def merge(table: pa.Table) -> pa.Table:
        width = table.column("width")[0].as_py()
        pairs = [_run(k, c, width) for k, c in zip(table.column("keys"), table.column("counts"), strict=True)]
        keys, counts = _counted([k for k, _ in pairs], [c.astype(np.int64) for _, c in pairs])
        return pa.table({
            "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
            "keys": pa.array([words.pack(keys.tobytes())], pa.binary()),
            "counts": pa.array([words.pack(counts.astype(np.int64).tobytes())], pa.binary()),
            "width": pa.array(["i8"]),
            "trained": pa.array([int(counts.sum())], pa.int64()),
            "distinct": pa.array([int((counts > 0).sum())], pa.int64()),
        })

    one_run = "bucket int, keys binary, counts binary, width string, trained long, distinct long"
    partial = salted.withColumn("width", F.lit("u4")).groupBy("bucket", "salt").applyInArrow(merge, one_run)
    merged = stored(partial.groupBy("bucket").applyInArrow(merge, one_run), "counts")

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
                key, zeros, ones, inside = bucket_top(*_run(keys, counts, "i8"))
                yield pa.RecordBatch.from_pydict({"key": key.astype(np.int64), "zeros": zeros, "ones": ones, "inside": inside})

    above = merged.where(F.col("bucket") < buckets).mapInArrow(tops, "key long, zeros double, ones double, inside double")
    summed = above.groupBy("key").agg(F.sum("zeros"), F.sum("ones"), F.sum("inside")).collect()  # 65,535 rows at most
    columns = np.array([list(r) for r in summed], float).reshape(-1, 4)
    top = finish_top(columns[:, 0].astype(np.uint64), *columns[:, 1:].T) if len(columns) else {}
    shared = spark.sparkContext.broadcast(top)
    size = merged.where(F.col("bucket") >= buckets).agg(F.sum("trained"), F.sum("distinct")).first()
    n_train, n_distinct = size[0] or 0, size[1] or 0

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, keys, counts in zip(batch.column("bucket").to_pylist(), batch.column("keys"), batch.column("counts"), strict=True):
                k, c = _run(keys, counts, "i8")
                value = bucket_values(k, c, shared.value) if bucket < buckets else c.astype(float)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([keys.as_py()], pa.binary()), pa.array([words.pack(value.tobytes())], pa.binary())],
                    names=["bucket", "keys", "values"],
                )

    model = stored(merged.mapInArrow(values, "bucket int, keys binary, values binary"), "model")
    wanted = salted.select("bucket", "salt").distinct().join(model, "bucket")
    for_salts = wanted.toDF("of_bucket", "of_salt", "keys", "values")

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        keys, value = _run(known.column("keys")[0], known.column("values")[0], "f8")
        found = [value[np.searchsorted(keys, np.frombuffer(words.unpack(k.as_py()), np.uint64))] for k in asked.column("keys")]
        return pa.table({
            "chunk": asked.column("chunk"), "bucket": asked.column("bucket"), "keys": asked.column("keys"),
            "values": pa.array([words.pack(x.tobytes()) for x in found], pa.binary()),
        })

    answers = salted.groupBy("bucket", "salt").cogroup(for_salts.groupBy("of_bucket", "of_salt")).applyInArrow(
        answer, "chunk long, bucket int, keys binary, values binary"
    )
    scale = math.log10(n_train + 0.1 * (n_distinct + 1)) if n_train + n_distinct else math.log10(0.1)

    def finish(of_chunk: pa.Table, known: pa.Table) -> pa.Table:
        tables = {}
        grams_first = np.array(known.column("bucket").to_pylist()) < buckets
        for which, use in ((GRAMS, grams_first), (WORDS, ~grams_first)):
            pairs = [_run(known.column("keys")[i], known.column("values")[i], "f8") for i in np.flatnonzero(use).tolist()]
            keys = np.concatenate([k for k, _ in pairs])
            order = np.argsort(keys)
            tables[which] = keys[order], np.concatenate([v for _, v in pairs])[order]
        scores, bases, sizes, seen = [], [], [], []
        packed = of_chunk.column("packed")
        for at in range(0, len(packed), 256):
            bodies = [words.unpack(p.as_py()) for p in packed.slice(at, 256)]
            closed = np.frombuffer(b"".join(bodies), np.uint8)
            byte_edges = np.cumsum([0, *map(len, bodies)])
            keys, edges, _, _ = tokens(closed, byte_edges)
            known_keys, value = tables[GRAMS]
            scores.append(np.add.reduceat(value[np.searchsorted(known_keys, grams(closed, byte_edges))], byte_edges[:-1]))
            known_keys, value = tables[WORDS]
            count = value[np.searchsorted(known_keys, keys)]
            bases.append(np.add.reduceat(np.log10(count + 0.1) - scale, edges[:-1]))
            seen.append(np.add.reduceat((count > 0).astype(np.int64), edges[:-1]))
            sizes.append(np.diff(edges))
        n = len(packed)
        return pa.table({
            "doc_id": of_chunk.column("doc_id"), "held_out": of_chunk.column("held_out"),
            "n_tokens": np.concatenate(sizes), "n_known": np.concatenate(seen),
            "train_tokens": np.full(n, n_train, np.int64), "base_score": np.concatenate(bases), "score": np.concatenate(scores),
        })

    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )

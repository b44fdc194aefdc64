"""Exact dedup by a tree-merge of sorted digest runs.

Texts are equal when they agree without white space; each is known by the SHA-256
of what is left.  Every partition sorts its digests once, into a run with one entry
for each.  Then partitions exchange runs in rounds: in round r each entry moves to
the partition whose r-th digit is the r-th digit of its digest, so a partition
meets ``FAN`` others.  A run travels in sorted blocks; the runs that arrive are merged,
not sorted anew, and of entries with one digest (all 32 bytes are compared) the best
row stays.  After the last round a digest is in one place.  A group of copies,
however large, travels as one entry for each run.

Blocks arrive by their first digest, so a merge holds ``WINDOW`` entries and one
block of each run.

Defined results: a null text counts as empty and equals every text of white space
only.  Of equal texts the one with the most code points stays, then the smallest
id (a null id is larger than any).  Rows alike in id and text: the first stored one
stays.  Texts of any length are hashed whole.  An empty table gives an empty result.
Columns of the input named like a result are left out of the result of ``dedup``;
``keep`` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.llm.rows import KEY, row_key
from tickbars.session import stored

WHITE = " \t\n\x0b\x0c\r"
FAN_BITS = 2
FAN = 1 << FAN_BITS
ENTRY = "digest binary, n_points long, keep_id long, keep_row long, group_size long"
BLOCK = "to int, run int, head binary, entries binary"
BLOCK_ENTRIES = 4096
WINDOW = 1 << 16
# An entry of a block; a null id has keep_id 0 and no_id.
WIRE = np.dtype(
    [("digest", "S32"), ("n_points", "<i8"), ("no_id", "?"), ("keep_id", "<i8"), ("keep_row", "<i8"), ("group_size", "<i8")]
)


def digest(text: Column) -> Column:
    """The 32 bytes of a text's digest."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITE, ""), 256))


def entries(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A stored row for each document: digest, code points, id and a row number of its own."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        digest(F.col(text)).alias("digest"),
        F.char_length(body).cast("long").alias("n_points"),
        F.col(doc_id).cast("long").alias("keep_id"),
        F.monotonically_increasing_id().alias("keep_row"),
        F.lit(1).cast("long").alias("group_size"),
    )
    return stored(rows, "digests")


def one_for_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first entry of each digest of a sorted run, with the sizes added up."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        both = pa.Table.from_batches([held, batch] if held else [batch]).combine_chunks()
        blocks = both.column("digest").combine_chunks()
        offset = blocks.offset * 32
        data = np.frombuffer(blocks.buffers()[2], np.uint8)[offset : offset + 32 * len(blocks)].reshape(-1, 32)
        first = np.flatnonzero(np.concatenate([[True], (data[1:] != data[:-1]).any(axis=1)]))
        sizes = np.add.reduceat(both.column("group_size").to_numpy(), first)
        merged = both.take(first).set_column(4, "group_size", pa.array(sizes))
        out = merged.combine_chunks().to_batches()[0]
        held = out.slice(out.num_rows - 1)
        yield out.slice(0, out.num_rows - 1)
    if held:
        yield held


def packed(batch: pa.RecordBatch) -> np.ndarray:
    """A batch of entries as an array of WIRE."""
    out = np.empty(batch.num_rows, WIRE)
    blocks, ids = batch.column("digest"), batch.column("keep_id")
    data = np.frombuffer(blocks.buffers()[2], np.uint8)[blocks.offset * 32 :][: 32 * len(blocks)]
    out["digest"] = data.view("S32")
    out["no_id"] = ids.is_null().to_numpy(zero_copy_only=False)
    out["keep_id"] = ids.fill_null(0).to_numpy()
    for name in ("n_points", "keep_row", "group_size"):
        out[name] = batch.column(name).to_numpy()
    return out


def unpacked(entries: np.ndarray) -> pa.RecordBatch:
    """An array of WIRE as a batch of entries."""
    offsets = np.arange(len(entries) + 1, dtype=np.int32) * 32
    data = np.ascontiguousarray(entries["digest"])
    digests = pa.BinaryArray.from_buffers(pa.binary(), len(entries), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
    ids = pa.array(entries["keep_id"], mask=np.ascontiguousarray(entries["no_id"]))
    rest = [pa.array(np.ascontiguousarray(entries[name])) for name in ("n_points", "keep_row", "group_size")]
    return pa.RecordBatch.from_arrays([digests, rest[0], ids, *rest[1:]], names=[c.split()[0] for c in ENTRY.split(", ")])


def two_merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two sorted arrays of entries as one: each entry goes behind those of the other array before it."""
    left, right = np.ascontiguousarray(a["digest"]), np.ascontiguousarray(b["digest"])
    out = np.empty(len(a) + len(b), WIRE)
    out[np.arange(len(a)) + np.searchsorted(right, left, "left")] = a
    out[np.arange(len(b)) + np.searchsorted(left, right, "right")] = b
    return out


def best_of_each(entries: np.ndarray) -> np.ndarray:
    """Of neighbours with one digest the best row, with the sizes added up."""
    if not len(entries):
        return entries
    digests = np.ascontiguousarray(entries["digest"])
    new = np.concatenate([[True], digests[1:] != digests[:-1]])
    first, group = np.flatnonzero(new), np.cumsum(new) - 1
    chosen = first.copy()
    again = np.flatnonzero(~new | np.concatenate([~new[1:], [False]]))  # members of groups of two and more
    some = entries[again]
    order = np.lexsort([some["keep_row"], some["keep_id"], some["no_id"], -some["n_points"], group[again]])
    ordered = group[again][order]
    heads = np.flatnonzero(np.diff(ordered, prepend=-1))
    chosen[ordered[heads]] = again[order[heads]]
    out = entries[chosen]
    out["group_size"] = np.add.reduceat(entries["group_size"], first)
    return out


def all_merged(runs: list[np.ndarray]) -> np.ndarray:
    """Sorted runs merged two by two until one is left, each time with one entry for each digest."""
    while len(runs) > 1:
        pairs = [best_of_each(two_merged(a, b)) for a, b in zip(runs[::2], runs[1::2])]  # noqa: B905
        runs = pairs + runs[2 * len(pairs) :]
    return runs[0] if runs else np.empty(0, WIRE)


def merged_blocks(blocks: Iterator[tuple[int, bytes, np.ndarray]]) -> Iterator[np.ndarray]:
    """Pieces of the merge of all runs, from their blocks (run, first digest, entries) in the order of first digests."""
    held, waiting, n = np.empty(0, WIRE), {}, 0
    for source, head, entries in blocks:
        if n >= WINDOW:
            held = all_merged([held, *(np.concatenate(w) for w in waiting.values())])
            done = int(np.searchsorted(np.ascontiguousarray(held["digest"]), np.bytes_(head), "left"))
            yield held[:done]
            held, waiting, n = held[done:], {}, 0
        waiting.setdefault(source, []).append(entries)
        n += len(entries)
    yield all_merged([held, *(np.concatenate(w) for w in waiting.values())])


def addressed(pieces: Iterator[np.ndarray], turn: int) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of this partition's run as blocks for the partitions that round *turn* sends them to."""
    here, shift = TaskContext.get().partitionId(), turn * FAN_BITS
    for piece in pieces:
        for at in range(0, len(piece), BLOCK_ENTRIES):
            part = piece[at : at + BLOCK_ENTRIES]
            low = np.ascontiguousarray(part["digest"]).view(np.uint8).reshape(-1, 32)[:, :4].copy().view(">u4").ravel()
            digit = (low.astype(np.int64) >> shift) & (FAN - 1)
            rows = []
            for d in np.unique(digit).tolist():
                block = part[digit == d]
                data = block.tobytes()
                rows.append(((here & ~((FAN - 1) << shift)) | (d << shift), here, data[:32], data))
            to, run, head, entries = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), pa.array(run, pa.int32()), pa.array(head, pa.binary()), pa.array(entries, pa.binary())],
                names=["to", "run", "head", "entries"],
            )


def received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield (
                batch.column("run")[i].as_py(), batch.column("head")[i].as_py(),
                np.frombuffer(batch.column("entries")[i].as_buffer(), WIRE),
            )


def tree_merge(rows: DataFrame) -> DataFrame:
    """One entry for each digest of *rows*: the best row, and how many there are."""
    wanted = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rounds = -(-(wanted - 1).bit_length() // FAN_BITS)
    slots = 1 << (rounds * FAN_BITS)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return addressed((packed(b) for b in one_for_each(batches) if b.num_rows), 0)

    def between(turn: int):
        return lambda batches: addressed(merged_blocks(received(batches)), turn)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (unpacked(piece) for piece in merged_blocks(received(batches)) if len(piece))

    best = ["digest", F.desc("n_points"), F.asc_nulls_last("keep_id"), "keep_row"]
    runs = rows.select("digest", "n_points", "keep_id", "keep_row", "group_size").sortWithinPartitions(*best)
    blocks = runs.mapInArrow(first, BLOCK)
    for turn in range(1, rounds + 1):
        moved = blocks.withColumn("to", F.pmod("to", F.lit(slots))).repartitionById(slots, "to").sortWithinPartitions("head")
        blocks = moved.mapInArrow(between(turn), BLOCK) if turn < rounds else moved.mapInArrow(last, ENTRY)
    return blocks


def groups(rows: DataFrame) -> DataFrame:
    """Stored entries, each beside the one of its group that stays."""
    merged = tree_merge(rows).select(
        "digest", F.col("keep_id").alias("_best_id"), F.col("keep_row").alias("_best_row"),
        F.col("group_size").alias("_size"),
    )
    return rows.select("digest", "keep_id", "keep_row").join(merged, "digest").select(
        F.col("keep_id").alias("doc_id"),
        F.col("_best_id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("keep_row") == F.col("_best_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: which document of its group stays, the group's size, the digest."""
    return groups(entries(docs, doc_id, text))


def keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of *docs* that stay, one of each group, with the columns of *docs*."""
    best = tree_merge(entries(docs, doc_id, text)).select(
        *row_key(F.col("keep_id"), F.col("digest")), F.col("n_points").alias("_points")
    )
    whole = docs.select(
        F.struct(*docs.columns).alias("_row"), *row_key(F.col(doc_id).cast("long"), digest(F.col(text))),
        F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("_points"),
    )
    # no column is null and both steps have the same ones, so that a text is exchanged once
    same = [*KEY, "_points"]
    return whole.dropDuplicates(same).join(best, same, "left_semi").select("_row.*")

"""Repeated passages by a distributed merge sort of suffixes that share their prefixes.

A byte is removed if a string of WINDOW bytes covers it that also starts earlier: in
a smaller document, or before in the same one.

Suffixes are taken at anchors.  The anchor of a window is its ANCHOR-byte string of
least hash, the leftmost of equal ones: two equal windows have equal anchors at one
place, so comparing what stands around equal anchors finds every repeat.  About one
byte in 35 is an anchor.

1. Chunks of texts give the hashes of their anchors as sorted runs, by bucket; the
   buckets tell every chunk which of them stand elsewhere too.
2. A chunk sorts the suffixes at those anchors (the bytes from the anchor on, then
   the bytes before it, nearest first), keeps one of those alike in all of that, and
   sends front-coded runs to the buckets of the anchors.
3. A bucket merges its runs with a loser tree over common prefixes.  The prefixes of
   neighbours give, for each length, the classes of suffixes that agree so far; within a
   class, those that agree before the anchor too are one repeated window, of which
   the earliest stays.
4. Covered spans go back to the chunks, which cut them out.

An anchor found more than HOT times sends each of its windows by itself, to a bucket
of its own, in place of its suffix: no bucket grows with the contexts of a passage.

Equality of strings before an anchor, and of whole suffixes in a chunk, is that of
64-bit hashes.

Defined results: a null text counts as empty.  Texts under WINDOW bytes lose nothing.
A null id comes after all others; rows with one id count in the order they were
read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm import merging, words
from tickbars.session import stored

WINDOW, ANCHOR = 100, 32
PLACES = WINDOW - ANCHOR + 1  # of an anchor in a window
BEFORE = PLACES - 1
WIDTH = WINDOW + BEFORE
HOT = 1 << 16
CHUNK_BYTES = 16 << 20
SEGMENT = 1 << 20
ROWS = 20_000  # suffixes laid out at a time
NO_ID = np.iinfo(np.int64).max


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts of under 16 MB together: place, hash, first and last window start they stand for."""
    n = len(data)
    none = np.empty(0, np.int64)
    if n < WINDOW:
        return none, none.astype(np.uint64), none, none
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((n + 1,), "<u8", padded, strides=(1,))
    count = n - ANCHOR + 1
    hashes = np.zeros(count, np.uint64)
    for part, factor in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
        hashes += (eights[8 * part : 8 * part + count] ^ np.uint64(factor >> 7)) * np.uint64(factor)
        hashes ^= hashes >> np.uint64(31)
    hashes = words.mixed(hashes)
    # 40 bits of the hash, then the place: the least is the leftmost of the least
    least = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(count, dtype=np.uint64)
    span = 1
    while 2 * span <= PLACES:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < PLACES:
        least = np.minimum(least[: count - PLACES + 1], least[PLACES - span : PLACES - span + count - PLACES + 1])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    starts = np.flatnonzero(np.arange(len(least)) + WINDOW <= ends[: len(least)])
    if not len(starts):
        return none, none.astype(np.uint64), none, none
    place = (least[starts] & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(starts) != 1)]))
    last = np.append(first[1:], len(starts)) - 1
    return place[first], hashes[place[first]], starts[first], starts[last]


def segments(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Parts of the texts to take anchors of: texts (from, to) and bytes (from, to); a long text is cut
    into parts that overlap, so that each window start lies in one of them."""
    for at, to in words.blocks(offsets, SEGMENT):
        low, high = int(offsets[at]), int(offsets[to])
        if to - at > 1 or high - low <= 2 * SEGMENT:
            yield at, to, low, high
        else:
            for start in range(low, high, SEGMENT):
                yield at, to, start, min(high, start + SEGMENT + WINDOW - 1)


class Anchors:
    """Anchors of all texts of a chunk, at places in its bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        found = []
        for at, to, low, high in segments(offsets):
            edges = np.clip(offsets[at : to + 1], low, high) - low
            place, key, first, last = anchors(data[low:high], edges)
            found.append((place + low, key, first + low, last + low))
        self.place, self.key, self.first, self.last = (np.concatenate(x) for x in zip(*found, strict=True))
        self.text = np.searchsorted(offsets, self.place, side="right") - 1
        self.short_key = self.key >> np.uint64(16)


def around(data: np.ndarray, offsets: np.ndarray, text: np.ndarray, place: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """A row of WIDTH bytes for each anchor: WINDOW - least bytes from it on, then *most* before it, backwards; zeros where out."""
    steps = np.arange(WINDOW)
    right = place[:, None] + steps
    use = right < np.minimum(offsets[text + 1], place + WINDOW - least)[:, None]
    rows = np.zeros((len(place), WIDTH), np.uint8)
    rows[:, :WINDOW] = np.where(use, data[np.minimum(right, len(data) - 1)], 0)
    left = place[:, None] - 1 - np.arange(BEFORE)
    use = left >= np.maximum(offsets[text], place - most)[:, None]
    rows[:, WINDOW:] = np.where(use, data[np.maximum(left, 0)], 0)
    return rows


def _row_keys(rows: np.ndarray) -> np.ndarray:
    n = len(rows)
    return words.range_keys(rows.ravel(), np.arange(n) * rows.shape[1], np.full(n, rows.shape[1]))


def suffix_runs(
    data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, numbers: np.ndarray, codes: np.ndarray, found: Anchors, buckets: int
) -> tuple[dict[int, dict], np.ndarray]:
    """Sorted front-coded runs by bucket of the anchors that stand elsewhere (code 1, or 2 for hot ones), and
    the spans (text, from, to) known to be covered already, as later ones of suffixes alike."""
    warm, hot = np.flatnonzero(codes == 1), np.flatnonzero(codes == 2)
    least, most = found.place - found.last, found.place - found.first  # of the distance from window start to anchor
    counts = (most - least + 1)[hot]
    each = np.repeat(hot, counts)
    distance = least[each] + np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts)
    which = np.concatenate([warm, each])
    low = np.concatenate([least[warm], distance])
    high = np.concatenate([most[warm], distance])
    runs = {}
    place, text = found.place[which], found.text[which]
    # of suffixes alike, the earliest stays
    keys = np.empty(len(which), np.uint64)
    wide = np.concatenate([np.zeros(len(warm), bool), np.ones(len(each), bool)])
    for at in range(0, len(which), ROWS):
        part = slice(at, at + ROWS)
        # a hot window stands by itself; the others with all that is near
        rows = around(data, offsets, text[part], place[part], np.where(wide[part], low[part], 0), np.where(wide[part], high[part], BEFORE))
        keys[part] = _row_keys(rows) ^ words.mixed((low[part] * 256 + high[part]).astype(np.uint64))
    order = np.lexsort((place, numbers[text], ids[text], keys))
    new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]]) if len(order) else np.empty(0, bool)
    later = order[~new]
    spans = np.stack([text[later], place[later] - high[later], place[later] - low[later] + WINDOW]).T.astype(np.int64)
    kept = order[new]
    anchor_bucket = words.mixed(found.key[which[kept]]) % np.uint64(buckets)
    window_bucket = words.mixed(keys[kept]) % np.uint64(buckets)
    bucket = np.where(wide[kept], window_bucket, anchor_bucket).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    for part in np.split(by_bucket, np.flatnonzero(np.diff(bucket[by_bucket])) + 1):
        if not len(part):
            continue
        chosen = kept[part]
        rows = around(
            data, offsets, text[chosen], place[chosen], np.where(wide[chosen], low[chosen], 0),
            np.where(wide[chosen], high[chosen], BEFORE),
        )
        order = np.argsort(rows.view(f"S{WIDTH}").ravel(), kind="stable")
        rows, chosen = rows[order], chosen[order]
        common = merging.prefixes(rows)
        runs[int(bucket[part[0]])] = {
            "common": common.astype(np.uint8), "rest": merging.front_coded(rows, common),
            "low": low[chosen].astype(np.uint8), "high": high[chosen].astype(np.uint8),
            "id": ids[text[chosen]], "number": numbers[text[chosen]], "text": text[chosen].astype(np.int64),
            "place": (place[chosen] - offsets[text[chosen]]).astype(np.int64),
        }
    return runs, spans


FIELDS = {"common": "u1", "low": "u1", "high": "u1", "id": "i8", "number": "i8", "text": "i8", "place": "i8"}


def pack_run(run: dict) -> bytes:
    n = len(run["common"])
    return words.pack(n.to_bytes(8, "little") + b"".join(run[f].astype(k).tobytes() for f, k in FIELDS.items()) + run["rest"])


def unpack_run(packed: bytes) -> dict:
    data = words.unpack(packed)
    n, at, run = int.from_bytes(data[:8], "little"), 8, {}
    for field, kind in FIELDS.items():
        run[field] = np.frombuffer(data, kind, n, at)
        at += n * int(kind[1])
    run["rest"] = data[at:]
    return run


def covered(runs: list[dict]) -> list[np.ndarray]:
    """For each run the spans (text, from, to), in the text, of windows that start earlier elsewhere."""
    coded = []
    for run in runs:
        common = run["common"].tolist()
        coded.append((merging.restored(common, run["rest"], WIDTH), common))
    steps = np.array(list(merging.merged(coded)), np.int64).reshape(-1, 3)
    begin = np.cumsum([0] + [len(r["common"]) for r in runs])
    at = begin[steps[:, 0]] + steps[:, 1]
    common = steps[:, 2]
    whole = {f: np.concatenate([r[f] for r in runs])[at] for f in FIELDS if f != "common"}
    left = np.frombuffer(b"".join(coded[i][0][j][WINDOW:] for i, j, _ in steps.tolist()), np.uint8).reshape(-1, BEFORE)
    order = np.lexsort((whole["place"], whole["number"], whole["id"]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    low, high = whole["low"].astype(np.int64), whole["high"].astype(np.int64)
    far, near = np.full(len(at), -1), np.full(len(at), WINDOW)  # largest and least covered distance
    before = np.zeros(len(at), np.uint64)
    for distance in range(PLACES):
        if distance:
            before = words.mixed(before ^ (left[:, distance - 1].astype(np.uint64) + np.uint64(257)))
        use = np.flatnonzero((low <= distance) & (distance <= high))
        if not len(use):
            continue
        same = np.cumsum(common < WINDOW - distance).astype(np.uint64)[use] * np.uint64(0x9E3779B97F4A7C15)
        key = words.mixed(before[use] ^ same)
        by = np.lexsort((rank[use], key))
        later = use[by[1:][key[by][1:] == key[by][:-1]]]
        far[later] = np.maximum(far[later], distance)
        near[later] = np.minimum(near[later], distance)
    some = np.flatnonzero(far >= 0)
    spans = np.stack([whole["text"][some], whole["place"][some] - far[some], whole["place"][some] - near[some] + WINDOW]).T
    return [spans[steps[some, 0] == i] for i in range(len(runs))]


def _runs_of(
    spans: np.ndarray, offsets: np.ndarray, at: int, to: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts *at* to *to*: whether each byte is in a span, begins and ends of the runs of such bytes in the block of
    the texts, and offsets of the texts into them.  *spans* (text, from, to) is ordered by text."""
    low, size = offsets[at], int(offsets[to] - offsets[at])
    some = spans[np.searchsorted(spans[:, 0], at) : np.searchsorted(spans[:, 0], to)]
    begin = offsets[some[:, 0]] - low
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, begin + some[:, 1], 1)
    np.add.at(edge, begin + some[:, 2], -1)
    gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
    inside = np.zeros(size + 2, bool)
    inside[1:-1] = gone
    cut = np.zeros(size + 1, bool)
    cut[offsets[at : to + 1] - low] = True
    first = np.flatnonzero(gone & (~inside[:-2] | cut[:-1]))
    last = np.flatnonzero(gone & (~inside[2:] | cut[1:])) + 1
    return gone, first, last, np.searchsorted(first, offsets[at : to + 1] - low)


def _order_ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def _texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Bytes and offsets of a chunk's texts in the order of their numbers, and the table in that order."""
    table = table.sort_by("number").combine_chunks()
    bodies = [words.unpack(p.as_py()) for p in table.column("packed")]
    return np.frombuffer(b"".join(bodies), np.uint8), np.cumsum([0, *map(len, bodies)]), table


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, the spans removed (from, to) and the bytes kept."""
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(
        F.monotonically_increasing_id().alias("number"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    id_kind = docs.schema[doc_id].dataType.simpleString()
    names = ["chunk", "bucket", "run", "number", "doc_id", "packed"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, keys, id_type = TaskContext.get().partitionId() << 24, 0, [], pa.int64()

        def runs() -> Iterator[pa.RecordBatch]:
            every = np.concatenate(keys) if keys else np.empty(0, np.uint64)
            key, count = np.unique(every, return_counts=True)
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                if len(part):
                    run = words.pack_sorted(key[part]) + count[part].astype("<u4").tobytes()
                    packed = words.pack(len(part).to_bytes(8, "little") + run)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk], pa.int64()), pa.array([int(bucket[part[0]])], pa.int32()), pa.array([packed], pa.binary()),
                         pa.nulls(1, pa.int64()), pa.nulls(1, id_type), pa.nulls(1, pa.binary())], names=names)

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            data, offsets = words.text_bytes(batch.column("text"))
            for at, to in words.blocks(offsets):
                part, edges = data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
                keys.append(Anchors(part, edges).short_key)
                flat, cuts = part.tobytes(), edges.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * (to - at), pa.int64()), pa.nulls(to - at, pa.int32()), pa.nulls(to - at, pa.binary()),
                     batch.column("number").slice(at, to - at), batch.column("doc_id").slice(at, to - at),
                     pa.array([words.pack(flat[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                    names=names,
                )
                size += len(part)
                if size >= CHUNK_BYTES:
                    yield from runs()
                    chunk, size, keys = chunk + 1, 0, []
        yield from runs()

    table = stored(slim.mapInArrow(chunks, f"chunk long, bucket int, run binary, number long, doc_id {id_kind}, packed binary"), "chunks")
    texts = table.where("bucket is null").select("chunk", "number", "doc_id", "packed")
    key_runs = table.where("bucket is not null").select("chunk", "bucket", "run")

    def key_run(packed: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        data = words.unpack(packed.as_py())
        n = int.from_bytes(data[:8], "little")
        return words.unpack_sorted(data[8 : len(data) - 4 * n]), np.frombuffer(data, "<u4", n, len(data) - 4 * n)

    def tell(asked: pa.Table) -> pa.Table:
        """Of each run, the keys that stand more than once in the bucket, and which of them are hot."""
        runs = [key_run(r) for r in asked.column("run")]
        every, which = np.unique(np.concatenate([k for k, _ in runs]), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate([c for _, c in runs]), minlength=len(every))
        code = (total > 1).astype(np.uint8) + (total > hot)
        out, at = [], 0
        for keys, _ in runs:
            codes = code[which[at : at + len(keys)]]
            at += len(keys)
            some = codes > 0
            body = words.pack_sorted(keys[some]) + codes[some].tobytes()
            out.append(words.pack(int(some.sum()).to_bytes(8, "little") + body))
        return pa.table({"of_chunk": asked.column("chunk"), "codes": pa.array(out, pa.binary())})

    told = key_runs.groupBy("bucket").applyInArrow(tell, "of_chunk long, codes binary")

    def sort(of_chunk: pa.Table, answers: pa.Table) -> pa.Table:
        data, offsets, ordered = _texts(of_chunk)
        chunk = ordered.column("chunk")[0].as_py()
        found = Anchors(data, offsets)
        pairs = []
        for packed in answers.column("codes"):
            body = words.unpack(packed.as_py())
            n = int.from_bytes(body[:8], "little")
            pairs.append((words.unpack_sorted(body[8 : len(body) - n]), np.frombuffer(body, np.uint8, n, len(body) - n)))
        known = np.concatenate([k for k, _ in pairs] or [np.empty(0, np.uint64)])
        code = np.concatenate([c for _, c in pairs] or [np.empty(0, np.uint8)])
        order = np.argsort(known)
        known, code = known[order], code[order]
        codes = np.zeros(len(found.place), np.uint8)
        if len(known) and len(codes):
            at = np.minimum(np.searchsorted(known, found.short_key), len(known) - 1)
            codes = np.where(known[at] == found.short_key, code[at], 0)
        ids = _order_ids(ordered.column("doc_id").combine_chunks())
        numbers = ordered.column("number").to_numpy()
        runs, spans = suffix_runs(data, offsets, ids, numbers, codes, found, buckets)
        spans[:, 1:] -= offsets[spans[:, 0]][:, None]
        return pa.table({
            "chunk": pa.array([chunk] * (len(runs) + 1), pa.int64()),
            "bucket": pa.array([-1 - chunk, *runs], pa.int64()),  # spans already known pass by the buckets
            "body": pa.array([words.pack(spans.tobytes()), *map(pack_run, runs.values())], pa.binary()),
        })

    sorted_runs = texts.groupBy("chunk").cogroup(told.groupBy("of_chunk")).applyInArrow(
        sort, "chunk long, bucket long, body binary"
    )

    def merge(of_bucket: pa.Table) -> pa.Table:
        if of_bucket.column("bucket")[0].as_py() < 0:
            return of_bucket.select(["chunk", "body"])
        runs = [unpack_run(b.as_py()) for b in of_bucket.column("body")]
        spans = [words.pack(np.ascontiguousarray(s, np.int64).tobytes()) for s in covered(runs)]
        return pa.table({"chunk": of_bucket.column("chunk"), "body": pa.array(spans, pa.binary())})

    every = sorted_runs.groupBy("bucket").applyInArrow(merge, "chunk long, body binary").toDF("of_chunk", "body")

    def cut(of_chunk: pa.Table, found: pa.Table) -> pa.Table:
        data, offsets, ordered = _texts(of_chunk)
        parts = [np.frombuffer(words.unpack(b.as_py()), np.int64).reshape(-1, 3) for b in found.column("body")]
        spans = np.concatenate(parts or [np.empty((0, 3), np.int64)])
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        counts, removed, kept = [], [], []
        for at, to in words.blocks(offsets, SEGMENT):
            gone, begin, end, of = _runs_of(spans, offsets, at, to)
            low = offsets[at]
            counts.append(np.diff(of))
            removed.append(np.stack([begin, end]) - np.repeat(offsets[at:to] - low, np.diff(of)))
            cuts = (offsets[at : to + 1] - low).tolist()
            kept += [data[low + a : low + b][~gone[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        begin, end = np.concatenate(removed, axis=1) if removed else np.empty((2, 0), np.int64)
        edges = np.concatenate([[0], np.cumsum(np.concatenate(counts or [np.empty(0, np.int64)]))])
        lists = pa.ListArray.from_arrays(
            pa.array(edges.astype(np.int32)), pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], names=["from", "to"])
        )
        return pa.table({
            "doc_id": ordered.column("doc_id"), "n_bytes": pa.array(np.diff(offsets)), "spans": lists,
            "kept": pa.array(kept, pa.binary()),
        })

    return texts.groupBy("chunk").cogroup(every.groupBy("of_chunk")).applyInArrow(
        cut, f"doc_id {id_kind}, n_bytes long, spans array<struct<from: long, to: long>>, kept binary"
    )

"""Token ids as files of length-delimited records, with an index of offsets beside each file.

Format, little-endian.  A record is

    length   8 bytes   of the payload
    check    4 bytes   masked CRC-32 of the 8 bytes
    payload  id (8 bytes, signed), flags (1: no id), width of a token id (2 or 4), token ids
    check    4 bytes   masked CRC-32 of the payload

A checksum c is masked as ``rotate_right(c, 15) + 0xA282EAD8``, so that the checksum
of data that holds checksums stays useful.  ``part-N.idx`` holds for every record of
``part-N.rec`` its id, offset and length (8 bytes each) for reads in any order.

Documents are dealt over files by ranges of the id and stand there in its order, so
files one after the other hold all documents in ascending order.  A task writes
under a name of its own and renames at the end: a repeated task leaves one file.

Defined results: a null text counts as empty and has the end id alone.  A null id
stands last.  Rows with one id stand in the order of their texts.  An empty table
leaves no files and reads back as an empty table.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickbars.llm import units, words
from tickbars.llm.bpe import file_content
from tickbars.session import stored

END_ID = 2
FILE_BYTES = 16 << 20  # of text in a file
BATCH = 4096  # pieces for the library at a time
HEAD = struct.Struct("<QI")
LEAD = struct.Struct("<qBB")
CHECK = struct.Struct("<I")
ENTRY = np.dtype([("id", "<i8"), ("offset", "<u8"), ("length", "<u8")])


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + CHECK.pack(masked(length)) + payload + CHECK.pack(masked(payload))


def payload_of(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return LEAD.pack(doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()


def unframe(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """Id and token ids of the record at *at*, and where the next one starts; raises if a checksum differs."""
    length, check = HEAD.unpack_from(data, at)
    if masked(bytes(data[at : at + 8])) != check:
        raise ValueError(f"damaged length at {at}")
    at += HEAD.size
    payload = data[at : at + length]
    if masked(payload) != CHECK.unpack_from(data, at + length)[0]:
        raise ValueError(f"damaged record at {at}")
    doc_id, none, width = LEAD.unpack_from(payload)
    return None if none else doc_id, np.frombuffer(payload, f"<u{width}", offset=LEAD.size), at + length + CHECK.size


_ENCODERS: dict[str, tuple[units.Encoder | None, object, int]] = {}


def cut_by_pattern(content: str) -> bool:
    """Whether a tokenizer file cuts texts by the byte-level pattern alone, so that pieces can be encoded apart."""
    spec = json.loads(content)
    cut = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        and not cut.get("add_prefix_space") and all(t["content"].startswith("<") for t in spec["added_tokens"])
    )


def _loaded(content: str, by_pieces: bool) -> tuple[units.Encoder | None, object, int]:
    """The library's tokenizer and, where its pattern allows, an encoder over distinct pieces; width of an id."""
    if content not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def encode(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            ids, lengths = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
            for at in range(0, len(found), BATCH):  # an encoding takes far more room than its ids
                texts = [f.decode() for f in found[at : at + BATCH]]
                lists = [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                lengths.append(np.array([len(x) for x in lists], np.int64))
                ids.append(np.fromiter((i for x in lists for i in x), np.uint32, int(lengths[-1].sum())))
            return np.concatenate(ids), np.concatenate(lengths)

        width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
        _ENCODERS[content] = units.Encoder(encode) if by_pieces else None, encode, width
    return _ENCODERS[content]


def _encoded(content: str, by_pieces: bool, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    encoder, encode, _ = _loaded(content, by_pieces)
    data, offsets = words.text_bytes(texts)
    if encoder is not None:
        yield from encoder.texts(data, offsets)
        return
    for at, to in words.blocks(offsets):
        flat, cuts = data[offsets[at] : offsets[to]].tobytes(), (offsets[at : to + 1] - offsets[at]).tolist()
        ids, lengths = encode([flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        yield at, to, ids, np.concatenate([[0], np.cumsum(lengths)])


def write(
    docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text",
    end_id: int = END_ID, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Encode *docs* with the tokenizer file at *path*, write record and index files; a row for each file."""
    spark = docs.sparkSession
    spec = file_content(path)
    content, by_pieces = spark.sparkContext.broadcast(spec), cut_by_pattern(spec)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // file_bytes))
    order = F.col("doc_id").asc_nulls_last()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        store, base = fs.FileSystem.from_uri(folder)
        name, own = f"{base}/part-{part:08d}", f"{base}/_part-{part:08d}-{attempt}"
        out, index, offset, n_ids = None, [], 0, 0
        width = _loaded(content.value, by_pieces)[2]
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{own}.rec")
            numbers = batch.column("doc_id").to_pylist()
            for at, to, ids, edges in _encoded(content.value, by_pieces, batch.column("text")):
                cuts = edges.tolist()
                frames = []
                for i in range(at, to):
                    of_doc = np.append(ids[cuts[i - at] : cuts[i - at + 1]], np.uint32(end_id))
                    frames.append(frame(payload_of(numbers[i], of_doc, width)))
                    index.append((numbers[i] or 0, offset, len(frames[-1])))
                    offset += len(frames[-1])
                    n_ids += len(of_doc)
                out.write(b"".join(frames))
        if out is not None:
            out.close()
            with store.open_output_stream(f"{own}.idx") as file:
                file.write(np.array(index, ENTRY).tobytes())
            for kind in ("idx", "rec"):
                store.move(f"{own}.{kind}", f"{name}.{kind}")
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "file": [f"part-{part:08d}"], "n_docs": [len(index)], "n_ids": [n_ids], "bytes": [offset]}
            )

    dealt = slim.repartitionByRange(parts, order).sortWithinPartitions(order, "text")
    return stored(dealt.mapInArrow(work, "part long, file string, n_docs long, n_ids long, bytes long"), "files")


def _read(spark: SparkSession, folder: str, files: DataFrame, work, schema: str) -> DataFrame:
    """*work* over the contents of the record files; none were written for an empty table."""
    if files.isEmpty():
        return spark.createDataFrame([], schema)
    content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.rec").load(folder)
    part = F.regexp_extract("path", r"part-(\d+)\.rec$", 1).cast("long").alias("part")
    return content.select(part, "content").mapInArrow(work, schema)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int | None], list[np.ndarray]]]:
    for batch in batches:
        for part, content in zip(batch.column("part").to_pylist(), batch.column("content"), strict=True):
            data, at, numbers, found = memoryview(content.as_buffer()), 0, [], []
            while at < len(data):
                number, ids, at = unframe(data, at)
                numbers.append(number)
                found.append(ids)
            yield part, numbers, found


def read(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The documents of all record files: part, place in it, doc_id, ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, numbers, found in _walk(batches):
            for at in range(0, len(found), 1024):
                some = found[at : at + 1024]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part] * len(some), pa.int64()), "place": pa.array(range(at, at + len(some)), pa.int64()),
                    "doc_id": pa.array(numbers[at : at + 1024], pa.int64()),
                    "ids": pa.array([x.astype(np.int64) for x in some], pa.list_(pa.int64())),
                })

    return _read(spark, folder, files, work, "part long, place long, doc_id long, ids array<long>")


def summaries(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start (ids before the document), n_tokens, ids_crc32 (of 32-bit ids)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, numbers, found in _walk(batches):
            sizes = np.array([len(x) for x in found], np.int64)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * len(found), pa.int64()), "doc_id": pa.array(numbers, pa.int64()),
                "local": np.cumsum(sizes) - sizes, "n_tokens": sizes,
                "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64()),
            })

    schema = "part long, doc_id long, local long, n_tokens long, ids_crc32 long"
    found = stored(_read(spark, folder, files, work, schema), "read")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    starts = found.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    return found.join(starts, "part").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def shuffled(spark: SparkSession, folder: str, files: DataFrame, seed: int = 1) -> DataFrame:
    """All documents in a seeded order, each read at the offset that the index gives: position, doc_id, ids."""
    schema = "position long, doc_id long, ids array<long>"
    if files.isEmpty():
        return spark.createDataFrame([], schema)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                rows = np.frombuffer(content.as_buffer(), ENTRY)
                yield pa.RecordBatch.from_pydict({
                    "file": [file] * len(rows), "offset": rows["offset"].astype(np.int64),
                    "length": rows["length"].astype(np.int64),
                })

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        opened: dict[str, object] = {}
        for batch in batches:
            numbers, found = [], []
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if file not in opened:
                    if len(opened) > 64:
                        for old in opened.values():
                            old.close()
                        opened.clear()
                    opened[file] = store.open_input_file(f"{base}/{file}.rec")
                number, ids, _ = unframe(memoryview(opened[file].read_at(length, offset)), 0)
                numbers.append(number)
                found.append(ids.astype(np.int64))
            yield pa.RecordBatch.from_pydict({
                "position": batch.column("position"), "doc_id": pa.array(numbers, pa.int64()),
                "ids": pa.array(found, pa.list_(pa.int64())),
            })

    index = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.idx").load(folder)
    name = F.regexp_extract("path", r"(part-\d+)\.idx$", 1).alias("file")
    listed = index.select(name, "content").mapInArrow(entries, "file string, offset long, length long")
    position = F.xxhash64(F.lit(seed), "file", "offset")
    n = max(1, files.count())
    order = listed.withColumn("position", position).repartitionByRange(n, "position").sortWithinPartitions("position")
    return order.mapInArrow(fetch, schema)

"""Ranked lexical search by range maxima over posting lists.

Two passes over blocks of documents.  The first cuts the texts into terms and writes an
index: a row for each block of some thousand documents, with their ids and lengths and
the postings of the terms that are asked for.  Spark sums documents, terms and
document frequencies over the blocks.  The second pass gives every posting its impact,
builds sparse tables of range maxima over each block's posting lists and searches the
block best-first (``intervals``).  A task keeps its best documents over all its blocks, so
later blocks are cut off sooner, and hands on at most ``k`` documents for each question.

Questions go to the tasks in parts of at most ``PART_TERMS`` terms, which bounds what is
sent; the driver holds one part.  The index of a part covers every document.

A term is a longest run of ASCII letters, digits and characters from U+0080 on, in lower
case (A-Z only), known by a 64-bit key.  The score of a document is a whole number: for
each term of the question, repeats included, its weight ``floor(1000 ln((2N+2)/(2df+1)))``
times ``10^9 tf div (1000 tf + 12 m)``, with ``m = 75 + 25 n N div L``.

Defined results: a null text or question has no term; a document without terms counts
nowhere, a question without terms finds nothing.  Equal scores stand by rising id, null
last.  Repeated rows of documents are documents of their own, repeated rows of questions
are answered each.  Long texts are read whole; a block ends after the batch that fills
it.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm import words
from tickbars.llm.intervals import NO_ID, Best, Block, Questions
from tickbars.session import stored

BLOCK_DOCUMENTS = 1 << 13
BLOCK_POSTINGS = 1 << 19
PART_TERMS = 1 << 18
TASKS_TOGETHER = 256

APART = np.ones(256, bool)
for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    APART[first : last + 1] = False

INDEX = "documents long, terms long, seen array<int>, ids array<long>, lengths array<long>, doc binary, term binary, tf binary"


def term_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the terms of the texts, and len(texts) + 1 offsets into them."""
    data, offsets = words.text_bytes(texts)
    data = words.LOWER[data]
    starts, ends, first = words.word_ranges(data, offsets, APART)
    return words.range_keys(data, starts, ends - starts), first


class _Postings:
    """Documents and postings that wait for their block to fill."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.clear()

    def clear(self) -> None:
        self.ids, self.lengths, self.found, self.documents, self.postings = [], [], [], 0, 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        data_keys, first = term_keys(texts)
        lengths = np.diff(first)
        kept = np.flatnonzero(lengths)
        number = np.cumsum(lengths > 0) - 1 + self.documents
        self.ids.append(ids.take(pa.array(kept)))
        self.lengths.append(lengths[kept])
        place = np.minimum(np.searchsorted(self.keys, data_keys), len(self.keys) - 1)
        hit = self.keys[place] == data_keys
        document = np.repeat(number, lengths)[hit]
        posting, tf = np.unique((place[hit] << 32) | document, return_counts=True)
        self.found.append((posting, tf))
        self.documents += len(kept)
        self.postings += len(posting)

    def full(self) -> bool:
        return self.documents >= BLOCK_DOCUMENTS or self.postings >= BLOCK_POSTINGS

    def row(self) -> pa.RecordBatch:
        """The block's documents by length, then id, and its postings by term, then document."""
        ids, lengths = pa.concat_arrays(self.ids), np.concatenate(self.lengths)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        number = ids.fill_null(NO_ID).to_numpy()
        order = np.lexsort((number, ~known, lengths))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        posting = np.concatenate([p for p, _ in self.found])
        tf = np.concatenate([t for _, t in self.found])
        term, document = posting >> 32, rank[posting & 0xFFFFFFFF]
        by = np.lexsort((document, term))
        packed = [words.pack(a[by].astype(np.int32).tobytes()) for a in (document, term, tf)]
        seen = np.bincount(term, minlength=len(self.keys)).astype(np.int32)
        row = {
            "documents": [len(ids)], "terms": [int(lengths.sum())], "seen": [seen],
            "ids": [ids.take(pa.array(order))], "lengths": [lengths[order]],
            "doc": [packed[0]], "term": [packed[1]], "tf": [packed[2]],
        }
        self.clear()
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], list(row))


def index(docs: DataFrame, keys: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A stored index of all documents with a term: a row a block, with the postings of the sorted term *keys*."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Postings(keys)
        for batch in batches:
            _, offsets = words.text_bytes(batch.column(1))
            for start, end in words.blocks(offsets):
                held.add(batch.column(0).slice(start, end - start), batch.column(1).slice(start, end - start))
                if held.full():
                    yield held.row()
        if held.documents:
            yield held.row()

    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    return stored(rows.mapInArrow(task, INDEX), "search-index")


def statistics(blocks: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms, and the documents that hold each term of the index."""
    total = blocks.agg(F.sum("documents").alias("n"), F.sum("terms").alias("l")).first()
    held = np.zeros(n_terms, np.int64)
    each = blocks.select(F.posexplode("seen").alias("term", "seen")).groupBy("term").agg(F.sum("seen").alias("df"))
    for row in each.where("df > 0").collect():
        held[row["term"]] = row["df"]
    return int(total["n"] or 0), int(total["l"] or 0), held


def _whole_numbers(buffer: bytes) -> np.ndarray:
    return np.frombuffer(words.unpack(buffer), np.int32).astype(np.int64)


def _block(row: dict, n_documents: int, n_terms: int) -> Block:
    ids = np.array([NO_ID if i is None else i for i in row["ids"]], np.int64)
    norm = np.array([75 + 25 * n * n_documents // n_terms for n in row["lengths"]], np.int64)
    doc, term, tf = (_whole_numbers(row[name]) for name in ("doc", "term", "tf"))
    return Block(ids, doc, term, (1_000_000_000 * tf) // (1000 * tf + 12 * norm[doc]))


def _part(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The distinct terms of some questions, and each question's places among them with its repeats."""
    distinct = np.unique(keys)
    asked = [
        np.unique(np.searchsorted(distinct, keys[a:b]), return_counts=True) for a, b in zip(offsets, offsets[1:])
    ]
    return distinct, asked


def _answer(docs: DataFrame, items: list[tuple], k: int, doc_id: str, text: str) -> DataFrame | None:
    """Rows (item_id, rank, doc_id, score) for some questions (id, keys of its terms)."""
    offsets = np.concatenate([[0], np.cumsum([len(keys) for _, keys in items])])
    distinct, asked = _part(np.concatenate([keys for _, keys in items]), offsets)
    blocks = index(docs, distinct, doc_id, text)
    n_documents, n_terms, held = statistics(blocks, len(distinct))
    if not n_documents:
        return None
    weight = np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * int(df) + 1))) for df in held], np.int64)
    questions = Questions(
        np.concatenate([places for places, _ in asked]).astype(np.int64),
        np.concatenate([repeats * weight[places] for places, repeats in asked]).astype(np.int64),
        np.concatenate([[0], np.cumsum([len(places) for places, _ in asked])]),
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(questions.count, k)
        for batch in batches:
            for i in range(batch.num_rows):
                _block(batch.slice(i, 1).to_pylist()[0], n_documents, n_terms).search(questions, best)
        if len(best.question):
            ids = pa.array(best.id, mask=best.id == NO_ID)
            yield pa.RecordBatch.from_pydict({"question": best.question, "score": best.score, "doc_id": ids})

    found = blocks.drop("seen").mapInArrow(task, "question long, score long, doc_id long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # First among the tasks of a group, then among the groups: no question meets all tasks' rows at once.
    group = F.floor(F.spark_partition_id() / TASKS_TOGETHER)
    some = Window.partitionBy("question", "_group").orderBy(*order)
    all_of_it = Window.partitionBy("question").orderBy(*order)
    near = found.withColumn("_group", group).withColumn("_place", F.row_number().over(some)).where(F.col("_place") <= k)
    ranked = near.withColumn("rank", F.row_number().over(all_of_it)).where(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame([(q, i) for q, (i, _) in enumerate(items)], "question long, item_id long")
    return ranked.join(names, "question").select("item_id", "rank", "doc_id", "score")


def _parts(queries: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Questions with their terms' keys, in parts of a bounded number of terms."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, offsets = term_keys(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["item_id", "keys"])

    rows = queries.select(F.col(item_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        task, "item_id long, keys array<long>"
    )
    part, terms = [], 0
    for row in rows.where(F.size("keys") > 0).toLocalIterator():
        if part and terms + len(row["keys"]) > PART_TERMS:
            yield part
            part, terms = [], 0
        part.append((row["item_id"], np.array(row["keys"], np.int64).view(np.uint64)))
        terms += len(row["keys"])
    if part:
        yield part


def search(
    docs: DataFrame, queries: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", query: str = "text",
) -> DataFrame:
    """The *k* documents of highest score above 0 for each row of *queries*: item_id, rank, doc_id, score."""
    answers = [_answer(docs, part, k, doc_id, text) for part in _parts(queries, item_id, query)]
    answers = [a for a in answers if a is not None]
    if not answers:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, answers)

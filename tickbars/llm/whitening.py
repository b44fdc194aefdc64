"""Whitening of embeddings by a QDWH spectral divide-and-conquer.

Spark sums what the fit needs: first how many vectors there are and the sum of each
dimension, in whole numbers; then, with the mean known, the products of centred
entries.  Each task adds up its own rows by matrix products and hands on one number
for each pair of dimensions, which a hash aggregate adds over the tasks.  The covariance
is as wide as a vector, never as long as the table; ``spectral`` splits it on the driver
by polar decompositions of its shifted self into projectors of ever smaller invariant
subspaces.  Mean and components then go to the tasks, ``dimensions * components``
numbers, and each row is projected where it lies: no row is shuffled.

Defined results: a vector that is null, has no entries, or holds a null or non-finite
entry is dropped.  So is one whose length differs from the most frequent length (of
equally frequent ones the largest).  An entry becomes ``floor(64 c) + 1000000``, held
within 2**53 of 0.  A component along which the vectors do not vary (eigenvalue below
rounding of the largest) can't be brought to unit variance and is left out, so equal
vectors or a single one give no rows.  A squared deviation beyond a long is null.  Ids
may be null or repeated: each row has its own result.  An empty table gives an empty
result.  Other columns are not read by the query; :func:`whiten` carries them, and
its result replaces a column of the name it is given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tickbars.llm.spectral import EPS, eigenvectors

COMPONENTS = 32
BLOCK_CELLS = 1 << 20
LOW_BITS = 26
LARGEST = float(1 << 53)


@dataclass(frozen=True)
class Whitening:
    """Mean (whole ``base`` plus ``rest``), exact ``sums`` over ``n`` vectors, components and their shares."""

    n: int
    sums: list[int]
    base: np.ndarray
    rest: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole-number rows."""
        return ((x - self.base) - self.rest) @ (self.vectors / np.sqrt(self.values))


def _whole(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can be used, and their entries as whole numbers, a row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), width), False)
    at = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(at)).flatten()
    entries = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, width)
    sound = np.isfinite(entries).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(64 * entries[sound]) + 1_000_000, -LARGEST, LARGEST)
    return at[sound], scaled.astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    rows = max(1, BLOCK_CELLS // width)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            at, x = _whole(part.column(0), width)
            if len(at):
                yield part, at, x


def _width(vectors: DataFrame, column: str) -> int:
    """The most frequent length of the vectors that are not null."""
    lengths = vectors.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("width")).count()
    top = lengths.where("width > 0").orderBy(F.desc("count"), F.desc("width")).first()
    return top["width"] if top else 0


def _summed(vectors: DataFrame, column: str, task: Callable, names: list[str], kind: str) -> list:
    """Sums over the tasks of what *task* gives for each ``cell``."""
    schema = ", ".join(["cell long", *[f"{name} {kind}" for name in names]])
    parts = vectors.select(column).mapInArrow(task, schema)
    total = F.sum if kind == "double" else lambda name: F.sum(F.col(name).cast("decimal(38,0)"))
    return parts.groupBy("cell").agg(*[total(name).alias(name) for name in names]).orderBy("cell").collect()


def _counts(width: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for _, at, x in _blocks(batches, width):
            n += len(at)
            low += (x & ((1 << LOW_BITS) - 1)).sum(axis=0)
            high += (x >> LOW_BITS).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict(
                {"cell": np.arange(width), "n": np.full(width, n), "low": low, "high": high}
            )

    return task


def _products(width: int, out: int, rows: Callable[[np.ndarray], np.ndarray]) -> Callable:
    """Sums of products of the *out* columns of ``rows(x)``, upper triangle row by row, then of the columns."""
    over, under = np.triu_indices(out)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, plain, found = np.zeros((out, out)), np.zeros(out), False
        for _, _, x in _blocks(batches, width):
            y = rows(x)
            products += y.T @ y
            plain += y.sum(axis=0)
            found = True
        if found:
            values = np.concatenate([products[over, under], plain])
            yield pa.RecordBatch.from_pydict({"cell": np.arange(len(values)), "value": values})

    return task


def _matrix(cells: list, out: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    values = np.array([r["value"] for r in cells])
    over, under = np.triu_indices(out)
    matrix = np.zeros((out, out))
    matrix[over, under] = matrix[under, over] = values[: len(over)] / n
    return matrix, values[len(over) :] / n


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Mean and leading *components* of all usable vectors; None where there are none."""
    width = _width(vectors, column)
    sums = _summed(vectors, column, _counts(width), ["n", "low", "high"], "long") if width else []
    if not sums:
        return None
    n = int(sums[0]["n"])
    total = [int(r["low"]) + (int(r["high"]) << LOW_BITS) for r in sums]
    base = [(2 * s + n) // (2 * n) for s in total]
    rest = np.array([(s - n * b) / n for s, b in zip(total, base)])
    base = np.array(base, np.int64)
    cells = _summed(vectors, column, _products(width, width, lambda x: (x - base) - rest), ["value"], "double")
    covariance, _ = _matrix(cells, width, n)
    values, basis = eigenvectors(covariance)
    kept = np.flatnonzero(values > width * EPS * max(values[0], 0.0))[:components]
    share = values[kept] / np.trace(covariance) if len(kept) else np.empty(0)
    return Whitening(n, total, base, rest, np.ascontiguousarray(basis[:, kept]), values[kept], share)


def identity_error(vectors: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """The largest entry of the whitened vectors' covariance, less the identity; measured on the rows."""
    width, out = model.vectors.shape
    if not out:
        return 0.0
    _, mean = _matrix(_summed(vectors, column, _products(width, out, model.apply), ["value"], "double"), out, model.n)
    centred = _products(width, out, lambda x: model.apply(x) - mean)
    covariance, _ = _matrix(_summed(vectors, column, centred, ["value"], "double"), out, model.n)
    return float(np.abs(covariance - np.eye(out)).max())


def _deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """Sums of squares of ``n x - S``, exact."""
    y = x - model.base
    left = [s - model.n * int(b) for s, b in zip(model.sums, model.base)]
    reach = model.n * (int(np.abs(y).max()) + 1)
    if reach * reach * y.shape[1] < 1 << 63:
        t = y * model.n - np.array(left, np.int64)
        return pa.array((t * t).sum(axis=1))
    exact = [sum((model.n * int(v) - s) ** 2 for v, s in zip(row, left)) for row in y]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def components(vectors: DataFrame, vec_id: str = "vec_id", column: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: the whitened value beside the figures of the fit."""
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    model = fit(vectors, column, count)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error, (width, out) = identity_error(vectors, model, column), model.vectors.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, at, x in _blocks(batches, width) if out else ():
            each = np.repeat(np.arange(len(at)), out)
            ids = part.column(1).take(pa.array(at))
            yield pa.RecordBatch.from_pydict({
                "vec_id": ids.take(pa.array(each)),
                "component": np.tile(np.arange(1, out + 1, dtype=np.int32), len(at)),
                "n": np.full(len(each), model.n),
                "deviation": _deviations(x, model).take(pa.array(each)),
                "whitened": model.apply(x).ravel(),
                "explained": np.tile(model.explained, len(at)),
                "identity_error": np.full(len(each), error),
            })

    return vectors.select(column, F.col(vec_id).cast("long")).mapInArrow(task, schema)


def whiten(vectors: DataFrame, model: Whitening, column: str = "embedding", into: str = "whitened") -> DataFrame:
    """The usable rows of *vectors* with their whitened vector as the column *into*."""
    width = model.vectors.shape[0]
    carried = [f for f in vectors.schema.fields if f.name != into]
    schema = StructType([*carried, StructField(into, ArrayType(DoubleType()))])
    names = [f.name for f in carried]
    # the vector first, whatever else is called like it
    rows = vectors.select(F.col(column).alias("_vector"), F.struct(*names).alias("_row"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, at, x in _blocks(batches, width):
            white = model.apply(x)
            bounds = np.arange(len(at) + 1, dtype=np.int32) * white.shape[1]
            arrays = part.column(1).take(pa.array(at)).flatten()
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.ListArray.from_arrays(pa.array(bounds), pa.array(white.ravel()))], [*names, into]
            )

    return rows.mapInArrow(task, schema)

"""Whitening of embeddings by an incremental eigendecomposition.

The fit list holds each different vector once, in whole numbers. Every
partition takes its rows in as centred rank-one updates of an
eigendecomposition (``secular``). Partitions are combined in a tree of small
groups, each spectrum entering the other by successive rank-one updates, so a
task never holds more than a few of them. The leading vectors are then refined
by Rayleigh-Ritz over the whole fit list: a distributed pass multiplies the
exactly centred rows with the basis, and the small projected problem is solved.
The pass is repeated with the multiplied basis where the residual asks for it.

Rows whose vector is null, empty, or holds null or non-finite entries are left
out. Repeated rows and ids stay rows of their own and count once in the fit
list. All vectors must have one length; another one is an error that names
both. Components without variance cannot be whitened and are left out, so a
table of one different vector, or an empty one, gives no rows. Squared
deviations beyond 64 bits are null. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.scratch import written
from spendwatch.llm.secular import Scatter

#: Whole numbers: floor of ``GRAIN`` times an entry, plus ``SHIFT``.
GRAIN, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Up to this many dimensions the refinement runs over the full basis; beyond, over this many leading vectors.
FULL_BASIS, BASIS = 256, 48
#: Partial results that one task combines.
FAN = 8
#: Refinement passes at most, and the residual, as a share of the leading eigenvalue, that ends them.
PASSES, RESIDUAL = 6, 1e-12
#: Variance below this share of the trace counts as none.
NO_VARIANCE = 1e-13

STATE = "part bigint, n bigint, total array<decimal(38,0)>, mean array<double>, eigenvalues array<double>, eigenvectors array<double>"
SUMS = "part bigint, sums array<double>"


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``n`` different vectors, their sums, components in columns, and how white the result is."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole_vectors(rows: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Usable rows of the table with ``x``, the vector in whole numbers."""
    finite = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).filter(finite)
    return kept.withColumn("x", F.transform(vector_col, lambda c: F.floor(F.lit(float(GRAIN)) * c.cast("double")).cast("long") + F.lit(SHIFT).cast("long")))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Vectors as rows less ``SHIFT``; a vector of another length is an error."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    if (sizes != dimensions).any():
        raise ValueError(f"a vector has {int(sizes[sizes != dimensions][0])} entries, others have {dimensions}")
    return flat.reshape(-1, dimensions) - SHIFT


def _state(part: int, scatter: Scatter, total: list[int]) -> pa.RecordBatch:
    row = {
        "part": part, "n": scatter.count, "total": [Decimal(t) for t in total], "mean": scatter.mean.tolist(),
        "eigenvalues": scatter.values.tolist(), "eigenvectors": scatter.vectors.ravel().tolist(),
    }
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.decimal128(38, 0)), *[pa.list_(pa.float64())] * 3]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))


def _taken_in(dimensions: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter, total = Scatter(dimensions), [0] * dimensions
        for batch in batches:
            x = _matrix(batch.column("x"), dimensions)
            for row in x.astype(np.float64):
                scatter.add(row)
            # sums of up to a batch of 64-bit numbers, in halves that cannot overflow
            high, low = (x >> 32).sum(0).tolist(), (x & 0xFFFFFFFF).sum(0).tolist()
            total = [t + (h << 32) + s for t, h, s in zip(total, high, low)]
        if scatter.count:
            yield _state(TaskContext.get().partitionId(), scatter, total)

    return run


def _merged(dimensions: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        scatter, total, rows = Scatter(dimensions), [0] * dimensions, group.sort_by("part").to_pylist()
        for row in rows:
            vectors = np.array(row["eigenvectors"]).reshape(dimensions, dimensions)
            scatter.merge(row["n"], np.array(row["mean"]), np.array(row["eigenvalues"]), vectors)
            total = [t + int(d) for t, d in zip(total, row["total"])]
        return pa.Table.from_batches([_state(rows[0]["part"] // FAN, scatter, total)])

    return run


def _in_tree(parts: DataFrame, width: int, merge: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """One row out of about ``width`` numbered ones, ``FAN`` of them in a task at a time."""
    while width > FAN:
        parts = parts.groupBy(F.expr(f"part div {FAN}").alias("_group")).applyInArrow(merge, schema)
        width = -(-width // FAN)
    return parts.groupBy(F.lit(0).alias("_group")).applyInArrow(merge, schema)


def _added(group: pa.Table) -> pa.Table:
    rows = group.sort_by("part").to_pylist()
    sums = np.sum([r["sums"] for r in rows], axis=0)
    return pa.table({"part": pa.array([rows[0]["part"] // FAN], pa.int64()), "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n`` with the difference taken in whole numbers where they fit."""
    offset = [s - n * SHIFT for s in sums]
    if (int(np.abs(x).max(initial=0)) + 1) * n + max(map(abs, offset)) < 1 << 62:
        return (x * n - np.array(offset, np.int64)) / n
    return ((x.astype(object) * n - np.array(offset, object)) / n).astype(np.float64)


def _summed(fit: DataFrame, width: int, n: int, sums: list[int], shape: tuple[int, int], work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over the fit list of a matrix made from the centred rows of a batch."""
    dimensions = len(sums)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen = np.zeros(shape), False
        for batch in batches:
            out += work(_centred(_matrix(batch.column("x"), dimensions), n, sums))
            seen = True
        if seen:
            arrays = [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([out.ravel().tolist()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "sums"])

    parts = fit.mapInArrow(run, SUMS)
    row = _in_tree(parts, width, _added, SUMS).first()
    return np.array(row["sums"]).reshape(shape)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on a table whose column ``x`` holds different vectors; None where there is nothing to whiten.

    Only the counts, sums and basis, whose sizes the dimensions bound, come to the driver.
    """
    first = fit.select(F.size("x")).first()
    if first is None:
        return None
    dimensions = first[0]
    states = written(fit.select("x").mapInArrow(_taken_in(dimensions), STATE))
    width = states.agg(F.max("part")).first()[0] + 1
    state = _in_tree(states, width, _merged(dimensions), STATE).first()
    n, sums = state["n"], [int(t) + state["n"] * SHIFT for t in state["total"]]
    trace = float(np.sum(state["eigenvalues"])) / n
    if trace <= 0:
        return None
    size = dimensions if dimensions <= FULL_BASIS else max(BASIS, 2 * components)
    basis = np.array(state["eigenvectors"]).reshape(dimensions, dimensions)[:, ::-1][:, :size]
    for _ in range(PASSES):
        basis = np.linalg.qr(basis)[0]
        image = _summed(fit, width, n, sums, basis.shape, lambda c, b=basis: c.T @ (c @ b)) / n
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:components], turn[:, ::-1]
        vectors = basis @ turn[:, :components]
        residual = np.abs(image @ turn[:, :components] - vectors * values).max()
        if residual <= RESIDUAL * values[0] or size == dimensions:
            break
        basis = image @ turn
    there = values > NO_VARIANCE * trace
    values, vectors = values[there], vectors[:, there]
    if not len(values):
        return None
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])
    scaled = vectors / np.sqrt(values)
    white = _summed(fit, width, n, sums, (len(values) + 1, len(values)), lambda c: np.vstack(((c @ scaled).T @ (c @ scaled), (c @ scaled).sum(0)))) / n
    off = white[:-1] - np.outer(white[-1], white[-1]) - np.eye(len(values))
    return Whitening(n, sums, vectors, values, values / trace, float(np.abs(off).max()))


def whiten(rows: DataFrame, fitted: Whitening, keep: list[str]) -> DataFrame:
    """``row`` (the kept columns), ``deviation`` and ``whitened``, one array per row with ``x``; a narrow pass."""
    n, sums = fitted.n, fitted.sums
    scaled = fitted.vectors / np.sqrt(fitted.variances)
    dimensions = len(sums)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offset = [s - n * SHIFT for s in sums]
        for batch in batches:
            x = _matrix(batch.column("x"), dimensions)
            bound = (int(np.abs(x).max(initial=0)) + 1) * n + max(map(abs, offset))
            exact = bound * bound * dimensions < 1 << 63
            step = x * n - np.array(offset, np.int64) if exact else x.astype(object) * n - np.array(offset, object)
            deviation = [int(v) if v < 1 << 63 else None for v in (step * step).sum(1).tolist()]
            white = _centred(x, n, sums) @ scaled
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(deviation, pa.int64()), flat], names=["row", "deviation", "whitened"])

    only = rows.select(F.struct(*[rows[c] for c in keep]).alias("row"), "x")
    return only.mapInArrow(run, f"row {only.schema['row'].dataType.simpleString()}, deviation bigint, whitened array<double>")


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every usable row and component."""
    usable = whole_vectors(rows.select(rows[id_col].alias("vec_id"), rows[vector_col].alias("_vector")), "_vector").select("vec_id", "x")
    fitted = fit_whitening(written(usable.select("x").distinct()), components)
    if fitted is None:
        kind = rows.schema[id_col].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(float(s)) for s in fitted.explained])
    each = whiten(usable, fitted, ["vec_id"]).select("row.vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"), F.lit(fitted.identity_error).alias("identity_error"),
    )

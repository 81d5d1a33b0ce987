"""Embedding whitening by bit-sliced cross-products.

Components become integers, shifted per dimension so that none is negative. A block of rows
is turned into bit planes: bit b of dimension i over 64 rows is one word. The sum of
``y_i * y_j`` over rows is then the sum over pairs of planes of ``2**(a + b)`` times the number
of ones in their AND, which is exact, whatever the order of rows, blocks and tasks. The
covariance is centred as integers (``n * C - S S'``) and divided once, so eigenvectors carry
no error of cancellation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwatch.session import cut_lineage, ready_python

SCALE, SHIFT = 1024, 100_000  # an entry c becomes floor(SCALE * c) + SHIFT
BLOCK_ROWS, BLOCK_BYTES = 8192, 16 << 20  # rows that are sliced at once: whichever bound is met first
MAX_DIM = 4096  # the driver holds a few matrices of dim x dim


@dataclass(frozen=True)
class Whitener:
    """A fit: ``n`` rows, integer sums per dimension, unit eigenvectors (columns) by falling eigenvalue."""

    n: int
    sums: list[int]
    low: list[int]
    high: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v``: the rows' keys and vectors; other number types than floats become doubles."""
    kind = rows.schema[vector].dataType.simpleString()
    v = F.col(f"`{vector}`")
    return rows.select(F.col(f"`{key}`").alias("id"), (v if kind in ("array<float>", "array<double>") else v.cast("array<double>")).alias("v"))


def _sound(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lists that are not null and hold no null or non-finite entry, and their lengths."""
    offsets = lists.offsets.to_numpy()
    entries = lists.values
    values = entries.to_numpy(zero_copy_only=False)  # nulls become NaN
    wrong = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    good = (wrong[offsets[1:]] == wrong[offsets[:-1]]) & np.asarray(lists.is_valid())
    at = np.nonzero(good)[0]
    return at, np.diff(offsets)[at]


def _integers(lists: pa.ListArray, at: np.ndarray, dim: int) -> np.ndarray:
    """The integers of the lists at ``at``, all of length ``dim``."""
    scaled = np.floor(lists.take(pa.array(at)).flatten().to_numpy().astype(float).reshape(-1, dim) * SCALE)
    if scaled.size and np.abs(scaled).max() >= 1 << 62:
        raise ValueError("an entry does not fit a long after scaling")
    return scaled.astype(np.int64) + SHIFT


def _blocks(matrices: Iterator[np.ndarray], dim: int) -> Iterator[np.ndarray]:
    """The same rows in matrices of up to a block of rows."""
    most, held, n = max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dim))), [], 0
    for m in matrices:
        for at in range(0, len(m), most):
            held.append(m[at : at + most])
            n += len(held[-1])
            if n >= most:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


def _usual(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Per batch of ``id, v``: ids and integers of the sound vectors of length ``dim``."""
    for batch in batches:
        at, dims = _sound(batch.column(1))
        at = at[dims == dim]
        if len(at):
            yield batch.column(0).take(pa.array(at)), _integers(batch.column(1), at, dim)


def bit_planes(y: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Planes x words: bit b of column i over all rows, dimension by dimension, low bits first. ``y`` is not negative."""
    n = len(y)
    words = -(-n // 64)
    out = np.zeros((int(bits.sum()), words * 8), dtype=np.uint8)
    at = 0
    for i, width in enumerate(bits.tolist()):
        column = np.ascontiguousarray(y[:, i])
        planes = (column[None, :] >> np.arange(width, dtype=np.int64)[:, None]) & 1
        out[at : at + width, : -(-n // 8)] = np.packbits(planes.astype(np.uint8), axis=1)
        at += width
    return out.view(np.uint64)


def cross_products(planes: np.ndarray, bits: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Sums per dimension and, for each i, the cross-products with j >= i: weighted counts of ones, exact integers."""
    first = np.concatenate(([0], np.cumsum(bits)))[:-1]
    exponent = np.concatenate([np.arange(b) for b in bits.tolist()]) if len(bits) else np.zeros(0, int)
    # weights and counts as machine integers while their sums cannot overflow
    safe = 2 * int(bits.max(initial=1)) + (planes.shape[1] * 64).bit_length() < 62
    kind = np.int64 if safe else object
    weight = np.array([1 << int(b) for b in exponent], dtype=kind)

    def per_dimension(counts: np.ndarray, start: int) -> np.ndarray:
        return np.add.reduceat(counts.astype(kind) * weight[start:], first[first >= start] - start)

    ones = np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
    sums, rows = [int(s) for s in per_dimension(ones, 0)], []
    for i, (start, width) in enumerate(zip(first.tolist(), bits.tolist())):
        total = 0
        for b in range(width):
            both = np.bitwise_count(planes[start + b] & planes[start:]).sum(axis=1, dtype=np.int64)
            total = total + per_dimension(both, start) * (1 << b)
        rows.append([int(c) for c in total])
    return sums, rows


def limits(rows: DataFrame) -> DataFrame:
    """``dim, n, low, high``: per task and length of vectors, how many there are and the limits of each dimension."""

    def run(batches):
        seen: dict[int, list] = {}
        for batch in batches:
            at, dims = _sound(batch.column(1))
            for dim in np.unique(dims).tolist():
                m = _integers(batch.column(1), at[dims == dim], dim) if dim else np.zeros((int((dims == 0).sum()), 0), np.int64)
                n, low, high = seen.get(dim, (0, m[0], m[0]))
                seen[dim] = [n + len(m), np.minimum(low, m.min(axis=0)), np.maximum(high, m.max(axis=0))]
        many, longs = pa.list_(pa.int64()), [*zip(*seen.values())] or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), *(pa.array(c, k) for c, k in zip(longs, (pa.int64(), many, many)))], names=["dim", "n", "low", "high"])

    return rows.mapInArrow(run, "dim int, n long, low array<long>, high array<long>")


def fit(rows: DataFrame) -> Whitener | None:
    """Fits on all sound rows of ``id, v`` whose vector has the usual length; None where there is none.

    Two passes: limits per dimension (a row per task and length), then the bit-sliced sums
    (a row per task and pair of dimensions). Both are added up by Spark; the driver gets
    one row per dimension and pair of dimensions, and solves the eigenproblem.
    """
    ready_python(rows.sparkSession)
    found = cut_lineage(limits(rows), "limits")
    lengths = found.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not lengths or lengths[0]["dim"] == 0:
        return None
    dim, n = lengths[0]
    if dim > MAX_DIM:
        raise ValueError(f"vectors of {dim} components; the covariance of at most {MAX_DIM} is solved")
    each = found.where(F.col("dim") == dim).select(F.posexplode(F.arrays_zip("low", "high")).alias("i", "limit"))
    ends = {r["i"]: r for r in each.groupBy("i").agg(F.min("limit.low").alias("low"), F.max("limit.high").alias("high")).collect()}
    low, high = [ends[i]["low"] for i in range(dim)], [ends[i]["high"] for i in range(dim)]
    bits = np.array([(h - lo).bit_length() for lo, h in zip(low, high)], dtype=np.int64)
    wide = np.nonzero(bits)[0]  # a dimension that never changes has no plane and no covariance

    def scatter(batches):
        sums, pairs = np.zeros(len(wide), dtype=object), [np.zeros(len(wide) - i, dtype=object) for i in range(len(wide))]
        for m in _blocks((m for _, m in _usual(batches, dim)), dim):
            s, c = cross_products(bit_planes(m[:, wide] - np.array(low)[wide], bits[wide]), bits[wide])
            sums += np.array(s, dtype=object)
            for have, new in zip(pairs, c):
                have += np.array(new, dtype=object)
        total = pa.decimal128(38, 0)
        for i in range(-1, len(wide)):
            values = sums if i < 0 else pairs[i]
            js = np.arange(max(i, 0), len(wide), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(js), i, np.int32)), pa.array(js), pa.array([int(v) for v in values], total)], names=["i", "j", "s"]
            )

    shifted, cross = [0] * dim, [[0] * dim for _ in range(dim)]
    if len(wide):
        for r in rows.mapInArrow(scatter, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
            j = int(wide[r["j"]])
            if r["i"] < 0:
                shifted[j] = int(r["s"])
            else:
                i = int(wide[r["i"]])
                cross[i][j] = cross[j][i] = int(r["s"])
    covariance = np.array([[(n * cross[i][j] - shifted[i] * shifted[j]) / (n * n) for j in range(dim)] for i in range(dim)])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = sum(n * cross[i][i] - shifted[i] ** 2 for i in range(dim)) / (n * n)
    return Whitener(n, [s + n * lo for s, lo in zip(shifted, low)], low, high, vectors, values, trace)


def project(rows: DataFrame, model: Whitener, components: int = 8) -> DataFrame:
    """``id, deviation, whitened``: exact squared deviation (times n squared) and the first components, over sqrt(e).

    Components whose eigenvalue is zero but for rounding cannot be whitened and are left out, so
    ``whitened`` may be shorter than ``components``. Vectors of another length than the fit's take no part.
    """
    ready_python(rows.sparkSession)
    dim, n = len(model.sums), model.n
    real = int((model.values > model.values.max(initial=0) * dim * 1e-14).sum())
    count = min(components, real)
    axes = model.vectors[:, :count] / np.sqrt(model.values[:count])
    widest = max(max(abs(n * lo - s), abs(n * h - s)) for lo, h, s in zip(model.low, model.high, model.sums))
    safe = dim * widest**2 < 1 << 63 and max(n * max(map(abs, (lo, h))) for lo, h in zip(model.low, model.high)) < 1 << 63
    kind = np.int64 if safe else object
    sums = np.array(model.sums, dtype=kind)

    def run(batches):
        for ids, m in _usual(batches, dim):
            off = m.astype(kind) * n - sums
            squares = (off * off).sum(axis=1)
            white = (off / n).astype(float) @ axes
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([int(s) for s in squares], pa.decimal128(38, 0)), pa.array(list(white), pa.list_(pa.float64()))],
                names=["id", "deviation", "whitened"],
            )

    key = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {key}, deviation decimal(38,0), whitened array<double>")


def identity_error(projected: DataFrame) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity: means first, then centred products."""
    count = projected.agg(F.max(F.size("whitened"))).first()[0]
    if not count:
        return 0.0
    means = projected.agg(*[F.avg(F.col("whitened")[k]) for k in range(count)]).first()

    def products(batches):
        total, n = np.zeros((count, count)), 0
        for m in _blocks((b.column(0).flatten().to_numpy().reshape(-1, count) for b in batches), count):
            off = m - np.array(means)
            total, n = total + off.T @ off, n + len(m)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count * count, dtype=np.int32)), pa.array(total.ravel()), pa.array(np.full(count * count, n))], names=["k", "s", "n"])

    sums = projected.select("whitened").mapInArrow(products, "k int, s double, n long").groupBy("k").agg((F.sum("s") / F.sum("n")).alias("v")).collect()
    return max(abs(r["v"] - (r["k"] % (count + 1) == 0)) for r in sums)


def whiten(rows: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: ``key, component, n, deviation, whitened, explained, identity_error``.

    Vectors that are null or hold null or non-finite entries are dropped. Those that remain are the
    fit list, repeated rows and ties included, each row counted; a null key is kept. All fitted vectors have one
    length, the one most rows have (ties: the longer); others take no part. An entry must fit a long after scaling,
    else the query fails. Components are numbered from 1 by falling eigenvalue; those
    without variance are left out, so an empty table, one row, or equal rows give no rows. Other columns are not read.
    ``deviation`` is the sum over dimensions of ``(n x - S)^2`` (decimal), ``explained`` the eigenvalue's share
    of the trace, ``identity_error`` one value for the whole fit.
    """
    spark = rows.sparkSession
    x = usable(rows, key, vector)
    kind = rows.schema[key].dataType.simpleString()
    model = fit(x)
    names = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or model.trace <= 0:
        return spark.createDataFrame([], names)
    projected = cut_lineage(project(x, model, components), "whitened")
    error = identity_error(projected)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values[:components]])
    each = projected.select("id", "deviation", F.posexplode("whitened").alias("k", "w"))
    return each.select(
        F.col("id").alias(key), (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.col("w").alias("whitened"), F.element_at(shares, F.col("k") + 1).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )

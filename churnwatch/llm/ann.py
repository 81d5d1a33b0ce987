"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector is rotated and reduced to the signs of its components (packed bits) plus two
scalars: its length and the inner product between its direction and its code's. From
these the inner product with a query, itself cut into four bit planes, is estimated
without bias by counting common bits, with a known error bound; only vectors whose upper
bound reaches the k-th best exact value so far are compared exactly, in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from churnwatch.session import cut_lineage, ready_python

SEED = 20_240_229
ERROR_WIDTH = 2.5  # standard widths of the estimate's error that the bounds allow for
QUERY_BLOCK, ROW_BLOCK = 8192, 8192  # rows that a block holds on average
PLANES = 4  # bits of a query's component
FIRST = 8  # times k: the best estimates that are compared exactly for a first k-th best
PAIRS_AT_ONCE = 1 << 15


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v``: rows with a key and a finite, non-zero vector, in single precision where it is stored so."""
    single = rows.schema[vector].dataType == ArrayType(FloatType(), rows.schema[vector].dataType.containsNull)
    v = F.col(f"`{vector}`") if single else F.col(f"`{vector}`").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & good)


def encode(rows: DataFrame) -> DataFrame:
    """Adds ``dim``, ``bits`` (packed signs after rotation), ``length`` and ``fit`` (direction times code)."""

    def run(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            dims = np.asarray(pc.list_value_length(lists))
            for dim in np.unique(dims):
                at = np.nonzero(dims == dim)[0]
                v = lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim).astype(np.float64)
                length = np.linalg.norm(v, axis=1)
                turned = (v / length[:, None]) @ rotation(int(dim)).T
                bits = np.packbits(turned > 0, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at)), lists.take(pa.array(at)), pa.array(np.full(len(at), dim, np.int32)),
                        pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length),
                        pa.array(np.abs(turned).sum(axis=1) / np.sqrt(dim)),
                    ],
                    names=["id", "v", "dim", "bits", "length", "fit"],
                )

    return rows.mapInArrow(run, f"id long, v {rows.schema['v'].dataType.simpleString()}, dim int, bits binary, length double, fit double")


def _exact(q: np.ndarray, c: np.ndarray, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Inner products of pairs, each summed in the same order, so equal vectors give equal values."""
    out = np.empty(len(qi))
    for at in range(0, len(qi), PAIRS_AT_ONCE):
        s = slice(at, at + PAIRS_AT_ONCE)
        out[s] = (q[qi[s]].astype(np.float64) * c[ci[s]]).sum(axis=1)
    return out


def _words(bits: np.ndarray) -> np.ndarray:
    """Packed bits as 64-bit words, one row a word place."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 8) * 8), np.uint8)
    wide[:, : bits.shape[1]] = bits
    return np.ascontiguousarray(wide.view(np.uint64).T)


def _planes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Rotated queries in ``2 ** PLANES`` even levels: lowest value, step, and the levels' bits as words."""
    low = turned.min(axis=1)
    step = (turned.max(axis=1) - low) / ((1 << PLANES) - 1)
    level = np.rint((turned - low[:, None]) / np.where(step > 0, step, 1)[:, None]).astype(np.uint8)
    return low, step, [_words(np.packbits((level >> j) & 1, axis=1)) for j in range(PLANES)]


def common_bits(planes: list[np.ndarray], codes: np.ndarray, part: slice) -> np.ndarray:
    """Sum over each code's set bits of each query's levels, from packed words alone."""
    total = np.zeros((len(planes[0][0][part]), codes.shape[1]), np.uint32)
    for j, plane in enumerate(planes):
        for mine, theirs in zip(plane, codes):
            total += np.left_shift(np.bitwise_count(mine[part][:, None] & theirs), j, dtype=np.uint32)
    return total


def search_block(q_ids, q, ids, vectors, bits, length, fit, k: int):
    """The k best of one block of rows for each query of a block, and how many pairs were compared exactly."""
    dim, n = q.shape[1], len(ids)
    codes = _words(bits)
    ones = np.bitwise_count(codes).sum(axis=0, dtype=np.int64).astype(np.float32)
    turned = q.astype(np.float64) @ rotation(dim).T
    low, width, planes = _planes(turned)
    whole = turned.sum(axis=1)
    scale = (length / fit / np.sqrt(dim)).astype(np.float32)
    # variances of the estimate over length / fit: of the code, a query's length squared, and of the query's levels
    of_code, of_levels = np.maximum(1 - fit**2, 0) / max(dim - 1, 1), width**2 / 12
    q_length = np.linalg.norm(turned, axis=1)
    error = (ERROR_WIDTH * length / fit).astype(np.float32)
    out, compared, step = [], 0, max(1, (1 << 21) // n)
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        sums = np.outer(low[part].astype(np.float32), ones) + width[part].astype(np.float32)[:, None] * common_bits(planes, codes, part)
        guess = (2 * sums - whole[part].astype(np.float32)[:, None]) * scale
        m, top = len(guess), min(n, FIRST * k + 1)
        best = np.argpartition(-guess, top - 1, axis=1)[:, :top] if top < n else np.tile(np.arange(n), (m, 1))
        rows = np.repeat(np.arange(m), top)
        known = _exact(q[part], vectors, rows, best.ravel())
        known[ids[best.ravel()] == q_ids[part][rows]] = -np.inf
        floor = np.sort(known.reshape(m, top), axis=1)[:, max(0, top - k)]
        spread = np.outer(q_length[part].astype(np.float32) ** 2, of_code.astype(np.float32)) + of_levels[part].astype(np.float32)[:, None]
        reach = guess + error * np.sqrt(spread)
        np.put_along_axis(reach, best, np.inf, axis=1)
        # bounds are in single precision; the margin covers its rounding
        qi, ci = np.nonzero(reach >= (floor - 1e-5 * np.abs(floor))[:, None])
        compared += len(qi)
        score = _exact(q[part], vectors, qi, ci)
        keep = (ids[ci] != q_ids[part][qi]) & (score >= floor[qi])
        qi, ci, score = qi[keep], ci[keep], score[keep]
        order = np.lexsort((ids[ci], -score, qi))
        qi, ci, score = qi[order], ci[order], score[order]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi)
        kept = place < k
        out.append((q_ids[part][qi[kept]], ids[ci[kept]], score[kept]))
    return [np.concatenate(x) for x in zip(*out)], compared


def nearest(rows: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every query, nearest first, ties to the smaller id.

    ``is_query`` is a condition on ``id``. Rows without a key, and vectors that are null,
    empty, zero or hold null or non-finite components, take no part; vectors of another
    length than the query's are not its candidates. Repeated rows count once; a key with several
    vectors is searched for each and found by its nearest. Of equal vectors only the
    ``k + 1`` smallest ids can be among the nearest, so copies beyond those are left out
    before the search. Queries and rows meet block by block: each side is dealt into
    blocks of bounded mean size and every pair of blocks is one group. An empty table
    gives no rows.
    """
    ready_python(rows.sparkSession)
    good = usable(rows, key, vector)
    alike = Window.partitionBy("v").orderBy("id")
    chosen = good.withColumn("nth", F.dense_rank().over(alike)).where(F.col("nth") <= k + 1).select("id", "v").distinct()
    index = cut_lineage(encode(chosen), "ann-index")
    queries = cut_lineage(good.where(is_query(F.col("id"))).distinct(), "ann-queries")
    n_rows, n_queries = index.count(), queries.count()
    row_blocks, query_blocks = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))

    def dealt(n):
        return F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")

    left = queries.select("id", "v", F.size("v").alias("dim"), dealt(query_blocks).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"))
    right = index.select("id", "v", "bits", "length", "fit", "dim", dealt(row_blocks).alias("rb"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not q.num_rows or not c.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        dim = c["dim"][0].as_py()
        matrix = lambda t: t["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        bits = np.frombuffer(b"".join(c["bits"].to_pylist()), np.uint8).reshape(c.num_rows, -1)
        found, _ = search_block(
            q["id"].to_numpy(), matrix(q), c["id"].to_numpy(), matrix(c), bits, c["length"].to_numpy(), c["fit"].to_numpy(), k
        )
        return pa.table([pa.array(x) for x in found], names=names)

    pairs = left.groupBy("qb", "rb", "dim").cogroup(right.groupBy("qb", "rb", "dim")).applyInArrow(run, "query_id long, vec_id long, score double")
    best = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

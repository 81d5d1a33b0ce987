from decimal import Decimal
from fractions import Fraction
from math import floor, inf, nan

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from churnwatch.llm import queries, whitening
from tests.conftest import SF001


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 5), st.integers(0, 40), st.randoms(use_true_random=False))
def test_bit_sliced_sums_are_exact(n, dim, width, random):
    y = np.array([[random.randrange(1 << (width if i else 3)) for i in range(dim)] for _ in range(n)], dtype=np.int64)
    bits = np.array([max(1, int(y[:, i].max()).bit_length()) for i in range(dim)])
    sums, pairs = whitening.cross_products(whitening.bit_planes(y, bits), bits)
    plain = y.astype(object)
    assert sums == [int(s) for s in plain.sum(axis=0)]
    assert pairs == [[int((plain[:, i] * plain[:, j]).sum()) for j in range(i, dim)] for i in range(dim)]


def brute(vectors):
    """The contract in exact fractions, but for the eigenvectors."""
    x = [[floor(1024 * Fraction(c)) + 100_000 for c in v] for v in vectors]
    n, dim = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(dim)]
    v = np.array([[float(sum((Fraction(r[i]) - Fraction(sums[i], n)) * (Fraction(r[j]) - Fraction(sums[j], n)) for r in x) / n) for j in range(dim)] for i in range(dim)])
    return x, n, sums, v


def check(found, vectors, components=8):
    """``found``: rows by (place of the vector, component)."""
    x, n, sums, v = brute(vectors)
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    white = {}
    for k, row in enumerate(x):
        for c in range(1, components + 1):
            r = found[k, c]
            assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(row, sums))
            assert abs(r.explained - values[c - 1] / np.trace(v)) <= 1e-9
            assert r.identity_error <= 1e-4
            white[k, c] = r.whitened
    # the axes are recovered from the results: each must be an eigenvector of V
    centred = np.array([[float(Fraction(a) - Fraction(s, n)) for a, s in zip(row, sums)] for row in x])
    for c in range(1, components + 1):
        w = np.array([white[k, c] for k in range(n)])
        axis = np.linalg.lstsq(centred, w * np.sqrt(values[c - 1]), rcond=None)[0]
        assert abs(np.linalg.norm(axis) - 1) < 1e-8
        assert np.abs(v @ axis - values[c - 1] * axis).max() < 1e-7 * values[0]


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()
    place = {r.vec_id: k for k, r in enumerate(rows)}
    got = queries.op11_bit_sliced_whitening(spark, SF001)
    assert dict(got.dtypes)["deviation"] == "bigint"
    found = {(place[r.vec_id], r.component): r for r in got.collect()}
    assert len(found) == 8 * len(rows)
    x, n, sums, v = brute([[c for c in r.embedding] for r in rows[:40]])
    assert n == 40 and len(sums) == 64
    some = {k: r for k, r in found.items()}
    exact = [[floor(1024 * c) + 100_000 for c in r.embedding] for r in rows]
    total = [sum(col) for col in zip(*exact)]
    for (k, _), r in some.items():
        assert r.n == len(rows) and r.deviation == sum((len(rows) * a - s) ** 2 for a, s in zip(exact[k], total))
    white = np.array([[found[k, c].whitened for c in range(1, 9)] for k in range(len(rows))])
    white -= white.mean(axis=0)
    error = np.abs(white.T @ white / len(rows) - np.eye(8)).max()
    assert error < 1e-9 and abs(found[0, 1].identity_error - error) < 1e-9
    shares = [found[0, c].explained for c in range(1, 9)]
    assert shares == sorted(shares, reverse=True) and sum(shares) < 1


def test_small_frames(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(c) for c in rng.normal(size=3) * [1, 5, 0.2]] for _ in range(70)]
    vectors += vectors[:5]  # repeated rows count
    bad = [None, [None, 1.0, 2.0], [nan, 1.0, 2.0], [inf, 1.0, 2.0], [], [1.0, 2.0]]
    rows = [(k, v, "x", 1) for k, v in enumerate(vectors)] + [(1000 + k, v, "x", 1) for k, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, x string, component int").repartition(5)
    got = whitening.whiten(df)
    found = {(r.vec_id, r.component): r for r in got.collect()}
    assert len(found) == 75 * 3  # three dimensions, three components; bad vectors are gone
    check(found, vectors, 3)
    keyless = whitening.whiten(df.selectExpr("case when vec_id > 3 then vec_id end as vec_id", "embedding")).collect()
    assert sum(r.vec_id is None for r in keyless) == 4 * 3


def test_rank_and_size_limits(spark):
    twice = [(k, [float(k % 7), 2.0 * (k % 7), 5.0, float(k % 3)]) for k in range(42)]
    df = spark.createDataFrame(twice, "vec_id long, embedding array<double>")
    found = whitening.whiten(df).collect()
    assert {r.component for r in found} == {1, 2} and abs(sum({r.component: r.explained for r in found}.values()) - 1) < 1e-9
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.limit(1)).count() == 0
    wide = spark.createDataFrame([(k, [float(s * 2**40), float(k)]) for k, s in enumerate([1, -1, 1, 0])], "vec_id long, embedding array<double>")
    x = [[floor(1024 * c) + 100_000 for c in r.embedding] for r in wide.collect()]
    sums = [sum(c) for c in zip(*x)]
    for r in whitening.whiten(wide).collect():  # beyond what machine integers hold
        assert r.deviation == Decimal(sum((4 * a - s) ** 2 for a, s in zip(x[r.vec_id], sums)))

"""Trailing ranges over dense series: running aggregates only, and the same values as by brute force."""

import random
from datetime import datetime, timedelta

import pytest

from churnwatch.operators import series as SE
from tests.test_plans import plan_of

T0 = datetime(2024, 1, 1)


def dense(spark, n=400, seed=4):
    """Samples close together beside long gaps, before 1970 too, with times and values that are missing; no two at one time."""
    rng, t, rows = random.Random(seed), datetime(1969, 12, 31, 23, 50), []
    for k in range(n):
        t += timedelta(microseconds=rng.choice([1, 7, 1_000_000, 1_000_000, 9_999_999, 10_000_000, 60_000_000]))
        rows.append((t, "m", "s", None if k % 37 == 5 else float(rng.randrange(4))))
    return rows, spark.createDataFrame([*rows, (None, "m", "s", 1.0)], "ts timestamp_ntz, metric string, series string, value double").repartition(3)


def windows(rows, seconds):
    for t, *_ in rows:
        yield t, [r for r in rows if t - timedelta(seconds=seconds) < r[0] <= t]


def sliding(df):
    """Window frames that do not begin at the partition's start: Spark goes over all their rows again for every row."""
    return [line for line in plan_of(df).splitlines() if "RangeFrame, -" in line]


@pytest.mark.parametrize("seconds", [1, 10, 3600])
def test_increase_is_running_and_equals_brute_force(spark, seconds):
    rows, df = dense(spark)
    out = SE.increase(df, seconds, True)
    assert not sliding(out)
    got, want = {r.ts: (r.increase, round(r.covered, 6)) for r in out.collect()}, {}
    for t, w in windows(rows, seconds):
        if len(w) < 2:
            continue
        # a NULL value gives a NULL step, which sums leave out; that to the first sample, from outside the window, makes the sum NULL
        first = rows.index(w[0])
        steps = [0.0 if a[3] is None else None if b[3] is None else b[3] if b[3] < a[3] else b[3] - a[3] for a, b in zip(w, w[1:])]
        total = None if first and rows[first - 1][3] is not None and w[0][3] is None else sum(x for x in steps if x is not None)
        want[t] = total, round((t - w[0][0]).total_seconds(), 6)
    assert got == want and len(want) > 50 and any(x is None for x, _ in want.values())


@pytest.mark.parametrize("seconds", [1, 10, 3600])
def test_changes_are_running_and_equal_brute_force(spark, seconds):
    rows, df = dense(spark, seed=6)
    out = SE.changes(df, seconds)
    assert not sliding(out)
    want = {t: sum(a[3] is not None and b[3] is not None and a[3] != b[3] for a, b in zip(w, w[1:])) for t, w in windows(rows, seconds)}
    assert {r.ts: r.changes for r in out.collect()} == want


def test_samples_at_one_time_are_one_window(spark):
    rows = [(T0, 1.0), (T0, 1.0), (T0 + timedelta(seconds=5), 4.0), (T0 + timedelta(seconds=5), 4.0), (T0 + timedelta(seconds=11), 2.0)]
    df = spark.createDataFrame([(t, "m", "s", v) for t, v in rows], "ts timestamp_ntz, metric string, series string, value double")
    got = sorted((r.ts, r.increase, r.covered) for r in SE.increase(df, 10).collect())
    assert got == [(T0, 0.0, 0.0)] * 2 + [(T0 + timedelta(seconds=5), 3.0, 5.0)] * 2 + [(T0 + timedelta(seconds=11), 2.0, 6.0)]


def test_changes_keep_the_last_sample_before_a_block(spark):
    """A sample many ranges after the one before it is alone in its window, and its own step is not counted."""
    rows = [(T0, 1.0), (T0 + timedelta(seconds=95), 2.0), (T0 + timedelta(seconds=96), 2.0), (T0 + timedelta(seconds=300), 3.0)]
    df = spark.createDataFrame([(t, "m", "s", v) for t, v in rows], "ts timestamp_ntz, metric string, series string, value double")
    out = SE.changes(df, 10)
    assert not sliding(out) and [r.changes for r in out.orderBy("ts").collect()] == [0, 0, 0, 0]

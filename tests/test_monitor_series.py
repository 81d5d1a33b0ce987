"""Windows of counts against the plain operators, the evaluation grid and chunked series against brute force."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from churnwatch.operators import drift as D
from churnwatch.operators import drift_series as DS
from churnwatch.operators import grid as G
from churnwatch.operators import quality as QU
from churnwatch.operators import series as SE

T0 = datetime(2024, 1, 1)


def log_rows(n=400, seed=4):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        ts = T0 + timedelta(hours=240 * k / n, microseconds=rng.randrange(10**6))
        x = None if rng.random() < 0.1 else math.nan if rng.random() < 0.1 else rng.choice([0.0, -0.0, 1.0, rng.gauss(k / 50, 2)])
        out.append((ts, k < n // 4, x, rng.choice(["a", "b", None, "c" if k > n // 2 else "a"]), None if 250 < k < 330 else "z"))
    return out + [(None, False, 1.0, "a", "z"), (None, True, 1.0, "a", "z"), (T0, None, 9.0, "q", "q")]


def test_windows_equal_the_plain_report(spark):
    df = spark.createDataFrame(log_rows(), "ts timestamp_ntz, is_ref boolean, x double, t string, u string").repartition(3)
    panes = DS.count_panes(df, ["x"], ["t", "u"], "2024-01-03 12:00:00", "2024-01-11 00:00:00", pane_seconds=6 * 3600, window_panes=3)
    report = {(r.ts, r.feature): r for r in DS.drift_series(panes).collect()}
    quality = {r.ts: r for r in DS.quality_series(panes).collect()}
    assert len(quality) == 31
    for at in (T0 + timedelta(hours=72), T0 + timedelta(hours=162), T0 + timedelta(hours=186), T0 + timedelta(hours=240)):
        window = df.where(F.col("is_ref") | ((F.col("ts") < F.lit(at)) & (F.col("ts") >= F.lit(at - timedelta(hours=18))))).where("is_ref is not null")
        plain = {r.feature: r for r in D.drift_report_labelled(window, ["x"], ["t", "u"]).collect()}
        there = {f for f in ("x", "t", "u") if window.where(f"not is_ref and {f} is not null").count()}
        assert {f for ts, f in report if ts == at} == there
        for f in there:
            got, want = report[at, f], plain[f]
            for c in ("ks", "js", "psi", "severity"):
                assert (got[c] is None) == (want[c] is None) and (got[c] is None or abs(got[c] - want[c]) < 1e-12), (at, f, c)
            assert (got.alert, got.reason, got.feature_type) == (want.alert, want.reason, want.feature_type)
        numeric, texts = [c for c in ("x",) if c in there], [c for c in ("t", "u") if c in there]
        q = QU.dq_report_labelled(window, numeric, texts).first()
        for c in ("missing_ratio", "unseen_category_ratio", "out_of_range_ratio"):
            assert abs(quality[at][c] - q[c]) < 1e-12
        assert quality[at].schema_violation_fraction == pytest.approx((3 - len(there)) / 3)
        newest = df.where(~F.col("is_ref") & (F.col("ts") < F.lit(at))).agg(F.max("ts")).first()[0]
        assert abs(quality[at].freshness_lag_seconds - (at - newest).total_seconds()) < 1e-6


def test_no_window_no_report(spark):
    df = spark.createDataFrame(log_rows(), "ts timestamp_ntz, is_ref boolean, x double, t string, u string").where("is_ref")
    panes = DS.count_panes(df, ["x"], ["t"], "2024-01-03 00:00:00", "2024-01-04 00:00:00", pane_seconds=3600, window_panes=2)
    assert DS.drift_series(panes).count() == 0
    q = DS.quality_series(panes).collect()
    assert len(q) == 25 and all(r.window_rows == 0 and r.missing_ratio is None and r.freshness_lag_seconds == 0 for r in q)


@pytest.mark.parametrize("step,look", [(60, 300), (300, 60), (60, 60), (7, 50)])
def test_grid_against_brute_force(spark, step, look):
    rng = random.Random(step)
    samples = [(T0 + timedelta(seconds=rng.uniform(-400, 2000)), "up", f"s{rng.randrange(3)}", rng.choice([0.0, 1.0, 2.5, None])) for _ in range(120)]
    samples += [(T0 + timedelta(seconds=k), "up", "edge", float(k)) for k in (0, 60, 300)]
    expected = [("up", s) for s in ("s0", "s1", "s1", "edge", "never")]
    end = T0 + timedelta(seconds=1500)
    grid = G.evaluation_grid(spark.createDataFrame(samples, "ts timestamp_ntz, metric string, series string, value double"),
                             spark.createDataFrame(expected, "metric string, series string"), str(T0), str(end), step, look)
    got = {(r.ts, r.series): (r.value, r.state) for r in grid.collect()}
    want = {}
    for s in {s for _, s in expected}:
        at = T0
        while at <= end:
            live = [(t, v) for t, _, x, v in samples if x == s and v is not None and t <= at and t > at - timedelta(seconds=look)]
            v = max(live)[1] if live else None
            want[at, s] = v, "absent" if v is None else "zero" if v == 0 else "present"
            at += timedelta(seconds=step)
    assert got == want
    assert {r.state: r.down for r in G.target_down(grid).select("state", "down").distinct().collect()} == {"absent": 1.0, "zero": 1.0, "present": 0.0}
    filled = G.or_vector(grid, 7.0).where("state = 'absent'").select("value").distinct().collect()
    assert [r.value for r in filled] == [7.0]


def irregular(seed=2, n=300):
    rng = random.Random(seed)
    t, out = T0, []
    for k in range(n):
        t += timedelta(microseconds=rng.choice([1, 250_000, 59_999_999, 60_000_000, 400_000_000]))
        out.append((t, "m", f"s{k % 2}", float(rng.randrange(4))))
    return out


@pytest.mark.parametrize("chunk", [30, 600, 7 * 24 * 3600])
def test_chunks_do_not_change_ranges(spark, chunk):
    rows, span = irregular(), 600
    df = spark.createDataFrame(rows, "ts timestamp_ntz, metric string, series string, value double").repartition(3)
    inc = {(r.ts, r.series): (r.increase, r.covered) for r in SE.increase(df, span, chunk_seconds=chunk).collect()}
    chg = {(r.ts, r.series): r.changes for r in SE.changes(df, span, chunk).collect()}
    want_inc, want_chg = {}, {}
    for t, _, s, _ in rows:
        w = [(u, v) for u, _, x, v in rows if x == s and t - timedelta(seconds=span) < u <= t]
        steps = list(zip(w, w[1:]))
        want_chg[t, s] = sum(a[1] != b[1] for a, b in steps)
        if len(w) > 1:
            want_inc[t, s] = sum(b[1] if b[1] < a[1] else b[1] - a[1] for a, b in steps), (t - w[0][0]).total_seconds()
    assert chg == want_chg and inc.keys() == want_inc.keys()
    assert all(inc[k][0] == v[0] and abs(inc[k][1] - v[1]) < 1e-6 for k, v in want_inc.items())


@pytest.mark.parametrize("chunk", [60, 1800, 7 * 24 * 3600])
def test_runs_go_on_over_chunks(spark, chunk):
    rng, t, rows = random.Random(8), T0, []
    for _ in range(300):
        t += timedelta(seconds=rng.choice([10, 10, 10, 50, 100, 900]))
        rows.append(("A", rng.choice(["warning", "critical"]), "x", t, "s", 1.0, rng.random() < 0.9))
    df = spark.createDataFrame(rows, "alertname string, severity string, type string, ts timestamp_ntz, series string, value double, active boolean")
    got = {(r.severity, r.ts): r.active_since for r in SE.alert_for(df, 120, 500, chunk).collect()}
    want = {}
    for severity in ("warning", "critical"):
        since, last = None, None
        for r in rows:
            if r[1] != severity:
                continue
            since = None if not r[6] else r[3] if since is None or (r[3] - last).total_seconds() > 500 else since
            last = r[3]
            if since and (r[3] - since).total_seconds() >= 120:
                want[severity, r[3]] = since
    assert got == want and len(want) > 50

"""A reference counted once: reports against its profile are those against all of its rows, and a stream reads it once."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from churnwatch.operators import drift as D
from churnwatch.operators import quality as QU
from churnwatch.streaming import log_stream as LS

NUMERIC, CATEGORICAL = ["a", "b", "few", "none"], ["c", "flag", "lacking"]
SCHEMA = "a double, b int, few double, none double, c string, flag boolean"


def sample(spark, n, seed, shift=0.0):
    """Spread and often repeated values, some missing, NaN or on the other side only."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        a = rng.choice([None, float("nan"), 0.5, rng.gauss(shift, 1.0), rng.gauss(shift, 1.0), rng.gauss(shift, 1.0)])
        rows.append((a, rng.choice([None, 7, rng.randrange(40) + int(shift * 30)]), 1.0 if k == 0 else None, None, rng.choice([None, "x", "y", f"z{seed}"]), rng.choice([None, True, False])))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def found(report):
    return [tuple(round(x, 12) if isinstance(x, float) else x for x in r) for r in report.collect()]


@pytest.mark.parametrize("cells, shift", [(1024, 0.0), (4, 0.3), (4, 50.0)])
def test_profiled_report_is_that_of_all_rows(spark, monkeypatch, cells, shift):
    monkeypatch.setattr(D, "CELLS", cells)
    ref = sample(spark, 900, 1)
    profile = D.reference_profile(ref, NUMERIC, CATEGORICAL)
    for n, seed in ((150, 2), (1, 3)):
        cur = sample(spark, n, seed, shift)
        want = D.drift_report_labelled(D.label_sides(ref, cur, NUMERIC + CATEGORICAL), NUMERIC, CATEGORICAL)
        assert sorted(found(D.drift_report_profiled(profile, cur))) == sorted(found(want))
    # the other way round: few reference rows, many current ones
    small, cur = D.reference_profile(sample(spark, 5, 4), NUMERIC, CATEGORICAL), sample(spark, 400, 5, shift)
    want = D.drift_report_labelled(D.label_sides(sample(spark, 5, 4), cur, NUMERIC + CATEGORICAL), NUMERIC, CATEGORICAL)
    assert sorted(found(D.drift_report_profiled(small, cur))) == sorted(found(want))


def test_few_reference_values_are_looked_up(spark, monkeypatch):
    ref = spark.range(20_000).select(((F.col("id") * 7919) % 20_000 / 7).alias("a"))
    profile, read, cut = D.reference_profile(ref, ["a"], []), [], D.cut_lineage
    monkeypatch.setattr(D, "cut_lineage", lambda df, name: read.append(cut(df, name)) or read[-1])
    cur = spark.range(300).select((F.col("id") * 9.0).alias("a"))
    got = D.drift_report_profiled(profile, cur).first()
    assert got.ks == D.drift_report(ref, cur, ["a"], []).first().ks
    assert read[1].select("cell").distinct().count() < 20 and profile.cells.count() == D.CELLS


def test_condensed_reference_gives_the_same_quality(spark):
    ref, cols = sample(spark, 500, 6), [c for c in NUMERIC + CATEGORICAL if c != "lacking"]
    few = QU.condensed_reference(ref)
    assert few.columns == ref.columns and few.count() < 20
    for seed in (7, 8):
        cur = sample(spark, 80, seed, 0.5)
        assert QU.dq_report(few, cur, cols).collect() == QU.dq_report(ref, cur, cols).collect()


def test_stream_counts_its_reference_once(spark, monkeypatch):
    t0, rng = datetime(2024, 1, 1), random.Random(9)
    rows = [(k, t0 + timedelta(seconds=k), rng.random(), rng.choice("pqr")) for k in range(300)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, score double, kind string")
    src, log, metrics = (LS.work_dir(spark, name) for name in ("src", "log", "metrics"))
    LS.stage_as_files(df.coalesce(1), src, 60)
    counted, counts = [], D.K.paired_counts

    def watched(df, *args):
        counted.append(tuple(df.agg(F.count_if("is_ref"), F.count_if(~F.col("is_ref"))).first()))
        return counts(df, *args)

    monkeypatch.setattr(D.K, "paired_counts", watched)
    clock, step = datetime(2024, 2, 1, tzinfo=timezone.utc), timedelta(hours=1)
    LS.stream_monitor(LS.read_log_stream(spark, src, df.schema, 1), df, log, metrics, LS.work_dir(spark, "ckpt"), numeric=["score"], categorical=["kind"], window=100,
                      clock=lambda: clock, batch_step=step)
    assert counted == [(300, 0), (0, 60)] + [(0, 100)] * 4
    m = {(r.batch_id, r.metric): r.value for r in spark.read.parquet(metrics).collect()}
    held = spark.read.parquet(log)
    for b in range(5):
        cur = QU.latest_window(held.where(F.col("batch_id") <= b), 100)
        want = D.drift_summary(D.drift_report_labelled(D.label_sides(df, cur, ["score", "kind"]), ["score"], ["kind"])).first().asDict()
        want |= QU.dq_report(df.select("score", "kind"), cur.select("score", "kind"), ["score", "kind"]).first().asDict() | {"row_count": 60.0 * (b + 1), "drift_rows": 60.0 * (b + 1), "up": 1.0}
        assert {k: m[b, k] for k in want} == pytest.approx(want, abs=1e-12)

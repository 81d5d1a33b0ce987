"""Nothing is lost or made up: duplicate flags, streaming ids, series edges, files, NaN, folds."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from churnwatch.functions.pvalues import _gammaincc
from churnwatch.operators import clean as CL
from churnwatch.operators import features as FE
from churnwatch.operators import profile as P
from churnwatch.operators import quality as QU
from churnwatch.operators import series as SE
from churnwatch.sources import files
from churnwatch.streaming import log_stream as LS


def test_duplicate_flags_with_null_keys_and_equal_rows(spark):
    rows = [("a", 1.0), ("a", 1.0), ("a", 2.0), (None, 1.0), (None, 1.0), ("b", 5.0)]
    df = spark.createDataFrame(rows, "customerID string, x double")
    first = CL.keep_first_duplicates(df, "customerID", ["x"]).collect()
    assert len(first) == 6 and sum(r.is_duplicate for r in first) == 3
    assert sorted((r.customerID or "", r.is_duplicate) for r in first if not r.is_duplicate) == [("", False), ("a", False), ("b", False)]
    every = CL.flag_all_duplicates(df, "customerID").collect()
    assert len(every) == 6 and {r.customerID: r.is_duplicate for r in every} == {"a": True, None: True, "b": False}


def test_streaming_ids_keep_every_row(spark, tmp_path):
    rows = [("A", 1, 0), (" a ", 1, 1), ("b", 2, 2), (None, 3, 3), ("  ", 4, 4), ("b", 2, 5), ("c", 9, 6)]
    df = spark.createDataFrame(rows, "id string, ts int, n int")
    df.coalesce(1).write.option("maxRecordsPerFile", 3).parquet(f"{tmp_path}/in")
    stream = LS.read_log_stream(spark, f"{tmp_path}/in", df.schema, files_per_trigger=1)
    LS.stream_unique_ids_exact(stream, "id", "ts", f"{tmp_path}/acc", f"{tmp_path}/rej", f"{tmp_path}/ck")
    acc, rej = spark.read.parquet(f"{tmp_path}/acc").collect(), spark.read.parquet(f"{tmp_path}/rej").collect()
    assert sorted(r.n for r in acc + rej) == list(range(7))
    assert sorted(r.id.strip().lower() for r in acc) == ["a", "b", "c"]


def test_monitor_clock_up_flag_and_history(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    rows = [(i, datetime(2024, 1, 1, 0, i), 0.1 * (i % 10)) for i in range(6)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, score double")
    df.coalesce(1).write.option("maxRecordsPerFile", 3).parquet(f"{tmp_path}/in")
    calls = iter(range(10))

    def clock():
        if next(calls) == 1:
            return datetime(2024, 1, 1, 2, tzinfo=timezone.utc)
        return datetime(2024, 1, 1, 1, tzinfo=timezone.utc)

    stream = LS.read_log_stream(spark, f"{tmp_path}/in", df.schema, files_per_trigger=1)
    LS.stream_monitor(stream, df, f"{tmp_path}/log", f"{tmp_path}/m", f"{tmp_path}/ck", probability="score", clock=clock)
    m = {(r.batch_id, r.metric): r.value for r in spark.read.parquet(f"{tmp_path}/m").collect()}
    assert [m[b, "row_count"] for b in (0, 1)] == [3.0, 6.0] and m[0, "up"] == m[1, "up"] == 1.0
    newest = max(m[0, "latest_event_seconds"], m[1, "latest_event_seconds"])
    assert m[1, "freshness_lag_seconds"] == pytest.approx(datetime(2024, 1, 1, 2, tzinfo=timezone.utc).timestamp() - newest)
    assert m[0, "freshness_lag_seconds"] > 0 and t0.year == 2024

    stream = LS.read_log_stream(spark, f"{tmp_path}/in", df.schema, files_per_trigger=5)
    LS.stream_monitor(stream, df, f"{tmp_path}/log2", f"{tmp_path}/m2", f"{tmp_path}/ck2", probability="no_such_column")
    failed = {r.metric: r.value for r in spark.read.parquet(f"{tmp_path}/m2").collect()}
    assert failed["up"] == 0.0 and failed["row_count"] == 6.0


def test_trailing_range_is_half_open_to_the_microsecond(spark):
    stamps = [0.0, 0.5, 100.25, 200.0, 299.75, 300.0, 300.5]
    rows = [(datetime.fromtimestamp(1_700_000_000 + s, timezone.utc), "m", "s", float(i)) for i, s in enumerate(stamps)]
    df = spark.createDataFrame(rows, "ts timestamp, metric string, series string, value double")
    got = {round(r.ts.timestamp() - 1_700_000_000, 2): (r.increase, r.covered) for r in SE.increase(df, 300).collect()}
    assert got[300.0] == (4.0, 299.5) and got[300.5] == (4.0, 200.25)


def test_intervals_of_several_units(spark):
    rows = [(datetime(2024, 1, 1, 0, m, 30),) for m in (0, 1, 4, 5, 9, 12)]
    got = SE.counter_samples(spark.createDataFrame(rows, "ts timestamp_ntz"), "c", [], "5 minutes").orderBy("ts").collect()
    assert [(r.ts.minute, r.value) for r in got] == [(5, 3.0), (10, 5.0), (15, 6.0)]


def test_limits_match_by_label_and_time(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    samples = spark.createDataFrame([(at(1), "a", 1.0), (at(3), "a", 2.0), (at(5), "a", 3.0), (at(3), None, 4.0)], "ts timestamp_ntz, k string, value double")
    limits = spark.createDataFrame([(at(2), "a", 10.0), (at(5), "a", 20.0), (at(0), "b", 30.0), (at(0), None, 40.0)], "ts timestamp_ntz, k string, value double")
    got = sorted((r.value, r.limit) for r in SE.match_limits(samples, limits, ["k"]).collect())
    assert got == [(1.0, None), (2.0, 10.0), (3.0, 20.0), (4.0, 40.0)]


def test_csv_keeps_text_and_names_what_is_missing(spark, tmp_path):
    rows = [(" a ", 'say "hi", you', None), ("", "é\\n", "1.50")]
    df = spark.createDataFrame(rows, " id string, note string, x string".replace(" id", "id"))
    files.write_csv(df, f"{tmp_path}/t")
    back = files.read_csv(spark, f"{tmp_path}/t", ["id", "note"])
    assert {f.dataType.simpleString() for f in back.schema.fields} == {"string"}
    assert {tuple(x or None for x in r) for r in back.collect()} == {tuple(x or None for x in r) for r in rows}
    with pytest.raises(ValueError, match="missing required columns"):
        files.read_csv(spark, f"{tmp_path}/t", ["id", "other"])
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, f"{tmp_path}/nothing")


def test_metrics_json_round_trip(spark, tmp_path):
    rows = [("m1", "f1", 0.5), ("m1", "auc", 0.75), (None, "f1", 0.25)]
    files.write_metrics_json(spark.createDataFrame(rows, "model string, metric string, value double"), f"{tmp_path}/j")
    assert {tuple(r) for r in files.read_metrics_json(spark, f"{tmp_path}/j").collect()} == set(rows)


def test_nan_is_missing(spark):
    nan = float("nan")
    ref = spark.createDataFrame([(1.0,), (nan,), (3.0,)], "x double")
    cur = spark.createDataFrame([(2.0,), (9.0,), (nan,)], "x double")
    assert QU.dq_out_of_range(ref, cur, ["x"]).first()[0] == 0.5
    d = P.describe(ref).first()
    assert (d["count"], d["mean"], d["max"]) == (2, 2.0, 3.0)
    assert sum(r.n for r in P.histogram(ref, "x", 2).collect()) == 2


def test_folds_are_stratified(spark):
    df = spark.range(503).select(F.col("id").cast("string").alias("customerID"), (F.col("id") % 7 == 0).cast("int").alias("churn_status"))
    got = FE.stratified_folds(df).groupBy("churn_status", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in got if r.churn_status == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_upper_gamma_at_large_degrees():
    import numpy as np

    q = _gammaincc(np.array([5e8, 5e8, 0.5, 10.0]), np.array([5e8, 5e8 + 3 * 5e8**0.5, 0.5 * 3.841458820694124, 10.0]))
    assert q[0] == pytest.approx(0.5, abs=1e-4) and q[1] == pytest.approx(0.00135, rel=1e-2)
    assert q[2] == pytest.approx(0.05, rel=1e-9) and q[3] == pytest.approx(0.4579297144718523, rel=1e-9)

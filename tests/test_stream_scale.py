"""What a stream sends to the driver: no broadcasts of its rows, few state partitions, a bounded number of batches."""

from datetime import datetime, timedelta

import __spark_entry__ as E
from churnwatch.streaming import log_stream as LS
from tests.conftest import SF001
from tests.test_plans import plan_of

STAGE = LS.stage_as_files


def ended(monkeypatch):
    """The streaming queries that end from now on."""
    queries = []
    monkeypatch.setattr(LS, "run_available", lambda q: (q.awaitTermination(), queries.append(q)))
    return queries


def batches_of(q):
    return {p["batchId"] for p in q.recentProgress if p["numInputRows"]}


def test_counters_join_without_broadcast_in_few_batches(spark, monkeypatch):
    monkeypatch.setattr(LS, "stage_as_files", lambda df, path: STAGE(df, path, rows_per_file=5))
    queries = ended(monkeypatch)
    got = {tuple(r) for r in E.queries()["stream_prediction_counters"](spark, SF001).collect()}
    (q,) = queries
    assert 1 < len(batches_of(q)) <= LS.MOST_BATCHES
    assert "BroadcastExchange" not in q._jsq.explainInternal(False)
    assert got == {tuple(r) for r in E.queries()["prediction_counters"](spark, SF001).collect()}


def test_exact_ids_join_without_broadcast_in_few_batches(spark, monkeypatch):
    monkeypatch.setattr(LS, "stage_as_files", lambda df, path: STAGE(df, path, rows_per_file=5))
    queries, plans, cut = ended(monkeypatch), [], LS.cut_lineage
    monkeypatch.setattr(LS, "cut_lineage", lambda df, name: plans.append((name, plan_of(df))) or cut(df, name))
    out = {r.user_id: (r.accepted, r.rejected) for r in E.queries()["stream_unique_ids"](spark, SF001).collect()}
    (q,) = queries
    assert 1 < len(batches_of(q)) <= LS.MOST_BATCHES
    joins = [p for name, p in plans if name == "first-rows"]
    assert joins and all("BroadcastExchange" not in p for p in joins)
    assert out == {r.user_id: (1, r["count"] - 1) for r in spark.read.parquet(f"{SF001}/events.parquet").groupBy("user_id").count().collect()}


def test_no_more_state_partitions_than_cores(spark, monkeypatch):
    t0 = datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, k % 7, t0 + timedelta(seconds=k)) for k in range(100)], "event_id long, user_id long, event_time timestamp")
    src, sink = STAGE(df.coalesce(1), LS.work_dir(spark, "src"), 20), LS.work_dir(spark, "unique")
    queries, before = ended(monkeypatch), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        LS.stream_unique_ids(LS.read_log_stream(spark, src, df.schema, 2), "user_id", "event_time", "1 hour", sink, LS.work_dir(spark, "ckpt"))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    (q,) = queries
    assert {s["numShufflePartitions"] for p in q.recentProgress for s in p["stateOperators"]} == {spark.sparkContext.defaultParallelism}
    assert sorted(r.user_id for r in spark.read.parquet(sink).collect()) == list(range(7))


def test_files_a_trigger(spark):
    path = STAGE(spark.range(100).coalesce(1), LS.work_dir(spark, "files"), 1)
    assert LS.files_a_trigger(spark, path) == 13 and LS.files_a_trigger(spark, path, least=40) == 40

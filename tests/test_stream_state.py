"""What a micro-batch reads of earlier ones: the touched id buckets, and one carried window."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from churnwatch.operators import quality as QU
from churnwatch.streaming import log_stream as LS
from tests.test_plans import plan_of


def staged(spark, df, rows_per_file):
    """Files of a bounded number of rows, in a fresh folder."""
    return LS.stage_as_files(df, LS.work_dir(spark, "staged"), rows_per_file)


def test_only_touched_buckets_are_read(spark):
    store = LS.work_dir(spark, "ids")
    ids = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("_id")).withColumn("bucket", LS.id_bucket(F.col("_id")))
    for n in range(3):
        ids.where(F.expr(f"cast(substring(_id, 2) as int) % 3 = {n}")).write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/batch_id={n}")
    wanted = ids.where(F.col("_id").isin("u7", "u4711"))
    buckets = {r["bucket"] for r in wanted.collect()}
    seen = LS.stored_ids(spark, store, wanted, 2)
    files = seen.select(F.input_file_name().alias("f")).distinct().collect()
    assert {int(r["f"].split("bucket=")[1].split("/")[0]) for r in files} <= buckets
    assert not any("batch_id=2" in r["f"] for r in files)
    assert "bucket" in [line for line in plan_of(seen).splitlines() if "PartitionFilters" in line][0]
    want = {r["_id"] for r in ids.where(F.col("bucket").isin(list(buckets)) & (F.expr("cast(substring(_id, 2) as int) % 3") < 2)).collect()}
    assert {r["_id"] for r in seen.collect()} == want


def test_exact_ids_over_many_batches(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, " ", f"u{rng.randrange(60)}", f" U{rng.randrange(60)} "]), k) for k in range(400)]
    df = spark.createDataFrame(rows, "id string, at int")
    path = staged(spark, df, 25)
    acc, rej = LS.work_dir(spark, "acc"), LS.work_dir(spark, "rej")
    stream = LS.read_log_stream(spark, path, df.schema, files_per_trigger=2)
    LS.stream_unique_ids_exact(stream, "id", "at", acc, rej, LS.work_dir(spark, "ckpt"))
    a, r = spark.read.parquet(acc), spark.read.parquet(rej)
    names = {i.strip().lower() for i, _ in rows if i and i.strip()}
    got = [x["_id"] for x in a.collect()]
    assert sorted(got) == sorted(names) and a.count() + r.count() == len(rows)
    assert a.select("batch_id").distinct().count() > 2


def test_window_is_carried_and_not_read_from_the_log(spark, monkeypatch):
    t0, rng = datetime(2024, 1, 1), random.Random(5)
    rows = [(k, t0 + timedelta(seconds=rng.randrange(10_000)), rng.random()) for k in range(600)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, score double")
    path = staged(spark, df, 30)
    log, metrics = LS.work_dir(spark, "log"), LS.work_dir(spark, "metrics")
    read = []
    carry = LS.carry_window

    def watched(spark, own, state, batch_id, window, order):
        out = carry(spark, own, state, batch_id, window, order)
        held = spark.read.parquet(log).where(F.col("batch_id") <= batch_id)
        want = sorted(tuple(r) for r in QU.latest_window(held, window, order).select("event_id").collect())
        assert sorted(tuple(r) for r in out.select("event_id").collect()) == want
        read.append(out.count())
        return out

    monkeypatch.setattr(LS, "carry_window", watched)
    LS.stream_monitor(LS.read_log_stream(spark, path, df.schema, files_per_trigger=4), df.limit(50), log, metrics, LS.work_dir(spark, "ckpt"), window=100, gate_tiers=False,
                      clock=lambda: datetime(2024, 2, 1).astimezone())
    assert len(read) > 3 and max(read) == 100
    m = spark.read.parquet(metrics)
    assert m.where("metric = 'up' and value = 1").count() == len(read)
    assert m.where("metric = 'prediction_count'").agg(F.max("value")).first()[0] == 100
    # a repeated batch gives the same window, and old states are gone
    fs = spark._jvm.org.apache.hadoop.fs.Path(f"{log}-window")
    assert len(fs.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(fs)) == 2
    last = len(read) - 1
    again = carry(spark, f"{log}/batch_id={last}", f"{log}-window", last, 100, ("ts", "event_id"))
    newest = sorted(sorted(rows, key=lambda r: (r[1], r[0]))[-100:])
    assert sorted(r["event_id"] for r in again.collect()) == [r[0] for r in newest]

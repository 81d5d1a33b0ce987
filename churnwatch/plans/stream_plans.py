"""Streaming queries: events staged as files of bounded size arrive as a file stream; each query runs
to completion with an ``availableNow`` trigger and returns its sink table (rows-only
checks; tests compare them with the batch equivalents)."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.plans.registry import register
from churnwatch.sources import tables as S
from churnwatch.streaming import log_stream as LS

MONITOR_CLOCK = datetime(2024, 3, 1, tzinfo=timezone.utc)  # fixed, so that reruns agree; a deployment keeps the real clock
MONITOR_STEP = timedelta(seconds=C.SLOW_DRIFT_SECONDS)  # from one micro-batch to the next, so that every tier is due in each
REFERENCE_UNTIL = "2024-01-08 00:00:00"


def staged_events(spark, sf_dir):
    e = S.table(spark, sf_dir, "events").select("*", S.score_of("value").alias("score"), F.col("ts").cast("timestamp").alias("event_time"))
    path = LS.stage_as_files(e, LS.work_dir(spark, "staged-events"))
    return path, spark.read.parquet(path).schema


@register("stream_append_log", "SELECT event_id, ts, user_id, event_type, value, least(value / 500.0, 1.0) AS score FROM events")
def q_stream_append(spark, sf_dir):
    src, schema = staged_events(spark, sf_dir)
    sink = LS.work_dir(spark, "log")
    LS.stream_append_log(LS.read_log_stream(spark, src, schema), sink, LS.work_dir(spark, "ckpt"))
    return spark.read.parquet(sink).select("event_id", "ts", "user_id", "event_type", "value", "score")


@register("stream_unique_ids", "SELECT user_id, 1 AS accepted, count(*) - 1 AS rejected FROM events GROUP BY user_id")
def q_stream_unique(spark, sf_dir):
    """Exact mode: an id (user) is accepted once over the whole log; later rows are rejected. How often each was either."""
    src, schema = staged_events(spark, sf_dir)
    acc, rej = LS.work_dir(spark, "accepted"), LS.work_dir(spark, "rejected")
    LS.stream_unique_ids_exact(LS.read_log_stream(spark, src, schema, LS.files_a_trigger(spark, src)), "user_id", "ts", acc, rej,
                               LS.work_dir(spark, "ckpt"))
    rows = spark.read.parquet(acc).select("user_id", F.lit(1).alias("a")).unionByName(spark.read.parquet(rej).select("user_id", F.lit(0).alias("a")))
    return rows.groupBy("user_id").agg(F.sum("a").alias("accepted"), F.count_if(F.col("a") == 0).alias("rejected"))


@register("stream_unique_ids_watermark")
def q_stream_unique_watermark(spark, sf_dir):
    """Bounded-state mode: duplicates rejected within a 1-hour event-time watermark."""
    src, schema = staged_events(spark, sf_dir)
    sink = LS.work_dir(spark, "unique")
    LS.stream_unique_ids(LS.read_log_stream(spark, src, schema), "user_id", "event_time", "1 hour", sink,
                         LS.work_dir(spark, "ckpt"))
    return spark.read.parquet(sink).select("event_id", "user_id", "event_time")


@register("stream_prediction_counters")
def q_stream_counters(spark, sf_dir):
    src, schema = staged_events(spark, sf_dir)
    req = S.request_log(spark, sf_dir).select("event_id", "endpoint")
    # stream-static join, by a shuffle: the side that a batch would broadcast is the batch itself
    stream = LS.read_log_stream(spark, src, schema, LS.files_a_trigger(spark, src)).join(req.hint("merge"), "event_id")
    sink = LS.work_dir(spark, "counters")
    LS.stream_prediction_counters(stream, "score", sink, LS.work_dir(spark, "ckpt"))
    return spark.read.parquet(sink)


@register("stream_monitor")
def q_stream_monitor(spark, sf_dir):
    src, schema = staged_events(spark, sf_dir)
    reference = spark.read.parquet(src).where(F.col("ts") < F.lit(REFERENCE_UNTIL).cast("timestamp_ntz"))
    log_path, metrics = LS.work_dir(spark, "monitor-log"), LS.work_dir(spark, "monitor-metrics")
    LS.stream_monitor(LS.read_log_stream(spark, src, schema, files_per_trigger=15), reference, log_path, metrics,
                      LS.work_dir(spark, "ckpt"), numeric=["value"], categorical=["event_type"], clock=lambda: MONITOR_CLOCK,
                      batch_step=MONITOR_STEP)
    return spark.read.parquet(metrics)

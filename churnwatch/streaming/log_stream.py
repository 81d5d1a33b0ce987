"""Structured Streaming over a scoring log.

Sources are file streams with an explicit schema; sinks are parquet tables with a
checkpoint under the shared checkpoint folder, so a restarted query resumes exactly
where it stopped. ``foreachBatch`` writers overwrite a per-batch partition, which
makes a retried micro-batch idempotent.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.operators import drift as D
from churnwatch.operators import quality as QU
from churnwatch.operators import series as SE
from churnwatch.session import checkpoint_dir, cut_lineage, path_exists


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/churnwatch/{name}-{uuid.uuid4().hex}"


def stage_as_files(df: DataFrame, path: str, rows_per_file: int = 20_000) -> str:
    """Write a table as files of bounded size to feed a file-stream source in several
    micro-batches; rows stay where they are read, so no day or key gathers in one task."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return path


def read_log_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 5) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


MOST_BATCHES = 8


def files_a_trigger(spark: SparkSession, path: str, least: int = 5, batches: int = MOST_BATCHES) -> int:
    """Files to take at a time so that the files waiting at ``path`` are worked off in ``batches`` micro-batches or fewer.

    For queries whose result does not depend on where batches end: what a batch costs whatever its size (its tasks'
    results, a pass over a static side) is then paid a bounded number of times, not once for every few files."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(fs_path)
    waiting = sum(1 for f in listed if f.getPath().getName().endswith(".parquet"))
    return max(least, -(-waiting // batches))


def run_available(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_append_log(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append every arriving row to the log table (exactly once via the checkpoint)."""
    q = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(sink))
    run_available(q)


def stream_unique_ids(stream: DataFrame, key: str, ts: str, delay: str, sink: str, checkpoint: str) -> None:
    """Keep the first row of each id within the watermark delay (bounded state); rows whose
    id repeats inside the delay are rejected.

    Every state partition reports its store to the driver after every batch (some 40 KB), however few rows a batch
    has, so there are no more of them than cores."""
    dedup = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    spark = stream.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    # read when the query starts, and kept in its checkpoint
    spark.conf.set("spark.sql.shuffle.partitions", min(int(before), spark.sparkContext.defaultParallelism))
    try:
        q = (dedup.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(sink))
        run_available(q)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


ID_BUCKETS = 256


def id_bucket(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(ID_BUCKETS)).cast("int")


def stored_ids(spark: SparkSession, store: str, wanted: DataFrame, before_batch: int) -> DataFrame:
    """Accepted ids of earlier batches in the buckets that ``wanted`` (with a ``bucket`` column) touches: at most ``ID_BUCKETS``
    numbers come to the driver, and the scan is of those partitions only."""
    touched = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]
    held = spark.read.schema("_id string, batch_id int, bucket int").parquet(store)
    return held.where((F.col("batch_id") < before_batch) & F.col("bucket").isin(touched)).select("_id")


def stream_unique_ids_exact(stream: DataFrame, key: str, order: str, accepted: str, rejected: str,
                            checkpoint: str) -> None:
    """Exact id uniqueness over the whole log; accepted and rejected rows together are the input.

    Per micro-batch the rows get numbers that are written with them. NULL and blank ids are
    rejected; of each other id the row with the smallest (order, number) stays (partial
    ``min`` per id, no per-id sort) unless an earlier batch accepted the id (anti-join with
    the id store). Everything else is rejected by row number, so ties lose nothing.
    Each batch writes its own partition, so a retried batch gives the same result.

    The id store (``<accepted>-ids``) holds the accepted ids by hash bucket; a batch reads the
    buckets that its own ids fall into, by partition, and nothing else of the log. Ids and row numbers are
    joined by shuffles: a broadcast would bring those of every batch, in the end of the whole log, to the driver."""
    from churnwatch.operators.contract import norm_id

    store = f"{accepted.rstrip('/')}-ids"

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = cut_lineage(batch.withColumn("_id", norm_id(key)).withColumn("_row", F.monotonically_increasing_id()), "arrivals")
        first = rows.where(F.col("_id").isNotNull()).groupBy("_id").agg(F.min(F.struct(order, "_row")).alias("r"))
        keep = cut_lineage(first.select("_id", "r._row", id_bucket(F.col("_id")).alias("bucket")), "candidates")
        if path_exists(spark, store):
            seen = stored_ids(spark, store, keep, batch_id)
            keep = cut_lineage(keep.join(seen.hint("merge"), "_id", "left_anti"), "first-rows")
        (keep.select("_id", "bucket").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/batch_id={batch_id}"))
        keep = keep.select("_row").hint("merge")
        rows.join(keep, "_row", "left_semi").drop("_row").write.mode("overwrite").parquet(f"{accepted}/batch_id={batch_id}")
        rows.join(keep, "_row", "left_anti").drop("_row").write.mode("overwrite").parquet(f"{rejected}/batch_id={batch_id}")

    q = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run_available(q)


def stream_prediction_counters(stream: DataFrame, probability: str, sink: str, checkpoint: str) -> None:
    """Running per-endpoint counters; each micro-batch overwrites the counter table with
    the updated totals (complete mode state = one row per endpoint)."""
    counts = SE.prediction_counters(stream, probability)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    q = (counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    run_available(q)


def stream_monitor(stream: DataFrame, reference: DataFrame, log_path: str, metrics_path: str, checkpoint: str,
                   ts: str = "ts", order: tuple[str, ...] = ("ts", "event_id"), probability: str = "score",
                   numeric: list[str] | None = None, categorical: list[str] | None = None,
                   window: int = C.CURRENT_WINDOW_SIZE, gate_tiers: bool = True,
                   clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
                   batch_step: timedelta = timedelta(0)) -> None:
    """Per micro-batch: append the batch to the log (partition ``batch_id``), then write the
    metrics of that batch id, stamped with the time that ``clock`` gives plus ``batch_step``
    for each earlier batch id, which moves a fixed clock on alike in a rerun or a repeated batch.

    Tiers: row count, newest event, freshness and the up flag every batch; model-quality and
    data-quality stats and drift over the latest window when ``quality.due_tiers`` says so,
    judged on the clock against the last time each tier ran. Row count and newest event go
    on from the earlier batches' metrics (``batch_id`` below this one), so the log is not read
    again for them and a repeated batch sees what it saw the first time. A batch whose
    collection fails leaves ``up`` 0 and its row count, and the stream goes on.

    The latest window is carried on: the newest rows after a batch are those of the window after the
    batch before it and of the batch itself (``<log_path>-window``), so a batch reads its own rows and one window,
    however long the log is. ``window`` 0 or less keeps all rows, and then the log is read.

    The reference stays the same, so it is counted and sorted once, by the first batch that needs it; the others read what
    ``operators.drift.ReferenceProfile`` and ``operators.quality.condensed_reference`` keep of it. So are the earlier batches' metrics: a run
    reads them in its first batch and carries them on."""
    numeric = numeric or []
    categorical = categorical or []
    fitted: dict = {}
    carried_on: dict = {}

    def once(name: str, make: Callable):
        if name not in fitted:
            fitted[name] = make()
        return fitted[name]

    def history(spark: SparkSession, batch_id: int) -> tuple[dict, dict]:
        """Time each tier last ran, and the newest value of every metric, before this batch."""
        if carried_on.get("batch") == batch_id - 1:
            return carried_on["ran"], carried_on["newest"]
        if not path_exists(spark, metrics_path):
            return {}, {}
        m = spark.read.parquet(metrics_path).where(F.col("batch_id") < batch_id)
        ran = m.groupBy("tier").agg(F.max(F.unix_micros("ts") / 1e6).alias("t")).collect()
        newest = m.groupBy("metric").agg(F.max_by("value", "batch_id").alias("v")).collect()
        return {r["tier"]: r["t"] for r in ran}, {r["metric"]: r["v"] for r in newest}

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{log_path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(own)
        now = clock().astimezone(timezone.utc) + batch_step * batch_id
        stamp = F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")
        last, newest = history(spark, batch_id)
        head = spark.read.schema(batch.schema).parquet(own).agg(
            F.count("*").alias("n"), F.max(F.unix_micros(F.col(ts).cast("timestamp")) / 1e6).alias("t")).first()
        rows = int(newest.get("row_count", 0)) + head["n"]
        latest_event = max((t for t in (newest.get("latest_event_seconds"), head["t"]) if t is not None), default=None)
        lag = max(0.0, now.timestamp() - latest_event) if latest_event is not None else 0.0
        fast = [("row_count", float(rows)), ("latest_event_seconds", latest_event), ("freshness_lag_seconds", lag)]
        due = QU.due_tiers(now.timestamp(), last, rows, int(newest.get("drift_rows", 0))) if gate_tiers else {"medium": True, "drift": True}

        # part of the append, as the log's own rows are: a collection that fails loses no row of the next window
        carried = carry_window(spark, own, f"{log_path}-window", batch_id, window, order) if window > 0 else None

        def write(up: float, parts: list[DataFrame], ran: tuple[str, ...] = ()) -> None:
            out = spark.createDataFrame([("fast", k, v) for k, v in [*fast, ("up", up)]], "tier string, metric string, value double")
            for p in parts:
                out = out.unionByName(p)
            out.select("tier", stamp.alias("ts"), "metric", F.col("value").cast("double").alias("value")).write.mode("overwrite").parquet(
                f"{metrics_path}/batch_id={batch_id}")
            drifted = {"drift_rows": float(rows)} if "drift" in ran else {}
            carried_on.update(batch=batch_id, ran={**last, **dict.fromkeys(("fast", *ran), now.timestamp())}, newest={**newest, **dict(fast), **drifted})

        try:
            parts, ran = [], ()
            if due["medium"] or due["drift"]:
                # a window is written by one task, and read by one it needs no shuffles
                latest = carried.coalesce(1) if carried is not None else spark.read.parquet(log_path).where(F.col("batch_id") <= batch_id)
                cols = numeric + categorical
                if due["medium"]:
                    known = once("dq", lambda: cut_lineage(QU.condensed_reference(reference.select(*cols)), "dq-reference")) if cols else reference
                    parts += _medium_parts(latest, known, probability, numeric, categorical)
                    ran += ("medium",)
                if due["drift"] and cols:
                    if carried is not None:
                        report = D.drift_report_profiled(once("drift", lambda: D.reference_profile(reference, numeric, categorical)), latest)
                    else:
                        report = D.drift_report_labelled(D.label_sides(reference, latest, cols), numeric, categorical)
                    parts += _drift_parts(report, rows)
                    ran += ("drift",)
            write(1.0, parts, ran)
        except Exception as failure:  # the exporter stays up and reports that this collection failed
            print(f"batch {batch_id}: collection failed: {failure}", file=sys.stderr)
            write(0.0, [])

    q = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run_available(q)


def carry_window(spark: SparkSession, own: str, state: str, batch_id: int, window: int, order: tuple[str, ...]) -> DataFrame:
    """The newest ``window`` rows of the log after this batch, from the last state before it and the batch's own rows (``own``).

    Written as this batch's state; a repeated batch reads the same earlier state again. States older than the
    one before are dropped: a batch is repeated only before the next one starts."""
    rows = spark.read.parquet(own)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(state).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath().getName() for f in fs.listStatus(fs_path(state))] if path_exists(spark, state) else []
    earlier = sorted(k for name in found if (k := int(name.removeprefix("after="))) < batch_id)
    if earlier:
        rows = spark.read.schema(rows.schema).parquet(f"{state}/after={earlier[-1]}").unionByName(rows)
    path = f"{state}/after={batch_id}"
    QU.latest_window(rows, window, order).write.mode("overwrite").parquet(path)
    for k in earlier[:-1]:
        fs.delete(fs_path(f"{state}/after={k}"), True)
    return spark.read.schema(rows.schema).parquet(path)


def _long(df: DataFrame, tier: str) -> DataFrame:
    return df.select(F.lit(tier).alias("tier"), F.stack(F.lit(len(df.columns)), *[
        x for c in df.columns for x in (F.lit(c), F.col(c).cast("double"))]).alias("metric", "value"))


def _medium_parts(latest: DataFrame, reference: DataFrame, probability: str, numeric: list[str],
                  categorical: list[str]) -> list[DataFrame]:
    parts = [_long(QU.prediction_stats(latest, probability), "medium")]
    cols = numeric + categorical
    if cols:
        parts.append(_long(QU.dq_report(reference.select(*cols), latest.select(*cols), cols), "medium"))
    return parts


def _drift_parts(report: DataFrame, rows: int) -> list[DataFrame]:
    summary = D.drift_summary(cut_lineage(report, "drift-report"))  # the summary reads it twice
    marker = summary.select(F.lit("drift").alias("tier"), F.lit("drift_rows").alias("metric"),
                            F.lit(float(rows)).alias("value"))
    return [_long(summary, "drift"), marker]

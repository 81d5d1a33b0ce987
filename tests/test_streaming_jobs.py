"""Streaming runs over the log in many files equal the batch results; jobs persist what
they claim."""

from pyspark.sql import functions as F

from churnwatch import config as C
import __spark_entry__ as E
from tests.conftest import SF001


def test_stream_append_equals_batch(spark):
    q = E.queries()
    streamed = q["stream_append_log"](spark, SF001)
    batch = spark.read.parquet(f"{SF001}/events.parquet")
    assert streamed.count() == batch.count()
    assert streamed.select("event_id").exceptAll(batch.select("event_id")).count() == 0


def test_stream_counters_equal_batch(spark):
    q = E.queries()
    s = sorted(tuple(r) for r in q["stream_prediction_counters"](spark, SF001).select(
        "endpoint", "predictions", "class_1", "class_0", "low_confidence").collect())
    b = sorted(tuple(r) for r in q["prediction_counters"](spark, SF001).select(
        "endpoint", "predictions", "class_1", "class_0", "low_confidence").collect())
    assert s == b


def test_stream_unique_ids_exact(spark):
    acc = E.queries()["stream_unique_ids"](spark, SF001)
    users = spark.read.parquet(f"{SF001}/events.parquet").select("user_id").distinct().count()
    assert acc.count() == users and acc.select("user_id").distinct().count() == users


def test_stream_monitor_writes_metrics_per_batch(spark):
    m = E.queries()["stream_monitor"](spark, SF001)
    metrics = {r["metric"] for r in m.select("metric").distinct().collect()}
    assert {"row_count", "freshness_lag_seconds", "prediction_mean", "missing_ratio", "features_total"} <= metrics
    last = m.where(F.col("metric") == "row_count").agg(F.max("value")).collect()[0][0]
    assert last == spark.read.parquet(f"{SF001}/events.parquet").count()


def test_stream_monitor_runs_every_tier_in_every_batch(spark, monkeypatch):
    from churnwatch.streaming import log_stream as LS

    stage = LS.stage_as_files
    monkeypatch.setattr(LS, "stage_as_files", lambda df, path: stage(df, path, rows_per_file=20))
    m = E.queries()["stream_monitor"](spark, SF001)
    tiers = {(r["batch_id"], r["tier"]) for r in m.select("batch_id", "tier").distinct().collect()}
    batches = {b for b, _ in tiers}
    assert len(batches) > 2
    assert tiers == {(b, t) for b in batches for t in ("fast", "medium", "drift")}


def test_preprocess_job_split_and_tables(spark):
    out = E.queries()["preprocess_job"](spark, SF001)
    got = {(r["table"], r[C.SPLIT_COLUMN]): r["rows"] for r in out.collect()}
    assert got[("tree", "train")] == got[("linear", "train")] and got[("tree", "test")] == got[("linear", "test")]
    assert got[("tree", "test")] > 0


def test_score_log_job_rejects_logged_ids_on_rerun(spark):
    from churnwatch.operators import clean as CL
    from churnwatch.operators import features as FE
    from churnwatch.plans import contract_plans as CP
    from churnwatch.plans import jobs as J
    from churnwatch.plans import ml_plans as ML
    from churnwatch.sources import churn as CH
    from churnwatch.streaming.log_stream import work_dir

    _, pre, _, model = ML._fit(spark, SF001, "logreg")
    cleaned, _ = CL.clean_table(CH.churn_view(spark, SF001), strict_schema=True, require_target=True)
    hc = FE.high_charge_threshold(cleaned)
    batch = CP.batch(spark, SF001)
    log = work_dir(spark, "score-log-test")
    paths = J.score_log_job(spark, batch, log, model, pre, hc, "2024-02-01 00:00:00")
    first = spark.read.parquet(paths["raw"]).count()
    assert first > 0
    J.score_log_job(spark, batch, log, model, pre, hc, "2024-02-02 00:00:00")
    assert spark.read.parquet(paths["raw"]).count() == first          # nothing new logged
    rej = spark.read.parquet(paths["rejected"]).where(F.col("rule") == "id_in_log").count()
    assert rej >= first                                                # every logged id rejected on rerun
    enc = spark.read.parquet(paths["encoded"])
    assert enc.where((F.col("churn_probability") < 0) | (F.col("churn_probability") > 1)).count() == 0

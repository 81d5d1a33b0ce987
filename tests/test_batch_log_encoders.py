"""Batches appended to several tables as one, and encoders whose categories are a table."""

import pytest
from pyspark.sql import functions as F

from churnwatch.operators import categories as CG
from churnwatch.operators import evaluate as EV
from churnwatch.operators import features as FE
from churnwatch.sources.batch_log import BatchLog
from churnwatch.streaming.log_stream import work_dir
from tests.conftest import SF001
from tests.test_plans import plan_of


def ids(log, table):
    df = log.read(table)
    return [] if df is None else sorted((r["batch_id"], r["id"]) for r in df.collect())


def test_a_batch_is_there_whole_or_not_at_all(spark):
    log = BatchLog(spark, work_dir(spark, "batch-log"))
    assert log.commits() is None and log.read("a") is None
    assert log.append("007", {"a": spark.range(3), "b": spark.range(2)})
    assert not log.append("007", {"a": spark.range(9), "b": spark.range(9)})  # committed once
    # fails between two tables: nothing of it can be read
    boom = spark.range(5).select(F.raise_error("no").cast("long").alias("id"))
    with pytest.raises(Exception):
        log.append("x-1", {"a": spark.range(4), "b": boom})
    assert ids(log, "a") == [("007", k) for k in range(3)] and ids(log, "b") == [("007", k) for k in range(2)]
    # run again: each row once
    assert log.append("x-1", {"a": spark.range(4), "b": spark.range(5)})
    assert ids(log, "a") == [("007", k) for k in range(3)] + [("x-1", k) for k in range(4)]
    assert len(ids(log, "b")) == 7 and log.commits().count() == 2
    for bad in ("", "a/b", "a=b"):
        with pytest.raises(ValueError):
            log.append(bad, {"a": spark.range(1)})


def test_score_log_survives_a_failure_between_two_logs(spark, monkeypatch):
    from churnwatch.plans import contract_plans as CP
    from churnwatch.plans import jobs as J
    from churnwatch.plans import ml_plans as ML

    _, pre, _, model = ML._fit(spark, SF001, "logreg")
    batch, hc, path = CP.batch(spark, SF001), ML.fitted_charge(spark, SF001), work_dir(spark, "score-log-fail")
    whole = BatchLog.append

    def half(self, batch_id, tables):
        whole(self, batch_id, {"raw": tables["raw"], "clean": tables["clean"].select(F.raise_error("lost").alias("x"))})

    monkeypatch.setattr(BatchLog, "append", half)
    with pytest.raises(Exception):
        J.score_log_job(spark, batch, path, model, pre, hc, "2024-02-01 00:00:00")
    monkeypatch.setattr(BatchLog, "append", whole)
    log = BatchLog(spark, path)
    assert log.read("raw") is None
    for _ in range(2):  # the second run finds the batch committed
        J.score_log_job(spark, batch, path, model, pre, hc, "2024-02-01 00:00:00")
    n = {name: log.read(name).count() for name in J.SCORE_LOGS}
    assert n["raw"] == n["clean"] == n["encoded"] > 0
    assert log.read("raw").select("row_no").distinct().count() == n["raw"]
    assert log.read("rejected").where("rule = 'id_in_log'").count() == 0
    # another batch of the same rows: all of them are in the log by now
    J.score_log_job(spark, batch, path, model, pre, hc, "2024-02-02 00:00:00")
    assert log.read("raw").count() == n["raw"] and log.read("rejected").where("rule = 'id_in_log'").count() >= n["raw"]


def test_categories_as_a_table_equal_the_lists(spark):
    rows = [(k, float(k % 5) if k % 4 else None, ["yes", "no", None][k % 3], [f"v{k % 6}", None, "Z", "é"][k % 4], "train") for k in range(60)]
    df = spark.createDataFrame(rows, "key long, x double, flag string, kind string, data_split string")
    train = df.where("key < 50").drop("key")
    for kind in ("tree", "linear"):
        pre, enc = FE.fit_preprocessor(train, kind), CG.fit_encoder(train, kind)
        new = df.unionByName(spark.createDataFrame([(99, None, "maybe", "unseen", "test")], df.schema))
        wide = pre.transform(new, keep=["key"])
        want = {(r["key"], c): r[c] for r in wide.collect() for c in pre.output_columns()}
        got = {(r["key"], r["column"]): r["value"] for r in enc.long(new, ["key"]).collect()}
        assert got == want
        vectors = {r["key"]: r["features"] for r in enc.vectors(new, ["key"]).collect()}
        for k, v in vectors.items():
            assert v.toArray().tolist() == [want[k, c] for c in pre.output_columns()]
    assert CG.fit_categories(train, [], {}).count() == 0


def test_many_categories_stay_in_the_table(spark):
    n = 100_000
    train = spark.range(n).select(F.concat(F.lit("c"), F.col("id")).alias("kind"), (F.col("id") % 3).cast("double").alias("x"))
    enc = CG.fit_encoder(train.repartition(4), "tree")
    codes = enc.categories.agg(F.count("*"), F.countDistinct("code"), F.min("code"), F.max("code")).first()
    assert tuple(codes) == (n, n, 0.0, n - 1.0)
    some = spark.createDataFrame([("c0", 1.0), ("c99999", None), ("new", 2.0), (None, 0.0)], "kind string, x double")
    out = enc.vectors(some, ["kind"])
    found = {r["kind"]: r["features"] for r in out.collect()}
    assert all(v.size == n + 1 for v in found.values())
    assert found["c0"].indices.tolist() == [0, 1] and found["c99999"].indices[-1] == n
    assert found["new"].indices.tolist() == [0] and found[None].indices.tolist() == []
    plan = plan_of(out)
    assert len(plan) < 20_000 and "c9999" not in plan
    order = [r["category"] for r in enc.categories.orderBy("code").limit(3).collect()]
    assert order == sorted(f"c{k}" for k in range(n))[:3]


def test_sweep_agrees_with_the_confusion_counts(spark):
    df = spark.createDataFrame([(0.9, 1), (0.1, 0), (float("nan"), 0), (float("nan"), 0), (None, 1)], "score double, label int")
    sweep = EV.threshold_sweep(df, group=None, thresholds=[0.6]).first()
    one = EV.confusion_metrics(df, threshold=0.6).first()
    for name in ("precision", "recall", "accuracy", "f1_score", "predicted_positive_rate"):
        assert sweep[name] == one[name]
    assert sweep["precision"] == 1.0


def test_one_threshold_in_tables_bundle_and_scoring(spark):
    import json

    from churnwatch.plans import jobs as J
    from churnwatch.plans import ml_plans as ML
    from churnwatch.sources import churn as CH

    out = work_dir(spark, "preprocess-one")
    paths = J.preprocess_job(spark, CH.churn_view(spark, SF001), out)
    kept = json.loads(spark.read.text(f"{out}/bundle_tree").first()[0])["high_charge"]
    assert kept == ML.fitted_charge(spark, SF001)
    flagged = spark.read.parquet(paths["tree"]).groupBy("high_monthly_charge").agg(F.min("MonthlyCharges").alias("lo"), F.max("MonthlyCharges").alias("hi")).collect()
    limits = {r["high_monthly_charge"]: r for r in flagged}
    assert limits[0.0]["hi"] < kept <= limits[1.0]["lo"]

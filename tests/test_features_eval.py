"""Features, fitted preprocessing, split, and evaluation metrics against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.operators import evaluate as EV
from churnwatch.operators import features as FE
from churnwatch.operators import quantiles as Q


def test_tenure_bucket_edges(spark):
    df = spark.createDataFrame([(x,) for x in [None, -1.0, 0.0, 12.0, 12.5, 24.0, 48.0, 72.0, 73.0]], "tenure double")
    got = [r["tenure_group"] for r in FE.tenure_bucket(df).orderBy(F.col("tenure").asc_nulls_first()).collect()]
    # NULL -> 0 -> '0-12'; -1 is inside the first (closed) bin; 73 is outside
    assert got == ["0-12", "0-12", "0-12", "0-12", "13-24", "13-24", "25-48", "49-72", None]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(0, 50, 301).astype(float)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    qs = [0.0, 0.1, 0.25, 0.3, 0.5, 0.75, 0.9, 1.0]
    got = Q.exact_quantiles(df, ["x"], qs)["x"]
    assert got == pytest.approx(list(np.quantile(v, qs)), abs=1e-12)
    med = Q.exact_medians(spark.createDataFrame([(1.0,), (2.0,), (4.0,), (7.0,)], "x double"), ["x"])["x"]
    assert med == 3.0


def test_fitted_linear_zero_mean_and_unseen(spark):
    train = spark.createDataFrame(
        [(1.0, "Yes", "a", 1), (2.0, "No", "b", 0), (None, "Yes", None, 1), (5.0, None, "a", 0)],
        "tenure double, Partner string, color string, churn_status int")
    pre = FE.fit_preprocessor(train, "linear")
    assert pre.binary == ["Partner"] and pre.onehot == ["color"] and pre.scaled == ["tenure"]
    out = pre.transform(train).agg(F.avg("tenure")).collect()[0][0]
    assert out == pytest.approx(0.0, abs=1e-12)
    test = spark.createDataFrame([(3.0, "Maybe", "z", 0)], "tenure double, Partner string, color string, churn_status int")
    r = pre.transform(test).collect()[0]
    assert r["Partner"] == -1.0
    assert all(r[f"color_{c}"] == 0.0 for c in pre.onehot_categories["color"])
    assert pre.onehot_categories["color"] == ["a", "b", "missing"]
    assert FE.FittedPreprocessor.from_json(pre.to_json()) == pre


def test_stratified_split_sizes(spark):
    rows = [(f"id{i}", 1 if i % 4 == 0 else 0) for i in range(203)]
    df = spark.createDataFrame(rows, "customerID string, churn_status int")
    s = FE.stratified_assign(df)
    got = {(r["churn_status"], r["data_split"]): r["count"] for r in s.groupBy("churn_status", "data_split").count().collect()}
    n1, n0 = sum(1 for _, y in rows if y), sum(1 for _, y in rows if not y)
    assert got[(1, "test")] == round(0.2 * n1) and got[(0, "test")] == round(0.2 * n0)
    again = {r["customerID"]: r["data_split"] for r in FE.stratified_assign(df).collect()}
    assert again == {r["customerID"]: r["data_split"] for r in s.collect()}


def _np_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def _np_ap(y, s):
    order = np.argsort(-s, kind="mergesort")
    ys, ss = y[order], s[order]
    thr = np.unique(ss)[::-1]
    P, ap, prev_r = y.sum(), 0.0, 0.0
    for t in thr:
        tp = ((ss >= t) & (ys == 1)).sum()
        fp = ((ss >= t) & (ys == 0)).sum()
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


def test_ranking_metrics_match_numpy(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 400)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)  # ties on purpose
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "score double, label int")
    r = EV.ranking_metrics(df).collect()[0]
    assert r["roc_auc"] == pytest.approx(_np_auc(y, s), abs=1e-12)
    assert r["pr_auc"] == pytest.approx(_np_ap(y, s), abs=1e-12)
    eps = np.finfo(float).eps
    p = np.clip(s, eps, 1 - eps)
    ll = EV.log_loss(df).collect()[0]["log_loss"]
    assert ll == pytest.approx(float(np.mean(-(y * np.log(p) + (1 - y) * np.log(1 - p)))), abs=1e-12)


def test_sweep_equals_confusion(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(rng.random(200), rng.integers(0, 2, 200))],
                               "score double, label int")
    sw = {r["threshold"]: r for r in EV.threshold_sweep(df, group=None).collect()}
    for t in (0.1, 0.6, 0.9):
        c = EV.confusion_metrics(df, threshold=t).collect()[0]
        for m in ("accuracy", "precision", "recall", "f1_score", "predicted_positive_rate"):
            assert sw[t][m] == pytest.approx(c[m], abs=1e-15)


def test_single_class_metrics_are_zero(spark):
    df = spark.createDataFrame([(0.3, 0), (0.7, 0)], "score double, label int")
    r = EV.ranking_metrics(df).collect()[0]
    assert r["roc_auc"] == 0.0 and r["pr_auc"] == 0.0
    c = EV.confusion_metrics(df).collect()[0]
    assert c["precision"] == 0.0 and c["recall"] == 0.0 and c["f1_score"] == 0.0


def test_degradation_alert_fixture(spark):
    """Baseline 0.8/0.8/0.82 vs current 0.6/0.65/0.7 must alert (reference monitoring test)."""
    base = spark.createDataFrame([("m", "f1_score", 0.8), ("m", "roc_auc", 0.8), ("m", "accuracy", 0.82)],
                                 "model string, metric string, value double")
    cur = spark.createDataFrame([("m", "f1_score", 0.6), ("m", "roc_auc", 0.65), ("m", "accuracy", 0.7)],
                                "model string, metric string, value double")
    deg = EV.metric_degradation(base, cur, ["model"])
    st = EV.degradation_status(deg, ["model"]).collect()[0]
    assert st["status"] == "ALERT" and st["degraded_metrics"] == 3 and st["total_checked_metrics"] == 3


def test_quality_gate_defaults(spark):
    cur = spark.createDataFrame([("m", "f1_score", 0.58), ("m", "roc_auc", 0.62)], "model string, metric string, value double")
    empty = spark.createDataFrame([], "model string, metric string, value double")
    g = EV.quality_gate(cur, empty, ["model"]).collect()[0]
    assert g["f1_score_threshold"] == pytest.approx(0.60 * 0.95) and g["f1_score_pass"]
    assert g["roc_auc_threshold"] == pytest.approx(0.65 * 0.95) and g["roc_auc_pass"] and g["passed"]
    assert C.GATE_RATIO == 0.95

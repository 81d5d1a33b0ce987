"""Contract rejects (reference API tests), batch rules, series operators, data quality,
monitoring behaviour (reference monitoring tests) and the driver entry points."""

import pytest
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.operators import contract as CT
from churnwatch.operators import drift as D
from churnwatch.operators import quality as QU
from churnwatch.operators import series as SE
from tests.conftest import SF001

PAYLOAD = {
    "customerID": "7590-VHVEG", "gender": "Female", "SeniorCitizen": "0", "Partner": "Yes", "Dependents": "No",
    "tenure": "1", "PhoneService": "No", "MultipleLines": "No phone service", "InternetService": "DSL",
    "OnlineSecurity": "No", "OnlineBackup": "Yes", "DeviceProtection": "No", "TechSupport": "No", "StreamingTV": "No",
    "StreamingMovies": "No", "Contract": "Month-to-month", "PaperlessBilling": "Yes",
    "PaymentMethod": "Electronic check", "MonthlyCharges": "29.85", "TotalCharges": "29.85",
}


def payload_df(spark, rows):
    cols = list(rows[0].keys())
    return spark.createDataFrame([(i, *[r.get(c) for c in cols]) for i, r in enumerate(rows, 1)],
                                 "row_no int, " + ", ".join(f"{c} string" for c in cols))


def test_contract_accepts_valid_and_rejects_four_cases(spark):
    missing = {k: v for k, v in PAYLOAD.items()}
    missing["gender"] = None
    text_charge = dict(PAYLOAD, MonthlyCharges="abc")
    null_id = dict(PAYLOAD, customerID=None)
    total_lt = dict(PAYLOAD, TotalCharges="10.0")
    df = payload_df(spark, [PAYLOAD, missing, text_charge, null_id, total_lt])
    got = {r["row_no"]: (r["accepted"], r["violations"]) for r in CT.contract_check(df).collect()}
    assert got[1] == (True, [])
    assert "gender:required" in got[2][1]
    assert "MonthlyCharges:number" in got[3][1]
    assert "customerID:required" in got[4][1]
    assert got[5][1] == ["TotalCharges:lt_monthly"]


def test_batch_rules(spark):
    rows = [dict(PAYLOAD, customerID=i) for i in ["a", " A ", "", "logged", "b"]]
    rows[4]["TotalCharges"] = "1"
    df = payload_df(spark, rows)
    log = spark.createDataFrame([("LOGGED ",)], "customerID string")
    got = sorted((r["rule"], r["row_no"]) for r in CT.batch_rules(df, log).collect())
    assert got == [("blank_id", 3), ("duplicate_id", 1), ("duplicate_id", 2), ("id_in_log", 4),
                   ("total_lt_monthly", 5)]
    assert sorted(r["row_no"] for r in CT.new_ids(df, log).collect()) == [1, 2, 5]


def _samples(spark, values, metric="c"):
    data = [(f"2024-01-01 {h:02d}:00:00", metric, "s", v) for h, v in values]
    df = spark.createDataFrame(data, "ts string, metric string, series string, value double")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_increase_and_rate_are_reset_aware(spark):
    s = _samples(spark, [(0, 10.0), (1, 15.0), (2, 3.0), (3, 8.0)])
    inc = {r["ts"].hour: r["increase"] for r in SE.increase(s, 3 * 3600).collect()}
    assert inc == {1: 5.0, 2: 8.0, 3: 8.0}  # hour 0 falls outside (t - 3h, t] at hour 3
    rt = {r["ts"].hour: r["rate"] for r in SE.increase(s, 2 * 3600, rate_per_second=True).collect()}
    assert rt[3] == pytest.approx(5.0 / 3600)  # samples at hours 2 and 3: growth 5 over one hour


def test_changes(spark):
    s = _samples(spark, [(0, 1.0), (1, 1.0), (2, 2.0), (3, 1.0)])
    ch = {r["ts"].hour: r["changes"] for r in SE.changes(s, 10 * 3600).collect()}
    assert ch == {0: 0, 1: 0, 2: 1, 3: 2}


def test_histogram_quantile(spark):
    b = spark.createDataFrame([("g", 0.1, 10.0), ("g", 0.5, 50.0), ("g", 1.0, 100.0), ("g", float("inf"), 100.0)],
                              "k string, le double, cumulative double")
    q = SE.histogram_quantile(b, 0.95, ["k"]).collect()[0]["quantile"]
    assert q == pytest.approx(0.5 + 0.5 * (95 - 50) / 50)
    top = spark.createDataFrame([("g", 0.1, 1.0), ("g", float("inf"), 10.0)], "k string, le double, cumulative double")
    assert SE.histogram_quantile(top, 0.95, ["k"]).collect()[0]["quantile"] == 0.1


def test_alert_for_needs_hold_and_no_gap(spark):
    s = _samples(spark, [(0, 1.0), (1, 1.0), (2, 1.0), (5, 1.0), (6, 0.0)])
    ev = SE.evaluate_rule(s, "A", ">", 0.5, "warning", "t")
    fired = sorted(r["ts"].hour for r in SE.alert_for(ev, 3600, 7200).collect())
    assert fired == [1, 2]  # hour 0 is pending; the gap before hour 5 restarts the run


def test_inhibit(spark):
    f = spark.createDataFrame([("A", "critical", "t", "2024-01-01", "s", 1.0, "2024-01-01"),
                               ("A", "warning", "t", "2024-01-01", "s", 1.0, "2024-01-01"),
                               ("B", "warning", "t", "2024-01-01", "s", 1.0, "2024-01-01")],
                              "alertname string, severity string, type string, ts string, series string, value double, "
                              "active_since string")
    got = sorted((r["alertname"], r["severity"]) for r in SE.alert_inhibit(f).collect())
    assert got == [("A", "critical"), ("B", "warning")]


def test_prediction_stats_and_freshness(spark):
    df = spark.createDataFrame([(0.9,), (0.55,), (None,), (1.7,)], "prediction double")
    r = QU.prediction_stats(df).collect()[0]
    assert r["prediction_count"] == 3.0 and r["prediction_positive_rate"] == 1.0
    assert r["low_confidence_fraction"] == pytest.approx(1 / 3)
    e = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("bad",)], "timestamp string")
    lag = QU.freshness_lag(e, "timestamp", "2024-01-01 00:10:00").collect()[0][0]
    assert lag == 600.0
    empty = spark.createDataFrame([("bad",)], "timestamp string")
    assert QU.freshness_lag(empty, "timestamp", "2024-01-01 00:10:00").collect()[0][0] == 0.0


def test_dq_report_schema_violation_ignores_label_and_id(spark):
    ref = spark.createDataFrame([("a", 1.0, 1, "x")], "gender string, tenure double, churn_status int, customerID string")
    cur = spark.createDataFrame([("b", 9.0)], "gender string, tenure double")
    r = QU.dq_report(ref, cur, ["gender", "tenure"]).collect()[0]
    assert r["schema_violation_fraction"] == 0.0
    assert r["unseen_category_ratio"] == 1.0 and r["out_of_range_ratio"] == 1.0


def test_monitoring_id_excluded_and_senior_citizen_categorical(spark):
    ref = spark.createDataFrame([(f"id{i}", i % 2, float(i)) for i in range(6)],
                                "customerID string, SeniorCitizen int, tenure double")
    cur = spark.createDataFrame([(f"new{i}", 1, float(i)) for i in range(6)],
                                "customerID string, SeniorCitizen int, tenure double")
    rep = {r["feature"]: r for r in D.drift_report(ref, cur).collect()}
    assert "customerID" not in rep
    assert rep["SeniorCitizen"]["feature_type"] == "categorical" and rep["SeniorCitizen"]["ks"] is None
    assert rep["SeniorCitizen"]["js"] > 0


def test_due_tiers():
    last = {"fast": 0.0, "medium": 0.0, "drift": 0.0}
    assert QU.due_tiers(61, last, 150, 0) == {"fast": True, "medium": False, "drift": False}
    assert QU.due_tiers(301, last, 150, 0)["drift"] is True
    assert QU.due_tiers(301, last, 50, 0)["drift"] is False
    assert QU.due_tiers(1800, last, 50, 0)["drift"] is True


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    assert out.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert C.CURRENT_WINDOW_SIZE == 5000
    for name in ("row_count", "prediction_stats", "class_weights"):
        assert E.queries()[name](spark, SF001).count() >= 1


def test_dq_labelled_equals_pair(spark):
    rows = [(True, 1.0, "a"), (True, 5.0, "b"), (True, None, None), (True, 3.0, "a"),
            (False, 7.0, "c"), (False, float("nan"), "a"), (False, 2.0, None), (False, 0.5, "z")]
    df = spark.createDataFrame(rows, "is_ref boolean, x double, k string")
    single = QU.dq_report_labelled(df, ["x"], ["k"], required=["x", "k"]).collect()[0].asDict()
    ref, cur = df.where("is_ref").drop("is_ref"), df.where("not is_ref").drop("is_ref")
    pair = QU.dq_report(ref, cur, ["x", "k"]).collect()[0].asDict()
    assert single == pytest.approx(pair)
    assert pair["missing_ratio"] == pytest.approx(2 / 8)       # NaN and NULL in the current side
    assert pair["unseen_category_ratio"] == pytest.approx(2 / 3)
    assert pair["out_of_range_ratio"] == pytest.approx(2 / 3)

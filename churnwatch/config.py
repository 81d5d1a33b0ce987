"""Fixed values of the churn domain and the monitoring limits.

These must equal the values the original pipeline uses for results to agree; they are
stated here once, in natural order, and every operator reads them from this module.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES: churn table schema
# ---------------------------------------------------------------------------
TARGET_COLUMN = "churn_status"
RAW_TARGET_COLUMN = "Churn"
ID_COLUMN = "customerID"
SPLIT_COLUMN = "data_split"

# 20 input feature columns (the raw table has these plus the label column "Churn")
FEATURE_COLUMNS = [
    "customerID",
    "gender",
    "SeniorCitizen",
    "Partner",
    "Dependents",
    "tenure",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
    "MonthlyCharges",
    "TotalCharges",
]
RAW_REQUIRED_COLUMNS = FEATURE_COLUMNS + ["Churn"]
DRIFT_REQUIRED_COLUMNS = [c for c in FEATURE_COLUMNS if c != "customerID"]

# label columns searched in this order
TARGET_COLUMNS = ("Churn", "churn", "churn_status")

# case-insensitive alias (lower-case name) -> canonical name
COLUMN_ALIASES = {c.lower(): c for c in FEATURE_COLUMNS}
COLUMN_ALIASES.update({"churn": "Churn", "churn_status": "churn_status"})

# label text (lower-cased, trimmed) -> class
TARGET_LABEL_MAPPING = {"yes": 1, "no": 0, "0": 0, "1": 1}

# numeric columns cast from text, in this order
NUMERIC_CANDIDATES = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen"]

# column -> (lower bound, upper bound); None = open
SANITY_BOUNDS = {
    "SeniorCitizen": (0, 1),
    "tenure": (0, None),
    "MonthlyCharges": (0, None),
    "TotalCharges": (0, None),
}

# contract domains of the scoring input
YES_NO = ["Yes", "No"]
DOMAINS = {
    "gender": ["Male", "Female"],
    "Partner": YES_NO,
    "Dependents": YES_NO,
    "PhoneService": YES_NO,
    "MultipleLines": ["Yes", "No", "No phone service"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "OnlineSecurity": ["Yes", "No", "No internet service"],
    "OnlineBackup": ["Yes", "No", "No internet service"],
    "DeviceProtection": ["Yes", "No", "No internet service"],
    "TechSupport": ["Yes", "No", "No internet service"],
    "StreamingTV": ["Yes", "No", "No internet service"],
    "StreamingMovies": ["Yes", "No", "No internet service"],
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaperlessBilling": YES_NO,
    "PaymentMethod": [
        "Electronic check",
        "Mailed check",
        "Bank transfer (automatic)",
        "Credit card (automatic)",
    ],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: feature engineering
# ---------------------------------------------------------------------------
HIGH_CARDINALITY_DROP_COLUMNS = ["customerID"]
REPLACED_SOURCE_COLUMNS = ["Contract"]
SERVICE_COLUMNS = [
    "PhoneService",
    "MultipleLines",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]
LINEAR_SCALE_COLUMNS = ["TotalCharges", "MonthlyCharges", "tenure", "service_yes_count"]
# tenure buckets: first closed on both ends, then (lo, hi]
TENURE_BINS = [-1, 12, 24, 48, 72]
TENURE_LABELS = ["0-12", "13-24", "25-48", "49-72"]
HIGH_CHARGE_QUANTILE = 0.75
TEST_SIZE = 0.2
RANDOM_STATE = 42
MISSING_TOKEN = "missing"

# ---------------------------------------------------------------------------
# FIXED VALUES: drift limits
# ---------------------------------------------------------------------------
DRIFT_EXCLUDE_COLUMNS = {"data_split", "churn_status", "customerID"}
CATEGORICAL_OVERRIDE_COLUMNS = {"SeniorCitizen"}
NUMERIC_DRIFT_THRESHOLD = 0.10
PSI_ALERT_THRESHOLD = 0.1
CATEGORICAL_DRIFT_THRESHOLD = 0.10
PSI_CRITICAL = 0.25
KS_CRITICAL = 0.20
JS_CRITICAL = 0.20
DRIFT_FRACTION_CRITICAL = 0.30
PSI_BUCKETS = 10
PSI_EPSILON = 1e-8
NULL_CATEGORY = "<NA>"

# ---------------------------------------------------------------------------
# FIXED VALUES: data-quality and model-quality limits
# ---------------------------------------------------------------------------
MISSING_RATIO_THRESHOLD = 0.10
SCHEMA_VIOLATION_THRESHOLD = 0.0
UNSEEN_CATEGORY_THRESHOLD = 0.05
OUT_OF_RANGE_THRESHOLD = 0.05
FRESHNESS_LAG_THRESHOLD_SECONDS = 1800.0
LOW_CONFIDENCE_PROB_THRESHOLD = 0.60
LOW_CONFIDENCE_FRACTION_THRESHOLD = 0.40
POSITIVE_RATE_MIN_THRESHOLD = 0.05
POSITIVE_RATE_MAX_THRESHOLD = 0.95
POSITIVE_CUT = 0.5
CONFIDENCE_LEVELS = {"low": 1.0, "medium": 2.0, "high": 3.0}

# ---------------------------------------------------------------------------
# FIXED VALUES: evaluation, degradation, gate
# ---------------------------------------------------------------------------
MONITORED_METRICS = ["f1_score", "roc_auc", "accuracy", "precision", "recall"]
MAX_ALLOWED_DEGRADATION = 0.05
GATE_RATIO = 0.95
GATE_DEFAULTS = {"f1_score": 0.60, "roc_auc": 0.65}
SELECTED_THRESHOLD = 0.6
BOOSTING_ITERATIONS = 666
BOOSTING_TOLERANCE = 0.01  # share of the validation loss that further trees must save
SWEEP_THRESHOLDS = [round(0.10 + 0.05 * i, 2) for i in range(17)]  # 0.10 ... 0.90
THRESHOLD_RANGE = (0.30, 0.70)
# threshold score = 0.35 recall + 0.30 precision + 0.20 f1 - 0.40 |ppr - base rate|
THRESHOLD_SCORE_WEIGHTS = {"recall": 0.35, "precision": 0.30, "f1_score": 0.20, "ppr_penalty": 0.40}

# ---------------------------------------------------------------------------
# FIXED VALUES: service metrics histogram bounds
# ---------------------------------------------------------------------------
LATENCY_BUCKETS = [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
BATCH_SIZE_BUCKETS = [1, 2, 5, 10, 20, 50, 100, 200, 500]
PROBABILITY_BUCKETS = [0.0, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 1.0]

# ---------------------------------------------------------------------------
# FIXED VALUES: refresh cadence of the monitor
# ---------------------------------------------------------------------------
FAST_REFRESH_SECONDS = 60
MEDIUM_REFRESH_SECONDS = 300
FAST_DRIFT_SECONDS = 300
SLOW_DRIFT_SECONDS = 1800
MIN_NEW_ROWS = 100
CURRENT_WINDOW_SIZE = 5000


# ---------------------------------------------------------------------------
# FIXED VALUES: limit series and alert rules
# ---------------------------------------------------------------------------
LIMIT_SERIES = {
    "drift_threshold_ks": KS_CRITICAL,
    "drift_threshold_js": JS_CRITICAL,
    "drift_threshold_psi": PSI_CRITICAL,
    "drift_threshold_feature_fraction": DRIFT_FRACTION_CRITICAL,
    "dq_threshold_missing_ratio": MISSING_RATIO_THRESHOLD,
    "dq_threshold_schema_violation_fraction": SCHEMA_VIOLATION_THRESHOLD,
    "dq_threshold_unseen_category_ratio": UNSEEN_CATEGORY_THRESHOLD,
    "dq_threshold_out_of_range_ratio": OUT_OF_RANGE_THRESHOLD,
    "dq_threshold_freshness_lag_seconds": FRESHNESS_LAG_THRESHOLD_SECONDS,
    "model_threshold_low_confidence_fraction": LOW_CONFIDENCE_FRACTION_THRESHOLD,
    "model_threshold_positive_rate_min": POSITIVE_RATE_MIN_THRESHOLD,
    "model_threshold_positive_rate_max": POSITIVE_RATE_MAX_THRESHOLD,
}
# name, metric, series (None: any), comparison, limit (a number or a limit series), seconds it must hold, severity, type
ALERT_RULES = [
    ("DriftCriticalKS", "drift_numeric_ks_max", None, ">", "drift_threshold_ks", 600, "critical", "drift"),
    ("DriftCriticalJS", "drift_categorical_js_max", None, ">", "drift_threshold_js", 600, "critical", "drift"),
    ("DriftCriticalPSI", "drift_numeric_psi_max", None, ">", "drift_threshold_psi", 600, "critical", "drift"),
    ("DriftHighFeatureFraction", "drift_features_alert_fraction", None, ">", "drift_threshold_feature_fraction", 600, "critical", "drift"),
    ("DriftRetrainingRecommended", "drift_retrain_recommended", None, "==", 1.0, 600, "warning", "retraining"),
    ("APITargetDown", "target_down", "job=api", "==", 1.0, 120, "critical", "service"),
    ("APIHigh5xxErrorRate", "api_error_ratio", None, ">", 0.05, 300, "critical", "service"),
    ("APIHighLatencyP95", "api_latency_p95", None, ">", 1.0, 600, "warning", "service"),
    ("APILowRequestRate", "api_request_rate", None, "<", 0.01, 1800, "warning", "service"),
    ("DriftExporterTargetDown", "target_down", "job=drift_exporter", "==", 1.0, 120, "critical", "drift-exporter"),
    ("DriftExporterCollectionFailure", "drift_exporter_up", None, "==", 0.0, 300, "critical", "drift-exporter"),
    ("DataQualityMissingValuesHigh", "dq_missing_ratio", None, ">", "dq_threshold_missing_ratio", 600, "warning", "data-quality"),
    ("DataQualitySchemaViolation", "dq_schema_violation_fraction", None, ">", "dq_threshold_schema_violation_fraction", 120, "critical", "data-quality"),
    ("DataQualityUnseenCategoryHigh", "dq_unseen_category_ratio", None, ">", "dq_threshold_unseen_category_ratio", 600, "warning", "data-quality"),
    ("DataQualityOutOfRangeHigh", "dq_out_of_range_ratio", None, ">", "dq_threshold_out_of_range_ratio", 600, "warning", "data-quality"),
    ("DataFreshnessLagHigh", "dq_freshness_lag_seconds", None, ">", "dq_threshold_freshness_lag_seconds", 900, "warning", "data-quality"),
    ("ModelLowConfidenceHigh", "model_low_confidence_fraction", None, ">", "model_threshold_low_confidence_fraction", 900, "warning", "model-quality"),
    ("ModelPositiveRateTooLow", "model_prediction_positive_rate", None, "<", "model_threshold_positive_rate_min", 1200, "warning", "model-quality"),
    ("ModelPositiveRateTooHigh", "model_prediction_positive_rate", None, ">", "model_threshold_positive_rate_max", 1200, "warning", "model-quality"),
]


@dataclass(frozen=True)
class DriftLimits:
    numeric: float = NUMERIC_DRIFT_THRESHOLD
    psi_alert: float = PSI_ALERT_THRESHOLD
    categorical: float = CATEGORICAL_DRIFT_THRESHOLD
    psi_critical: float = PSI_CRITICAL
    ks_critical: float = KS_CRITICAL
    js_critical: float = JS_CRITICAL
    fraction_critical: float = DRIFT_FRACTION_CRITICAL
    psi_buckets: int = PSI_BUCKETS

"""Drift-family queries over the order tables (reference = orders before the split date)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.functions.scalar import rnd
from churnwatch.operators import counts as K
from churnwatch.operators import drift as D
from churnwatch.plans import oracle_drift as O
from churnwatch.plans.registry import register
from churnwatch.session import cut_lineage
from churnwatch.sources import tables as S

REPORT_COLS = ["feature", "feature_type", "ks", "js", "psi", "value", "severity", "alert", "reason"]
ROUND = ["ks", "js", "psi", "value", "severity"]


def _rounded(df: DataFrame, cols: list[str], round_cols: list[str]) -> DataFrame:
    return df.select(*[rnd(F.col(c)).alias(c) if c in round_cols else F.col(c) for c in cols])


def report(spark: SparkSession, sf_dir: str, shifted: bool = False, with_pvalue: bool = False) -> DataFrame:
    d = S.drift_frame(spark, sf_dir, shifted)
    return D.drift_report_labelled(d, S.DRIFT_NUMERIC, S.DRIFT_CATEGORICAL, with_pvalue=with_pvalue)


def _counts(spark: SparkSession, sf_dir: str, shifted: bool = False) -> DataFrame:
    d = S.drift_frame(spark, sf_dir, shifted)
    return cut_lineage(K.paired_counts(d, S.DRIFT_NUMERIC, S.DRIFT_CATEGORICAL), "counts")


@register("drift_report", O.report_sql(False))
def q_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(report(spark, sf_dir), REPORT_COLS, ROUND)


@register("drift_report_shifted", O.report_sql(True))
def q_drift_report_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(report(spark, sf_dir, shifted=True), REPORT_COLS, ROUND)


@register("numeric_drift", O.report_sql(True) + " WHERE feature_type = 'numeric'")
def q_numeric_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    num = K.numeric_counts(_counts(spark, sf_dir, True))
    return _rounded(D.numeric_drift(num), REPORT_COLS, ROUND)


@register("categorical_drift", O.report_sql(True) + " WHERE feature_type = 'categorical'")
def q_categorical_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = K.categorical_counts(_counts(spark, sf_dir, True))
    return _rounded(D.categorical_drift(cat), REPORT_COLS, ROUND)


@register("ks_statistic", f"WITH {O.drift_ctes(True)} SELECT feature, round(ks, 9) AS ks FROM ks")
def q_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    num = K.numeric_counts(_counts(spark, sf_dir, True))
    totals = {f: t for f, t in K.feature_totals(num).items() if t["n_ref"] >= 2 and t["n_cur"] >= 2}
    cum = K.with_cumulative(num.where(F.col("feature").isin(list(totals))))
    return D.ks_table(cum).select("feature", rnd(F.col("ks")).alias("ks"))


@register("psi", f"WITH {O.drift_ctes(True)} SELECT feature, round(psi, 9) AS psi FROM psi")
def q_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    num = K.numeric_counts(_counts(spark, sf_dir, True))
    totals = {f: t for f, t in K.feature_totals(num).items() if t["n_ref"] >= 2 and t["n_cur"] >= 2}
    cum = cut_lineage(K.with_cumulative(num.where(F.col("feature").isin(list(totals)))), "cum")
    edges = D.reference_quantiles(cum, totals, D.quantile_probs())
    return D.psi_table(cum, edges).select("feature", rnd(F.col("psi")).alias("psi"))


@register("js_distance", f"WITH {O.drift_ctes(True)} SELECT feature, round(js, 9) AS js FROM js")
def q_js(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = K.categorical_counts(_counts(spark, sf_dir, True))
    return D.js_table(cat).select("feature", rnd(F.col("js")).alias("js"))


@register(
    "entropy",
    f"""WITH {O.drift_ctes(True)}
SELECT feature,
  round(sum(CASE WHEN n_ref > 0 THEN -(CAST(n_ref AS DOUBLE) / rt) * log2(CAST(n_ref AS DOUBLE) / rt) ELSE 0.0 END), 9)
    AS entropy_ref,
  round(sum(CASE WHEN n_cur > 0 THEN -(CAST(n_cur AS DOUBLE) / ctt) * log2(CAST(n_cur AS DOUBLE) / ctt) ELSE 0.0 END), 9)
    AS entropy_cur
FROM ctot GROUP BY feature""",
)
def q_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = K.categorical_counts(_counts(spark, sf_dir, True))
    e = D.entropy_table(cat)
    return e.select("feature", rnd(F.col("entropy_ref")).alias("entropy_ref"), rnd(F.col("entropy_cur")).alias("entropy_cur"))


@register(
    "chi2_test",
    f"""WITH {O.drift_ctes(True)},
e AS (SELECT feature, n_ref, n_cur, rt, ctt, CAST(n_ref + n_cur AS DOUBLE) AS rw, CAST(rt + ctt AS DOUBLE) AS n FROM ctot)
SELECT feature,
  round(sum((n_ref - rw * rt / n) * (n_ref - rw * rt / n) / (rw * rt / n)
          + (n_cur - rw * ctt / n) * (n_cur - rw * ctt / n) / (rw * ctt / n)), 6) AS chi2,
  count(*) - 1 AS dof
FROM e GROUP BY feature""",
)
def q_chi2(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = K.categorical_counts(_counts(spark, sf_dir, True))
    return D.chi2_table(cat).select("feature", F.round("chi2", 6).alias("chi2"), "dof")


@register("drift_pvalues")
def q_pvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KS asymptotic p-value and chi-square p-value per feature (no SQL oracle: needs
    distribution functions DuckDB lacks; checked against NumPy in tests)."""
    r = report(spark, sf_dir, shifted=True, with_pvalue=True)
    return r.select("feature", "feature_type", rnd(F.col("value")).alias("value"), F.col("p_value"))


@register(
    "paired_counts",
    f"""WITH {O.drift_ctes(True)}
SELECT 'numeric' AS kind, feature, value AS num_value, CAST(NULL AS VARCHAR) AS cat_value, n_ref, n_cur FROM cnt
UNION ALL
SELECT 'categorical', feature, CAST(NULL AS DOUBLE), value, n_ref, n_cur FROM ccnt""",
)
def q_paired_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = S.drift_frame(spark, sf_dir, True)
    return K.paired_counts(d, S.DRIFT_NUMERIC, S.DRIFT_CATEGORICAL)


@register(
    "empirical_cdf",
    f"""WITH {O.drift_ctes(True)},
all_cum AS (
  SELECT feature, value,
    sum(n_ref) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr,
    sum(n_cur) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc,
    sum(n_ref) OVER (PARTITION BY feature) AS nr, sum(n_cur) OVER (PARTITION BY feature) AS nc
  FROM cnt)
SELECT feature, value, round(CASE WHEN nr > 0 THEN CAST(cr AS DOUBLE) / nr END, 9) AS cdf_ref,
  round(CASE WHEN nc > 0 THEN CAST(cc AS DOUBLE) / nc END, 9) AS cdf_cur
FROM all_cum""",
)
def q_empirical_cdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    num = K.numeric_counts(_counts(spark, sf_dir, True))
    cdf = K.empirical_cdf(num)
    return cdf.select("feature", "value", rnd(F.col("cdf_ref")).alias("cdf_ref"), rnd(F.col("cdf_cur")).alias("cdf_cur"))


@register("retraining_decision", O.decision_sql(True))
def q_retraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    dec = D.retraining_decision(report(spark, sf_dir, shifted=True))
    return dec.select(
        "recommended",
        "confidence",
        F.array_join("reasons", " | ").alias("reasons_text"),
        F.size("reasons").cast("bigint").alias("reason_count"),
        rnd(F.col("drift_fraction")).alias("drift_fraction"),
        rnd(F.col("avg_severity")).alias("avg_severity"),
    )


@register("drift_summary", O.summary_sql(True))
def q_drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = D.drift_summary(report(spark, sf_dir, shifted=True))
    rc = ["alert_fraction", "ks_max", "js_max", "psi_max", "avg_severity"]
    return _rounded(s, s.columns, rc)


@register("drift_gauges", O.gauges_sql(True))
def q_drift_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = D.drift_gauges(report(spark, sf_dir, shifted=True))
    return g.select("feature", "feature_type", "metric", rnd(F.col("value")).alias("value"))


@register("series_sort_desc", O.gauges_sql(True).replace(
    "SELECT feature, feature_type, metric, round(value, 9) AS value FROM (",
    "SELECT * FROM (SELECT feature, feature_type, metric, round(value, 9) AS value FROM (", 1)
    + ") WHERE metric = 'ks' ORDER BY value DESC")
def q_series_sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-feature score for one metric (KS), high to low."""
    g = D.drift_gauges(report(spark, sf_dir, shifted=True)).where(F.col("metric") == "ks")
    return g.select("feature", "feature_type", "metric", rnd(F.col("value")).alias("value")).coalesce(1) \
        .sortWithinPartitions(F.desc("value"))


__all__ = ["report", "C"]

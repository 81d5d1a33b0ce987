"""Data-quality, freshness and log-window queries.

Reference and current are the order tables before / after the split date, with the
shifted current side (new segment label, scaled quantities) so the ratios are not 0.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.functions.scalar import rnd
from churnwatch.operators import quality as QU
from churnwatch.plans import eval_plans as EP
from churnwatch.plans import oracle_drift as OD
from churnwatch.plans.registry import register
from churnwatch.sources import tables as S

REQUIRED = S.DRIFT_NUMERIC + S.DRIFT_CATEGORICAL + ["l_tax"]
NOW = "2024-02-01 00:00:00"
PAIR_SQL = (f"j AS ({OD.drift_input_sql(True)}), ref AS (SELECT * EXCLUDE (is_ref) FROM j WHERE is_ref), "
            "cur AS (SELECT * EXCLUDE (is_ref) FROM j WHERE NOT is_ref)")


def _pair(spark, sf_dir):
    return S.drift_pair(spark, sf_dir, shifted=True)


def _missing_sql() -> str:
    cols = S.DRIFT_NUMERIC + S.DRIFT_CATEGORICAL
    nulls = " + ".join(
        f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in S.DRIFT_NUMERIC else ''})" for c in cols)
    return f"SELECT coalesce(CAST({nulls} AS DOUBLE) / nullif(count(*) * {len(cols)}, 0), 0.0) AS missing_ratio FROM cur"


def _unseen_sql() -> str:
    per = " UNION ALL ".join(
        f"SELECT count(*) FILTER (WHERE {c} NOT IN (SELECT {c} FROM ref WHERE {c} IS NOT NULL)) / count(*) AS r "
        f"FROM cur WHERE {c} IS NOT NULL HAVING count(*) > 0" for c in S.DRIFT_CATEGORICAL)
    return f"SELECT coalesce(avg(r), 0.0) AS unseen_category_ratio FROM ({per})"


def _oor_sql() -> str:
    per = " UNION ALL ".join(
        f"SELECT count(*) FILTER (WHERE {c} < (SELECT min({c}) FROM ref) OR {c} > (SELECT max({c}) FROM ref)) / count(*) "
        f"AS r FROM cur WHERE {c} IS NOT NULL AND NOT isnan({c}) HAVING count(*) > 0" for c in S.DRIFT_NUMERIC)
    return f"SELECT coalesce(avg(r), 0.0) AS out_of_range_ratio FROM ({per})"


@register("dq_missing_ratio", f"WITH {PAIR_SQL} SELECT round(missing_ratio, 9) AS missing_ratio FROM ({_missing_sql()})")
def q_dq_missing(spark, sf_dir):
    ref, cur = _pair(spark, sf_dir)
    common, _, _ = QU.dq_roles(ref, cur)
    return QU.dq_missing_ratio(cur, common).select(rnd(F.col("missing_ratio")).alias("missing_ratio"))


@register("dq_unseen_ratio",
          f"WITH {PAIR_SQL} SELECT round(unseen_category_ratio, 9) AS unseen_category_ratio FROM ({_unseen_sql()})")
def q_dq_unseen(spark, sf_dir):
    ref, cur = _pair(spark, sf_dir)
    _, cat, _ = QU.dq_roles(ref, cur)
    return QU.dq_unseen_ratio(ref, cur, cat).select(rnd(F.col("unseen_category_ratio")).alias("unseen_category_ratio"))


@register("dq_out_of_range",
          f"WITH {PAIR_SQL} SELECT round(out_of_range_ratio, 9) AS out_of_range_ratio FROM ({_oor_sql()})")
def q_dq_oor(spark, sf_dir):
    ref, cur = _pair(spark, sf_dir)
    _, _, num = QU.dq_roles(ref, cur)
    return QU.dq_out_of_range(ref, cur, num).select(rnd(F.col("out_of_range_ratio")).alias("out_of_range_ratio"))


ORACLE_DQ_REPORT = f"""WITH {PAIR_SQL}
SELECT round(m.missing_ratio, 9) AS missing_ratio, CAST('{1 / len(REQUIRED)!r}' AS DOUBLE) AS schema_violation_fraction,
  round(u.unseen_category_ratio, 9) AS unseen_category_ratio, round(o.out_of_range_ratio, 9) AS out_of_range_ratio
FROM ({_missing_sql()}) m, ({_unseen_sql()}) u, ({_oor_sql()}) o"""


@register("dq_report", ORACLE_DQ_REPORT)
def q_dq_report(spark, sf_dir):
    """Single scan: both samples in one frame, ratios from the paired-counts table."""
    d = S.drift_frame(spark, sf_dir, shifted=True)
    r = QU.dq_report_labelled(d, S.DRIFT_NUMERIC, S.DRIFT_CATEGORICAL, required=REQUIRED)
    return r.select(*[rnd(F.col(c)).alias(c) if c != "schema_violation_fraction" else F.col(c) for c in r.columns])


@register("dq_report_pair", ORACLE_DQ_REPORT)
def q_dq_report_pair(spark, sf_dir):
    """Two-frame form (reference and current as separate tables)."""
    ref, cur = _pair(spark, sf_dir)
    r = QU.dq_report(ref, cur, REQUIRED)
    return r.select(*[rnd(F.col(c)).alias(c) if c != "schema_violation_fraction" else F.col(c) for c in r.columns])


@register("unseen_values_anti_join", f"""WITH {PAIR_SQL},
c AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS value FROM cur WHERE {c} IS NOT NULL" for c in S.DRIFT_CATEGORICAL)}),
r AS ({' UNION ALL '.join(f"SELECT DISTINCT '{c}' AS feature, {c} AS value FROM ref WHERE {c} IS NOT NULL" for c in S.DRIFT_CATEGORICAL)})
SELECT feature, value, count(*) AS n FROM c WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.feature = c.feature AND r.value = c.value)
GROUP BY feature, value""")
def q_unseen_values(spark, sf_dir):
    ref, cur = _pair(spark, sf_dir)
    return QU.unseen_values(ref, cur, S.DRIFT_CATEGORICAL)


@register("range_broadcast_join", f"""WITH {PAIR_SQL},
b AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, min({c}) AS lo, max({c}) AS hi FROM ref" for c in S.DRIFT_NUMERIC)}),
c AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM cur WHERE {c} IS NOT NULL" for c in S.DRIFT_NUMERIC)})
SELECT c.feature, count(*) FILTER (WHERE c.value < b.lo OR c.value > b.hi) AS out_of_range, count(*) AS n
FROM c JOIN b ON c.feature = b.feature GROUP BY c.feature""")
def q_range_join(spark, sf_dir):
    ref, cur = _pair(spark, sf_dir)
    from churnwatch.operators.quantiles import long_values

    bounds = long_values(ref, S.DRIFT_NUMERIC).groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    c = long_values(cur, S.DRIFT_NUMERIC)
    # bounds: one row per numeric feature, so the broadcast side is bounded by the feature list
    j = c.join(F.broadcast(bounds), "feature")
    return j.groupBy("feature").agg(
        F.count_if((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))).alias("out_of_range"),
        F.count("*").alias("n"))


@register("freshness_lag", f"""SELECT round(coalesce(greatest((epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(ts))) / 1e6, 0.0),
  0.0), 6) AS freshness_lag_seconds FROM events""")
def q_freshness(spark, sf_dir):
    f = QU.freshness_lag(S.table(spark, sf_dir, "events"), "ts", NOW)
    return f.select(F.round("freshness_lag_seconds", 6).alias("freshness_lag_seconds"))


@register("latest_window", f"""WITH {EP.SCORED_SQL}
SELECT event_id, ts, score FROM scored ORDER BY ts DESC, event_id DESC LIMIT {C.CURRENT_WINDOW_SIZE}""")
def q_latest_window(spark, sf_dir):
    s = EP.scored(spark, sf_dir)
    return QU.latest_window(s).select("event_id", "ts", "score")


@register("latest_window_stats", f"""WITH {EP.SCORED_SQL},
w AS (SELECT score FROM scored ORDER BY ts DESC, event_id DESC LIMIT {C.CURRENT_WINDOW_SIZE}),
p AS (SELECT least(greatest(score, 0.0), 1.0) AS p FROM w WHERE score IS NOT NULL)
SELECT CAST(count(*) AS DOUBLE) AS prediction_count, round(coalesce(avg(p), 0.0), 9) AS prediction_mean,
  round(coalesce(stddev_pop(p), 0.0), 9) AS prediction_std,
  round(coalesce(avg(CASE WHEN p >= {C.POSITIVE_CUT} THEN 1.0 ELSE 0.0 END), 0.0), 9) AS prediction_positive_rate,
  round(coalesce(avg(CASE WHEN greatest(p, 1.0 - p) < {C.LOW_CONFIDENCE_PROB_THRESHOLD} THEN 1.0 ELSE 0.0 END), 0.0), 9)
    AS low_confidence_fraction FROM p""")
def q_latest_window_stats(spark, sf_dir):
    w = QU.latest_window(EP.scored(spark, sf_dir))
    s = QU.prediction_stats(w, "score")
    return s.select(*[rnd(F.col(c)).alias(c) if c != "prediction_count" else F.col(c) for c in s.columns])

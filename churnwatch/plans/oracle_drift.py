"""DuckDB SQL for the drift family, written from the definitions (plain windows over
sorted values, no buckets), independent of the Spark operators it checks."""

from __future__ import annotations

from churnwatch import config as C
from churnwatch.sources.tables import DRIFT_CATEGORICAL, DRIFT_NUMERIC, DRIFT_SPLIT_DATE


def _q(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def drift_input_sql(shifted: bool = False) -> str:
    is_ref = f"o_orderdate < TIMESTAMP '{DRIFT_SPLIT_DATE} 00:00:00'"
    cols = []
    for c in DRIFT_NUMERIC + DRIFT_CATEGORICAL:
        x = c
        if shifted and c == "l_quantity":
            x = f"CASE WHEN {is_ref} THEN l_quantity ELSE l_quantity * 1.3 END"
        if shifted and c == "o_orderpriority":
            x = (f"CASE WHEN {is_ref} THEN o_orderpriority WHEN substring(o_orderpriority, 1, 1) IN ('4', '5') "
                 "THEN '3-MEDIUM' ELSE o_orderpriority END")
        if shifted and c == "c_mktsegment":
            x = f"CASE WHEN {is_ref} THEN c_mktsegment WHEN c_mktsegment = 'MACHINERY' THEN 'ROBOTICS' ELSE c_mktsegment END"
        cols.append(f"{x} AS {c}")
    return (f"SELECT {is_ref} AS is_ref, {', '.join(cols)} FROM lineitem "
            "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey")


def drift_ctes(shifted: bool = False, numeric=None, categorical=None) -> str:
    numeric = DRIFT_NUMERIC if numeric is None else numeric
    categorical = DRIFT_CATEGORICAL if categorical is None else categorical
    pos = " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(numeric + categorical))
    num_union = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, is_ref FROM j" for f in numeric
    )
    cat_union = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, coalesce(CAST({f} AS VARCHAR), '{C.NULL_CATEGORY}') AS value, is_ref FROM j"
        for f in categorical
    )
    probs = [i * (1.0 / C.PSI_BUCKETS) for i in range(C.PSI_BUCKETS)] + [1.0]
    qvals = ", ".join(f"({i}, {_q(q)})" for i, q in enumerate(probs))
    b = C.PSI_BUCKETS
    ks_t, psi_t, js_t = C.NUMERIC_DRIFT_THRESHOLD, C.PSI_ALERT_THRESHOLD, C.CATEGORICAL_DRIFT_THRESHOLD
    return f"""
j AS ({drift_input_sql(shifted)}),
num AS ({num_union}),
cnt AS (
  SELECT feature, value, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur
  FROM num WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY feature, value),
tot AS (
  SELECT feature, sum(n_ref) AS nr, sum(n_cur) AS nc FROM cnt GROUP BY feature
  HAVING sum(n_ref) >= 2 AND sum(n_cur) >= 2),
cum AS (
  SELECT c.feature, c.value, c.n_ref, c.n_cur, t.nr, t.nc,
    sum(c.n_ref) OVER (PARTITION BY c.feature ORDER BY c.value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr,
    sum(c.n_cur) OVER (PARTITION BY c.feature ORDER BY c.value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc
  FROM cnt c JOIN tot t ON c.feature = t.feature),
ks AS (
  SELECT feature, max(abs(CAST(cr AS DOUBLE) / nr - CAST(cc AS DOUBLE) / nc)) AS ks, max(nr) AS nr, max(nc) AS nc
  FROM cum GROUP BY feature),
qs AS (SELECT * FROM (VALUES {qvals}) AS q(i, q)),
pos AS (
  SELECT feature, i, nr, (CAST(nr AS DOUBLE) - 1.0) * q AS vi FROM tot CROSS JOIN qs),
pos2 AS (
  SELECT feature, i,
    CASE WHEN vi >= nr - 1 THEN nr - 1 ELSE CAST(floor(vi) AS BIGINT) END AS plo,
    CASE WHEN vi >= nr - 1 THEN nr - 1 ELSE CAST(floor(vi) AS BIGINT) + 1 END AS phi,
    CASE WHEN vi >= nr - 1 THEN 0.0 ELSE vi - floor(vi) END AS g
  FROM pos),
ev AS (
  SELECT p.feature, p.i, lo.value AS a, hi.value AS b, p.g FROM pos2 p
  JOIN cum lo ON lo.feature = p.feature AND lo.n_ref > 0 AND lo.cr - lo.n_ref <= p.plo AND p.plo < lo.cr
  JOIN cum hi ON hi.feature = p.feature AND hi.n_ref > 0 AND hi.cr - hi.n_ref <= p.phi AND p.phi < hi.cr),
edges AS (
  SELECT feature, i, CASE WHEN g >= 0.5 THEN b - (b - a) * (1.0 - g) ELSE a + (b - a) * g END AS edge FROM ev),
rng AS (
  SELECT feature, max(edge) FILTER (WHERE i = 0) AS e0, max(edge) FILTER (WHERE i = {b}) AS eb FROM edges GROUP BY feature),
binned AS (
  SELECT c.feature, c.value, c.n_ref, c.n_cur, count(e.edge) AS bin
  FROM cum c JOIN rng r ON c.feature = r.feature AND c.value >= r.e0 AND c.value <= r.eb
  LEFT JOIN edges e ON e.feature = c.feature AND e.i BETWEEN 1 AND {b - 1} AND e.edge <= c.value
  GROUP BY c.feature, c.value, c.n_ref, c.n_cur),
bins AS (SELECT feature, bin, sum(n_ref) AS r, sum(n_cur) AS c FROM binned GROUP BY feature, bin),
sh AS (
  SELECT feature, r, c, sum(r) OVER (PARTITION BY feature) AS rt, sum(c) OVER (PARTITION BY feature) AS ct FROM bins),
sh2 AS (
  SELECT feature, ct,
    CASE WHEN r = 0 THEN {C.PSI_EPSILON!r} ELSE CAST(r AS DOUBLE) / rt END AS p,
    CASE WHEN ct = 0 THEN NULL WHEN c = 0 THEN {C.PSI_EPSILON!r} ELSE CAST(c AS DOUBLE) / ct END AS q
  FROM sh),
psi AS (
  SELECT feature, CASE WHEN max(ct) > 0 THEN sum((p - q) * ln(p / q)) END AS psi FROM sh2 GROUP BY feature),
numrep AS (
  SELECT k.feature, 'numeric' AS feature_type, k.ks, CAST(NULL AS DOUBLE) AS js, s.psi, k.ks AS value,
    CASE WHEN s.psi IS NOT NULL THEN
      least(greatest(0.6 * least(k.ks, 1.0) + 0.4 * least(s.psi / 0.2, 1.0), 0.0), 1.0) END AS severity,
    (k.ks > {ks_t}) OR coalesce(s.psi > {psi_t}, false) AS alert,
    coalesce(nullif(concat_ws(', ',
      CASE WHEN k.ks > {ks_t} THEN 'KS>{ks_t}' END,
      CASE WHEN s.psi > {psi_t} THEN 'PSI>{psi_t}' END,
      CASE WHEN s.psi IS NULL THEN 'no_overlap' END), ''), 'ok') AS reason
  FROM ks k LEFT JOIN psi s ON k.feature = s.feature),
cat AS ({cat_union}),
ccnt AS (
  SELECT feature, value, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur
  FROM cat GROUP BY feature, value),
ctot AS (
  SELECT feature, value, n_ref, n_cur, sum(n_ref) OVER (PARTITION BY feature) AS rt,
    sum(n_cur) OVER (PARTITION BY feature) AS ctt FROM ccnt),
cshare AS (
  SELECT feature, rt, ctt, n_ref, n_cur,
    CASE WHEN rt > 0 THEN CAST(n_ref AS DOUBLE) / rt END AS p,
    CASE WHEN ctt > 0 THEN CAST(n_cur AS DOUBLE) / ctt END AS q FROM ctot),
js AS (
  SELECT feature,
    CASE WHEN max(rt) > 0 AND max(ctt) > 0 THEN
      sqrt(greatest(sum((CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2.0)) ELSE 0.0 END)
                      + (CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2.0)) ELSE 0.0 END)) / ln(2.0) / 2.0, 0.0))
    ELSE 0.0 END AS js
  FROM cshare GROUP BY feature),
catrep AS (
  SELECT feature, 'categorical' AS feature_type, CAST(NULL AS DOUBLE) AS ks, js, CAST(NULL AS DOUBLE) AS psi,
    js AS value, least(greatest(least(js, 1.0), 0.0), 1.0) AS severity, js > {js_t} AS alert,
    CASE WHEN js > {js_t} THEN 'JS>{js_t}' ELSE 'ok' END AS reason
  FROM js),
report AS (
  SELECT *, CASE feature {pos} END AS position FROM (SELECT * FROM numrep UNION ALL SELECT * FROM catrep))"""


def r9(c: str) -> str:
    return f"round({c}, 9) AS {c}"


def report_sql(shifted: bool = False) -> str:
    return f"""WITH {drift_ctes(shifted)}
SELECT feature, feature_type, {r9('ks')}, {r9('js')}, {r9('psi')}, {r9('value')}, {r9('severity')}, alert, reason
FROM report"""


def decision_ctes() -> str:
    names = lambda cond: (
        f"coalesce(string_agg(feature, ', ' ORDER BY alert DESC, value DESC, position) FILTER (WHERE {cond}), '')"
    )
    fc = C.DRIFT_FRACTION_CRITICAL
    pct = lambda x: f"CAST(CAST(round_even({x} * 100.0, 0) AS BIGINT) AS VARCHAR) || '%'"
    return f"""
agg AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE alert) AS drifted,
    {names(f'psi > {C.PSI_CRITICAL}')} AS crit_psi,
    {names(f"feature_type = 'numeric' AND value > {C.KS_CRITICAL}")} AS crit_ks,
    {names(f"feature_type = 'categorical' AND value > {C.JS_CRITICAL}")} AS crit_js,
    avg(severity) FILTER (WHERE alert) AS avg_sev
  FROM report),
dec0 AS (
  SELECT CASE WHEN total > 0 THEN CAST(drifted AS DOUBLE) / total ELSE 0.0 END AS drift_fraction,
    crit_psi, crit_ks, crit_js, coalesce(avg_sev, 0.0) AS avg_severity FROM agg),
dec1 AS (
  SELECT *, list_filter([
      CASE WHEN crit_psi <> '' THEN 'PSI > {C.PSI_CRITICAL} on: ' || crit_psi END,
      CASE WHEN crit_ks <> '' THEN 'KS > {C.KS_CRITICAL} on: ' || crit_ks END,
      CASE WHEN crit_js <> '' THEN 'JS > {C.JS_CRITICAL} on: ' || crit_js END,
      CASE WHEN drift_fraction > {fc} THEN {pct('drift_fraction')} || ' of features are drifted (threshold: '
           || {pct(repr(fc))} || ')' END], lambda x: x IS NOT NULL) AS reasons
  FROM dec0),
decision AS (
  SELECT len(reasons) > 0 AS recommended,
    CASE WHEN len(reasons) >= 3 OR (crit_psi <> '' AND drift_fraction > {fc}) THEN 'high'
         WHEN len(reasons) = 2 OR avg_severity > 0.6 THEN 'medium'
         WHEN len(reasons) = 0 THEN 'low' ELSE 'medium' END AS confidence,
    array_to_string(reasons, ' | ') AS reasons_text, CAST(len(reasons) AS BIGINT) AS reason_count,
    drift_fraction, avg_severity
  FROM dec1)"""


def decision_sql(shifted: bool = True) -> str:
    return f"""WITH {drift_ctes(shifted)}, {decision_ctes()}
SELECT recommended, confidence, reasons_text, reason_count, {r9('drift_fraction')}, {r9('avg_severity')}
FROM decision"""


def summary_sql(shifted: bool = True) -> str:
    return f"""WITH {drift_ctes(shifted)}, {decision_ctes()},
summ AS (
  SELECT count(*) AS features_total, count(*) FILTER (WHERE alert) AS features_alert,
    coalesce(max(coalesce(ks, 0.0)) FILTER (WHERE feature_type = 'numeric'), 0.0) AS ks_max,
    coalesce(max(coalesce(js, 0.0)) FILTER (WHERE feature_type = 'categorical'), 0.0) AS js_max,
    coalesce(max(coalesce(psi, 0.0)) FILTER (WHERE feature_type = 'numeric'), 0.0) AS psi_max
  FROM report)
SELECT features_total, features_alert,
  {r9('alert_fraction')}, {r9('ks_max')}, {r9('js_max')}, {r9('psi_max')}, {r9('avg_severity')},
  retrain_recommended, retrain_confidence
FROM (
  SELECT s.*, CASE WHEN features_total > 0 THEN CAST(features_alert AS DOUBLE) / features_total ELSE 0.0 END
      AS alert_fraction,
    d.avg_severity, CASE WHEN d.recommended THEN 1.0 ELSE 0.0 END AS retrain_recommended,
    CASE d.confidence WHEN 'low' THEN 1.0 WHEN 'medium' THEN 2.0 WHEN 'high' THEN 3.0 ELSE 0.0 END
      AS retrain_confidence
  FROM summ s CROSS JOIN decision d)"""


def gauges_sql(shifted: bool = True) -> str:
    return f"""WITH {drift_ctes(shifted)}
SELECT feature, feature_type, metric, round(value, 9) AS value FROM (
  SELECT feature, feature_type, 'state' AS metric, CASE WHEN alert THEN 1.0 ELSE 0.0 END AS value FROM report
  UNION ALL SELECT feature, feature_type, 'ks', ks FROM report
  UNION ALL SELECT feature, feature_type, 'js', js FROM report
  UNION ALL SELECT feature, feature_type, 'psi', psi FROM report) WHERE value IS NOT NULL"""

"""Drift, data quality and service metrics of a monitored log as series, and every alert rule over them.

``events`` is read as a log with known faults (``sources.tables.monitored_log``): the rows of the first week are the reference,
windows of a day are evaluated every six hours, service metrics every hour."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.functions.scalar import rnd
from churnwatch.operators import drift as D
from churnwatch.operators import drift_series as DS
from churnwatch.operators import grid as G
from churnwatch.operators import series as SE
from churnwatch.plans.registry import register
from churnwatch.session import cut_lineage
from churnwatch.sources import tables as S

PANE_S, WINDOW_PANES = 6 * 3600, 4
START, END = "2024-01-08 06:00:00", "2024-01-31 00:00:00"
HOUR = 3600


def panes(spark, sf_dir) -> DS.Panes:
    return DS.count_panes(S.monitored_log(spark, sf_dir), S.MONITOR_NUMERIC, S.MONITOR_CATEGORICAL, START, END, pane_seconds=PANE_S, window_panes=WINDOW_PANES)


# ---------------------------------------------------------------------------
# SQL
# ---------------------------------------------------------------------------
def _in(fault: str) -> str:
    a, b = S.FAULTS[fault]
    return f"(ts >= TIMESTAMP '{a}' AND ts < TIMESTAMP '{b}')"


def log_sql() -> str:
    ends = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.ENDPOINT_OF_EVENT.items())
    return f"""log AS (SELECT event_id, ts, ts < TIMESTAMP '{S.MONITOR_FROM}' AS is_ref,
  CASE WHEN {_in('amounts_missing')} AND event_id % 4 = 0 THEN NULL WHEN {_in('amounts_up')} THEN value * 4.0::DOUBLE ELSE value END AS amount,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) + CASE WHEN {_in('out_of_range')} THEN 1000.0 ELSE 0.0 END AS k,
  CASE WHEN {_in('renamed')} AND event_type = 'click' THEN 'tap' ELSE event_type END AS event_type,
  CASE WHEN NOT {_in('no_segment')} THEN 's' || (user_id % 5) END AS segment,
  CASE event_type {ends} END AS endpoint,
  CASE WHEN {_in('failing')} OR event_id % 20 = 0 THEN '5xx' WHEN event_id % 20 = 1 THEN '4xx' ELSE '2xx' END AS status_class,
  value / CASE WHEN {_in('slow')} THEN 50.0::DOUBLE ELSE 1000.0::DOUBLE END AS latency
  FROM events WHERE NOT {_in('silent')})"""


def drift_sql() -> str:
    """Straight from the definitions: every window's rows beside the reference, all distinct values of both."""
    lim = C.DriftLimits()
    b = lim.psi_buckets
    probs = D.quantile_probs(b)
    ps = ", ".join(f"({i}, {p!r}::DOUBLE)" for i, p in enumerate(probs))
    num = " UNION ALL ".join(f"SELECT ts, is_ref, {i} AS position, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM log WHERE {c} IS NOT NULL" for i, c in enumerate(S.MONITOR_NUMERIC))
    cat = " UNION ALL ".join(
        f"SELECT ts, is_ref, {i} AS position, '{c}' AS feature, {c} AS t FROM log" for i, c in enumerate(S.MONITOR_CATEGORICAL, len(S.MONITOR_NUMERIC)))
    return f"""{log_sql()},
steps AS (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL {PANE_S} SECOND)) AS wt),
num AS ({num}),
ref AS (SELECT position, feature, v FROM num WHERE is_ref),
cur AS (SELECT s.wt, n.position, n.feature, n.v FROM steps s JOIN num n ON NOT n.is_ref AND n.ts < s.wt AND n.ts >= s.wt - INTERVAL {PANE_S * WINDOW_PANES} SECOND),
wins AS (SELECT wt, feature, position, count(*) AS m FROM cur GROUP BY ALL HAVING count(*) >= 2),
points AS (SELECT w.wt, w.feature, r.v, 1 AS r, 0 AS c FROM wins w JOIN ref r USING (feature) UNION ALL SELECT wt, feature, v, 0, 1 FROM cur SEMI JOIN wins USING (wt, feature)),
val AS (SELECT wt, feature, v, sum(r) AS r, sum(c) AS c FROM points GROUP BY ALL),
cdf AS (SELECT wt, feature, abs(sum(r) OVER w / (sum(r) OVER (PARTITION BY wt, feature))::DOUBLE - sum(c) OVER w / (sum(c) OVER (PARTITION BY wt, feature))::DOUBLE) AS d
  FROM val WINDOW w AS (PARTITION BY wt, feature ORDER BY v)),
ks AS (SELECT wt, feature, max(d) AS ks FROM cdf GROUP BY ALL),
rr AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY feature) AS n FROM ref),
pos AS (SELECT DISTINCT feature, n, q.k, CASE WHEN q.p * (n - 1) >= n - 1 THEN n - 1 ELSE CAST(floor(q.p * (n - 1)) AS BIGINT) END AS lo,
  CASE WHEN q.p * (n - 1) >= n - 1 THEN 0.0 ELSE q.p * (n - 1) - floor(q.p * (n - 1)) END AS g FROM rr, (VALUES {ps}) q(k, p)),
edge AS (SELECT p.feature, p.k, CASE WHEN p.g >= 0.5 THEN h.v - (h.v - l.v) * (1.0 - p.g) ELSE l.v + (h.v - l.v) * p.g END AS e
  FROM pos p JOIN rr l ON l.feature = p.feature AND l.i = p.lo JOIN rr h ON h.feature = p.feature AND h.i = least(p.lo + 1, p.n - 1)),
edges AS (SELECT feature, list(e ORDER BY k) AS e FROM edge GROUP BY feature),
binned AS (SELECT wt, x.feature, len(list_filter(e.e[2:{b}], lambda y: x.v >= y)) AS bin, r, c FROM
  (SELECT wt, feature, v, r, c FROM val) x JOIN edges e USING (feature) WHERE x.v >= e.e[1] AND x.v <= e.e[{b + 1}]),
bins AS (SELECT w.wt, w.feature, k.bin, coalesce(sum(n.r), 0) AS r, coalesce(sum(n.c), 0) AS c FROM wins w CROSS JOIN range({b}) k(bin)
  LEFT JOIN binned n ON n.wt = w.wt AND n.feature = w.feature AND n.bin = k.bin GROUP BY ALL),
share AS (SELECT wt, feature, bin, CASE WHEN r = 0 THEN {C.PSI_EPSILON!r} ELSE r / (sum(r) OVER w)::DOUBLE END AS p,
  CASE WHEN c = 0 THEN {C.PSI_EPSILON!r} ELSE c / (sum(c) OVER w)::DOUBLE END AS q, sum(c) OVER w AS total FROM bins WINDOW w AS (PARTITION BY wt, feature)),
psi AS (SELECT wt, feature, CASE WHEN max(total) > 0 THEN sum((p - q) * ln(p / q)) END AS psi FROM share GROUP BY ALL),
cat AS ({cat}),
ccur AS (SELECT s.wt, n.position, n.feature, n.t FROM steps s JOIN cat n ON NOT n.is_ref AND n.ts < s.wt AND n.ts >= s.wt - INTERVAL {PANE_S * WINDOW_PANES} SECOND),
cwins AS (SELECT wt, feature, position, count(*) AS m FROM ccur GROUP BY ALL HAVING count(t) > 0),
cval AS (SELECT wt, feature, coalesce(t, '<NA>') AS t, sum(r) AS r, sum(c) AS c FROM (
  SELECT w.wt, w.feature, k.t, 1 AS r, 0 AS c FROM cwins w JOIN cat k ON k.feature = w.feature AND k.is_ref
  UNION ALL SELECT wt, feature, t, 0, 1 FROM ccur SEMI JOIN cwins USING (wt, feature)) GROUP BY ALL),
cshare AS (SELECT wt, feature, r / (sum(r) OVER w)::DOUBLE AS p, c / (sum(c) OVER w)::DOUBLE AS q FROM cval WINDOW w AS (PARTITION BY wt, feature)),
js AS (SELECT wt, feature, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0.0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0.0 END) / ln(2.0) / 2, 0.0)) AS js
  FROM cshare GROUP BY ALL),
rep AS (
  SELECT wt, position, feature, 'numeric' AS feature_type, ks, NULL::DOUBLE AS js, psi, ks AS value,
    CASE WHEN psi IS NOT NULL THEN least(greatest(0.6 * least(ks, 1.0) + 0.4 * least(psi / 0.2, 1.0), 0.0), 1.0) END AS severity,
    ks > {lim.numeric} OR coalesce(psi > {lim.psi_alert}, false) AS alert,
    coalesce(nullif(concat_ws(', ', CASE WHEN ks > {lim.numeric} THEN 'KS>{lim.numeric}' END, CASE WHEN psi > {lim.psi_alert} THEN 'PSI>{lim.psi_alert}' END,
      CASE WHEN psi IS NULL THEN 'no_overlap' END), ''), 'ok') AS reason
  FROM wins JOIN ks USING (wt, feature) LEFT JOIN psi USING (wt, feature)
  UNION ALL
  SELECT wt, position, feature, 'categorical', NULL, js, NULL, js, least(greatest(least(js, 1.0), 0.0), 1.0), js > {lim.categorical},
    CASE WHEN js > {lim.categorical} THEN 'JS>{lim.categorical}' ELSE 'ok' END FROM cwins JOIN js USING (wt, feature))"""


def drift_gauges_sql() -> str:
    lim = C.DriftLimits()
    return f"""{drift_sql()},
dsum AS (SELECT wt, coalesce(max(CASE WHEN feature_type = 'numeric' THEN coalesce(ks, 0.0) END), 0.0) AS ks_max,
  coalesce(max(CASE WHEN feature_type = 'categorical' THEN coalesce(js, 0.0) END), 0.0) AS js_max,
  coalesce(max(CASE WHEN feature_type = 'numeric' THEN coalesce(psi, 0.0) END), 0.0) AS psi_max,
  count(*) FILTER (WHERE alert) / count(*)::DOUBLE AS frac,
  CASE WHEN bool_or(coalesce(psi > {lim.psi_critical}, false)) OR bool_or(feature_type = 'numeric' AND value > {lim.ks_critical})
    OR bool_or(feature_type = 'categorical' AND value > {lim.js_critical}) OR count(*) FILTER (WHERE alert) / count(*)::DOUBLE > {lim.fraction_critical}
    THEN 1.0 ELSE 0.0 END AS retrain FROM rep GROUP BY wt),
dg AS (SELECT wt AS ts, unnest(['drift_numeric_ks_max', 'drift_categorical_js_max', 'drift_numeric_psi_max', 'drift_features_alert_fraction',
  'drift_retrain_recommended']) AS metric, '' AS series, unnest([ks_max, js_max, psi_max, frac, retrain]) AS value FROM dsum)"""


def quality_sql() -> str:
    feats = S.MONITOR_NUMERIC + S.MONITOR_CATEGORICAL
    win = f"NOT l.is_ref AND l.ts < s.wt AND l.ts >= s.wt - INTERVAL {PANE_S * WINDOW_PANES} SECOND"
    per = []
    for c in feats:
        if c in S.MONITOR_NUMERIC:
            odd = f"CAST(l.{c} AS DOUBLE) < (SELECT min({c}) FROM log WHERE is_ref) OR CAST(l.{c} AS DOUBLE) > (SELECT max({c}) FROM log WHERE is_ref)"
            kind = "numeric"
        else:
            odd, kind = f"l.{c} IS NOT NULL AND l.{c} NOT IN (SELECT {c} FROM log WHERE is_ref AND {c} IS NOT NULL)", "categorical"
        per.append(f"SELECT s.wt, '{kind}' AS kind, count(*) AS n, count(l.{c}) AS vals, count(*) FILTER (WHERE {odd}) AS odd FROM qsteps s JOIN log l ON {win} GROUP BY s.wt")
    return f"""{log_sql()},
qsteps AS (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL {PANE_S} SECOND)) AS wt),
per AS ({' UNION ALL '.join(per)}),
ratios AS (SELECT wt, max(n) AS window_rows, coalesce(sum(CASE WHEN vals > 0 THEN n - vals END) / sum(CASE WHEN vals > 0 THEN n END)::DOUBLE, 0.0) AS missing_ratio,
  count(*) FILTER (WHERE vals = 0) / {len(feats)}.0::DOUBLE AS schema_violation_fraction,
  coalesce(avg(CASE WHEN kind = 'categorical' AND vals > 0 THEN odd / vals::DOUBLE END), 0.0) AS unseen_category_ratio,
  coalesce(avg(CASE WHEN kind = 'numeric' AND vals > 0 THEN odd / vals::DOUBLE END), 0.0) AS out_of_range_ratio FROM per GROUP BY wt),
fresh AS (SELECT s.wt, coalesce(greatest((epoch_us(s.wt) - max(epoch_us(l.ts))) / 1e6, 0.0), 0.0) AS freshness_lag_seconds
  FROM qsteps s LEFT JOIN log l ON NOT l.is_ref AND l.ts < s.wt GROUP BY s.wt),
quality AS (SELECT f.wt AS ts, coalesce(window_rows, 0) AS window_rows, missing_ratio, schema_violation_fraction, unseen_category_ratio, out_of_range_ratio,
  freshness_lag_seconds FROM fresh f LEFT JOIN ratios r ON r.wt = f.wt),
qg AS (SELECT ts, metric, '' AS series, value FROM (SELECT ts, unnest(['dq_missing_ratio', 'dq_schema_violation_fraction', 'dq_unseen_category_ratio', 'dq_out_of_range_ratio',
  'dq_freshness_lag_seconds']) AS metric, unnest([missing_ratio, schema_violation_fraction, unseen_category_ratio, out_of_range_ratio, freshness_lag_seconds]) AS value FROM quality)
  WHERE value IS NOT NULL)"""


# ---------------------------------------------------------------------------
# registered queries: series
# ---------------------------------------------------------------------------
_REPORT = ["ts", "feature", "feature_type", "ks", "js", "psi", "value", "severity", "alert", "reason", "position"]
_ROUNDED = ["ks", "js", "psi", "value", "severity"]


@register("drift_series", f"""WITH {drift_sql()} SELECT wt AS ts, feature, feature_type, alert, reason, position, {', '.join(f'round({c}, 9) AS {c}' for c in _ROUNDED)} FROM rep""")
def q_drift_series(spark, sf_dir):
    report = DS.drift_series(panes(spark, sf_dir))
    return report.select(*[rnd(F.col(c)).alias(c) if c in _ROUNDED else F.col(c) for c in _REPORT])


@register("drift_gauge_series", f"WITH {drift_gauges_sql()} SELECT ts, metric, round(value, 9) AS value FROM dg")
def q_drift_gauge_series(spark, sf_dir):
    return DS.drift_gauge_series(DS.drift_series(panes(spark, sf_dir))).select("ts", "metric", rnd(F.col("value")).alias("value"))


_RATIOS = ["missing_ratio", "schema_violation_fraction", "unseen_category_ratio", "out_of_range_ratio", "freshness_lag_seconds"]


@register("dq_series", f"WITH {quality_sql()} SELECT ts, window_rows, {', '.join(f'round({c}, 9) AS {c}' for c in _RATIOS)} FROM quality")
def q_dq_series(spark, sf_dir):
    q = DS.quality_series(panes(spark, sf_dir))
    return q.select("ts", "window_rows", *[rnd(F.col(c)).alias(c) for c in _RATIOS])


# ---------------------------------------------------------------------------
# service metrics of the monitored log, hourly
# ---------------------------------------------------------------------------
RANGE_S = 3 * HOUR
JOBS = ["job=api", "job=drift_exporter", "job=batch"]  # the last one never reports
PREDICT = ["/predict", "/batch-predict"]
SAMPLE = ["ts", "metric", "series", "labels", "value"]


def _gauge(df, metric, value, series=None):
    labels = F.create_map().cast("map<string,string>")
    return df.select("ts", F.lit(metric).alias("metric"), (F.lit("") if series is None else series).alias("series"), labels.alias("labels"), value.cast("double").alias("value"))


def up_samples(spark, sf_dir):
    """Scrapes: the service answers an hour with any request that does not fail, the exporter every six hours with rows."""
    log = S.monitored_log(spark, sf_dir).where(~F.col("is_ref"))
    api = SE.gauge_samples(log, "up", F.max((F.col("status_class") != "5xx").cast("int")), interval="1 hour")
    exporter = SE.gauge_samples(log, "up", F.max(F.lit(1)), interval=f"{PANE_S // HOUR} hours")
    return api.select("ts", "metric", F.lit("job=api").alias("series"), "value").unionByName(
        exporter.select("ts", "metric", F.lit("job=drift_exporter").alias("series"), "value"))


def up_grid(spark, sf_dir):
    """Every job at every hour: a scrape is stale after six hours and half of one."""
    expected = spark.createDataFrame([("up", j) for j in JOBS], "metric string, series string")
    return G.evaluation_grid(up_samples(spark, sf_dir), expected, START, END, HOUR, PANE_S + HOUR // 2)


def service_rates(spark, sf_dir):
    log = S.monitored_log(spark, sf_dir).where(F.col("endpoint").isin(PREDICT))
    return SE.increase(SE.counter_samples(log, "api_requests_total", ["endpoint", "status_class"]), RANGE_S, rate_per_second=True)


def error_ratio(spark, sf_dir):
    per = service_rates(spark, sf_dir).groupBy("ts").agg(F.sum(F.when(F.col("status_class") == "5xx", F.col("rate")).otherwise(0.0)).alias("e"), F.sum("rate").alias("a"))
    ratio = _gauge(per, "api_error_ratio", F.col("e") / F.greatest(F.col("a"), F.lit(0.001)))
    return ratio.unionByName(_gauge(per, "api_request_rate", F.col("a")))


def latency_p95(spark, sf_dir):
    log = S.monitored_log(spark, sf_dir).where(F.col("endpoint").isin(PREDICT))
    grown = SE.increase(SE.bucket_samples(log, "api_request_latency_seconds_bucket", "latency", C.LATENCY_BUCKETS, ["endpoint"]), RANGE_S)
    q = SE.histogram_quantile(grown, 0.95, ["ts", "endpoint"], count="increase")
    return _gauge(q, "api_latency_p95", F.col("quantile"), F.concat(F.lit("endpoint="), F.col("endpoint")))


def model_gauges(spark, sf_dir):
    e = S.scored_events(spark, sf_dir)
    p = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    pos = SE.gauge_samples(e, "model_prediction_positive_rate", F.avg((p >= C.POSITIVE_CUT).cast("double")))
    low = SE.gauge_samples(e, "model_low_confidence_fraction", F.avg((F.greatest(p, F.lit(1.0) - p) < C.LOW_CONFIDENCE_PROB_THRESHOLD).cast("double")))
    return pos.select(*SAMPLE).unionByName(low.select(*SAMPLE))


def all_samples(spark, sf_dir):
    counted = panes(spark, sf_dir)
    quality = cut_lineage(DS.quality_series(counted), "quality")
    parts = [
        DS.drift_gauge_series(DS.drift_series(counted)),
        DS.quality_gauge_series(quality),
        _gauge(quality, "drift_exporter_up", (F.col("window_rows") > 0).cast("double")),
        _gauge(G.target_down(up_grid(spark, sf_dir)), "target_down", F.col("down"), F.col("series")),
        error_ratio(spark, sf_dir),
        latency_p95(spark, sf_dir),
        model_gauges(spark, sf_dir),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut_lineage(out, "samples")  # a row per series and evaluation; rules read it more than once


# the PSI limit is raised for one day in the series of limits
LIMIT_CHANGES = [("2024-01-11 12:00:00", "drift_threshold_psi", 5.0), ("2024-01-12 12:00:00", "drift_threshold_psi", C.PSI_CRITICAL)]
LIMITS = [("2024-01-01 00:00:00", name, float(v)) for name, v in C.LIMIT_SERIES.items()] + LIMIT_CHANGES
SIX_HOURLY = ("drift_", "dq_")


def rules():
    """(..., threshold, limit_metric, hold, stale, severity, type): a sample is stale after two evaluation intervals."""
    out = []
    for name, metric, series, op, limit, hold, severity, kind in C.ALERT_RULES:
        named = isinstance(limit, str)
        stale = 2 * (PANE_S if metric.startswith(SIX_HOURLY) else HOUR)
        out.append((name, metric, series, op, None if named else limit, limit if named else None, hold, stale, severity, kind))
    return out


def evaluated(spark, sf_dir):
    table = spark.createDataFrame(rules(), "alertname string, metric string, series string, op string, threshold double, limit_metric string, hold_seconds int, "
                                  "stale_seconds int, severity string, type string")
    limits = spark.createDataFrame(LIMITS, "ts string, metric string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return SE.evaluate_limit_rules(all_samples(spark, sf_dir), table, limits)


def firing(spark, sf_dir):
    return SE.alert_for(evaluated(spark, sf_dir), None, None)


def service_sql() -> str:
    preds = ", ".join(f"'{p}'" for p in PREDICT)
    jobs = ", ".join(f"('{j}')" for j in JOBS)
    les = ", ".join(f"({float(x)!r}::DOUBLE)" for x in C.LATENCY_BUCKETS)
    us = RANGE_S * 1_000_000 - 1
    return f"""{log_sql()},
ups AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, 'job=api' AS series, max(CASE WHEN status_class <> '5xx' THEN 1.0 ELSE 0.0 END) AS value FROM log WHERE NOT is_ref GROUP BY 1
  UNION ALL SELECT time_bucket(INTERVAL {PANE_S} SECOND, ts) + INTERVAL {PANE_S} SECOND, 'job=drift_exporter', 1.0 FROM log WHERE NOT is_ref GROUP BY 1),
ugrid AS (SELECT h.ts, j.series, (SELECT arg_max(u.value, u.ts) FROM ups u WHERE u.series = j.series AND u.ts <= h.ts AND u.ts > h.ts - INTERVAL {PANE_S + HOUR // 2} SECOND) AS value
  FROM (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 HOUR)) AS ts) h CROSS JOIN (VALUES {jobs}) j(series)),
req AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, endpoint, status_class, latency FROM log WHERE endpoint IN ({preds})),
sper AS (SELECT ts, endpoint, status_class, count(*)::DOUBLE AS inc FROM req GROUP BY ALL),
ctr AS (SELECT *, epoch_us(ts) AS t, sum(inc) OVER (PARTITION BY endpoint, status_class ORDER BY ts) AS v FROM sper),
rts AS (SELECT ts, status_class, (v - first_value(v) OVER w) / ((t - min(t) OVER w) / 1e6) AS rate, count(*) OVER w AS n FROM ctr
  WINDOW w AS (PARTITION BY endpoint, status_class ORDER BY t RANGE BETWEEN {us} PRECEDING AND CURRENT ROW)),
rt AS (SELECT ts, sum(CASE WHEN status_class = '5xx' THEN rate ELSE 0.0 END) AS e, sum(rate) AS a FROM rts WHERE n >= 2 GROUP BY ts),
lb AS (SELECT * FROM (VALUES {les}, ('Infinity'::DOUBLE)) t(le)),
hb AS (SELECT ts, endpoint, le, count(*) FILTER (WHERE latency <= le) AS c FROM req CROSS JOIN lb GROUP BY ALL),
hc AS (SELECT *, epoch_us(ts) AS t, sum(c) OVER (PARTITION BY endpoint, le ORDER BY ts) AS v FROM hb),
hi AS (SELECT ts, endpoint, le, (v - first_value(v) OVER w)::DOUBLE AS c, count(*) OVER w AS n FROM hc
  WINDOW w AS (PARTITION BY endpoint, le ORDER BY t RANGE BETWEEN {us} PRECEDING AND CURRENT ROW)),
hq AS (SELECT *, lag(le) OVER w AS prev_le, lag(c) OVER w AS prev_c, max(c) FILTER (WHERE le = 'Infinity'::DOUBLE) OVER (PARTITION BY ts, endpoint) AS total,
  max(le) FILTER (WHERE le <> 'Infinity'::DOUBLE) OVER (PARTITION BY ts, endpoint) AS top FROM hi WHERE n >= 2 WINDOW w AS (PARTITION BY ts, endpoint ORDER BY le)),
p95 AS (SELECT ts, endpoint, arg_min(CASE WHEN le = 'Infinity'::DOUBLE THEN top ELSE coalesce(prev_le, 0.0) + (le - coalesce(prev_le, 0.0)) *
  ((0.95 * total - coalesce(prev_c, 0.0)) / nullif(c - coalesce(prev_c, 0.0), 0)) END, le) AS value FROM hq WHERE c >= 0.95 * total AND total > 0 GROUP BY ts, endpoint),
sc AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, least(greatest(least(value / 500.0::DOUBLE, 1.0), 0.0), 1.0) AS p FROM events),
service AS (SELECT ts, 'target_down' AS metric, series, CASE WHEN value IS NULL OR value = 0 THEN 1.0 ELSE 0.0 END AS value FROM ugrid
  UNION ALL SELECT ts, 'api_error_ratio', '', e / greatest(a, 0.001) FROM rt UNION ALL SELECT ts, 'api_request_rate', '', a FROM rt
  UNION ALL SELECT ts, 'api_latency_p95', 'endpoint=' || endpoint, value FROM p95
  UNION ALL SELECT ts, 'model_prediction_positive_rate', '', avg(CASE WHEN p >= {C.POSITIVE_CUT} THEN 1.0 ELSE 0.0 END) FROM sc GROUP BY ts
  UNION ALL SELECT ts, 'model_low_confidence_fraction', '', avg(CASE WHEN greatest(p, 1.0 - p) < {C.LOW_CONFIDENCE_PROB_THRESHOLD} THEN 1.0 ELSE 0.0 END) FROM sc GROUP BY ts)"""


def rules_sql() -> str:
    limits = ", ".join(f"(TIMESTAMP '{t}', '{m}', {v!r}::DOUBLE)" for t, m, v in LIMITS)
    quoted = lambda x: "NULL" if x is None else f"'{x}'"
    table = ", ".join(f"('{n}', '{m}', {quoted(s)}, '{op}', {'NULL' if t is None else repr(t)}::DOUBLE, {quoted(lm)}, {hold}, {stale}, '{sev}', '{kind}')"
                      for n, m, s, op, t, lm, hold, stale, sev, kind in rules())
    strip = lambda sql: sql.removeprefix(log_sql() + ",")
    return f"""{drift_gauges_sql()}, {strip(quality_sql())}, {strip(service_sql())},
sample AS (SELECT ts, metric, series, value FROM dg UNION ALL SELECT ts, metric, series, value FROM qg
  UNION ALL SELECT ts, 'drift_exporter_up', '', CASE WHEN window_rows > 0 THEN 1.0 ELSE 0.0 END FROM quality UNION ALL SELECT * FROM service),
lim AS (SELECT * FROM (VALUES {limits}) t(since, limit_metric, "limit")),
rule AS (SELECT * FROM (VALUES {table}) t(alertname, metric, of_series, op, threshold, limit_metric, hold, stale, severity, type)),
matched AS (SELECT r.*, s.ts, s.series, s.value FROM sample s JOIN rule r ON r.metric = s.metric AND (r.of_series IS NULL OR r.of_series = s.series)),
limited AS (SELECT m.*, coalesce(m.threshold, l."limit") AS lim FROM matched m ASOF LEFT JOIN lim l ON m.limit_metric = l.limit_metric AND m.ts >= l.since),
ev AS (SELECT alertname, severity, type, ts, series, value, lim, hold, stale, coalesce(CASE op WHEN '>' THEN value > lim WHEN '<' THEN value < lim ELSE value = lim END, false) AS active
  FROM limited),
e1 AS (SELECT *, epoch_us(ts) / 1e6 AS t, CASE WHEN NOT active OR lag(active) OVER w IS NULL OR NOT lag(active) OVER w
    OR epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER w > stale THEN 1 ELSE 0 END AS brk FROM ev WINDOW w AS (PARTITION BY alertname, severity, series ORDER BY ts)),
e2 AS (SELECT *, sum(brk) OVER (PARTITION BY alertname, severity, series ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM e1),
e3 AS (SELECT *, min(t) OVER (PARTITION BY alertname, severity, series, run) AS st, min(ts) OVER (PARTITION BY alertname, severity, series, run) AS active_since FROM e2),
fire AS (SELECT alertname, severity, type, ts, series, value, active_since FROM e3 WHERE active AND t - st >= hold)"""


# ---------------------------------------------------------------------------
# registered queries: grid and rules
# ---------------------------------------------------------------------------
@register("evaluation_grid", f"""WITH {service_sql()}
SELECT ts, series, value, CASE WHEN value IS NULL THEN 'absent' WHEN value = 0 THEN 'zero' ELSE 'present' END AS state FROM ugrid""")
def q_evaluation_grid(spark, sf_dir):
    return up_grid(spark, sf_dir).select("ts", "series", "value", "state")


@register("error_ratio_or_vector", f"""WITH {service_sql()},
h AS (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 HOUR)) AS ts)
SELECT h.ts, round(coalesce(s.value, 0.0), 9) AS value, s.value IS NULL AS filled
FROM h LEFT JOIN service s ON s.ts = h.ts AND s.metric = 'api_error_ratio'""")
def q_error_ratio_or_vector(spark, sf_dir):
    """The error ratio at every hour; hours without one are zero."""
    ratio = error_ratio(spark, sf_dir).where(F.col("metric") == "api_error_ratio")
    expected = spark.createDataFrame([("api_error_ratio", "")], "metric string, series string")
    grid = G.or_vector(G.evaluation_grid(ratio, expected, START, END, HOUR, HOUR))
    return grid.select("ts", rnd(F.col("value")).alias("value"), (F.col("state") == "absent").alias("filled"))


@register("latency_p95_series", f"WITH {service_sql()} SELECT ts, endpoint, round(value, 9) AS value FROM p95")
def q_latency_p95(spark, sf_dir):
    p = latency_p95(spark, sf_dir)
    return p.select("ts", F.regexp_replace("series", "^endpoint=", "").alias("endpoint"), rnd(F.col("value")).alias("value"))


@register("alert_rule_all", f"""WITH {rules_sql()}
SELECT alertname, severity, type, ts, series, round(value, 9) AS value, lim AS "limit", active FROM ev""")
def q_alert_rule_all(spark, sf_dir):
    return evaluated(spark, sf_dir).drop("hold_seconds", "stale_seconds").withColumn("value", rnd(F.col("value")))


@register("alert_for_all", f"WITH {rules_sql()} SELECT alertname, severity, type, ts, series, round(value, 9) AS value, active_since FROM fire")
def q_alert_for_all(spark, sf_dir):
    return firing(spark, sf_dir).withColumn("value", rnd(F.col("value")))


@register("alert_inhibit_all", f"""WITH {rules_sql()},
crit AS (SELECT DISTINCT alertname, ts FROM fire WHERE severity = 'critical')
SELECT alertname, severity, type, ts, series, round(value, 9) AS value, active_since FROM fire f
WHERE severity <> 'warning' OR NOT EXISTS (SELECT 1 FROM crit WHERE crit.alertname = f.alertname AND crit.ts = f.ts)""")
def q_alert_inhibit_all(spark, sf_dir):
    return SE.alert_inhibit(firing(spark, sf_dir)).withColumn("value", rnd(F.col("value")))


@register("alert_group_all", f"""WITH {rules_sql()}
SELECT alertname, severity, type, count(*) AS alerts, count(DISTINCT series) AS series, min(active_since) AS first_active,
  max(ts) AS last_seen FROM fire GROUP BY alertname, severity, type""")
def q_alert_group_all(spark, sf_dir):
    return SE.alert_group(firing(spark, sf_dir))

"""Metric-series and alert queries. ``events`` is read as a request log (endpoint from the
event type, status from the event id, latency = value / 1000) and as a scoring log; both
are aggregated to hourly samples, counters restart on 2024-01-15 (a process restart)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.functions.scalar import rnd
from churnwatch.operators import quality as QU
from churnwatch.operators import series as SE
from churnwatch.plans.registry import register
from churnwatch.sources import tables as S

RESET_AT = "2024-01-15 00:00:00"
RANGE_S = 3 * 3600          # trailing range of rate / increase / ratio
CHANGES_RANGE_S = 6 * 3600
STALE_S = 2 * 3600          # a gap longer than two samples ends an alert run
LAST_TS = "2024-01-31 00:00:00"
PREDICT = ["/predict", "/batch-predict"]
LABELS = ["endpoint", "method", "status_class"]
RULES = [  # alertname, metric, op, threshold, hold seconds, severity, type
    ("ModelLowConfidenceHigh", "model_low_confidence_fraction", ">", C.LOW_CONFIDENCE_FRACTION_THRESHOLD, 900,
     "warning", "model-quality"),
    ("ModelPositiveRateTooLow", "model_prediction_positive_rate", "<", C.POSITIVE_RATE_MIN_THRESHOLD, 1200,
     "warning", "model-quality"),
    ("ModelPositiveRateTooHigh", "model_prediction_positive_rate", ">", C.POSITIVE_RATE_MAX_THRESHOLD, 1200,
     "warning", "model-quality"),
    # the same name in two severities: a firing critical mutes the warning of its name
    ("ModelPositiveRateTooLow", "model_prediction_positive_rate", "<", C.POSITIVE_RATE_MIN_THRESHOLD, 3600,
     "critical", "model-quality"),
    ("APIHigh5xxErrorRate", "api_error_ratio", ">", 0.05, 300, "critical", "service"),
    ("APILowRequestRate", "api_request_rate", "<", 0.01, 1800, "warning", "service"),
]


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
def req(spark, sf_dir):
    return S.request_log(spark, sf_dir)


def counters(spark, sf_dir):
    return SE.counter_samples(req(spark, sf_dir), "api_requests_total", LABELS, reset_at=RESET_AT)


def rates(spark, sf_dir):
    return SE.increase(counters(spark, sf_dir), RANGE_S, rate_per_second=True)


def gauges(spark, sf_dir):
    e = S.scored_events(spark, sf_dir)
    p = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    conf = F.greatest(p, F.lit(1.0) - p)
    pos = SE.gauge_samples(e, "model_prediction_positive_rate", F.avg((p >= C.POSITIVE_CUT).cast("double")))
    low = SE.gauge_samples(e, "model_low_confidence_fraction",
                           F.avg((conf < C.LOW_CONFIDENCE_PROB_THRESHOLD).cast("double")))
    r = rates(spark, sf_dir).where(F.col("endpoint").isin(PREDICT))
    per_ts = r.groupBy("ts").agg(F.sum(F.when(F.col("status_class") == "5xx", F.col("rate")).otherwise(0.0)).alias("e"),
                                 F.sum("rate").alias("a"))
    base = [F.lit("").alias("series"), F.create_map().cast("map<string,string>").alias("labels")]
    ratio = per_ts.select("ts", F.lit("api_error_ratio").alias("metric"), *base,
                          (F.col("e") / F.greatest(F.col("a"), F.lit(0.001))).alias("value"))
    reqrate = per_ts.select("ts", F.lit("api_request_rate").alias("metric"), *base, F.col("a").alias("value"))
    cols = ["ts", "metric", "series", "labels", "value"]
    return pos.select(*cols).unionByName(low.select(*cols)).unionByName(ratio).unionByName(reqrate)


def rules_table(spark):
    return spark.createDataFrame(
        [(n, m, op, float(thr), int(hold), sev, kind) for n, m, op, thr, hold, sev, kind in RULES],
        "alertname string, metric string, op string, threshold double, hold_seconds int, severity string, type string")


def evaluated(spark, sf_dir):
    return SE.evaluate_rules(gauges(spark, sf_dir), rules_table(spark))


def firing(spark, sf_dir):
    return SE.alert_for(evaluated(spark, sf_dir), None, STALE_S)


# ---------------------------------------------------------------------------
# SQL
# ---------------------------------------------------------------------------
REQ_SQL = """req AS (SELECT event_id, ts,
  CASE event_type WHEN 'view' THEN '/predict' WHEN 'click' THEN '/batch-predict' WHEN 'purchase' THEN '/predict'
    WHEN 'signup' THEN '/health' WHEN 'error' THEN '/batch-predict' END AS endpoint,
  CASE WHEN event_type = 'signup' THEN 'GET' ELSE 'POST' END AS method,
  CAST((CASE WHEN event_id % 20 = 0 THEN 500 WHEN event_id % 20 = 1 THEN 422 ELSE 200 END) // 100 AS VARCHAR) || 'xx'
    AS status_class,
  value / 1000.0 AS latency, least(value / 500.0, 1.0) AS score FROM events)"""


def counters_sql() -> str:
    return f"""{REQ_SQL},
per AS (SELECT date_trunc('hour', ts) AS bucket, endpoint, method, status_class, CAST(count(*) AS DOUBLE) AS inc,
  CASE WHEN date_trunc('hour', ts) >= TIMESTAMP '{RESET_AT}' THEN 1 ELSE 0 END AS ep FROM req GROUP BY 1, 2, 3, 4),
cnt AS (SELECT bucket + INTERVAL 1 HOUR AS ts, 'api_requests_total' AS metric,
  'endpoint=' || endpoint || ',method=' || method || ',status_class=' || status_class AS series,
  endpoint, method, status_class,
  sum(inc) OVER (PARTITION BY endpoint, method, status_class, ep ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS value
  FROM per)"""


def rates_sql() -> str:
    return f"""{counters_sql()},
d AS (SELECT *, epoch_us(ts) / 1e6 AS t,
  CASE WHEN lag(value) OVER w IS NULL THEN 0.0 WHEN value < lag(value) OVER w THEN value ELSE value - lag(value) OVER w END
    AS dd FROM cnt WINDOW w AS (PARTITION BY metric, series ORDER BY ts)),
inc AS (SELECT ts, metric, series, endpoint, method, status_class,
  sum(dd) OVER r - first_value(dd) OVER r AS increase, count(*) OVER r AS n, t - min(t) OVER r AS covered
  FROM (SELECT *, epoch_us(ts) AS us FROM d) WINDOW r AS (PARTITION BY metric, series ORDER BY us RANGE BETWEEN {RANGE_S * 1_000_000 - 1} PRECEDING AND CURRENT ROW)),
rt AS (SELECT *, increase / covered AS rate FROM inc WHERE n >= 2)"""


def gauges_sql() -> str:
    preds = ", ".join(f"'{p}'" for p in PREDICT)
    return f"""{rates_sql()},
sc AS (SELECT ts, least(greatest(score, 0.0), 1.0) AS p FROM req),
g_pos AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, 'model_prediction_positive_rate' AS metric, '' AS series,
  avg(CASE WHEN p >= {C.POSITIVE_CUT} THEN 1.0 ELSE 0.0 END) AS value FROM sc GROUP BY 1),
g_low AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, 'model_low_confidence_fraction' AS metric, '' AS series,
  avg(CASE WHEN greatest(p, 1.0 - p) < {C.LOW_CONFIDENCE_PROB_THRESHOLD} THEN 1.0 ELSE 0.0 END) AS value FROM sc GROUP BY 1),
pt AS (SELECT ts, sum(CASE WHEN status_class = '5xx' THEN rate ELSE 0.0 END) AS e, sum(rate) AS a FROM rt
  WHERE endpoint IN ({preds}) GROUP BY ts),
g_err AS (SELECT ts, 'api_error_ratio' AS metric, '' AS series, e / greatest(a, 0.001) AS value FROM pt),
g_rate AS (SELECT ts, 'api_request_rate' AS metric, '' AS series, a AS value FROM pt),
gauges AS (SELECT * FROM g_pos UNION ALL SELECT * FROM g_low UNION ALL SELECT * FROM g_err UNION ALL SELECT * FROM g_rate)"""


def evaluated_sql() -> str:
    parts = [f"SELECT '{n}' AS alertname, '{sev}' AS severity, '{kind}' AS type, ts, series, value, "
             f"coalesce(value {op} {thr!r}, false) AS active FROM gauges WHERE metric = '{m}'"
             for n, m, op, thr, _, sev, kind in RULES]
    return f"{gauges_sql()}, ev AS ({' UNION ALL '.join(parts)})"


def firing_sql() -> str:
    holds = " ".join(f"WHEN alertname = '{n}' AND severity = '{sev}' THEN {hold}" for n, _, _, _, hold, sev, _ in RULES)
    return f"""{evaluated_sql()},
e1 AS (SELECT *, epoch_us(ts) / 1e6 AS t, CASE WHEN NOT active OR lag(active) OVER w IS NULL OR NOT lag(active) OVER w
    OR epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER w > {STALE_S} THEN 1 ELSE 0 END AS brk
  FROM ev WINDOW w AS (PARTITION BY alertname, severity, series ORDER BY ts)),
e2 AS (SELECT *, sum(brk) OVER (PARTITION BY alertname, severity, series ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM e1),
e3 AS (SELECT *, min(t) OVER (PARTITION BY alertname, severity, series, run) AS st,
  min(ts) OVER (PARTITION BY alertname, severity, series, run) AS active_since FROM e2),
fire AS (SELECT alertname, severity, type, ts, series, value, active_since FROM e3
  WHERE active AND t - st >= CASE {holds} END)"""


# ---------------------------------------------------------------------------
# registered queries
# ---------------------------------------------------------------------------
@register("counter_samples", f"WITH {counters_sql()} SELECT ts, metric, series, endpoint, method, status_class, value FROM cnt")
def q_counter_samples(spark, sf_dir):
    return counters(spark, sf_dir).drop("labels")


@register("increase", f"""WITH {rates_sql()}
SELECT ts, series, endpoint, method, status_class, increase, round(covered, 6) AS covered FROM inc WHERE n >= 2""")
def q_increase(spark, sf_dir):
    i = SE.increase(counters(spark, sf_dir), RANGE_S)
    return i.select("ts", "series", *LABELS, "increase", F.round("covered", 6).alias("covered"))


@register("rate", f"WITH {rates_sql()} SELECT ts, series, endpoint, method, status_class, round(rate, 9) AS rate FROM rt")
def q_rate(spark, sf_dir):
    return rates(spark, sf_dir).select("ts", "series", *LABELS, rnd(F.col("rate")).alias("rate"))


@register("changes", f"""WITH {gauges_sql()},
c0 AS (SELECT ts, epoch_us(ts) AS t, CASE WHEN lag(value) OVER (ORDER BY ts) IS NOT NULL
    AND value <> lag(value) OVER (ORDER BY ts) THEN 1 ELSE 0 END AS c FROM g_pos)
SELECT ts, sum(c) OVER r - first_value(c) OVER r AS changes FROM c0
WINDOW r AS (ORDER BY t RANGE BETWEEN {CHANGES_RANGE_S * 1_000_000 - 1} PRECEDING AND CURRENT ROW)""")
def q_changes(spark, sf_dir):
    g = gauges(spark, sf_dir).where(F.col("metric") == "model_prediction_positive_rate")
    return SE.changes(g, CHANGES_RANGE_S).select("ts", F.col("changes").cast("bigint").alias("changes"))


def _lat_buckets_sql() -> str:
    vals = ", ".join(f"({float(x)!r})" for x in C.LATENCY_BUCKETS)
    return f"lb AS (SELECT * FROM (VALUES {vals}, ('Infinity'::DOUBLE)) t(le))"


@register("histogram_quantile", f"""WITH {REQ_SQL}, {_lat_buckets_sql()},
hb AS (SELECT date_trunc('hour', r.ts) + INTERVAL 1 HOUR AS ts, r.endpoint, lb.le,
  count(*) FILTER (WHERE r.latency <= lb.le) AS c FROM req r CROSS JOIN lb GROUP BY 1, 2, 3),
hq AS (SELECT ts, endpoint, le, CAST(c AS DOUBLE) AS c, lag(le) OVER w AS prev_le, CAST(lag(c) OVER w AS DOUBLE) AS prev_c,
  max(c) FILTER (WHERE le = 'Infinity'::DOUBLE) OVER (PARTITION BY ts, endpoint) AS total,
  max(le) FILTER (WHERE le <> 'Infinity'::DOUBLE) OVER (PARTITION BY ts, endpoint) AS top
  FROM hb WINDOW w AS (PARTITION BY ts, endpoint ORDER BY le))
SELECT ts, endpoint, round(arg_min(CASE WHEN le = 'Infinity'::DOUBLE THEN top ELSE coalesce(prev_le, 0.0)
  + (le - coalesce(prev_le, 0.0)) * ((0.95 * total - coalesce(prev_c, 0.0)) / nullif(c - coalesce(prev_c, 0.0), 0)) END, le), 9)
  AS quantile FROM hq WHERE c >= 0.95 * total AND total > 0 GROUP BY ts, endpoint""")
def q_histogram_quantile(spark, sf_dir):
    r = req(spark, sf_dir).withColumn("hour", F.date_trunc("hour", F.col("ts")) + F.expr("INTERVAL 1 HOUR"))
    hb = QU.cumulative_histogram(r, "latency", C.LATENCY_BUCKETS, ["hour", "endpoint"])
    q = SE.histogram_quantile(hb, 0.95, ["hour", "endpoint"])
    return q.select(F.col("hour").alias("ts"), "endpoint", rnd(F.col("quantile")).alias("quantile"))


@register("sum_by", f"""WITH {counters_sql()}
SELECT ts, metric, endpoint, sum(value) AS value FROM cnt GROUP BY ts, metric, endpoint""")
def q_sum_by(spark, sf_dir):
    return SE.aggregate_by(counters(spark, sf_dir), ["endpoint"], "sum")


@register("max_without", f"""WITH {counters_sql()}
SELECT ts, metric, endpoint, method, max(value) AS value FROM cnt GROUP BY ts, metric, endpoint, method""")
def q_max_without(spark, sf_dir):
    return SE.aggregate_by(counters(spark, sf_dir), ["endpoint", "method"], "max")


@register("error_ratio", f"""WITH {gauges_sql()}
SELECT ts, round(value, 9) AS ratio, value > 0.05 AS breach FROM g_err""")
def q_error_ratio(spark, sf_dir):
    g = gauges(spark, sf_dir).where(F.col("metric") == "api_error_ratio")
    return g.select("ts", rnd(F.col("value")).alias("ratio"), (F.col("value") > 0.05).alias("breach"))


@register("absent_series", f"""WITH {counters_sql()},
ex AS (SELECT DISTINCT series FROM cnt),
now AS (SELECT series, value FROM cnt WHERE ts = TIMESTAMP '{LAST_TS}')
SELECT ex.series, CASE WHEN now.value IS NULL THEN 'absent' ELSE 'zero' END AS reason
FROM ex LEFT JOIN now ON ex.series = now.series WHERE now.value IS NULL OR now.value = 0""")
def q_absent(spark, sf_dir):
    c = counters(spark, sf_dir)
    expected = c.select("series").distinct()
    return SE.absent_series(c, expected, LAST_TS)


@register("alert_rule", f"WITH {evaluated_sql()} SELECT alertname, severity, type, ts, series, round(value, 9) AS value, active FROM ev")
def q_alert_rule(spark, sf_dir):
    return evaluated(spark, sf_dir).drop("hold_seconds").withColumn("value", rnd(F.col("value")))


LIMIT_FACTOR = 1.2  # an endpoint's limit: so many times the mean latency of the day before


@register("threshold_label_match", f"""WITH {REQ_SQL},
m AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, endpoint, avg(latency) AS value FROM req GROUP BY 1, 2),
l AS (SELECT date_trunc('day', ts) + INTERVAL 1 DAY AS ts, endpoint, avg(latency) * {LIMIT_FACTOR} AS lim FROM req GROUP BY 1, 2)
SELECT m.ts, m.endpoint, round(m.value, 9) AS value, round(l.lim, 9) AS "limit", coalesce(m.value > l.lim, false) AS breach
FROM m ASOF LEFT JOIN l ON m.endpoint = l.endpoint AND m.ts >= l.ts""")
def q_threshold_label_match(spark, sf_dir):
    """Hourly latency of every endpoint against that endpoint's own limit series (set daily)."""
    r = req(spark, sf_dir)
    samples = SE.gauge_samples(r, "latency_mean", F.avg("latency"), ["endpoint"]).select("ts", "endpoint", "value")
    limits = SE.gauge_samples(r, "latency_limit", F.avg("latency") * LIMIT_FACTOR, ["endpoint"], "1 day").select("ts", "endpoint", "value")
    j = SE.match_limits(samples, limits, ["endpoint"])
    return j.select("ts", "endpoint", rnd(F.col("value")).alias("value"), rnd(F.col("limit")).alias("limit"),
                    F.coalesce(F.col("value") > F.col("limit"), F.lit(False)).alias("breach"))


@register("alert_for", f"WITH {firing_sql()} SELECT alertname, severity, type, ts, series, round(value, 9) AS value, active_since FROM fire")
def q_alert_for(spark, sf_dir):
    return firing(spark, sf_dir).withColumn("value", rnd(F.col("value")))


@register("alert_inhibit", f"""WITH {firing_sql()},
crit AS (SELECT DISTINCT alertname, ts FROM fire WHERE severity = 'critical')
SELECT alertname, severity, type, ts, series, round(value, 9) AS value, active_since FROM fire f
WHERE severity <> 'warning' OR NOT EXISTS (SELECT 1 FROM crit WHERE crit.alertname = f.alertname AND crit.ts = f.ts)""")
def q_alert_inhibit(spark, sf_dir):
    return SE.alert_inhibit(firing(spark, sf_dir)).withColumn("value", rnd(F.col("value")))


@register("alert_group", f"""WITH {firing_sql()}
SELECT alertname, severity, type, count(*) AS alerts, count(DISTINCT series) AS series, min(active_since) AS first_active,
  max(ts) AS last_seen FROM fire GROUP BY alertname, severity, type""")
def q_alert_group(spark, sf_dir):
    return SE.alert_group(firing(spark, sf_dir))


@register("request_latency_histogram", f"""WITH {REQ_SQL}, {_lat_buckets_sql()},
h AS (SELECT r.endpoint, r.method, r.status_class, lb.le, count(*) FILTER (WHERE r.latency <= lb.le) AS cumulative
  FROM req r CROSS JOIN lb GROUP BY 1, 2, 3, 4)
SELECT *, cumulative - coalesce(lag(cumulative) OVER (PARTITION BY endpoint, method, status_class ORDER BY le), 0) AS count
FROM h""")
def q_latency_histogram(spark, sf_dir):
    return QU.cumulative_histogram(req(spark, sf_dir), "latency", C.LATENCY_BUCKETS, LABELS)


@register("batch_size_histogram", f"""WITH b AS (SELECT user_id, date_trunc('hour', ts) AS h, count(*) AS size
  FROM events GROUP BY 1, 2),
lb AS (SELECT * FROM (VALUES {', '.join(f'({float(x)!r})' for x in C.BATCH_SIZE_BUCKETS)}, ('Infinity'::DOUBLE)) t(le)),
hh AS (SELECT lb.le, count(*) FILTER (WHERE b.size <= lb.le) AS cumulative FROM b CROSS JOIN lb GROUP BY lb.le)
SELECT le, cumulative, cumulative - coalesce(lag(cumulative) OVER (ORDER BY le), 0) AS count FROM hh""")
def q_batch_size_histogram(spark, sf_dir):
    e = S.table(spark, sf_dir, "events")
    b = e.groupBy("user_id", F.date_trunc("hour", F.col("ts")).alias("h")).agg(F.count("*").alias("size"))
    return QU.cumulative_histogram(b, "size", C.BATCH_SIZE_BUCKETS)


ORACLE_COUNTERS = f"""WITH {REQ_SQL},
p AS (SELECT endpoint, least(greatest(score, 0.0), 1.0) AS p FROM req)
SELECT endpoint, count(*) AS predictions, count(*) FILTER (WHERE p >= {C.POSITIVE_CUT}) AS class_1,
  count(*) FILTER (WHERE p < {C.POSITIVE_CUT}) AS class_0,
  count(*) FILTER (WHERE greatest(p, 1.0 - p) < {C.LOW_CONFIDENCE_PROB_THRESHOLD}) AS low_confidence
FROM p GROUP BY endpoint"""


@register("prediction_counters", f"""WITH {REQ_SQL},
p AS (SELECT endpoint, least(greatest(score, 0.0), 1.0) AS p FROM req)
SELECT endpoint, count(*) AS predictions, count(*) FILTER (WHERE p >= {C.POSITIVE_CUT}) AS class_1,
  count(*) FILTER (WHERE p < {C.POSITIVE_CUT}) AS class_0,
  count(*) FILTER (WHERE greatest(p, 1.0 - p) < {C.LOW_CONFIDENCE_PROB_THRESHOLD}) AS low_confidence
FROM p GROUP BY endpoint""")
def q_prediction_counters(spark, sf_dir):
    return SE.prediction_counters(req(spark, sf_dir), "score")


# ---------------------------------------------------------------------------
# irregular samples: every event is a sample of its endpoint's series, at its own microsecond
# ---------------------------------------------------------------------------
IRREGULAR_RANGE_S = 5 * 3600
IRREGULAR_CHUNK_S = 2 * 3600  # shorter than the range


def irregular(spark, sf_dir):
    e = S.table(spark, sf_dir, "events")
    # values fall and rise, so about half of the steps are counter resets; a coarse one, so that values repeat
    value = F.floor(F.col("value") / 20).cast("double")
    return e.select("ts", F.lit("raw").alias("metric"), F.col("event_type").alias("series"), "event_id", value.alias("value"))


IRREGULAR_SQL = f"""raw AS (SELECT ts, epoch_us(ts) AS t, event_type AS series, event_id, floor(value / 20) AS value FROM events),
d AS (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY t) AS before FROM raw),
e AS (SELECT *, CASE WHEN before IS NULL THEN 0.0 WHEN value < before THEN value ELSE value - before END AS dd,
  CASE WHEN before IS NOT NULL AND value <> before THEN 1 ELSE 0 END AS c FROM d),
r AS (SELECT ts, series, event_id, sum(dd) OVER w - first_value(dd) OVER w AS increase, count(*) OVER w AS n, (t - min(t) OVER w) / 1e6 AS covered,
  sum(c) OVER w - first_value(c) OVER w AS changes
  FROM e WINDOW w AS (PARTITION BY series ORDER BY t RANGE BETWEEN {IRREGULAR_RANGE_S * 1_000_000 - 1} PRECEDING AND CURRENT ROW))"""


@register("rate_irregular", f"WITH {IRREGULAR_SQL} SELECT event_id, series, increase, round(covered, 6) AS covered, round(increase / covered, 9) AS rate FROM r WHERE n >= 2")
def q_rate_irregular(spark, sf_dir):
    r = SE.increase(irregular(spark, sf_dir), IRREGULAR_RANGE_S, True, IRREGULAR_CHUNK_S)
    return r.select("event_id", "series", "increase", F.round("covered", 6).alias("covered"), rnd(F.col("rate")).alias("rate"))


@register("changes_irregular", f"WITH {IRREGULAR_SQL} SELECT event_id, series, changes FROM r")
def q_changes_irregular(spark, sf_dir):
    c = SE.changes(irregular(spark, sf_dir), IRREGULAR_RANGE_S, IRREGULAR_CHUNK_S)
    return c.select("event_id", "series", F.col("changes").cast("bigint").alias("changes"))


IRREGULAR_HOLD_S, IRREGULAR_STALE_S = 5400, 7200


@register("alert_for_irregular", f"""WITH ev AS (SELECT ts, epoch_us(ts) AS t, event_type AS series, event_id, value, value > 20 AS active FROM events),
b AS (SELECT *, CASE WHEN NOT active OR lag(active) OVER w IS NULL OR NOT lag(active) OVER w OR t - lag(t) OVER w > {IRREGULAR_STALE_S * 1_000_000} THEN 1 ELSE 0 END AS brk
  FROM ev WINDOW w AS (PARTITION BY series ORDER BY t)),
g AS (SELECT *, sum(brk) OVER (PARTITION BY series ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM b),
f AS (SELECT *, min(t) OVER (PARTITION BY series, run) AS since, min(ts) OVER (PARTITION BY series, run) AS active_since FROM g)
SELECT ts, series, value, active_since FROM f WHERE active AND t - since >= {IRREGULAR_HOLD_S * 1_000_000}""")
def q_alert_for_irregular(spark, sf_dir):
    """Runs that go on over many chunks of time (an hour each) and end by a false sample or by a gap."""
    e = S.table(spark, sf_dir, "events")
    ev = e.select(F.lit("ValueHigh").alias("alertname"), F.lit("warning").alias("severity"), F.lit("test").alias("type"), "ts", F.col("event_type").alias("series"), "value",
                  (F.col("value") > 20).alias("active"))
    return SE.alert_for(ev, IRREGULAR_HOLD_S, IRREGULAR_STALE_S, 3600).select("ts", "series", "value", "active_since")

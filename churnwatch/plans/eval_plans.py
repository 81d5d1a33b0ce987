"""Evaluation, degradation and gate queries on events read as a scored table
(score = least(value / 500, 1), label = purchase, model = user_id % 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.functions.scalar import rnd
from churnwatch.operators import evaluate as EV
from churnwatch.operators import quality as QU
from churnwatch.plans.registry import register
from churnwatch.sources import tables as S

SPLIT_TS = "2024-01-16"
EPS = EV.EPS

SCORED_SQL = ("scored AS (SELECT event_id, ts, user_id, CAST(user_id % 2 AS VARCHAR) AS model, "
              "least(value / 500.0, 1.0) AS score, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label "
              "FROM events)")


def _r(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else rnd(F.col(c)).alias(c) for c in df.columns])


def _label_sql(src: str, thr: float | str, group: str = "model") -> str:
    t = thr if isinstance(thr, str) else repr(float(thr))
    return f"""SELECT {group} AS "group",
  count(*) FILTER (WHERE score >= {t} AND label = 1) AS tp, count(*) FILTER (WHERE score >= {t} AND label <> 1) AS fp,
  count(*) FILTER (WHERE score < {t} AND label = 1) AS fn, count(*) FILTER (WHERE score < {t} AND label <> 1) AS tn
FROM {src} GROUP BY {group}"""


def _metrics_cols(p: str = "") -> str:
    tp, fp, fn, tn = (f"CAST({p}{c} AS DOUBLE)" for c in ("tp", "fp", "fn", "tn"))
    return f"""round(coalesce(({tp} + {tn}) / nullif({tp} + {fp} + {fn} + {tn}, 0), 0.0), 9) AS accuracy,
  round(coalesce({tp} / nullif({tp} + {fp}, 0), 0.0), 9) AS precision,
  round(coalesce({tp} / nullif({tp} + {fn}, 0), 0.0), 9) AS recall,
  round(coalesce(2 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0.0), 9) AS f1_score,
  round(coalesce(({tp} + {fp}) / nullif({tp} + {fp} + {fn} + {tn}, 0), 0.0), 9) AS predicted_positive_rate"""


def _rank_sql(src: str, group: str = "model", p: str = "") -> str:
    return f"""{p}sc AS (SELECT {group} AS g, score, count(*) FILTER (WHERE label <> 1) AS neg,
    count(*) FILTER (WHERE label = 1) AS pos FROM {src} WHERE score IS NOT NULL GROUP BY {group}, score),
{p}cu AS (SELECT *, sum(neg) OVER (PARTITION BY g ORDER BY score ROWS UNBOUNDED PRECEDING) AS cneg,
    sum(pos) OVER (PARTITION BY g ORDER BY score ROWS UNBOUNDED PRECEDING) AS cpos,
    sum(neg) OVER (PARTITION BY g) AS nn, sum(pos) OVER (PARTITION BY g) AS np_ FROM {p}sc),
{p}rk AS (SELECT g AS "group",
    CASE WHEN max(np_) > 0 AND max(nn) > 0 THEN
      sum(CAST(pos AS DOUBLE) * (CAST(cneg - neg AS DOUBLE) + 0.5 * neg)) / (CAST(max(np_) AS DOUBLE) * max(nn))
      ELSE 0.0 END AS roc_auc,
    CASE WHEN max(np_) > 0 THEN
      sum(CASE WHEN pos > 0 THEN pos * (CAST(np_ - cpos + pos AS DOUBLE) /
          CAST((np_ - cpos + pos) + (nn - cneg + neg) AS DOUBLE)) END) / max(np_) ELSE 0.0 END AS pr_auc
  FROM {p}cu GROUP BY g)"""


def _ll_sql(src: str, group: str = "model", pre: str = "") -> str:
    p = f"least(greatest(CAST(score AS DOUBLE), {EPS!r}), {1.0 - EPS!r})"
    return (f"{pre}ll AS (SELECT {group} AS \"group\", avg(-(label * ln({p}) + (1.0 - label) * ln(1.0 - {p}))) AS log_loss "
            f"FROM {src} WHERE score IS NOT NULL GROUP BY {group})")


def scored(spark, sf_dir) -> DataFrame:
    return S.scored_events(spark, sf_dir)


@register("confusion_metrics", f"WITH {SCORED_SQL}, c AS ({_label_sql('scored', C.SELECTED_THRESHOLD)}) "
                               f"SELECT \"group\", tp, fp, fn, tn, {_metrics_cols()} FROM c")
def q_confusion(spark, sf_dir):
    return _r(EV.confusion_metrics(scored(spark, sf_dir), group="model"), ["group", "tp", "fp", "fn", "tn"])


@register("roc_auc", f"WITH {SCORED_SQL}, {_rank_sql('scored')} SELECT \"group\", round(roc_auc, 9) AS roc_auc FROM rk")
def q_roc_auc(spark, sf_dir):
    return _r(EV.ranking_metrics(scored(spark, sf_dir), group="model").select("group", "roc_auc"), ["group"])


@register("average_precision",
          f"WITH {SCORED_SQL}, {_rank_sql('scored')} SELECT \"group\", round(pr_auc, 9) AS pr_auc FROM rk")
def q_average_precision(spark, sf_dir):
    return _r(EV.ranking_metrics(scored(spark, sf_dir), group="model").select("group", "pr_auc"), ["group"])


@register("log_loss", f"WITH {SCORED_SQL}, {_ll_sql('scored')} SELECT \"group\", round(log_loss, 9) AS log_loss FROM ll")
def q_log_loss(spark, sf_dir):
    return _r(EV.log_loss(scored(spark, sf_dir), group="model"), ["group"])


def _evaluate_sql(src: str, group: str = "model", p: str = "") -> str:
    return f"""{p}c AS ({_label_sql(src, C.SELECTED_THRESHOLD, group)}), {_rank_sql(src, group, p)}, {_ll_sql(src, group, p)},
{p}ev AS (SELECT c."group", {_metrics_cols('c.')}, round(rk.roc_auc, 9) AS roc_auc, round(rk.pr_auc, 9) AS pr_auc,
  round(ll.log_loss, 9) AS log_loss
  FROM {p}c c JOIN {p}rk rk ON c."group" = rk."group" JOIN {p}ll ll ON c."group" = ll."group")"""


@register("evaluate_models", f"WITH {SCORED_SQL}, {_evaluate_sql('scored')} SELECT * FROM ev")
def q_evaluate_models(spark, sf_dir):
    return _r(EV.evaluate_models(scored(spark, sf_dir)), ["group"])


def _sweep_sql(src: str) -> str:
    parts = []
    for t in C.SWEEP_THRESHOLDS:
        parts.append(f"SELECT \"group\", CAST('{float(t)!r}' AS DOUBLE) AS threshold, tp, fp, fn, tn "
                     f"FROM ({_label_sql(src, t)})")
    return f"sw0 AS ({' UNION ALL '.join(parts)}), sw AS (SELECT \"group\", threshold, {_metrics_cols()} FROM sw0)"


@register("threshold_sweep", f"WITH {SCORED_SQL}, {_sweep_sql('scored')} SELECT * FROM sw")
def q_threshold_sweep(spark, sf_dir):
    return _r(EV.threshold_sweep(scored(spark, sf_dir)), ["group", "threshold"])


@register("threshold_sweep_gaps", f"""WITH {SCORED_SQL}, gaps AS (SELECT * FROM scored WHERE event_id % 17 <> 0 AND event_id % 19 <> 0), {_sweep_sql('gaps')} SELECT * FROM sw""")
def q_threshold_sweep_gaps(spark, sf_dir):
    """Every 17th score is NaN and every 19th NULL: those rows take no part."""
    gaps = F.when(F.col("event_id") % 17 == 0, F.lit(float("nan"))).when(F.col("event_id") % 19 != 0, F.col("score"))
    return _r(EV.threshold_sweep(scored(spark, sf_dir).withColumn("score", gaps)), ["group", "threshold"])


@register("threshold_choice", f"""WITH {SCORED_SQL}, {_sweep_sql('scored')},
br AS (SELECT avg(CAST(label AS DOUBLE)) AS b FROM scored),
cand AS (SELECT sw.*, abs(predicted_positive_rate - (SELECT b FROM br)) AS ppr_penalty FROM sw
  WHERE threshold >= {C.THRESHOLD_RANGE[0]} AND threshold <= {C.THRESHOLD_RANGE[1]}),
sc AS (SELECT *, 0.35 * recall + 0.30 * precision + 0.20 * f1_score - 0.40 * ppr_penalty AS score FROM cand)
SELECT "group", threshold, accuracy, precision, recall, f1_score, predicted_positive_rate,
  round(ppr_penalty, 9) AS ppr_penalty, round(score, 9) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY score DESC, threshold) AS rn FROM sc) WHERE rn = 1""")
def q_threshold_choice(spark, sf_dir):
    s = scored(spark, sf_dir)
    sweep = EV.threshold_sweep(s)
    base = s.agg(F.avg(F.col("label").cast("double")).alias("b"))
    # the base rate is one number: joined as a one-row frame
    sweep = sweep.crossJoin(base)
    choice = EV.threshold_choice(sweep, F.col("b")).drop("b")
    return _r(choice, ["group", "threshold"])


@register("class_weights", f"""WITH {SCORED_SQL}, c AS (SELECT label, count(*) AS n FROM scored GROUP BY label)
SELECT label, n, round(CAST((SELECT sum(n) FROM c) AS DOUBLE) / ((SELECT count(*) FROM c) * n), 9) AS weight,
  round(CAST((SELECT sum(n) FROM c WHERE label = 0) AS DOUBLE) / (SELECT sum(n) FROM c WHERE label = 1), 9)
    AS neg_pos_ratio FROM c""")
def q_class_weights(spark, sf_dir):
    return _r(EV.class_weights(scored(spark, sf_dir)), ["label", "n"])


# ---------------------------------------------------------------------------
# degradation and gate: baseline = first half of the log, current = second half
# ---------------------------------------------------------------------------
def _period_metrics(spark, sf_dir):
    s = scored(spark, sf_dir)
    early = F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")
    base = EV.metrics_long(EV.evaluate_models(s.where(early)).withColumnRenamed("group", "model"), ["model"])
    cur = EV.metrics_long(EV.evaluate_models(s.where(~early)).withColumnRenamed("group", "model"), ["model"])
    return base, cur


def _period_sql() -> str:
    b = f"base_s AS (SELECT * FROM scored WHERE ts < TIMESTAMP '{SPLIT_TS} 00:00:00')"
    c = f"cur_s AS (SELECT * FROM scored WHERE ts >= TIMESTAMP '{SPLIT_TS} 00:00:00')"
    def long(name: str, src: str) -> str:
        ev = _evaluate_sql(src, "model", f"{name}_")
        cols = ["accuracy", "precision", "recall", "f1_score", "predicted_positive_rate", "roc_auc", "pr_auc", "log_loss"]
        un = " UNION ALL ".join(f"SELECT \"group\" AS model, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {name}_ev"
                                for m in cols)
        return f"{ev}, {name}_long AS ({un})"
    return f"{SCORED_SQL}, {b}, {c}, {long('b', 'base_s')}, {long('k', 'cur_s')}"


def _deg_sql() -> str:
    ms = ", ".join(f"'{m}'" for m in C.MONITORED_METRICS)
    f = 1.0 - C.MAX_ALLOWED_DEGRADATION
    return f"""deg AS (SELECT b.model, b.metric, b.value AS baseline, k.value AS current,
    b.value * {f!r} AS allowed_floor, (b.value - k.value) / b.value AS degradation_pct,
    k.value < b.value * {f!r} AS degraded
  FROM b_long b JOIN k_long k ON b.model = k.model AND b.metric = k.metric
  WHERE b.metric IN ({ms}) AND b.value IS NOT NULL AND k.value IS NOT NULL AND b.value > 0)"""


@register("metric_degradation", f"""WITH {_period_sql()}, {_deg_sql()}
SELECT model, metric, round(baseline, 9) AS baseline, round(current, 9) AS current,
  round(allowed_floor, 9) AS allowed_floor, round(degradation_pct, 9) AS degradation_pct, degraded FROM deg""")
def q_metric_degradation(spark, sf_dir):
    base, cur = _period_metrics(spark, sf_dir)
    return _r(EV.metric_degradation(base, cur, ["model"]), ["model", "metric", "degraded"])


@register("degradation_status", f"""WITH {_period_sql()}, {_deg_sql()}
SELECT model, count(*) FILTER (WHERE degraded) AS degraded_metrics, count(*) AS total_checked_metrics,
  CASE WHEN count(*) FILTER (WHERE degraded) > 0 THEN 'ALERT' ELSE 'OK' END AS status FROM deg GROUP BY model""")
def q_degradation_status(spark, sf_dir):
    base, cur = _period_metrics(spark, sf_dir)
    return EV.degradation_status(EV.metric_degradation(base, cur, ["model"]), ["model"])


@register("quality_gate", f"""WITH {_period_sql()},
cur AS (SELECT model, max(value) FILTER (WHERE metric = 'f1_score') AS f1, max(value) FILTER (WHERE metric = 'roc_auc')
  AS auc FROM k_long GROUP BY model),
bas AS (SELECT model, max(value) FILTER (WHERE metric = 'f1_score') AS f1, max(value) FILTER (WHERE metric = 'roc_auc')
  AS auc FROM b_long WHERE model = '0' GROUP BY model),
g AS (SELECT c.model, coalesce(c.f1, 0.0) AS f1c, coalesce(b.f1, {C.GATE_DEFAULTS['f1_score']}) * {C.GATE_RATIO} AS f1t,
    coalesce(c.auc, 0.0) AS aucc, coalesce(b.auc, {C.GATE_DEFAULTS['roc_auc']}) * {C.GATE_RATIO} AS auct
  FROM cur c LEFT JOIN bas b ON c.model = b.model)
SELECT model, round(f1c, 9) AS f1_score_current, round(f1t, 9) AS f1_score_threshold, f1c >= f1t AS f1_score_pass,
  round(aucc, 9) AS roc_auc_current, round(auct, 9) AS roc_auc_threshold, aucc >= auct AS roc_auc_pass,
  f1c >= f1t AND aucc >= auct AS passed FROM g""")
def q_quality_gate(spark, sf_dir):
    base, cur = _period_metrics(spark, sf_dir)
    gate = EV.quality_gate(cur, base.where(F.col("model") == "0"), ["model"])
    return _r(gate, ["model", "f1_score_pass", "roc_auc_pass", "passed"])


# ---------------------------------------------------------------------------
# prediction statistics on the log
# ---------------------------------------------------------------------------
@register("prediction_stats", f"""WITH {SCORED_SQL},
p AS (SELECT least(greatest(score, 0.0), 1.0) AS p FROM scored WHERE score IS NOT NULL)
SELECT CAST(count(*) AS DOUBLE) AS prediction_count, round(coalesce(avg(p), 0.0), 9) AS prediction_mean,
  round(coalesce(stddev_pop(p), 0.0), 9) AS prediction_std,
  round(coalesce(avg(CASE WHEN p >= {C.POSITIVE_CUT} THEN 1.0 ELSE 0.0 END), 0.0), 9) AS prediction_positive_rate,
  round(coalesce(avg(CASE WHEN greatest(p, 1.0 - p) < {C.LOW_CONFIDENCE_PROB_THRESHOLD} THEN 1.0 ELSE 0.0 END), 0.0), 9)
    AS low_confidence_fraction FROM p""")
def q_prediction_stats(spark, sf_dir):
    return _r(QU.prediction_stats(scored(spark, sf_dir), "score"), [])


@register("batch_summary", f"""WITH {SCORED_SQL}
SELECT count(*) AS rows, round(avg(CASE WHEN score >= {C.SELECTED_THRESHOLD} THEN 1.0 ELSE 0.0 END), 9) AS churn_rate,
  round(avg(score), 9) AS mean_probability FROM scored""")
def q_batch_summary(spark, sf_dir):
    return _r(QU.batch_summary(scored(spark, sf_dir), "score"), ["rows"])


@register("probability_histogram", f"""WITH {SCORED_SQL},
b AS (SELECT * FROM (VALUES {', '.join(f'({float(x)!r})' for x in C.PROBABILITY_BUCKETS)}, ('Infinity'::DOUBLE)) t(le)),
h AS (SELECT b.le, (SELECT count(*) FROM scored WHERE least(greatest(score, 0.0), 1.0) <= b.le) AS cumulative FROM b)
SELECT le, cumulative, cumulative - coalesce(lag(cumulative) OVER (ORDER BY le), 0) AS count FROM h""")
def q_probability_histogram(spark, sf_dir):
    s = scored(spark, sf_dir).select(F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0)).alias("p"))
    return QU.cumulative_histogram(s, "p", C.PROBABILITY_BUCKETS)

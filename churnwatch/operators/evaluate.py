"""Classifier evaluation on a scored table (score in [0, 1], label 0/1), optionally per group.

Ranking metrics pre-aggregate to one row per (group, distinct score) and use the
range-partitioned running sums of ``operators.counts``, so no group is sorted in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.operators import counts as K

EPS = float(np.finfo(np.float64).eps)


def _group(group: str | None) -> Column:
    return F.col(group).cast("string") if group else F.lit("all")


def confusion_counts(df: DataFrame, score: str, label: str, threshold: float, group: str | None = None) -> DataFrame:
    pred = F.col(score) >= F.lit(threshold)
    y = F.col(label) == 1
    return _scored(df, score).groupBy(_group(group).alias("group")).agg(
        F.count_if(pred & y).alias("tp"),
        F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"),
        F.count_if(~pred & ~y).alias("tn"),
    )


def label_metrics(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1_score, predicted_positive_rate; 0 on empty denominators."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    z = F.lit(0.0)
    precision = F.coalesce(F.try_divide(tp, tp + fp), z)
    recall = F.coalesce(F.try_divide(tp, tp + fn), z)
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), z)
    return counts.select(
        "*",
        F.coalesce(F.try_divide(tp + tn, n), z).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1_score"),
        F.coalesce(F.try_divide(tp + fp, n), z).alias("predicted_positive_rate"),
    )


def confusion_metrics(df: DataFrame, score: str = "score", label: str = "label", threshold: float = C.SELECTED_THRESHOLD,
                      group: str | None = None) -> DataFrame:
    return label_metrics(confusion_counts(df, score, label, threshold, group))


def _scored(df: DataFrame, score: str) -> DataFrame:
    """Rows with a score; NULL and NaN scores take no part in any metric."""
    return df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def score_counts(df: DataFrame, score: str, label: str, group: str | None = None) -> DataFrame:
    """(feature=group, value=score, n_ref=negatives, n_cur=positives): one row per distinct score."""
    return _scored(df, score).groupBy(
        _group(group).alias("feature"), F.col(score).cast("double").alias("value")
    ).agg(F.count_if(F.col(label) != 1).alias("n_ref"), F.count_if(F.col(label) == 1).alias("n_cur"))


def ranking_metrics(df: DataFrame, score: str = "score", label: str = "label", group: str | None = None) -> DataFrame:
    """(group, roc_auc, pr_auc): Mann-Whitney AUC with half credit for ties, and step-wise
    average precision over distinct thresholds; 0.0 when a class is absent."""
    cum = K.with_cumulative(score_counts(df, score, label, group))
    return cum.groupBy(F.col("feature").alias("group")).agg(*_ranking_sums()).select("group", *_ranking_columns())


def _ranking_sums() -> list[Column]:
    neg_below = F.col("cum_ref") - F.col("n_ref")
    pos, neg = F.col("n_cur").cast("double"), F.col("n_ref").cast("double")
    n_pos, n_neg = F.col("n_cur_total").cast("double"), F.col("n_ref_total").cast("double")
    tp_ge = n_pos - F.col("cum_cur") + F.col("n_cur")
    fp_ge = n_neg - F.col("cum_ref") + F.col("n_ref")
    auc_term = pos * (neg_below.cast("double") + F.lit(0.5) * neg)
    ap_term = F.when(pos > 0, pos * (tp_ge / (tp_ge + fp_ge)))
    return [F.sum(auc_term).alias("auc_num"), F.sum(ap_term).alias("ap_num"), F.max(n_pos).alias("P"), F.max(n_neg).alias("N")]


def _ranking_columns() -> list[Column]:
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    return [
        F.when(ok, F.col("auc_num") / (F.col("P") * F.col("N"))).otherwise(F.lit(0.0)).alias("roc_auc"),
        F.when(F.col("P") > 0, F.col("ap_num") / F.col("P")).otherwise(F.lit(0.0)).alias("pr_auc"),
    ]


def log_loss(df: DataFrame, score: str = "score", label: str = "label", group: str | None = None) -> DataFrame:
    """Mean negative log-likelihood, probabilities clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(EPS)), F.lit(1.0 - EPS))
    y = F.col(label).cast("double")
    ll = -(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))
    return _scored(df, score).groupBy(_group(group).alias("group")).agg(F.avg(ll).alias("log_loss"))


def evaluate_models(df: DataFrame, score: str = "score", label: str = "label", group: str | None = "model",
                    threshold: float = C.SELECTED_THRESHOLD) -> DataFrame:
    """The eight metrics side by side, one row per group.

    Everything follows from the rows per (group, score): the table is read and shuffled once, and the counts with their
    running sums are what the rest reads. A NULL label takes no part; any other than 1 counts as 0."""
    cum = K.with_cumulative(score_counts(df, score, label, group))
    s = F.col("value")
    p = F.least(F.greatest(s, F.lit(EPS)), F.lit(1.0 - EPS))
    pos, neg = F.col("n_cur"), F.col("n_ref")
    hit = s >= F.lit(threshold)
    total = lambda c, x: F.sum(F.when(c, x).otherwise(0))
    loss = F.try_divide(F.sum(-(pos.cast("double") * F.ln(p) + neg.cast("double") * F.ln(F.lit(1.0) - p))), F.sum(pos + neg))
    per = cum.groupBy(F.col("feature").alias("group")).agg(
        total(hit, pos).alias("tp"), total(hit, neg).alias("fp"), total(~hit, pos).alias("fn"), total(~hit, neg).alias("tn"),
        loss.alias("log_loss"), *_ranking_sums(),
    )
    return label_metrics(per).select(
        "group", "accuracy", "precision", "recall", "f1_score", "predicted_positive_rate", *_ranking_columns(), "log_loss")


def threshold_sweep(df: DataFrame, score: str = "score", label: str = "label", group: str | None = "model",
                    thresholds: list[float] = C.SWEEP_THRESHOLDS) -> DataFrame:
    """(group, threshold, accuracy, precision, recall, f1_score, predicted_positive_rate); rows without a score take no part.

    One conditional aggregate per group computes all thresholds at once, then ``stack``
    turns it long: no cross join with the data."""
    y = F.col(label) == 1
    aggs = []
    for i, t in enumerate(thresholds):
        pred = F.col(score) >= F.lit(t)
        aggs += [F.count_if(pred & y).alias(f"tp{i}"), F.count_if(pred & ~y).alias(f"fp{i}"),
                 F.count_if(~pred & y).alias(f"fn{i}"), F.count_if(~pred & ~y).alias(f"tn{i}")]
    wide = _scored(df, score).groupBy(_group(group).alias("group")).agg(*aggs)
    args = []
    for i, t in enumerate(thresholds):
        args += [F.lit(float(t)), F.col(f"tp{i}"), F.col(f"fp{i}"), F.col(f"fn{i}"), F.col(f"tn{i}")]
    long = wide.select("group", F.stack(F.lit(len(thresholds)), *args).alias("threshold", "tp", "fp", "fn", "tn"))
    return label_metrics(long).drop("tp", "fp", "fn", "tn")


def threshold_choice(sweep: DataFrame, base_rate: Column | float, lo: float = C.THRESHOLD_RANGE[0],
                     hi: float = C.THRESHOLD_RANGE[1]) -> DataFrame:
    """Best threshold per group by 0.35 recall + 0.30 precision + 0.20 f1 - 0.40 |ppr - base rate|."""
    w = C.THRESHOLD_SCORE_WEIGHTS
    br = base_rate if isinstance(base_rate, Column) else F.lit(float(base_rate))
    cand = sweep.where((F.col("threshold") >= lo) & (F.col("threshold") <= hi)).withColumn(
        "ppr_penalty", F.abs(F.col("predicted_positive_rate") - br)
    )
    scored = cand.withColumn(
        "score",
        F.lit(w["recall"]) * F.col("recall") + F.lit(w["precision"]) * F.col("precision")
        + F.lit(w["f1_score"]) * F.col("f1_score") - F.lit(w["ppr_penalty"]) * F.col("ppr_penalty"),
    )
    # per group: max_by over (score, -threshold); a group has at most len(thresholds) rows
    best = scored.groupBy("group").agg(
        F.max_by(F.struct(*[c for c in scored.columns if c != "group"]), F.struct(F.col("score"), -F.col("threshold")))
        .alias("b")
    )
    return best.select("group", "b.*")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, weight) with balanced weights n_total / (classes * n_class), plus neg/pos ratio."""
    from pyspark.sql import Window

    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    w = Window.partitionBy()  # over the class table: one row per class
    return counts.select(
        "label",
        "n",
        (F.sum("n").over(w) / (F.count("*").over(w) * F.col("n"))).alias("weight"),
        F.try_divide(
            F.sum(F.when(F.col("label") == 0, F.col("n"))).over(w).cast("double"),
            F.sum(F.when(F.col("label") == 1, F.col("n"))).over(w),
        ).alias("neg_pos_ratio"),
    )


# ---------------------------------------------------------------------------
# degradation and gate
# ---------------------------------------------------------------------------
def metrics_long(evaluated: DataFrame, run_cols: list[str]) -> DataFrame:
    """Wide metric rows -> (run columns..., metric, value)."""
    metric_cols = [c for c in evaluated.columns if c not in run_cols]
    args = [x for m in metric_cols for x in (F.lit(m), F.col(m).cast("double"))]
    return evaluated.select(*run_cols, F.stack(F.lit(len(metric_cols)), *args).alias("metric", "value"))


def metric_degradation(baseline: DataFrame, current: DataFrame, keys: list[str],
                       max_drop: float = C.MAX_ALLOWED_DEGRADATION,
                       metrics: list[str] = C.MONITORED_METRICS) -> DataFrame:
    """Per key and monitored metric: baseline, current, allowed_floor, degradation_pct, degraded.
    Missing either side, or baseline <= 0, is skipped (inner join + filter)."""
    b = baseline.where(F.col("metric").isin(metrics)).select(*keys, "metric", F.col("value").alias("baseline"))
    c = current.where(F.col("metric").isin(metrics)).select(*keys, "metric", F.col("value").alias("current"))
    j = b.join(c, keys + ["metric"]).where(F.col("baseline").isNotNull() & F.col("current").isNotNull()
                                           & (F.col("baseline") > 0))
    floor = F.col("baseline") * F.lit(1.0 - max_drop)
    return j.select(
        *keys, "metric", "baseline", "current",
        floor.alias("allowed_floor"),
        ((F.col("baseline") - F.col("current")) / F.col("baseline")).alias("degradation_pct"),
        (F.col("current") < floor).alias("degraded"),
    )


def degradation_status(degradation: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: degraded_metrics, total_checked_metrics, status ALERT/OK."""
    return degradation.groupBy(*keys).agg(
        F.count_if("degraded").alias("degraded_metrics"), F.count("*").alias("total_checked_metrics")
    ).withColumn("status", F.when(F.col("degraded_metrics") > 0, "ALERT").otherwise("OK"))


def quality_gate(current: DataFrame, baseline: DataFrame, keys: list[str], ratio: float = C.GATE_RATIO,
                 defaults: dict = C.GATE_DEFAULTS) -> DataFrame:
    """Per key: F1 and ROC-AUC must reach ratio x baseline; a missing baseline metric uses
    the default; a missing current metric counts as 0."""
    gated = list(defaults)
    cur = current.where(F.col("metric").isin(gated)).groupBy(*keys).pivot("metric", gated).agg(F.first("value"))
    base = baseline.where(F.col("metric").isin(gated)).groupBy(*keys).pivot("metric", gated).agg(F.first("value"))
    base = base.select(*keys, *[F.col(m).alias(f"b_{m}") for m in gated])
    j = cur.join(base, keys, "left")
    cols = [*[F.col(k) for k in keys]]
    passes = []
    for m in gated:
        c = F.coalesce(F.col(m), F.lit(0.0))
        thr = F.coalesce(F.col(f"b_{m}"), F.lit(defaults[m])) * F.lit(ratio)
        cols += [c.alias(f"{m}_current"), thr.alias(f"{m}_threshold"), (c >= thr).alias(f"{m}_pass")]
        passes.append(c >= thr)
    ok = passes[0]
    for p in passes[1:]:
        ok = ok & p
    return j.select(*cols, ok.alias("passed"))

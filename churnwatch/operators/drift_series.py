"""Drift and data quality as series: one value per evaluation time over a sliding window of the log.

The log is counted once into *panes* (time buckets): rows per (pane, feature, value), the reference in a
pane of its own. Counts merge, so a window is the sum of its panes, and everything below works on
counts: a hot value is one row per pane.

* Reference ranks are attached to the values once (``ranked``): the running reference count at a value, its bin
  and whether it lies in the reference's range. The two step functions of KS can only be furthest apart at a value of the
  window, or just before one, so no window ever reads the reference again.
* Bins, totals, missing and unseen counts are small per pane and are handed to the windows that hold the
  pane. For KS the values themselves are; running counts stay inside value ranges (of the global distribution), with
  offsets from the ranges' totals, so no feature of a window is sorted in one task.

A window at time ``t`` holds the rows of ``[t - window, t)``; panes start at multiples of the pane length since the epoch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.operators import counts as K
from churnwatch.operators import drift as D
from churnwatch.session import cut_lineage


def _seconds(text: str) -> Column:
    return F.unix_seconds(F.lit(text).cast("timestamp"))


@dataclass
class Panes:
    """Counts of a log per pane, and how they make up windows."""

    counts: DataFrame  # pane (seconds, NULL: reference), fid, num_value, cat_value, n, latest
    numeric: list[str]
    categorical: list[str]
    pane_seconds: int
    window_panes: int
    start: str  # first and last evaluation time
    end: str

    def features(self) -> list[str]:
        return self.numeric + self.categorical

    def current(self) -> DataFrame:
        return self.counts.where(F.col("pane").isNotNull())

    def in_windows(self, df: DataFrame) -> DataFrame:
        """Rows of panes handed to every window that holds them: ``at`` (seconds) replaces ``pane``."""
        ends = F.transform(F.sequence(F.lit(1), F.lit(self.window_panes)), lambda k: F.col("pane") + k * F.lit(self.pane_seconds))
        return df.withColumn("at", F.explode(ends)).drop("pane").where(F.col("at").between(_seconds(self.start), _seconds(self.end)))


def count_panes(
    df: DataFrame, numeric: list[str], categorical: list[str], start: str, end: str, ts: str = "ts", side_col: str = K.SIDE,
    pane_seconds: int = 3600, window_panes: int = 24,
) -> Panes:
    """One scan and one shuffle over both samples; windows are evaluated at the multiples of the pane length in [start, end]. Numbers that are NULL or NaN, and NULL texts, are counted as missing.

    Current rows without a time are in no window; rows of neither side are left out.
    """
    args: list[Column] = []
    for i, name in enumerate(numeric):
        x = F.col(name).cast("double")
        args += [F.lit(i), F.when(~F.isnan(x), x + F.lit(0.0)), F.lit(None).cast("string")]
    for j, name in enumerate(categorical, len(numeric)):
        args += [F.lit(j), F.lit(None).cast("double"), F.col(name).cast("string")]
    second = F.unix_micros(F.col(ts).cast("timestamp"))
    pane = F.when(~F.col(side_col), F.floor(second / F.lit(pane_seconds * 1_000_000)) * F.lit(pane_seconds))
    placed = df.where(F.col(side_col) | (~F.col(side_col) & F.col(ts).isNotNull()))
    long = placed.select(pane.alias("pane"), second.alias("latest"), F.stack(F.lit(len(numeric) + len(categorical)), *args).alias("fid", "num_value", "cat_value"))
    counts = long.groupBy("pane", "fid", "num_value", "cat_value").agg(F.count("*").alias("n"), F.max("latest").alias("latest"))
    return Panes(cut_lineage(counts, "panes"), numeric, categorical, pane_seconds, window_panes, start, end)


def _named(features: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(f) for f in features]), F.col("fid") + 1)


def _stamp(at: Column) -> Column:
    return F.timestamp_seconds(at).cast("timestamp_ntz")


def numeric_windows(panes: Panes, limits: C.DriftLimits) -> DataFrame:
    """(at, fid, ks, psi) for features with at least two numbers in the reference and in the window."""
    values = panes.counts.where((F.col("fid") < len(panes.numeric)) & F.col("num_value").isNotNull())
    per_value = values.groupBy(F.col("fid").alias("feature"), F.col("num_value").alias("value")).agg(
        F.sum(F.when(F.col("pane").isNull(), F.col("n")).otherwise(0)).alias("n_ref"),
        F.sum(F.when(F.col("pane").isNotNull(), F.col("n")).otherwise(0)).alias("n_cur"),
    )
    cum = cut_lineage(K.with_cumulative(per_value, keep_part=True), "pane-ranks")
    totals = {f: t for f, t in K.feature_totals(cum).items() if t["n_ref"] >= 2 and t["n_cur"] >= 2}
    empty = "at long, fid int, ks double, psi double"
    if not totals:
        return values.sparkSession.createDataFrame([], empty)
    buckets = limits.psi_buckets
    edges = D.reference_quantiles(cum, totals, D.quantile_probs(buckets))
    e = F.element_at(F.create_map(*[x for f, es in edges.items() for x in (F.lit(f), F.array(*[F.lit(float(v)) for v in es]))]), F.col("fid"))
    x = F.col("num_value")
    place = sum((F.when(x >= F.element_at(e, k + 1), 1).otherwise(0) for k in range(1, buckets)), F.lit(0))
    in_range = (x >= F.element_at(e, 1)) & (x <= F.element_at(e, buckets + 1))
    ranks = cum.where(F.col("feature").isin(list(totals))).select(
        F.col("feature").alias("fid"), F.col("value").alias("num_value"), "part", "n_ref", "n_ref_total", "cum_ref",
    ).withColumn("bin", F.when(in_range, place))
    ref = ranks.where(F.col("bin").isNotNull()).groupBy("fid").agg(*[F.sum(F.when(F.col("bin") == k, F.col("n_ref")).otherwise(0)).alias(f"r{k}") for k in range(buckets)])
    ranked = cut_lineage(values.where(F.col("pane").isNotNull()).select("pane", "fid", "num_value", "n").join(ranks, ["fid", "num_value"]), "ranked")

    # PSI: in-range rows per bin, small per pane
    bins = ranked.where(F.col("bin").isNotNull()).groupBy("pane", "fid", "bin").agg(F.sum("n").alias("n"))
    cur = panes.in_windows(bins).groupBy("at", "fid").agg(*[F.sum(F.when(F.col("bin") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(buckets)])
    psi, _ = D.psi_value([F.col(f"r{k}") for k in range(buckets)], [F.col(f"c{k}") for k in range(buckets)])
    psi_rows = cur.join(ref, "fid").select("at", "fid", psi.alias("psi"))

    # KS: running counts inside value ranges, offsets from the ranges' totals
    parts = panes.in_windows(ranked.groupBy("pane", "fid", "part").agg(F.sum("n").alias("n"))).groupBy("at", "fid", "part").agg(F.sum("n").alias("n"))
    window = Window.partitionBy("at", "fid")
    before = window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("at", "fid", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"), F.sum("n").over(window).alias("total"))
    kept = panes.in_windows(ranked).groupBy("at", "fid", "part", "num_value", "n_ref", "n_ref_total", "cum_ref").agg(F.sum("n").alias("n"))
    inside = Window.partitionBy("at", "fid", "part").orderBy("num_value").rowsBetween(Window.unboundedPreceding, 0)
    run = kept.withColumn("run", F.sum("n").over(inside)).join(offsets, ["at", "fid", "part"])

    def apart(ref_count: Column, cur_count: Column) -> Column:
        return F.abs(ref_count.cast("double") / F.col("n_ref_total") - cur_count.cast("double") / F.col("total"))

    upto = F.col("off") + F.col("run")
    furthest = F.greatest(apart(F.col("cum_ref"), upto), apart(F.col("cum_ref") - F.col("n_ref"), upto - F.col("n")))
    ks = run.where(F.col("total") >= 2).groupBy("at", "fid").agg(F.max(furthest).alias("ks"))
    return ks.join(psi_rows, ["at", "fid"], "left")


def categorical_windows(panes: Panes) -> DataFrame:
    """(at, fid, js) for features with a text in the window; NULL is a category beside them, as in the report."""
    first = len(panes.numeric)
    texts = panes.counts.where(F.col("fid") >= first).withColumn("value", F.coalesce("cat_value", F.lit(C.NULL_CATEGORY)))
    ref = texts.where(F.col("pane").isNull()).groupBy("fid", "value").agg(F.sum("n").alias("n_ref"))
    r_tot = ref.groupBy("fid").agg(F.sum("n_ref").alias("r_tot"))
    cur = texts.where(F.col("pane").isNotNull())
    # the window's own totals; one without any text is no window of this feature
    totals = panes.in_windows(cur.groupBy("pane", "fid").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("cat_value").isNotNull(), F.col("n")).otherwise(0)).alias("texts")))
    totals = totals.groupBy("at", "fid").agg(F.sum("n").alias("c_tot"), F.sum("texts").alias("texts")).where(F.col("texts") > 0)
    kept = panes.in_windows(cur.groupBy("pane", "fid", "value").agg(F.sum("n").alias("n"))).groupBy("at", "fid", "value").agg(F.sum("n").alias("n"))
    both = kept.join(totals, ["at", "fid"]).join(r_tot, "fid", "left").join(ref, ["fid", "value"], "left")
    p = F.coalesce(F.col("n_ref"), F.lit(0)).cast("double") / F.col("r_tot")
    q = F.col("n").cast("double") / F.col("c_tot")
    m = (p + q) / F.lit(2.0)
    terms = F.when(p > 0, p * F.ln(p / m)).otherwise(F.lit(0.0)) + q * F.ln(q / m)
    # categories of the reference that the window lacks add p * ln 2 each: the share not met, at once
    per = both.groupBy("at", "fid").agg(F.sum(terms).alias("met"), F.sum(F.coalesce(F.col("n_ref"), F.lit(0))).alias("met_ref"), F.max("r_tot").alias("r_tot"))
    unmet = (F.col("r_tot") - F.col("met_ref")).cast("double") / F.col("r_tot") * F.lit(D.LN2)
    js = F.sqrt(F.greatest((F.col("met") + unmet) / F.lit(D.LN2) / F.lit(2.0), F.lit(0.0)))
    return per.select("at", "fid", F.coalesce(js, F.lit(0.0)).alias("js"))


def drift_series(panes: Panes, limits: C.DriftLimits = C.DriftLimits()) -> DataFrame:
    """The drift report of every window: ``ts`` and the columns of ``drift.drift_report``, in no order.

    Windows without rows have no report; a feature is reported where both sides have at least two numbers, or where
    the window has a text. The p-value is not computed.
    """
    none = F.lit(None).cast("double")
    parts = []
    named = lambda df: df.withColumn("feature", _named(panes.features()))
    keys = ["at", F.col("fid").alias("position")]
    if panes.numeric:
        parts.append(named(numeric_windows(panes, limits)).select(*keys, *D.numeric_row(limits, none)))
    if panes.categorical:
        parts.append(named(categorical_windows(panes)).withColumn("p_value", none).select(*keys, *D.categorical_row(limits)))
    report = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return report.select(_stamp(F.col("at")).alias("ts"), *[c for c in report.columns if c != "at"])


def quality_series(panes: Panes, required: int | None = None) -> DataFrame:
    """The data-quality ratios of every window, and the log's freshness at every evaluation time.

    One row per evaluation time: ``ts, window_rows, missing_ratio, schema_violation_fraction,
    unseen_category_ratio, out_of_range_ratio, freshness_lag_seconds``. A feature without any value in a window that has rows
    counts as a column that the window lacks: it is a schema violation (share of ``required`` columns, all features unless given) and takes no
    part in the other ratios. The lag is that of the newest row before ``ts``; 0 if there is none. Ratios are NULL without rows.
    """
    step, first = panes.pane_seconds, len(panes.numeric)
    counts, cur = panes.counts, panes.current()
    value = F.when(F.col("fid") < first, F.col("num_value").isNotNull()).otherwise(F.col("cat_value").isNotNull())
    seen = counts.where(F.col("pane").isNull() & F.col("cat_value").isNotNull()).select("fid", "cat_value").distinct().withColumn("known", F.lit(True))
    bounds = counts.where(F.col("pane").isNull()).groupBy("fid").agg(F.min("num_value").alias("lo"), F.max("num_value").alias("hi"))
    # texts the reference never saw and numbers outside its range: counted per value before any join
    odd = cur.join(seen, ["fid", "cat_value"], "left").join(bounds, "fid", "left").withColumn(
        "odd", F.when(F.col("fid") >= first, F.col("cat_value").isNotNull() & F.col("known").isNull()).otherwise((F.col("num_value") < F.col("lo")) | (F.col("num_value") > F.col("hi")))
    )
    judged = F.when(F.col("fid") >= first, F.lit(True)).otherwise(F.col("lo").isNotNull())
    per_pane = odd.groupBy("pane", "fid").agg(
        F.sum("n").alias("n"), F.sum(F.when(value, F.col("n")).otherwise(0)).alias("values"),
        F.sum(F.when(F.col("odd"), F.col("n")).otherwise(0)).alias("odd"), F.bool_or(judged).alias("judged"), F.max("latest").alias("latest"),
    )
    per_pane = cut_lineage(per_pane, "pane-quality")  # panes x features rows
    windows = panes.in_windows(per_pane.drop("latest")).groupBy("at", "fid").agg(
        F.sum("n").alias("n"), F.sum("values").alias("values"), F.sum("odd").alias("odd"), F.bool_or("judged").alias("judged")
    )
    there = F.col("values") > 0
    share = F.when(there & F.col("judged"), F.col("odd") / F.col("values"))
    zero = F.lit(0.0)
    ratios = windows.groupBy("at").agg(
        F.max("n").alias("window_rows"),
        F.coalesce(F.try_divide(F.sum(F.when(there, F.col("n") - F.col("values"))).cast("double"), F.sum(F.when(there, F.col("n")))), zero).alias("missing_ratio"),
        (F.count_if(~there).cast("double") / F.lit(float(required or len(panes.features())))).alias("schema_violation_fraction"),
        F.coalesce(F.avg(F.when(F.col("fid") >= first, share)), zero).alias("unseen_category_ratio"),
        F.coalesce(F.avg(F.when(F.col("fid") < first, share)), zero).alias("out_of_range_ratio"),
    )
    spark = counts.sparkSession
    first_at, last_at = (F.ceil(_seconds(panes.start) / F.lit(step)) * F.lit(step)).cast("bigint"), _seconds(panes.end)
    steps = spark.range(1).where(first_at <= last_at).select(F.explode(F.sequence(first_at, last_at, F.lit(step).cast("bigint"))).alias("at"))
    # the newest row before each step: a running maximum over panes (one row per pane)
    newest = per_pane.groupBy((F.col("pane") + F.lit(step)).alias("at")).agg(F.max("latest").alias("latest"))
    whole = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    fresh = steps.withColumn("asked", F.lit(True)).join(newest, "at", "full").withColumn("latest", F.max("latest").over(whole)).where("asked")
    lag = F.greatest((F.col("at").cast("double") * F.lit(1e6) - F.col("latest")) / F.lit(1e6), zero)
    return fresh.select("at", F.coalesce(lag, zero).alias("freshness_lag_seconds")).join(ratios, "at", "left").select(
        _stamp(F.col("at")).alias("ts"), F.coalesce("window_rows", F.lit(0)).alias("window_rows"), "missing_ratio", "schema_violation_fraction",
        "unseen_category_ratio", "out_of_range_ratio", "freshness_lag_seconds",
    )


DRIFT_METRICS = {  # metric name -> column of drift.drift_summary
    "drift_numeric_ks_max": "ks_max",
    "drift_categorical_js_max": "js_max",
    "drift_numeric_psi_max": "psi_max",
    "drift_features_alert_fraction": "alert_fraction",
    "drift_retrain_recommended": "retrain_recommended",
}
QUALITY_METRICS = {  # metric name -> column of quality_series
    "dq_missing_ratio": "missing_ratio",
    "dq_schema_violation_fraction": "schema_violation_fraction",
    "dq_unseen_category_ratio": "unseen_category_ratio",
    "dq_out_of_range_ratio": "out_of_range_ratio",
    "dq_freshness_lag_seconds": "freshness_lag_seconds",
}


def as_samples(df: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """(ts, metric, series, labels, value): one gauge sample per metric column that is not NULL."""
    args = [x for name, column in metrics.items() for x in (F.lit(name), F.col(column).cast("double"))]
    long = df.select("ts", F.stack(F.lit(len(metrics)), *args).alias("metric", "value")).where(F.col("value").isNotNull())
    return long.select("ts", "metric", F.lit("").alias("series"), F.create_map().cast("map<string,string>").alias("labels"), "value")


def drift_gauge_series(report: DataFrame, limits: C.DriftLimits = C.DriftLimits()) -> DataFrame:
    """The exported drift gauges of every window, as samples."""
    windows = cut_lineage(report, "window-reports")  # windows x features rows, rolled up twice
    return as_samples(D.drift_summary(windows, limits, ("ts",)), DRIFT_METRICS)


def quality_gauge_series(quality: DataFrame) -> DataFrame:
    """The exported data-quality gauges, as samples; windows without rows have the freshness lag only."""
    return as_samples(quality, QUALITY_METRICS)

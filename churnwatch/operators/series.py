"""Metric series and alert rules as DataFrame operators.

A metrics table has one row per sample: ``ts``, ``metric``, ``series`` (canonical
label text, e.g. ``endpoint=/predict,status_class=5xx``), ``labels`` (map) and
``value``. Raw logs are first aggregated to samples (one row per series and interval),
so every per-series window below runs over a bounded number of samples.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.session import cut_lineage


def epoch(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)


def series_key(labels: list[str]) -> Column:
    return F.concat_ws(",", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in labels])


def label_map(labels: list[str]) -> Column:
    return F.create_map(*[x for k in labels for x in (F.lit(k), F.col(k).cast("string"))])


# ---------------------------------------------------------------------------
# samples
# ---------------------------------------------------------------------------
def counter_samples(log: DataFrame, metric: str, labels: list[str], interval: str = "1 hour",
                    reset_at: str | None = None, value: Column | None = None) -> DataFrame:
    """A monotonic counter per label set, sampled at the end of each interval with activity.

    ``reset_at`` restarts every counter at that instant (a process restart), so the
    series drops back and consumers must be reset-aware. ``value`` sums a column
    instead of counting rows."""
    bucket = interval_start(F.col("ts"), interval)
    incr = F.count("*") if value is None else F.sum(value)
    per = log.groupBy(bucket.alias("bucket"), *labels).agg(incr.cast("double").alias("inc"))
    epoch_no = F.lit(0) if reset_at is None else (F.col("bucket") >= F.lit(reset_at).cast("timestamp_ntz")).cast("int")
    per = per.withColumn("_epoch", epoch_no)
    # one window per series and process epoch over interval buckets (bounded by the time range)
    w = Window.partitionBy(*labels, "_epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return per.select(
        (F.col("bucket") + F.expr(f"INTERVAL {interval}")).alias("ts"),
        F.lit(metric).alias("metric"),
        series_key(labels).alias("series"),
        label_map(labels).alias("labels"),
        *labels,
        F.sum("inc").over(w).alias("value"),
    )


def bucket_samples(log: DataFrame, metric: str, column: str, bounds: list[float], labels: list[str], interval: str = "1 hour") -> DataFrame:
    """A histogram's bucket counters: per label set and upper bound ``le`` the rows so far, sampled at the end of each interval with activity."""
    from churnwatch.operators.quality import cumulative_histogram

    per = cumulative_histogram(log.withColumn("bucket", interval_start(F.col("ts"), interval)), column, bounds, ["bucket", *labels])
    w = Window.partitionBy(*labels, "le").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return per.select(
        (F.col("bucket") + F.expr(f"INTERVAL {interval}")).alias("ts"), F.lit(metric).alias("metric"), series_key([*labels, "le"]).alias("series"),
        *labels, "le", F.sum("cumulative").over(w).cast("double").alias("value"),
    )


def gauge_samples(log: DataFrame, metric: str, value: Column, labels: list[str] | None = None,
                  interval: str = "1 hour") -> DataFrame:
    """A gauge per label set: the aggregate ``value`` over each interval, stamped at its end."""
    labels = labels or []
    bucket = interval_start(F.col("ts"), interval)
    per = log.groupBy(bucket.alias("bucket"), *labels).agg(value.cast("double").alias("value"))
    return per.select(
        (F.col("bucket") + F.expr(f"INTERVAL {interval}")).alias("ts"),
        F.lit(metric).alias("metric"),
        series_key(labels).alias("series"),
        label_map(labels).alias("labels"),
        *labels,
        "value",
    )


def interval_start(ts: Column, interval: str) -> Column:
    """Start of the interval (for example ``5 minutes``) that holds ``ts``, counted from the epoch."""
    return F.window(ts, interval)["start"]


# ---------------------------------------------------------------------------
# range functions
# ---------------------------------------------------------------------------
def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


CHUNK_SECONDS = 7 * 24 * 3600  # length of the time chunks that runs of an alert are cut into


def trailing(samples: DataFrame, range_seconds: int, step: Callable[[Column, Column], Column]) -> DataFrame:
    """Samples with what lies in (t - range, t] of their series, t in whole microseconds: ``_n`` samples, the earliest at ``_from``, and
    ``_sum``, the sum of ``step(before, value)`` over all of them but the first (NULL where the step to the first is NULL).

    Time is cut into blocks of one range, so a window is a start of its own block and an end of the block before. Each
    sample is held in its own block and, moved on by the range, in the next one (``_late``): there it lies in the windows up to
    its moved time. The last sample before these (``_late`` NULL) lies in no window and only says what the first one follows.
    Both parts are running aggregates, one forwards and one backwards, so the work is in proportion to the samples however
    many lie in a range, and a series is as many tasks as it has blocks."""
    span = range_seconds * 1_000_000
    s = samples.withColumn("_t", micros("ts")).where(F.col("_t").isNotNull()).withColumn("_block", F.col("_t") - F.pmod(F.col("_t"), F.lit(span)))
    # what came before all that a block holds: one row per block, no window in it
    row = Window.partitionBy("metric", "series").orderBy("_block")
    ends = s.groupBy("metric", "series", "_block").agg(F.max(F.struct("_t", "value", "_block")).alias("_end"))
    past = [F.lag("_end", k).over(row) for k in (1, 2)]
    ends = ends.withColumn("_end", F.when(past[0]["_block"] < F.col("_block") - F.lit(span), past[0]).otherwise(past[1])).where(F.col("_end").isNotNull())
    ends = ends.select("metric", "series", "_block", F.col("_end._t").alias("_t"), F.col("_end.value").alias("value"), F.col("_block").alias("_at"))
    s = s.withColumn("_late", F.explode(F.array(F.lit(False), F.lit(True))))
    s = s.withColumn("_at", F.col("_t") + F.when(F.col("_late"), F.lit(span - 1)).otherwise(F.lit(0)))
    s = s.withColumn("_block", F.col("_block") + F.when(F.col("_late"), F.lit(span)).otherwise(F.lit(0))).unionByName(ends, allowMissingColumns=True)
    block = Window.partitionBy("metric", "series", "_block")
    inside = block.orderBy("_t")  # the samples that follow each other, those of earlier blocks first
    s = s.withColumn("_row", F.row_number().over(inside)).withColumn("_step", step(F.lag("value").over(inside), F.col("value")))
    parts = []
    for late, order in ((False, F.col("_at")), (True, F.desc("_at"))):
        w, own = block.orderBy(order), F.col("_late") if late else ~F.col("_late")  # the default frame: all up to this time, ties with it
        parts.append((
            F.count_if(own).over(w), F.min(F.when(own, F.struct("_t", "_row", "_step"))).over(w), F.coalesce(F.sum(F.when(own, F.col("_step"))).over(w), F.lit(0)),
        ))
    (n, first, total), (n_late, first_late, total_late) = parts
    s = s.select(*samples.columns, "_t", "_late", n.alias("_n0"), first.alias("_f0"), total.alias("_s0"), n_late.alias("_n1"), first_late.alias("_f1"), total_late.alias("_s1"))
    head = F.coalesce("_f1", "_f0")
    return s.where(~F.col("_late")).select(
        *samples.columns, "_t", (F.col("_n0") + F.col("_n1")).alias("_n"), head["_t"].alias("_from"), (F.col("_s1") + F.col("_s0") - head["_step"]).alias("_sum"),
    )


def increase(samples: DataFrame, range_seconds: int, rate_per_second: bool = False, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Reset-aware growth of each counter over the trailing range (samples in (t - range, t]).

    A drop between two samples is a reset: the later value counts as the growth. No
    extrapolation to the range edges; at least two samples are needed. With
    ``rate_per_second`` the growth is divided by the seconds the samples cover.
    ``chunk_seconds`` has no effect: blocks are as long as the range."""
    growth = lambda prev, value: F.when(prev.isNull(), F.lit(0.0)).when(value < prev, value).otherwise(value - prev)
    s = trailing(samples, range_seconds, growth)
    covered = (F.col("_t") - F.col("_from")) / F.lit(1e6)
    out = s.where(F.col("_n") >= 2).select(*[c for c in samples.columns if c != "value"], F.col("_sum").alias("increase"), covered.alias("covered"))
    if rate_per_second:
        out = out.withColumn("rate", F.col("increase") / F.col("covered"))
    return out


def changes(samples: DataFrame, range_seconds: int, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Number of value changes between consecutive samples inside the trailing range. ``chunk_seconds`` has no effect, as in ``increase``."""
    changed = lambda prev, value: F.when(prev.isNotNull() & (value != prev), 1).otherwise(0)
    s = trailing(samples, range_seconds, changed)
    return s.select(*[c for c in samples.columns if c != "value"], F.col("_sum").alias("changes"))


def histogram_quantile(buckets: DataFrame, q: float, group: list[str], le: str = "le", count: str = "cumulative") -> DataFrame:
    """Quantile from cumulative bucket counts per group (linear inside the bucket, lower
    edge 0 for the first bucket, the last finite edge when the rank falls in +Inf)."""
    w = Window.partitionBy(*group).orderBy(le)  # over the bucket list of one group
    b = buckets.select(*group, F.col(le).alias("le"), F.col(count).cast("double").alias("c"))
    b = b.select(*group, "le", "c", F.lag("le").over(w).alias("prev_le"), F.lag("c").over(w).alias("prev_c"),
                 F.max(F.when(F.col("le") == float("inf"), F.col("c"))).over(Window.partitionBy(*group)).alias("total"),
                 F.max(F.when(F.col("le") != float("inf"), F.col("le"))).over(Window.partitionBy(*group)).alias("top"))
    rank = F.lit(q) * F.col("total")
    hit = b.where((F.col("c") >= rank) & (F.col("total") > 0))
    lower = F.coalesce(F.col("prev_le"), F.lit(0.0))
    prev_c = F.coalesce(F.col("prev_c"), F.lit(0.0))
    val = F.when(F.col("le") == float("inf"), F.col("top")).otherwise(
        lower + (F.col("le") - lower) * F.try_divide(rank - prev_c, F.col("c") - prev_c))
    return hit.groupBy(*group).agg(F.min_by(val, F.col("le")).alias("quantile"))


def aggregate_by(samples: DataFrame, keep: list[str], fn: str = "sum", value: str = "value") -> DataFrame:
    """``sum by (keep)`` / ``max without (others)``: aggregate per timestamp over dropped labels."""
    agg = getattr(F, fn)(value).alias(value)
    return samples.groupBy("ts", "metric", *keep).agg(agg)


# ---------------------------------------------------------------------------
# rules
# ---------------------------------------------------------------------------
def evaluate_rule(samples: DataFrame, alertname: str, op: str, threshold: float, severity: str, kind: str) -> DataFrame:
    """(alertname, severity, type, ts, series, value, active) for one comparison rule."""
    v = F.col("value")
    cond = {">": v > threshold, "<": v < threshold, "==": v == threshold, ">=": v >= threshold, "<=": v <= threshold}[op]
    return samples.select(
        F.lit(alertname).alias("alertname"), F.lit(severity).alias("severity"), F.lit(kind).alias("type"),
        "ts", "series", "value", F.coalesce(cond, F.lit(False)).alias("active"),
    )


def evaluate_rules(samples: DataFrame, rules: DataFrame) -> DataFrame:
    """All comparison rules in one pass: samples joined with the rules table on ``metric``
    (the rules table has one row per rule, so its broadcast is bounded).

    rules columns: alertname, metric, op, threshold, hold_seconds, severity, type."""
    r = F.broadcast(rules)
    j = samples.join(r, "metric")
    v, t = F.col("value"), F.col("threshold")
    cond = (F.when(F.col("op") == ">", v > t).when(F.col("op") == "<", v < t).when(F.col("op") == ">=", v >= t)
            .when(F.col("op") == "<=", v <= t).when(F.col("op") == "==", v == t))
    return j.select("alertname", "severity", "type", "ts", "series", "value", "hold_seconds",
                    F.coalesce(cond, F.lit(False)).alias("active"))


def match_limits(samples: DataFrame, limits: DataFrame, on: list[str], limit: str = "limit") -> DataFrame:
    """Samples with the limit that holds for their labels at their time: the newest limit sample
    not after the sample (a metric is compared with its limit *series*, matched by label).

    Limits become intervals (valid until the next one of their labels); they are sparse beside the samples, and the join is on
    the labels with the interval as its condition. Samples before the first limit have none."""
    w = Window.partitionBy(*on).orderBy("since")
    spans = limits.select(*on, F.col("ts").alias("since"), F.col("value").alias(limit)).withColumn("until", F.lead("since").over(w))
    inside = (F.col("ts") >= F.col("since")) & (F.col("until").isNull() | (F.col("ts") < F.col("until")))
    left = samples
    keyed = spans.withColumnsRenamed({c: f"_{c}" for c in on})
    same = inside
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(keyed, same, "left").drop("since", "until", *[f"_{c}" for c in on])


def evaluate_limit_rules(samples: DataFrame, rules: DataFrame, limits: DataFrame) -> DataFrame:
    """Rules whose limit is a series of its own: each sample against the limit that holds at its time.

    rules columns: alertname, metric, series (NULL: any), op, threshold, limit_metric, hold_seconds, stale_seconds, severity, type; one of
    ``threshold`` and ``limit_metric`` is given. limits columns: ts, metric, value. Where the limit series has no
    value yet, the rule is not active. The rules table has one row per rule, so its broadcast is bounded."""
    r = F.broadcast(rules.withColumnRenamed("series", "_of"))
    j = samples.join(r, "metric").where(F.col("_of").isNull() | (F.col("_of") == F.col("series"))).drop("_of")
    j = match_limits(j, limits.select("ts", F.col("metric").alias("limit_metric"), "value"), ["limit_metric"])
    v, t = F.col("value"), F.coalesce(F.col("threshold"), F.col("limit"))
    cond = F.when(F.col("op") == ">", v > t).when(F.col("op") == "<", v < t).when(F.col("op") == "==", v == t)
    return j.select("alertname", "severity", "type", "ts", "series", "value", t.alias("limit"), "hold_seconds", "stale_seconds", F.coalesce(cond, F.lit(False)).alias("active"))


def alert_for(evaluated: DataFrame, hold_seconds: int | None, stale_seconds: int | None, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Firing samples: the condition held without a break (false sample or a gap longer
    than ``stale_seconds``) for at least ``hold_seconds`` (None: the per-row column of that
    name from the rules table). Gaps-and-islands per (rule, severity, series).

    A series is worked on in chunks of time. What a chunk needs of those before it is one row per chunk: whether the
    condition held at its last sample, when that was, and since when; the running window over them holds as many rows as there are chunks."""
    key = ["alertname", "severity", "series"]
    hold = F.col("hold_seconds") if hold_seconds is None else F.lit(hold_seconds)
    stale = F.col("stale_seconds") if stale_seconds is None else F.lit(stale_seconds)
    micro = micros("ts")
    s = evaluated.withColumn("_t", epoch("ts")).withColumn("_chunk", F.floor(micro / F.lit(chunk_seconds * 1_000_000))).withColumn("_stale", stale.cast("double"))
    w = Window.partitionBy(*key, "_chunk").orderBy("_t")
    before = F.lag(F.struct(F.col("_t").alias("t"), "active")).over(w)
    s = s.withColumn("_before", before)
    # where a run starts; the first sample of a chunk is told by the chunks before
    s = s.withColumn("_starts", F.when(F.col("_before").isNotNull(), ~F.col("active") | ~F.col("_before.active") | (F.col("_t") - F.col("_before.t") > F.col("_stale"))))
    s = cut_lineage(s, "alert-samples")  # read for the chunks' ends and for the runs
    at = F.struct("_t", "active", "_stale", "ts")
    ends = s.groupBy(*key, "_chunk").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.max(F.when(F.col("_starts"), F.struct("_t", "ts"))).alias("inner"))
    row = Window.partitionBy(*key).orderBy("_chunk")
    past = F.lag("last").over(row)
    cut = past.isNull() | ~F.col("first.active") | ~past["active"] | (F.col("first._t") - past["_t"] > F.col("first._stale"))
    ends = ends.withColumn("_cut", F.coalesce(cut, F.lit(True)))
    since = F.coalesce(F.col("inner"), F.when(F.col("_cut"), F.struct(F.col("first._t").alias("_t"), F.col("first.ts").alias("ts"))))
    carried = F.last(since, ignorenulls=True).over(row.rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(*[F.col(c).alias(f"_{c}") for c in key], F.col("_chunk").alias("_at"), "_cut", carried.alias("_carried"))
    same = F.col("_chunk") == F.col("_at")
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    s = s.join(ends, same)
    own = F.max(F.when(F.coalesce(F.col("_starts"), F.col("_cut")), F.struct("_t", "ts"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    s = s.withColumn("_since", F.coalesce(own, F.col("_carried")))
    fired = s.where(F.col("active") & (F.col("_t") - F.col("_since._t") >= hold))
    return fired.select("alertname", "severity", "type", "ts", "series", "value", F.col("_since.ts").alias("active_since"))


def alert_inhibit(firing: DataFrame) -> DataFrame:
    """Drop warnings muted by a critical alert of the same name at the same evaluation time."""
    crit = firing.where(F.col("severity") == "critical").select("alertname", "ts").distinct()
    warn = firing.where(F.col("severity") == "warning").join(crit, ["alertname", "ts"], "left_anti")
    return firing.where(F.col("severity") != "warning").unionByName(warn)


def alert_group(firing: DataFrame) -> DataFrame:
    """Notification groups by (alertname, severity, type): counts and first/last time."""
    return firing.groupBy("alertname", "severity", "type").agg(
        F.count("*").alias("alerts"), F.count_distinct("series").alias("series"),
        F.min("active_since").alias("first_active"), F.max("ts").alias("last_seen"))


def absent_series(samples: DataFrame, expected: DataFrame, at: str, lookback_seconds: int = 300) -> DataFrame:
    """Expected series without a sample in the lookback before ``at``, or whose newest sample there is zero
    (``x == 0 or absent(x)``). Matched by metric and series where ``expected`` names the metric."""
    t, key = F.lit(at).cast("timestamp"), [c for c in ("metric", "series") if c in expected.columns]
    own = F.col("ts").cast("timestamp")
    recent = samples.where((own <= t) & (own > t - F.make_interval(secs=F.lit(lookback_seconds))))
    now = recent.groupBy(*key).agg(F.max_by("value", "ts").alias("value"))
    j = expected.join(now, key, "left")
    return j.where(F.col("value").isNull() | (F.col("value") == 0)).select(
        *key, F.when(F.col("value").isNull(), "absent").otherwise("zero").alias("reason"))


def prediction_counters(log: DataFrame, probability: str = "probability", endpoint: str = "endpoint") -> DataFrame:
    """Per endpoint: predictions, class counts at 0.5, low-confidence (< 0.60) count."""
    p = F.least(F.greatest(F.col(probability).cast("double"), F.lit(0.0)), F.lit(1.0))
    conf = F.greatest(p, F.lit(1.0) - p)
    return log.groupBy(endpoint).agg(
        F.count("*").alias("predictions"),
        F.count_if(p >= C.POSITIVE_CUT).alias("class_1"),
        F.count_if(p < C.POSITIVE_CUT).alias("class_0"),
        F.count_if(conf < C.LOW_CONFIDENCE_PROB_THRESHOLD).alias("low_confidence"),
    )

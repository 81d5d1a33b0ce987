"""Data-quality and model-quality statistics of a current sample against a reference.

Each statistic is one aggregate (or an anti-join for unseen categories); reference
bounds are one aggregate row used as literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwatch import config as C
from churnwatch.functions.scalar import nan_to_null
from churnwatch.session import cut_lineage


# ---------------------------------------------------------------------------
# model quality on a scoring log
# ---------------------------------------------------------------------------
def prediction_stats(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """count, mean, population std, share >= 0.5, share with confidence < 0.60 of the
    clipped probabilities (non-numeric / NULL dropped); zeros when nothing is left."""
    x = F.col(prediction).cast("double")
    p = F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    kept = df.where(x.isNotNull() & ~F.isnan(x)).select(p.alias("p"))
    conf = F.greatest(F.col("p"), F.lit(1.0) - F.col("p"))
    z = F.lit(0.0)
    return kept.agg(
        F.count("*").cast("double").alias("prediction_count"),
        F.coalesce(F.avg("p"), z).alias("prediction_mean"),
        F.coalesce(F.stddev_pop("p"), z).alias("prediction_std"),
        F.coalesce(F.avg((F.col("p") >= C.POSITIVE_CUT).cast("double")), z).alias("prediction_positive_rate"),
        F.coalesce(F.avg((conf < C.LOW_CONFIDENCE_PROB_THRESHOLD).cast("double")), z).alias("low_confidence_fraction"),
    )


def batch_summary(df: DataFrame, probability: str = "churn_probability",
                  threshold: float = C.SELECTED_THRESHOLD) -> DataFrame:
    """rows, predicted churn rate at the model threshold, mean probability."""
    return df.agg(
        F.count("*").alias("rows"),
        F.avg((F.col(probability) >= threshold).cast("double")).alias("churn_rate"),
        F.avg(F.col(probability).cast("double")).alias("mean_probability"),
    )


def cumulative_histogram(df: DataFrame, col: str, bounds: list[float], group: list[str] | None = None) -> DataFrame:
    """(group..., le, cumulative, count) with an implicit +Inf bucket; one aggregate pass,
    then differences along the (bounded) bucket list."""
    group = group or []
    les = [float(b) for b in bounds] + [float("inf")]
    x = F.col(col)
    aggs = [F.count_if(x <= F.lit(le)).alias(f"b{i}") for i, le in enumerate(les)]
    wide = df.groupBy(*group).agg(*aggs)
    args = [v for i, le in enumerate(les) for v in (F.lit(le), F.col(f"b{i}"))]
    long = wide.select(*group, F.stack(F.lit(len(les)), *args).alias("le", "cumulative"))
    w = Window.partitionBy(*group).orderBy("le") if group else Window.orderBy("le")
    return long.select(
        *group, "le", "cumulative", (F.col("cumulative") - F.coalesce(F.lag("cumulative").over(w), F.lit(0))).alias("count")
    )


# ---------------------------------------------------------------------------
# data quality
# ---------------------------------------------------------------------------
def dq_roles(reference: DataFrame, current: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """(common, categorical, numeric): categorical = text/bool in the reference; numeric =
    numeric on both sides (booleans count as both, as in the original)."""
    common = sorted(set(reference.columns) & set(current.columns))
    rt = {f.name: f.dataType for f in reference.schema.fields}
    ct = {f.name: f.dataType for f in current.schema.fields}
    num_like = (T.NumericType, T.BooleanType)
    categorical = [c for c in common if isinstance(rt[c], (T.StringType, T.BooleanType))]
    numeric = [c for c in common if isinstance(rt[c], num_like) and isinstance(ct[c], num_like)]
    return common, categorical, numeric


def dq_missing_ratio(current: DataFrame, common: list[str]) -> DataFrame:
    """nulls / (rows x common columns); 0 when there are no cells."""
    if not common:
        return current.agg(F.lit(0.0).alias("missing_ratio"))
    nulls = sum((F.count_if(_missing(current, c)) for c in common), F.lit(0))
    cells = F.count("*") * F.lit(len(common))
    return current.agg(F.coalesce(F.try_divide(nulls.cast("double"), cells), F.lit(0.0)).alias("missing_ratio"))


def _missing(df: DataFrame, c: str) -> Column:
    m = F.col(c).isNull()
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        m = m | F.isnan(F.col(c))
    return m


def dq_schema_violation(current: DataFrame, required: list[str]) -> float:
    if not required:
        return 0.0
    return len([c for c in required if c not in current.columns]) / len(required)


def _melt_text(df: DataFrame, cols: list[str]) -> DataFrame:
    args = [v for c in cols for v in (F.lit(c), F.col(c).cast("string"))]
    return df.select(F.stack(F.lit(len(cols)), *args).alias("feature", "value")).where(F.col("value").isNotNull())


def unseen_values(reference: DataFrame, current: DataFrame, categorical: list[str]) -> DataFrame:
    """(feature, value, n): current non-null values that the reference never has, with their counts.

    Values are counted before the anti-join, so one held by a third of the rows is one row in it."""
    seen = _melt_text(reference, categorical).distinct()
    counts = _melt_text(current, categorical).groupBy("feature", "value").agg(F.count("*").alias("n"))
    return counts.join(seen, ["feature", "value"], "left_anti")


def dq_unseen_ratio(reference: DataFrame, current: DataFrame, categorical: list[str]) -> DataFrame:
    """Mean over categorical columns of the share of current non-null values never seen in
    the reference; columns with no current values are skipped; 0 when none remain."""
    if not categorical:
        return current.agg(F.lit(0.0).alias("unseen_category_ratio"))
    unseen = unseen_values(reference, current, categorical).groupBy("feature").agg(F.sum("n").alias("u"))
    tot = _melt_text(current, categorical).groupBy("feature").agg(F.count("*").alias("n"))
    per = tot.join(unseen, "feature", "left").select(
        (F.coalesce(F.col("u"), F.lit(0)) / F.col("n")).alias("r")  # tot has one row per feature, n > 0
    )
    return per.agg(F.coalesce(F.avg("r"), F.lit(0.0)).alias("unseen_category_ratio"))


def dq_out_of_range(reference: DataFrame, current: DataFrame, numeric: list[str]) -> DataFrame:
    """Mean over numeric columns of the share of current values outside the reference
    [min, max]; columns empty on either side are skipped; 0 when none remain."""
    if not numeric:
        return current.agg(F.lit(0.0).alias("out_of_range_ratio"))
    values = {c: nan_to_null(F.col(c).cast("double")) for c in numeric}  # NaN is no bound
    b = reference.agg(*[F.min(values[c]).alias(f"lo_{c}") for c in numeric],
                      *[F.max(values[c]).alias(f"hi_{c}") for c in numeric]).collect()[0]
    ratios = []
    for c in numeric:
        lo, hi = b[f"lo_{c}"], b[f"hi_{c}"]
        if lo is None:
            continue
        x = F.col(c).cast("double")
        ok = x.isNotNull() & ~F.isnan(x)
        out = F.count_if(ok & ((x < F.lit(lo)) | (x > F.lit(hi))))
        ratios.append((F.when(F.count_if(ok) > 0, out / F.count_if(ok)), F.count_if(ok) > 0))
    if not ratios:
        return current.agg(F.lit(0.0).alias("out_of_range_ratio"))
    total = sum((F.coalesce(r, F.lit(0.0)) for r, _ in ratios), F.lit(0.0))
    kept = sum((k.cast("int") for _, k in ratios), F.lit(0))
    return current.agg(F.coalesce(F.try_divide(total, kept.cast("double")), F.lit(0.0)).alias("out_of_range_ratio"))


def dq_report(reference: DataFrame, current: DataFrame, required: list[str] = C.DRIFT_REQUIRED_COLUMNS) -> DataFrame:
    """One row: missing_ratio, schema_violation_fraction, unseen_category_ratio, out_of_range_ratio."""
    common, categorical, numeric = dq_roles(reference, current)
    parts = [
        dq_missing_ratio(current, common),
        dq_unseen_ratio(reference, current, categorical),
        dq_out_of_range(reference, current, numeric),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row x one row
    return out.select(
        "missing_ratio",
        F.lit(float(dq_schema_violation(current, required))).alias("schema_violation_fraction"),
        "unseen_category_ratio",
        "out_of_range_ratio",
    )


def condensed_reference(reference: DataFrame) -> DataFrame:
    """All that ``dq_report`` reads of a reference, in few rows: every category once, and the least and largest numbers."""
    _, categorical, numeric = dq_roles(reference, reference)
    out = reference.where(F.lit(False))
    for c in categorical:
        out = out.unionByName(reference.select(c).distinct(), allowMissingColumns=True)
    if numeric:
        types = {f.name: f.dataType for f in reference.schema.fields}
        kept = {c: nan_to_null(F.col(c)) if isinstance(types[c], (T.DoubleType, T.FloatType)) else F.col(c) for c in numeric}
        for bound in (F.min, F.max):
            out = out.unionByName(reference.agg(*[bound(kept[c]).cast(types[c]).alias(c) for c in numeric]), allowMissingColumns=True)
    return out


# ---------------------------------------------------------------------------
# log freshness and windows
# ---------------------------------------------------------------------------
def freshness_lag(df: DataFrame, ts_col: str, now: str) -> DataFrame:
    """Seconds from the latest parseable timestamp to ``now`` (floor 0; 0 when none)."""
    ts = F.col(ts_col)
    if isinstance(df.schema[ts_col].dataType, T.StringType):
        ts = F.try_to_timestamp(ts)
    latest = df.agg(F.max(ts.cast("timestamp")).alias("latest"))
    now_c = F.lit(now).cast("timestamp")
    lag = (F.unix_micros(now_c) - F.unix_micros(F.col("latest"))) / F.lit(1e6)
    return latest.select(F.coalesce(F.greatest(lag, F.lit(0.0)), F.lit(0.0)).alias("freshness_lag_seconds"))


def latest_window(df: DataFrame, n: int = C.CURRENT_WINDOW_SIZE, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """The last ``n`` rows by (ts, id) - a top-k (TakeOrderedAndProject); n <= 0 keeps all."""
    if n <= 0:
        return df
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def due_tiers(now_s: float, last: dict, rows: int, last_rows: int) -> dict[str, bool]:
    """Which refresh tiers are due (pure function of times and row counts)."""
    fast = now_s - last.get("fast", float("-inf")) >= C.FAST_REFRESH_SECONDS
    medium = now_s - last.get("medium", float("-inf")) >= C.MEDIUM_REFRESH_SECONDS
    since = now_s - last.get("drift", float("-inf"))
    new_rows = rows - last_rows
    drift = (new_rows >= C.MIN_NEW_ROWS and since >= C.FAST_DRIFT_SECONDS) or since >= C.SLOW_DRIFT_SECONDS
    return {"fast": fast, "medium": medium, "drift": drift}


def dq_report_labelled(df: DataFrame, numeric: list[str], categorical: list[str], side_col: str = "is_ref",
                       required: list[str] | None = None) -> DataFrame:
    """The four data-quality ratios from one frame holding both samples: one scan, one shuffle, no join of one-row results.

    Rows are counted by feature and value, missing ones included; what is missing, unseen or out of range then follows per
    feature from the counts, and the ratios from the features (one row each). Columns: missing_ratio, schema_violation_fraction,
    unseen_category_ratio, out_of_range_ratio."""
    cols = numeric + categorical
    required = cols if required is None else required
    schema = len([c for c in required if c not in df.columns]) / len(required) if required else 0.0
    zero = F.lit(0.0)
    if not cols:
        return df.limit(0).agg(zero.alias("missing_ratio"), F.lit(float(schema)).alias("schema_violation_fraction"),
                               zero.alias("unseen_category_ratio"), zero.alias("out_of_range_ratio"))
    args = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double") if i < len(numeric) else F.lit(None).cast("double")
        args += [F.lit(i), _missing(df, c), F.when(~F.isnan(x), x), F.col(c).cast("string") if i >= len(numeric) else F.lit(None).cast("string")]
    long = df.select(F.col(side_col).cast("boolean").alias("ref"), F.stack(F.lit(len(cols)), *args).alias("fid", "gone", "num", "text"))
    counts = cut_lineage(long.groupBy("fid", "gone", "num", "text").agg(F.count_if("ref").alias("n_ref"), F.count_if(~F.col("ref")).alias("n_cur")), "dq-counts")
    is_text = F.col("fid") >= len(numeric)
    bounds = counts.where(F.col("n_ref") > 0).groupBy("fid").agg(F.min("num").alias("lo"), F.max("num").alias("hi"))
    n = F.col("n_cur")
    valued = F.when(is_text, F.col("text").isNotNull()).otherwise(F.col("num").isNotNull())
    odd = F.when(is_text, F.col("text").isNotNull() & (F.col("n_ref") == 0)).otherwise((F.col("num") < F.col("lo")) | (F.col("num") > F.col("hi")))
    # one row per feature: bounded broadcast
    per = counts.join(F.broadcast(bounds), "fid", "left").groupBy("fid").agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("gone"), n).otherwise(0)).alias("gone"), F.sum(F.when(valued, n).otherwise(0)).alias("values"),
        F.sum(F.when(odd, n).otherwise(0)).alias("odd"), F.max("lo").alias("lo"),
    )
    share = F.when((F.col("values") > 0) & (is_text | F.col("lo").isNotNull()), F.col("odd") / F.col("values"))
    return per.agg(
        F.coalesce(F.try_divide(F.sum("gone").cast("double"), F.sum("n")), zero).alias("missing_ratio"),
        F.lit(float(schema)).alias("schema_violation_fraction"),
        F.coalesce(F.avg(F.when(is_text, share)), zero).alias("unseen_category_ratio"),
        F.coalesce(F.avg(F.when(~is_text, share)), zero).alias("out_of_range_ratio"),
    )

"""Paired-counts table: both samples of every feature in one long aggregate.

``paired_counts`` melts the reference and current rows of all features with one
``stack`` and collapses them with one ``groupBy(kind, feature, value)``, so each
side is scanned once and map-side partial aggregation shrinks low-cardinality and
hot values before the shuffle. Every distribution statistic (KS, PSI edges and
bins, JS, chi-square, ranges, unseen shares) is computed from this table.

``with_cumulative`` adds running counts per feature ordered by value. Distinct values are
range-partitioned on (feature, value) by sampled bounds and written once together with
their partition number; running sums stay inside a partition, and the offsets of the partitions
(features x partitions rows) come from their totals. Skew in the values moves the bounds, not the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwatch.config import NULL_CATEGORY
from churnwatch.session import cut_lineage

SIDE = "is_ref"


def melt_features(df: DataFrame, numeric: list[str], categorical: list[str], side_col: str = SIDE) -> DataFrame:
    """(is_ref, fid, num_value, cat_value): one row per input row and feature.

    ``fid`` indexes ``numeric + categorical`` (an int key hashes cheaper than names).
    Numeric values are doubles with NaN and NULL dropped; categorical values are text
    with NULL kept as the ``<NA>`` category.
    """
    args: list[Column] = []
    for i, name in enumerate(numeric):
        x = F.col(name).cast("double")
        args += [F.lit(i), F.when(~F.isnan(x), x), F.lit(None).cast("string")]
    for j, name in enumerate(categorical):
        args += [F.lit(len(numeric) + j), F.lit(None).cast("double"),
                 F.coalesce(F.col(name).cast("string"), F.lit(NULL_CATEGORY))]
    n = len(numeric) + len(categorical)
    long = df.select(
        F.col(side_col).cast("boolean").alias(SIDE),
        F.stack(F.lit(n), *args).alias("fid", "num_value", "cat_value"),
    )
    return long.where((F.col("fid") >= len(numeric)) | F.col("num_value").isNotNull())


def paired_counts(df: DataFrame, numeric: list[str], categorical: list[str], side_col: str = SIDE) -> DataFrame:
    """(kind, feature, num_value, cat_value, n_ref, n_cur) - one row per distinct value."""
    long = melt_features(df, numeric, categorical, side_col)
    agg = long.groupBy("fid", "num_value", "cat_value").agg(
        F.count_if(F.col(SIDE)).alias("n_ref"),
        F.count_if(~F.col(SIDE)).alias("n_cur"),
    )
    names = F.array(*[F.lit(c) for c in numeric + categorical])
    return agg.select(
        F.when(F.col("fid") < len(numeric), F.lit("numeric")).otherwise(F.lit("categorical")).alias("kind"),
        F.element_at(names, F.col("fid") + 1).alias("feature"),
        "num_value", "cat_value", "n_ref", "n_cur",
    )


def numeric_counts(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("kind") == "numeric").select(
        "feature", F.col("num_value").alias("value"), "n_ref", "n_cur"
    )


def categorical_counts(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("kind") == "categorical").select(
        "feature", F.col("cat_value").alias("value"), "n_ref", "n_cur"
    )


def feature_totals(num_counts: DataFrame) -> dict[str, dict]:
    """Per numeric feature: n_ref, n_cur, lo, hi. One row per feature, collected as a
    fitted parameter (size bounded by the feature list, not by the data)."""
    rows = num_counts.groupBy("feature").agg(
        F.sum("n_ref").alias("n_ref"),
        F.sum("n_cur").alias("n_cur"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.count("*").alias("n_values"),
    ).collect()
    return {r["feature"]: r.asDict() for r in rows}


def with_cumulative(num_counts: DataFrame, keep_part: bool = False) -> DataFrame:
    """Adds cum_ref / cum_cur (inclusive running counts by value) and the feature totals;
    with ``keep_part`` also the number of the value range that each row lies in.

    Exact for any partitioning. Range bounds are sampled, so the dealt rows are written
    before anything reads their partition number. A value shared by many rows is already
    one row here, so neither a hot value nor an outlier overloads a task.
    """
    placed = cut_lineage(
        num_counts.select("feature", "value", "n_ref", "n_cur").repartitionByRange("feature", "value")
        .withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    sums = placed.groupBy("feature", "part").agg(F.sum("n_ref").alias("b_ref"), F.sum("n_cur").alias("b_cur"))
    feature = Window.partitionBy("feature")
    before = feature.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "feature", "part",
        F.coalesce(F.sum("b_ref").over(before), F.lit(0)).alias("off_ref"),
        F.coalesce(F.sum("b_cur").over(before), F.lit(0)).alias("off_cur"),
        F.sum("b_ref").over(feature).alias("n_ref_total"),
        F.sum("b_cur").over(feature).alias("n_cur_total"),
    )
    running = Window.partitionBy("feature", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(offsets, ["feature", "part"]).select(
        "feature", "value", "n_ref", "n_cur", "n_ref_total", "n_cur_total",
        (F.col("off_ref") + F.sum("n_ref").over(running)).alias("cum_ref"),
        (F.col("off_cur") + F.sum("n_cur").over(running)).alias("cum_cur"),
        *([F.col("part")] if keep_part else []),
    )


def empirical_cdf(num_counts: DataFrame) -> DataFrame:
    """(feature, value, cdf_ref, cdf_cur): share of each sample <= value, at every sample point."""
    cum = with_cumulative(num_counts)
    return cum.select(
        "feature",
        "value",
        F.try_divide(F.col("cum_ref").cast("double"), F.col("n_ref_total")).alias("cdf_ref"),
        F.try_divide(F.col("cum_cur").cast("double"), F.col("n_cur_total")).alias("cdf_cur"),
    )

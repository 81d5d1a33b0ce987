"""Exploratory profiles as aggregates: one pass per table where possible, results in
long form so they stay tables rather than driver-side dicts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwatch.functions.scalar import nan_to_null
from churnwatch.session import cut_lineage
from churnwatch.operators import quantiles as Q
from churnwatch.operators.clean import null_counts


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls, rate) for every column, highest rate first."""
    rows = df.agg(F.count("*").alias("n"))
    nc = null_counts(df, only_positive=False)
    return nc.crossJoin(rows).select(  # one-row total
        "column", "nulls", F.coalesce(F.try_divide(F.col("nulls").cast("double"), F.col("n")), F.lit(0.0)).alias("rate")
    ).orderBy(F.desc("rate"), "column")


def dtype_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) - the schema with non-null counts from one aggregate."""
    agg = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    args = [x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()), F.col(f.name))]
    return agg.select(F.stack(F.lit(len(df.columns)), *args).alias("column", "dtype", "non_null"))


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max): sample std, exact linear quartiles."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    x = {c: nan_to_null(F.col(c).cast("double")) for c in columns}  # NaN is missing
    stats = df.agg(*[e for c in columns for e in (
        F.count(x[c]).alias(f"n_{c}"), F.avg(x[c]).alias(f"m_{c}"), F.stddev_samp(x[c]).alias(f"s_{c}"),
        F.min(x[c]).alias(f"lo_{c}"), F.max(x[c]).alias(f"hi_{c}"))])
    qs = Q.exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    args = []
    for c in columns:
        q25, q50, q75 = qs[c]
        args += [F.lit(c), F.col(f"n_{c}"), F.col(f"m_{c}"), F.col(f"s_{c}"), F.col(f"lo_{c}"),
                 F.lit(q25).cast("double"), F.lit(q50).cast("double"), F.lit(q75).cast("double"), F.col(f"hi_{c}")]
    return stats.select(F.stack(F.lit(len(columns)), *args).alias(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"))


def value_frequency(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, n, share) per column, share of non-null rows; by feature, most frequent first, ties by value.

    The rows are counted once; totals are sums of the counts, which are written for the two readers."""
    args = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    long = df.select(F.stack(F.lit(len(columns)), *args).alias("feature", "value")).where(F.col("value").isNotNull())
    counts = cut_lineage(long.groupBy("feature", "value").agg(F.count("*").alias("n")), "frequencies")
    # one row per column: bounded broadcast, no per-feature window over all distinct values
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), "feature").select(
        "feature", "value", "n", (F.col("n") / F.col("total")).alias("share"))
    return shares.orderBy("feature", F.desc("n"), "value")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share, min_class, neg_pos_ratio) with NULL as its own class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    w = Window.partitionBy()  # over the class table: one row per class
    neg = F.sum(F.when(F.col("label") == 0, F.col("n"))).over(w)
    pos = F.sum(F.when(F.col("label") == 1, F.col("n"))).over(w)
    return counts.select(
        "label", "n", (F.col("n") / F.sum("n").over(w)).alias("share"), F.min("n").over(w).alias("min_class"),
        F.try_divide(neg.cast("double"), pos).alias("neg_pos_ratio"),
    )


def group_means(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    return df.groupBy(by).agg(*[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in columns])


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r): Pearson correlation of every pair in one aggregate pass (diagonal = 1)."""
    pairs = list(combinations(columns, 2))
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    args = []
    for i, (a, b) in enumerate(pairs):
        args += [F.lit(a), F.lit(b), F.col(f"c{i}"), F.lit(b), F.lit(a), F.col(f"c{i}")]
    for c in columns:
        args += [F.lit(c), F.lit(c), F.lit(1.0)]
    n = 2 * len(pairs) + len(columns)
    return agg.select(F.stack(F.lit(n), *args).alias("a", "b", "r"))


def crosstab_rates(df: DataFrame, category: str, label: str) -> DataFrame:
    """(category, label, n, rate): counts of category x label, normalised per category row."""
    counts = df.groupBy(F.col(category).alias("category"), F.col(label).alias("label")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("category")  # over the labels of one category
    return counts.select("category", "label", "n", (F.col("n") / F.sum("n").over(w)).alias("rate"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """(bin, lo, hi, n): equal-width bins over [min, max], last bin closed (NumPy rule)."""
    x = nan_to_null(F.col(col).cast("double"))
    b = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).collect()[0]
    lo, hi = b["lo"], b["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    idx = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count("*").alias("n"))
    return counts.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                         (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "n")

"""Exact quantiles by rank selection.

Values are counted per (group, value), running counts come from the range-partitioned
prefix sums of ``operators.counts``, and only the rows holding the wanted sorted positions
are read back (at most groups x positions rows). No group is sorted in one task and
no per-group value map is held in memory, unlike the ``percentile`` aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwatch.operators import counts as K
from churnwatch.session import cut_lineage


def quantile_positions(n: int, probs: list[float]) -> list[tuple[int, int, float]]:
    """(lower position, upper position, weight) per probability in a sorted sample of n
    (NumPy linear method: virtual index (n - 1) * q)."""
    out = []
    for q in probs:
        vi = (n - 1) * q
        if vi >= n - 1:
            out.append((n - 1, n - 1, 0.0))
        else:
            lo = math.floor(vi)
            out.append((lo, lo + 1, vi - lo))
    return out


def np_lerp(a: float, b: float, t: float) -> float:
    d = b - a
    return b - d * (1.0 - t) if t >= 0.5 else a + d * t


def values_at_positions(cum: DataFrame, wanted: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """Reference-side value at each wanted 0-based sorted position of each feature.

    One filter pass over the cumulative table with a plain (codegen) predicate: a row is
    kept when its run of positions [cum_ref - n_ref, cum_ref) holds a wanted position.
    At most features x positions rows come back; positions are matched on the driver."""
    if not wanted:
        return {}
    start, end = F.col("cum_ref") - F.col("n_ref"), F.col("cum_ref")
    cond = None
    for f, ps in wanted.items():
        inner = None
        for p in ps:
            hit = (start <= F.lit(int(p))) & (end > F.lit(int(p)))
            inner = hit if inner is None else inner | hit
        c = (F.col("feature") == F.lit(f)) & inner
        cond = c if cond is None else cond | c
    rows = cum.where((F.col("n_ref") > 0) & cond).select(
        "feature", "value", start.alias("s"), end.alias("e")).collect()
    out = {}
    for r in rows:
        for p in wanted[r["feature"]]:
            if r["s"] <= p < r["e"]:
                out[(r["feature"], int(p))] = r["value"]
    return out


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value) for the given numeric columns, NULL and NaN dropped."""
    args = []
    for c in columns:
        x = F.col(c).cast("double")
        args += [F.lit(c), F.when(~F.isnan(x), x)]
    long = df.select(F.stack(F.lit(len(columns)), *args).alias("feature", "value"))
    return long.where(F.col("value").isNotNull())


def _cumulative(long: DataFrame) -> tuple[DataFrame, dict[str, dict]]:
    counts = long.groupBy("feature", "value").agg(F.count("*").alias("n_ref")).withColumn(
        "n_cur", F.lit(0).cast("bigint")
    )
    counts = cut_lineage(counts, "value-counts")
    return K.with_cumulative(counts), K.feature_totals(counts)


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list]:
    """Per column, the linear-interpolated quantiles (NumPy rules); None when no values."""
    if not columns:
        return {}
    cum, totals = _cumulative(long_values(df, columns))
    plan = {c: quantile_positions(int(totals[c]["n_ref"]), probs) for c in columns if c in totals}
    vals = values_at_positions(cum, {c: sorted({p for lo, hi, _ in ps for p in (lo, hi)}) for c, ps in plan.items()})
    return {
        c: ([np_lerp(vals[(c, lo)], vals[(c, hi)], g) for lo, hi, g in plan[c]] if c in plan else [None] * len(probs))
        for c in columns
    }


def grouped_quantiles(long: DataFrame, probs: list[float], least: int = 1) -> dict[str, list[float]]:
    """Per feature of ``feature, value`` with ``least`` values or more, the linear-interpolated quantiles."""
    cum, totals = _cumulative(long)
    plan = {f: quantile_positions(int(t["n_ref"]), probs) for f, t in totals.items() if t["n_ref"] >= least}
    vals = values_at_positions(cum, {f: sorted({p for lo, hi, _ in ps for p in (lo, hi)}) for f, ps in plan.items()})
    return {f: [np_lerp(vals[(f, lo)], vals[(f, hi)], g) for lo, hi, g in ps] for f, ps in plan.items()}


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Per column, the median as the mean of the two middle values for even counts."""
    if not columns:
        return {}
    cum, totals = _cumulative(long_values(df, columns))
    want = {}
    for c in columns:
        if c in totals:
            n = int(totals[c]["n_ref"])
            want[c] = [n // 2] if n % 2 else [n // 2 - 1, n // 2]
    vals = values_at_positions(cum, want)
    out = {}
    for c in columns:
        if c not in want:
            out[c] = None
        elif len(want[c]) == 1:
            out[c] = vals[(c, want[c][0])]
        else:
            out[c] = (vals[(c, want[c][0])] + vals[(c, want[c][1])]) / 2
    return out

"""Evaluation grid: every expected series at every evaluation step, with staleness.

A series has a value at step ``s`` if its newest sample at or before ``s`` is younger than
the lookback. Samples are first thinned to the newest one per series and step, then each is handed to the
steps that it may serve (at most lookback / step + 1 of them), and the newest wins: two grouped
maxima with map-side combine, no window over a series and no join on a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SERIES = ("metric", "series")


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def at_steps(samples: DataFrame, start: str, end: str, step_seconds: int, lookback_seconds: int, keys: tuple[str, ...] = SERIES) -> DataFrame:
    """(keys, step, value, sampled_at): the newest sample in (s - lookback, s] at every step that has one.

    Steps are ``start + step * step_seconds`` up to ``end``, both included. Ties in time go to the larger
    value (NaN above all); samples without a value or time are not seen.
    """
    step, look = step_seconds * 1_000_000, lookback_seconds * 1_000_000
    origin = _micros(F.lit(start))
    last = F.floor((_micros(F.lit(end)) - origin) / F.lit(step))
    t = _micros(F.col("ts"))
    seen = samples.where(F.col("value").isNotNull() & F.col("ts").isNotNull()).select(*keys, F.struct(t.alias("t"), F.col("value").alias("value")).alias("s"))
    first = F.greatest(F.ceil((F.col("s.t") - origin) / F.lit(step)), F.lit(0))
    newest = seen.groupBy(*keys, first.alias("first")).agg(F.max("s").alias("s"))
    # the sample is too old at the first step that lies a whole lookback after it
    until = F.least(F.floor((F.col("s.t") + F.lit(look - 1) - origin) / F.lit(step)), last)
    served = newest.where(until >= F.col("first")).select(*keys, F.explode(F.sequence(F.col("first"), until)).alias("step"), "s")
    return served.groupBy(*keys, "step").agg(F.max("s").alias("s")).select(
        *keys, "step", F.col("s.value").alias("value"), F.timestamp_micros("s.t").alias("sampled_at")
    )


def evaluation_grid(
    samples: DataFrame, expected: DataFrame, start: str, end: str, step_seconds: int, lookback_seconds: int, keys: tuple[str, ...] = SERIES,
) -> DataFrame:
    """(ts, keys, value, state) for every expected series and step; state is present, zero or absent.

    ``expected`` lists the series (repeats count once). Series that are not expected are left out; an
    expected series without any sample is absent at every step.
    """
    step = step_seconds * 1_000_000
    origin = _micros(F.lit(start))
    last = F.floor((_micros(F.lit(end)) - origin) / F.lit(step))
    steps = expected.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("step"))
    found = steps.join(at_steps(samples, start, end, step_seconds, lookback_seconds, keys), [*keys, "step"], "left")
    state = F.when(F.col("value").isNull(), "absent").when(F.col("value") == 0, "zero").otherwise("present")
    at = F.timestamp_micros(origin + F.col("step") * F.lit(step))
    return found.select(at.cast("timestamp_ntz").alias("ts"), *keys, "value", state.alias("state"))


def or_vector(grid: DataFrame, value: float = 0.0) -> DataFrame:
    """``x or vector(value)``: absent steps get the value; the state tells them apart."""
    return grid.withColumn("value", F.coalesce(F.col("value"), F.lit(float(value))))


def target_down(grid: DataFrame) -> DataFrame:
    """``x == 0 or absent(x)`` at every step: adds ``down`` (1.0 or 0.0), the value a rule compares."""
    return grid.withColumn("down", (F.col("state") != "present").cast("double"))

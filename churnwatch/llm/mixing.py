"""Mixing sources to target weights by entropy balancing.

Every document gets a rate ``min(cap, exp(lambda_source * size / scale_source))``: of all
rates that meet the token targets, those nearest to "take everything once" in relative
entropy under the cap. ``lambda`` solves the convex dual, one token constraint per
source, by safeguarded Newton steps. Each step is one grouped aggregate over the
(source, size) histogram; documents themselves are read once. Rates are then rounded into
whole copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwatch.llm.common import WORD
from churnwatch.session import cut_lineage

ROWS_PER_RANK = 4096  # rows that one ranking group holds on average
HEAVY = 0.01  # share of its source's target above which one document is rounded first


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Token targets per source.

    ``sizes``: ``source``, ``source_size`` (one row per source). Weights repeat over the
    sources by code point, null last. Together the targets are ``share`` of all sizes; a
    target stops at ``cap`` times its source and the excess is shared anew by weight. The
    common level is found in closed form: sources in the order in which they reach their
    cap, with running sums. One row per source goes through these windows, never documents.
    Returns ``source, source_size, src (int), target``.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("src", F.row_number().over(order))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("src") - 1) % len(weights) + 1)
    full = F.col("source_size") * F.lit(float(cap))
    by_cap = Window.orderBy(F.col("ratio"), F.col("src"))
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("w", w).withColumn("full", full).withColumn("ratio", F.col("full") / F.col("w"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("w").over(rest))
        .withColumn("fits", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
        .withColumn("level", F.first("fits", ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least(F.col("full"), F.coalesce(F.col("w") * F.col("level"), F.col("full")))
    return levels.select("source", "source_size", "src", target.alias("target"))


def solve_dual(hist: DataFrame, targets: DataFrame, cap: float, rounds: int = 60, tolerance: float = 1e-7) -> DataFrame:
    """Newton iterations on the dual, all sources at once.

    ``hist``: ``src, size, n``; ``targets``: ``src, goal``. Returns ``src, lam, scale``;
    ``lam`` is +inf where the goal needs every document at the cap, -inf where it is zero.
    A step outside the bracket known so far is replaced by its midpoint, so the loop also
    settles where the capped objective has corners. Only the largest residual comes to
    the driver.
    """
    stats = hist.where("size > 0").groupBy("src").agg(
        F.sum(F.col("n") * F.col("size")).cast("double").alias("all_words"),
        (F.sum(F.col("n") * F.col("size").cast("double") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).alias("scale"),
    )
    lam = (
        F.when(F.col("goal") >= F.col("all_words") * cap * (1 - 1e-12), F.lit(float("inf")))
        .when(F.col("goal") <= 0, F.lit(float("-inf")))
        .otherwise(F.lit(0.0))
    )
    state = cut_lineage(
        targets.join(stats, "src").select(
            "src", "goal", "scale", lam.alias("lam"),
            F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(False).alias("done"),
        ),
        "mix-state",
    )
    for _ in range(rounds):
        open_ = state.where(F.abs("lam") != float("inf")).where("not done")
        x = F.col("size") / F.col("scale")
        rate = F.exp(F.least(F.col("lam") * x, F.lit(700.0)))
        free = rate < cap
        sums = (
            hist.where("size > 0").join(open_.select("src", "lam", "scale"), "src")
            .groupBy("src").agg(
                F.sum(F.col("n") * F.col("size") * F.least(rate, F.lit(float(cap)))).alias("got"),
                F.sum(F.when(free, F.col("n") * F.col("size") * x * rate).otherwise(0.0)).alias("slope"),
            )
        )
        gap = F.col("got") - F.col("goal")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        reach = 1 + 2 * F.abs("lam")
        newton = F.when(F.col("slope") > 0, F.col("lam") - gap / F.col("slope"))
        bounded = F.greatest(F.least(F.coalesce(newton, F.col("lam") - F.signum(gap) * reach), F.col("lam") + reach), F.col("lam") - reach)
        inside = F.coalesce(bounded > F.col("lo2"), F.lit(True)) & F.coalesce(bounded < F.col("hi2"), F.lit(True))
        middle = (F.col("lo2") + F.col("hi2")) / 2
        moved = F.when(inside, bounded).otherwise(F.coalesce(middle, bounded))
        settled = F.abs(gap) <= F.col("goal") * tolerance
        state = cut_lineage(
            state.join(sums, "src", "left").withColumn("lo2", lo).withColumn("hi2", hi)
            .select(
                "src", "goal", "scale",
                F.when(F.col("got").isNull() | settled, F.col("lam")).otherwise(moved).alias("lam"),
                F.col("lo2").alias("lo"), F.col("hi2").alias("hi"),
                (F.col("got").isNull() | settled).alias("done"),
            ),
            "mix-state",
        )
        if state.where("not done").isEmpty():
            break
    else:
        raise RuntimeError(f"the dual did not settle in {rounds} rounds")
    return state.select("src", "lam", "scale")


def _copies(hist: DataFrame, dual: DataFrame, cap: float) -> DataFrame:
    """Rate of each (source, size) cell and how many copies its ``n`` documents get together.

    Whole parts are taken as they are; fractions are summed over the sizes of a source in
    order and a cell gets the whole numbers its stretch passes, so the counts never drift.
    """
    x = F.col("size") / F.col("scale")
    rate = (
        F.when(F.col("size") == 0, F.lit(1.0))
        .when(F.col("lam") == float("inf"), F.lit(float(cap)))
        .when(F.col("lam") == float("-inf"), F.lit(0.0))
        .otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * x, F.lit(700.0)))))
    )
    upto = Window.partitionBy("src").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = (
        hist.join(dual, "src", "left").withColumn("rate", F.coalesce(rate, F.lit(1.0)))
        .withColumn("base", F.floor("rate").cast("long"))
        .withColumn("part", F.col("n") * (F.col("rate") - F.col("base")))
        .withColumn("end", F.sum("part").over(upto) + 0.5)
    )
    extra = F.floor(F.col("end") + 1e-9) - F.floor(F.col("end") - F.col("part") + 1e-9)
    return cells.select("src", "size", "n", "rate", "base", F.least(extra.cast("long"), F.col("n")).alias("extra"))


def mix_to_targets(
    docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0,
    text: str = "text", source: str = "source", key: str = "doc_id", keep: list[str] | None = None,
) -> DataFrame:
    """Rates and whole copies that bring each source's words near its target.

    Returns the columns ``keep`` (default: the key alone) plus ``size, source_size, target,
    rate, copies, taken``, one row per input row. Documents above ``HEAVY`` of their
    source's target are rounded first and the dual is solved again for the others against
    what is left, so one long document does not spoil the total. Inside a (source, size)
    cell the documents with the smallest hash of key and text get the extra copies; a
    large cell is ranked in groups of about ``ROWS_PER_RANK`` rows, so no cell lands in
    one task. Null text has size 0; a document without words keeps one copy of nothing;
    a null source is a source of its own; repeated rows are ranked like any others and may
    differ by one copy; an empty table gives an empty result; the result is the same on
    every run.
    """
    added = ["size", "source_size", "target", "rate", "copies", "taken"]
    keep = [c for c in ([key] if keep is None else keep) if c not in added]
    staged = cut_lineage(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
            F.col(f"`{source}`").alias("source"),
            word_count(F.col(f"`{text}`")).alias("size"),
            F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("h"),
        ),
        "mix-docs",
    )
    counted = cut_lineage(staged.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-hist")
    targets = cut_lineage(
        source_targets(counted.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, cap),
        "mix-targets",
    )
    hist = cut_lineage(
        counted.join(targets.select(F.col("source").alias("s"), "src", "target"), F.col("source").eqNullSafe(F.col("s")))
        .select("source", "src", "size", "n", (F.col("size") > F.col("target") * HEAVY).alias("heavy")),
        "mix-cells",
    )
    first = solve_dual(hist, targets.select("src", F.col("target").alias("goal")), cap)
    heavy = cut_lineage(_copies(hist.where("heavy"), first, cap), "mix-heavy")
    spent = heavy.groupBy("src").agg(F.sum(F.col("size") * (F.col("n") * F.col("base") + F.col("extra"))).alias("spent"))
    left = targets.join(spent, "src", "left").select("src", (F.col("target") - F.coalesce(F.col("spent"), F.lit(0))).alias("goal"))
    light = hist.where("not heavy")
    cells = cut_lineage(heavy.unionByName(_copies(light, solve_dual(light, left, cap), cap)), "mix-copies")
    full = cells.join(targets, "src").select(F.col("source").alias("s"), F.col("size").alias("z"), "src", "n", "rate", "base", "extra", "source_size", "target")
    dealt = (
        staged.join(full, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
        .withColumn("groups", F.ceil(F.col("n") / ROWS_PER_RANK))
        .withColumn("grp", F.pmod(F.xxhash64("h"), F.col("groups")))
    )
    cell = Window.partitionBy("src", "size", "grp")
    even = F.pmod(F.xxhash64("src", "size", "grp"), F.lit(1 << 20)) / float(1 << 20)
    quota = F.when(F.col("groups") <= 1, F.col("extra")).otherwise(F.floor(F.col("in_group") * F.col("extra") / F.col("n") + even))
    copies = F.col("base") + (F.col("place") <= quota).cast("long")
    return (
        dealt.withColumn("in_group", F.count("*").over(cell))
        .withColumn("place", F.row_number().over(cell.orderBy("h")))
        .withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies")).select("row.*", *added)
    )

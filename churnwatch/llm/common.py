"""Helpers shared by the operators: written cuts, connected components, held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwatch.session import cut_lineage

# ASCII white space as the contracts define it: space and \t to \r
WORD = r"[^\x20\x09-\x0D]+"


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the decimal doc_id leaves 1 modulo 3 (a null id is never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def unused(columns: list[str], *names: str) -> list[str]:
    """The ``names``, with underscores before those that ``columns`` already have in any case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` has it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def components(links: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph.

    ``links`` has two long columns ``a`` and ``b``. Returns ``node``, ``root``: one row per
    node with a link to another node, ``root`` being the smallest node it reaches (which
    itself has no row). Alternates large-star and small-star steps, each a grouped minimum
    (combined before the shuffle) joined back on the node, until the link set stops
    changing; the rounds grow with the logarithm of the longest path. A hub's links are a
    skewed join key, which adaptive execution splits. Every round is written to the shared
    checkpoint folder. Empty links give an empty result.
    """
    edges = cut_lineage(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        f"{name}-links",
    )
    state = None
    for _ in range(max_rounds):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == state:
            break
        state = now
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u")).join(low, "u").where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v"), F.col("m")).where(F.col("v") != F.col("m"))
        edges = cut_lineage(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct(),
            f"{name}-round",
        )
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))

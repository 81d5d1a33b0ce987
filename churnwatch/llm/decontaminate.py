"""Benchmark decontamination by SimHash windows, in DataFrame operations alone.

Every item-sized window of a document is a candidate in which enough places hold a five-word
shingle of the items of that size: the shared weight is at most the number of those
places, in any order, so no window that could pass is left out. Candidates are fingerprinted.
Fingerprints of 64 bits are cut into 8
blocks; two fingerprints within the radius agree in some block up to ``RADIUS // 8`` bits, so
an index of the items' blocks with up to that many bits flipped finds every item within
the radius. Candidates are verified by the exact similarity of their weighted shingles.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwatch.llm.common import bind, unused
from churnwatch.llm.templates import row_key
from churnwatch.session import cut_lineage

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 23, 8  # similarity 0.8 is an expected distance of 13 bits, 3 bits a standard deviation
BROADCAST_SHINGLES = 1_000_000  # more benchmark shingles than these are joined by a shuffle
BROADCAST_KEYS = 2_000_000


def shingles(text: Column) -> Column:
    """Hashes of the word shingles in order: lower-case letters and digits only; a text of fewer words is one shingle."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        each = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - SHINGLE + 1)), lambda i: F.xxhash64(F.array_join(F.slice(w, i, SHINGLE), " ")))
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(each)

    return bind(F.filter(F.split(plain, " "), lambda w: w != ""), of_words)


def fingerprint(rows: DataFrame, by: list[str]) -> DataFrame:
    """``by, fp``: SimHash of the shingles ``h`` with weights ``n``.

    Bits k and k + 32 are counted side by side in the halves of one long, so 32 grouped
    sums do; a bit is set where more than half of the weight has it.
    """
    pair = (1 << 32) | 1
    lanes = [F.sum(F.col("n") * F.shiftrightunsigned("h", k).bitwiseAND(F.lit(pair))).alias(f"l{k}") for k in range(32)]
    sums = rows.groupBy(*by).agg(F.sum("n").alias("all"), *lanes)
    counts = sums.select(*by, "all", F.array(*[f"l{k}" for k in range(32)]).alias("lanes"))
    low = F.transform("lanes", lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)))
    high = F.transform("lanes", lambda x: F.shiftrightunsigned(x, 32))
    bits = F.transform(F.concat(low, high), lambda c, k: F.when(2 * c > F.col("all"), F.expr("1L")).otherwise(F.expr("0L")))
    fp = F.aggregate(F.reverse(bits), F.expr("0L"), lambda acc, bit: F.shiftleft(acc, 1).bitwiseOR(bit))
    return counts.select(*by, fp.alias("fp"))


def block_value(fp: Column, block: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * block).bitwiseAND(F.lit(255)).cast("int")


def block_keys(fp: Column, flips: int) -> Column:
    """Array of block keys, each block with up to ``flips`` of its 8 bits flipped."""
    masks = [sum(1 << b for b in bits) for k in range(flips + 1) for bits in combinations(range(8), k)]
    each = F.array(*[block_value(fp, b).bitwiseOR(F.lit(b << 8)) for b in range(BLOCKS)])
    return F.flatten(F.transform(each, lambda key: F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: key.bitwiseXOR(m))))


def _bounded(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast where the counted rows are few enough; otherwise the planner shuffles."""
    return F.broadcast(df) if rows <= limit else df


def _runs(ats: Column, long: Column, total: Column, similarity: float) -> Column:
    """Array of ``first, last``: disjoint runs of the starts whose windows hold enough of the sorted places ``ats``.

    The fewest places a window needs are ``need``; of ``need`` places in a row, a window holds all if it starts at the
    first or before it and ends behind the last. Starts up to the place before belong to the run before.
    """
    size = F.least(long, total)
    need = F.greatest(F.lit(1), F.floor(similarity * (size + long) / 2.0 + (1 - 1e-9)).cast("int"))

    def run(i: Column) -> Column:
        before = F.when(i > 1, F.get(ats, i - 2)).otherwise(F.lit(-1))
        first = F.greatest(F.lit(0), before + 1, F.get(ats, i + need - 2) - long + 1)
        return F.struct(first.alias("first"), F.least(F.get(ats, i - 1), total - size).alias("last"))

    each = F.when(F.size(ats) >= need, F.transform(F.sequence(F.lit(1), F.size(ats) - need + 1), run))
    return F.filter(each, lambda r: r["first"] <= r["last"])


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``_a, _b, item, similarity``: the documents that hold a window similar to an item.

    Similarity is twice the shared shingle weight over both weights, weights being
    occurrences. Windows are as long as an item and start anywhere in the document (one
    window where the document is shorter), so passages in another order count. Items without
    words, and null items, are in no document; repeated items count once each; a null
    document is empty; equal rows are one document.
    """
    bench = cut_lineage(
        items.select(F.col(f"`{item_key}`").alias("item"), F.monotonically_increasing_id().alias("nth"), shingles(F.col(f"`{item_text}`")).alias("hs")).where(F.size("hs") > 0), "bench"
    )
    placed = cut_lineage(bench.select("item", "nth", F.size("hs").alias("long"), F.posexplode("hs").alias("at", "h")), "bench-shingles")
    weights = cut_lineage(placed.groupBy("nth", "long", "h").agg(F.count("*").alias("n")), "bench-weights")
    anchors = placed.select("h", "long").distinct()
    n_anchors = anchors.count()
    doc = ["_a", "_b"]
    texts = docs.select(*row_key(key, text), F.col(f"`{text}`").alias("_text"))
    spots = texts.select(*doc, shingles(F.col("_text")).alias("hs")).select(*doc, F.posexplode_outer("hs").alias("at", "h"))  # outer: no filter that hashes once more
    hits = cut_lineage(spots.join(_bounded(anchors, n_anchors, BROADCAST_SHINGLES), "h").select(*doc, "long", "at").distinct(), "bench-spots")
    # a window holds no more of an item than all hits of its size; it weighs no less than what it holds
    places = hits.groupBy(*doc, "long").agg(F.sort_array(F.collect_list("at")).alias("ats")).where(2.0 * F.size("ats") / (F.size("ats") + F.col("long")) >= similarity)
    # only documents with enough shared shingles are read again, and each once
    per_doc = places.groupBy(*doc).agg(F.collect_list(F.struct("long", "ats")).alias("places"))
    # a merge join at every size: the hits grow with the documents, so a broadcast of them would not last
    held = texts.join(per_doc.hint("merge"), doc).dropDuplicates(doc).select(*doc, "places", shingles(F.col("_text")).alias("hs"))
    window = [*doc, "start", "long"]
    windows = cut_lineage(
        held.withColumn("p", F.explode("places")).withColumn("run", F.explode(_runs(F.col("p.ats"), F.col("p.long"), F.size("hs"), similarity)))
        .select(*doc, "hs", F.col("p.long").alias("long"), F.explode(F.sequence("run.first", "run.last")).alias("start"))
        .select(*window, F.explode(F.slice("hs", F.col("start") + 1, F.col("long"))).alias("h"))
        .groupBy(*window, "h").agg(F.count("*").alias("n")),
        "bench-windows",
    )
    marked = fingerprint(windows, window)
    index = cut_lineage(
        fingerprint(weights, ["nth", "long"]).select("nth", "long", F.col("fp").alias("item_fp"), F.explode(block_keys(F.col("fp"), RADIUS // BLOCKS)).alias("key")),
        "bench-index",
    )
    probes = marked.select(*window, "fp", F.explode(block_keys(F.col("fp"), 0)).alias("key"))
    near = cut_lineage(
        probes.join(_bounded(index, index.count(), BROADCAST_KEYS), ["long", "key"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS).select(*window, "nth").distinct(),
        "bench-candidates",
    )
    common = near.join(windows.withColumnRenamed("n", "a"), window).join(weights.select("nth", "h", F.col("n").alias("b")), ["nth", "h"])
    both = common.groupBy(*window, "nth").agg(F.sum(F.least("a", "b")).alias("both"))
    sizes = windows.groupBy(*window).agg(F.sum("n").alias("size"))
    alike = both.join(sizes, window).withColumn("similarity", 2.0 * F.col("both") / (F.col("size") + F.col("long")))
    return (
        alike.where(F.col("similarity") >= similarity).join(bench.select("nth", "item"), "nth")
        .groupBy(*doc, "item").agg(F.max("similarity").alias("similarity"))
    )


def flag(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_items``, ``items`` (sorted array) and ``similarity`` (the highest, null without an item).

    Columns named like these three are replaced; an empty table on either side gives no items.
    """
    added = ["n_items", "items", "similarity"]
    found = contaminated(docs, items, key, text, **options).groupBy("_a", "_b").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.max("similarity").alias("similarity")
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    a, b = unused([*docs.columns, *added], "_a", "_b")
    joined = docs.select(*kept, *row_key(key, text, (a, b))).join(cut_lineage(found, "bench-found").toDF(a, b, "items", "similarity"), [a, b], "left")
    return joined.select(*kept, F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.array()).alias("items"), "similarity")

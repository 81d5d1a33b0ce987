"""SimHash near-duplicates with pigeonring filtering.

Fingerprints of 64 bits are cut into 8 segments on a ring. If two of them differ in at
most 4 bits, there is a segment from which every chain of consecutive segments stays
within its share of the budget: 0 differing bits in the first, at most 1 in the first two
and three, 2 in four and five, 3 in six and seven, 4 in all eight. The first three
segments of such a chain (24 bits, the first 8 equal, at most one of the other 16 off) are
the candidate key; the rest of the chain is tested before the full distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwatch.llm.common import components, unused
from churnwatch.llm.templates import row_key
from churnwatch.session import cut_lineage, ready_python

SEGMENTS, WIDTH, MAX_BITS = 8, 8, 4
ROWS_AT_ONCE = 100_000  # keyed rows searched at once
KEYED_AT_ONCE = 10_000  # fingerprints that one task turns into keyed rows
CHUNK = 1 << 16  # shingles hashed at once, so a very long text needs bounded memory
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the word shingles of one text (0 without words)."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[s:e], 42) for s, e in zip(starts[at : at + CHUNK], stops[at : at + CHUNK])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", shingle: int = 4) -> DataFrame:
    """``keys, fp``: the fingerprint of every row as a signed long; null text counts as empty."""
    ready_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(len(keys))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], names=[*keys, "fp"])

    schema = "".join(f"`{k}` {docs.schema[k].dataType.simpleString()}, " for k in keys) + "fp long"
    return docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").alias("_text")).mapInArrow(run, schema)


def _turned(fp: Column, start: int) -> Column:
    """The fingerprint with segment ``start`` in its lowest bits."""
    if start == 0:
        return fp
    return F.shiftrightunsigned(fp, start * WIDTH).bitwiseOR(F.shiftleft(fp, 64 - start * WIDTH))


def neighbours_in_order(fps: DataFrame) -> DataFrame:
    """Some of the links, at linear cost: in each of the 8 turned orders, a run of neighbours
    within the distance is linked to its first member. Only a head start for groups with
    many members; :func:`links` finds all that these orders miss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn0, fp0, head = np.empty(0, np.int32), np.empty(0, np.int64), None  # the row before this batch and the first of its run
        for batch in batches:
            turn = np.concatenate((turn0, batch.column(0).to_numpy()))
            fp = np.concatenate((fp0, batch.column(1).to_numpy()))
            if not len(fp):
                continue
            near = np.zeros(len(fp), dtype=bool)
            near[1:] = (np.bitwise_count((fp[1:] ^ fp[:-1]).view(np.uint64)) <= MAX_BITS) & (turn[1:] == turn[:-1])
            first = np.maximum.accumulate(np.where(near, 0, np.arange(len(fp))))
            heads = fp[first]
            if head is not None:
                heads[first == 0] = head
            turn0, fp0, head = turn[-1:], fp[-1:], heads[-1]
            moved = heads != fp
            yield pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(heads[moved])], names=["a", "b"])

    turned = F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), _turned(F.col("fp"), i).alias("at")) for i in range(SEGMENTS)]))
    rows = fps.select(turned.alias("t"), "fp").select("t.turn", "t.at", "fp")
    return rows.repartitionByRange("turn", "at").sortWithinPartitions("turn", "at").select("turn", "fp").mapInArrow(run, "a long, b long")


def _keyed(fps: DataFrame) -> DataFrame:
    """``slot, fp, grp``: 8 chain keys per fingerprint (even slots), and each with one of its last 16 bits flipped (odd)."""
    chains = [_turned(F.col("fp"), i).bitwiseAND(F.lit((1 << 24) - 1)).bitwiseOR(F.lit(i << 24)).cast("int") for i in range(SEGMENTS)]
    flips = [0] + [1 << bit for bit in range(WIDTH, 3 * WIDTH)]
    keyed = fps.select("fp", "grp", F.explode_outer(F.array(*chains)).alias("chain"))
    each = keyed.select("fp", "grp", "chain", F.explode_outer(F.array(*[F.lit(f) for f in flips])).alias("flip"))
    slot = F.shiftleft(F.col("chain").bitwiseXOR(F.col("flip")), 1).bitwiseOR((F.col("flip") != 0).cast("int"))
    return each.select(slot.alias("slot"), "fp", "grp")


def chains_hold(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which differences keep every chain from segment ``start`` within its share, and the distance within the whole."""
    turn = (start * WIDTH).astype(np.uint64)
    x = (x >> turn) | (x << ((np.uint64(64) - turn) & np.uint64(63)))
    ok = np.ones(len(x), dtype=bool)
    for length in range(1, SEGMENTS + 1):
        mask = np.uint64((1 << (WIDTH * length)) - 1)
        ok[ok] = np.bitwise_count(x[ok] & mask) <= length * MAX_BITS // SEGMENTS
    return ok


def _pairs(slot: np.ndarray, fp: np.ndarray, grp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among whole keys, rows being sorted by slot: every chain key of a bucket against all later rows of it.

    A bucket with one group only has nothing open and is left out first.
    """
    key = slot >> 1
    first = np.nonzero(np.concatenate(([True], key[1:] != key[:-1])))[0]
    size = np.diff(np.append(first, len(key)))
    mixed = (np.minimum.reduceat(grp, first) != np.maximum.reduceat(grp, first)) & (slot[first] & 1 == 0)
    keep = np.repeat(mixed, size)
    key, fp, grp, probe = key[keep], fp[keep].view(np.uint64), grp[keep], slot[keep] & 1
    at, found = np.nonzero(probe == 0)[0], []
    step = 1
    while len(at):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        other = at[grp[at] != grp[at + step]]
        good = other[chains_hold(fp[other] ^ fp[other + step], key[other] >> 24)]
        found.append((fp[good].view(np.int64), fp[good + step].view(np.int64)))
        step += 1
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (fp.view(np.int64)[:0],) * 2


def links(fps: DataFrame) -> DataFrame:
    """All links ``a, b`` between fingerprints of different groups ``grp`` within the distance.

    Keyed rows are shuffled once and read in slot order, so a bucket lies together with
    its chain keys first; memory is one batch and one bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []  # rows not yet searched, the last bucket of which may go on

        def search(last: bool) -> pa.RecordBatch:
            rows = [np.concatenate(c) for c in zip(*waiting)]
            whole = len(rows[0]) if last else int(np.searchsorted(rows[0] >> 1, rows[0][-1] >> 1))
            waiting[:] = [[r[whole:] for r in rows]]
            a, b = _pairs(*[r[:whole] for r in rows]) if whole else (rows[1][:0],) * 2
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if batch.num_rows:
                waiting.append([c.to_numpy() for c in batch.columns])
                if sum(len(w[0]) for w in waiting[1:]) >= ROWS_AT_ONCE:
                    yield search(False)
        if waiting:
            yield search(True)

    dealt = fps.repartition(1 + fps.count() // KEYED_AT_ONCE, "fp")
    ordered = _keyed(dealt).repartition(F.shiftright("slot", 1)).sortWithinPartitions("slot")
    return ordered.mapInArrow(run, "a long, b long")


def fingerprint_components(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """``fp, component_id, root``: for every distinct fingerprint the smallest key it reaches, and its component.

    ``rows`` has ``key`` and ``fp``. Equal fingerprints are one class before anything is
    searched, so copies add no pairs.
    """
    ready_python(rows.sparkSession)
    classes = cut_lineage(rows.groupBy("fp").agg(F.min(key).alias("low")), "ring-classes")
    near = components(neighbours_in_order(classes.select("fp")), "ring-near")
    grouped = cut_lineage(
        classes.join(near, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("grp")), "ring-groups"
    )
    found = links(grouped.select("fp", "grp"))
    ends = grouped.select(F.col("fp").alias("b"), F.col("grp").alias("gb"))
    whole = found.join(grouped.select(F.col("fp").alias("a"), F.col("grp").alias("ga")), "a").join(ends, "b").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    roots = components(whole, "ring-whole")
    named = grouped.join(roots, F.col("grp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "grp").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return cut_lineage(named.join(lows, "root").select("fp", "component_id", "root"), "ring-components")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``key, fp, component_id`` for every row.

    Null text is empty; texts without words share fingerprint zero and link like any
    other; a null key never names a component unless all keys of it are null; repeated
    rows share their class; extra columns are not read; an empty table gives no rows.
    """
    rows = cut_lineage(fingerprints(docs, [key], text, shingle), "ring-rows")
    return rows.join(fingerprint_components(rows, key), "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the smallest key (null last).

    Among rows of one key the choice falls by a hash of the text; rows equal in key and
    text, whose other columns may differ, give the smallest row. The choice is a grouped minimum per
    component over hashes; texts meet once, in the join with the chosen rows.
    """
    a, b = unused([*docs.columns, "fp", "root", "component_id", "none", "k"], "_a", "_b")
    named = docs.select("*", *row_key(key, text, (a, b)))
    rows = cut_lineage(fingerprints(named, [a, b, key], text, shingle), "keep-rows")
    found = rows.join(fingerprint_components(rows, key), "fp")
    best = F.min(F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("k"), a, b)).alias("m")
    chosen = cut_lineage(found.groupBy("root").agg(best).select(f"m.{a}", f"m.{b}"), "keep-chosen")
    kept = named.join(chosen, [a, b], "left_semi").groupBy(a, b).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row"))
    return kept.select("row.*")

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from churnwatch.llm import simhash
from churnwatch.llm.common import components
from tests.conftest import SF01


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(fps):
    """fps: list of (id, unsigned); id of the smallest member of each one's component."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    arr = np.array([f for _, f in fps], dtype=np.uint64)
    for i in range(len(fps)):
        for j in np.nonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= 4)[0]:
            parent[find(i)] = find(i + 1 + int(j))
    low = {}
    for i, (k, _) in enumerate(fps):
        low[find(i)] = min(low.get(find(i), k), k)
    return [low[find(i)] for i in range(len(fps))]


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    fps = [(k, brute_fingerprint(t)) for k, t in rows]
    assert {k: f for k, f in fps} == {k: v[0] for k, v in got.items()}
    assert dict(zip([k for k, _ in fps], brute_components(fps))) == {k: v[1] for k, v in got.items()}


def test_planted_distances(spark):
    """Chains, rings round the word edge, and a dense group; every distance 0 to 6."""
    rng, fps = random.Random(7), []
    for c in range(120):
        base = rng.getrandbits(64)
        fps.append(base)
        for d in range(1, 7):
            x = base
            for b in rng.sample(range(64), d):
                x ^= 1 << b
            fps.append(x)
    dense = rng.getrandbits(64)
    fps += [dense ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(200)]
    rows = [(i, f) for i, f in enumerate(fps)]
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in rows], "doc_id long, fp long")
    comp = {r.fp & (1 << 64) - 1: r.component_id for r in simhash.fingerprint_components(df).collect()}
    assert [comp[f] for _, f in rows] == brute_components(rows)


def test_odd_rows(spark):
    rows = [(5, None, 1), (4, "", 1), (3, " \n", 1), (None, "a b c d e", 1), (9, "A b c d e", 1), (9, "a b c d e", 1), (7, "one two", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(((r.doc_id or -1), r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert [g[2] for g in got] == [9, 3, 3, 3, 7, 9, 9]
    assert [g[1] for g in got][1:4] == [0, 0, 0]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    long = "x1 " * 200000
    assert simhash.fingerprint(long) == brute_fingerprint(long)


def test_components_long_path(spark):
    path = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(path.unionByName(spark.createDataFrame([(1000, 1001), (5, 5)], "a long, b long")))
    assert {(r.node, r.root) for r in got.collect()} == {(i, 0) for i in range(1, 301)} | {(1001, 1000)}

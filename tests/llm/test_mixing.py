import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from churnwatch.llm import mixing
from tests.conftest import SF01

SCHEMA = "doc_id long, text string, source string, size string, src int"


def brute_targets(sizes: dict, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if w[s] * level > cap * sizes[s]]
        if not over:
            return out | {s: w[s] * level for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def test_targets_and_totals(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = mixing.mix_to_targets(docs).collect()
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    sizes = defaultdict(int)
    for text, source in texts.values():
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = brute_targets(sizes)
    taken = defaultdict(int)
    assert len(got) == len(texts)
    for r in got:
        text, source = texts[r.doc_id]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
    longest = defaultdict(int)
    for text, source in texts.values():
        longest[source] = max(longest[source], len((text or "").split()))
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(0.03 * target, 0.6 * longest[source])


def test_rates_solve_the_dual(spark):
    """Rates are exp(lambda * size) under the cap, one lambda a source, and meet the token target."""
    rows = [(i, "w " * (1 + i % 40), "a" if i % 3 else "b", "", 0) for i in range(900)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix_to_targets(docs, keep=["doc_id", "source"]).collect()
    import math

    for source in "ab":
        own = [r for r in got if r.source == source]
        lams = {round(math.log(r.rate) / r["size"], 6) for r in own if 0 < r.rate < 2}
        assert len(lams) <= 1
        assert sum(r.rate * r["size"] for r in own) == pytest.approx(own[0].target, rel=1e-4)


def test_odd_rows(spark):
    rows = [(1, None, None, "x", 1), (1, None, None, "x", 1), (None, "", "s", None, None), (2, "a b\tc\x0bd", "s", None, None), (2, "a b\tc\x0bd", "s", None, None), (3, "é" * 50 + " " + "z " * 30000, "t", None, 7)]
    docs = spark.createDataFrame(rows, SCHEMA)
    a, b = (sorted(map(tuple, mixing.mix_to_targets(docs, keep=["doc_id"]).collect()), key=str) for _ in range(2))
    assert a == b and len(a) == 6
    assert sorted(r[1] for r in a) == [0, 0, 0, 4, 4, 30001]
    empty = mixing.mix_to_targets(docs.limit(0))
    assert empty.count() == 0 and "taken" in empty.columns


def test_hot_cell_is_ranked_in_groups(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANK", 50)
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a b c"), (F.col("id") % 7).cast("string")).alias("text"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("source"))
    got = mixing.mix_to_targets(docs, keep=["source"]).groupBy("source", "target").agg(F.sum("taken").alias("t")).collect()
    for r in got:
        assert abs(r.t - r.target) <= 0.02 * r.target

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnwatch.llm import importance, queries
from tests.conftest import SF01

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]


def brute(docs, target, percent=25, least=20, buckets=10_000):
    bucket = lambda f: crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in grams(t)[1])
    t = Counter(bucket(f) for x in target for f in grams(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for key, text in docs:
        words, f = grams(text)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def plain(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "B", "É", "漢1", " ", "\x00", "-", "\n", "\x7f", "z9", "😀"])).map("".join), max_size=6))
def test_words_and_pairs_stay_in_their_document(texts):
    document, bucket, words = importance.features([t.encode() for t in texts], 997)
    found = Counter(zip(document.tolist(), bucket.tolist()))
    assert found == Counter((k, crc32(f.encode()) % 997) for k, t in enumerate(texts) for f in grams(t)[1])
    assert words.tolist() == [len(grams(t)[0]) for t in texts]


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    assert plain(queries.op13_importance_resampling(spark, SF01)) == brute(docs, target)


@pytest.mark.parametrize("group", [1, 50, 1 << 22])
def test_small_frames(spark, monkeypatch, group):
    """Nulls, empty, long and repeated texts, a clashing column, any grouping of a batch's texts."""
    monkeypatch.setattr(importance, "_GROUP_BYTES", group)
    docs = [(k, " ".join(f"w{(k * j) % 13}" for j in range(k))) for k in range(60)]
    docs += [(None, "x y " * 20), (None, None), (7, None), (61, ""), (62, "w1 " * 30_000), (30, docs[30][1]), (30, docs[30][1]), (63, "!? \x00")]
    df = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id long, text string, h int, key int, rank int").repartition(3)
    target = spark.createDataFrame([("w3 w6 w9",), (None,)], "text string")
    assert plain(importance.resample(df, target, percent=40)) == brute(docs, ["w3 w6 w9", None], percent=40)
    assert plain(importance.resample(df, target.limit(0))) == brute(docs, [])
    assert importance.resample(df.limit(0), target).count() == 0


def test_draw_leans_towards_the_target_and_repeats(spark):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.repeat(F.lit("alpha beta gamma "), 10)).otherwise(F.repeat(F.lit("delta eps zeta "), 10)).alias("text"),
    )
    target = spark.createDataFrame([("alpha beta gamma alpha beta",)] * 50, "text string")
    first = plain(importance.resample(docs, target))
    drawn = [r for r in first if r[4]]
    assert len(drawn) == 500 and sorted(r[4] for r in drawn) == list(range(1, 501))
    assert sum(r[0] % 2 == 0 for r in drawn) > 450
    assert plain(importance.resample(docs.repartition(7), target)) == first

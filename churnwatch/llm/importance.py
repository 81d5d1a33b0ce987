"""Importance resampling towards a target's distribution of hashed n-grams.

A batch's texts are joined with a sentinel between them and one regular expression finds
the words of all; each word's document is looked up in the sorted offsets of the texts, and
a pair of words counts only if both lie in one document. Buckets of all n-grams then give
counts (one ``bincount`` per batch) or, with a table of gains, weights per document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnwatch.session import cut_lineage, ready_python

BUCKETS = 10_000
SEPARATOR = b"\x00"  # not part of any word
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GROUP_BYTES = 4 << 20  # texts joined at once; a longer text is a group of its own


def _groups(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of bounded size, each with the place of its first row."""
    first, texts, size = 0, [], 0
    for k, text in enumerate(batch.column(at).cast(pa.binary()).to_pylist()):
        if texts and size + len(text or b"") > _GROUP_BYTES:
            yield first, texts
            first, texts, size = k, [], 0
        texts.append(text or b"")
        size += len(texts[-1])
    if texts:
        yield first, texts


def features(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, bucket, words)``: one entry per word and per pair of words of a document, and words per document."""
    joined = SEPARATOR.join(texts).lower()  # of bytes: A to Z only
    offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))[:-1]
    starts, hashes, pairs, before = [], [], [], 0
    for m in _WORD.finditer(joined):
        word = m.group()
        starts.append(m.start())
        pairs.append(crc32(word, before))  # with the word before, over the space between; the first entry is not a pair
        hashes.append(crc32(word))
        before = crc32(b" ", hashes[-1])
    document = np.searchsorted(offsets, np.array(starts, dtype=np.int64), side="right") - 1
    inside = document[1:] == document[:-1]
    single, double = np.array(hashes, dtype=np.int64) % buckets, np.array(pairs[1:], dtype=np.int64) % buckets
    return (
        np.concatenate((document, document[1:][inside])), np.concatenate((single, double[inside])),
        np.bincount(document, minlength=len(texts)),
    )


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, text: str = "text") -> list[int]:
    """How many n-grams of all texts fall into each bucket: one row per task and bucket is shuffled, one per bucket collected."""
    ready_python(texts.sparkSession)

    def run(batches):
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, group in _groups(batch, 0):
                counts += np.bincount(features(group, buckets)[1], minlength=buckets)
        at = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["bucket", "n"])

    found = texts.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * buckets
    for r in found.collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: list[int], target: list[int]) -> np.ndarray:
    """Per bucket 1000 times the log of the target's smoothed share over the source's, rounded down."""
    n, s_all, t_all = len(source), sum(source), sum(target)
    return np.array([math.floor(1000 * math.log(float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n)))) for s, t in zip(source, target)], dtype=np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_features, weight, h``: the mean gain of each document's n-grams, rounded down (none: 0).

    ``h`` is a hash of the text that orders rows equal in key and score.
    """
    ready_python(docs.sparkSession)
    buckets = len(gains)

    def run(batches):
        for batch in batches:
            words, n, weight = [], [], []
            for _, group in _groups(batch, 1):
                document, bucket, n_words = features(group, buckets)
                size = np.bincount(document, minlength=len(group))
                total = np.zeros(len(group), dtype=np.int64)
                np.add.at(total, document, gains[bucket])
                words.append(n_words)
                n.append(size)
                weight.append(total // np.maximum(size, 1))
            columns = [pa.array(np.concatenate(c).astype(np.int64)) if c else pa.array([], pa.int64()) for c in (words, n, weight)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, batch.column(2)], names=["key", "n_words", "n_features", "weight", "h"])

    kind = docs.schema[key].dataType.simpleString()
    chosen = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("h"))
    return chosen.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long, h long")


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """Adds ``place``, 1 for the first row by ``order``: ranges are sorted on their own and start where the ones before end.

    The rows are written once in ranges of sampled bounds, since bounds may differ when a task is run
    again; the window over ranges holds one row per range.
    """
    dealt = cut_lineage(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("range").count()
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("range").orderBy(*order)
    return dealt.join(F.broadcast(starts), "range").withColumn("place", F.col("start") + F.row_number().over(inside)).drop("range", "start")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7, least_words: int = 20, buckets: int = BUCKETS, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``key, n_words, n_features, weight, score, rank`` of every document; ``rank`` is null for those not drawn.

    Words are runs of ASCII digits, letters (A-Z lowered) and non-ASCII characters; features are words and pairs of
    neighbouring words, hashed into ``buckets``. ``weight`` is the mean log gain (in thousandths) of a document's
    features under the target, ``score`` adds Gumbel noise derived from the seed and the key, so the
    ``percent`` of highest scores among documents of ``least_words`` are a draw without replacement; reruns agree.
    Null and empty texts have no features and weight 0; a null key is noised like an empty one. Ties go to
    the smaller key (null first), then the smaller n_features, then a hash of the text; repeated rows are drawn one by one. An empty
    table gives no rows, an empty target a uniform one. Texts are read whole, other columns not at all.
    """
    gains = bucket_gains(bucket_counts(docs, buckets, text), bucket_counts(target, buckets, text))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = cut_lineage(weigh(docs, gains, key, text).withColumn("score", F.col("weight") + noise), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    n_drawn = able.count() * percent // 100
    placed = ranked(able, [F.col("score").desc(), F.col("key").asc_nulls_first(), F.col("n_features"), F.col("h")])
    rank = F.when(F.col("place") <= n_drawn, F.col("place")).cast("long")
    columns = [F.col("key").alias(key), "n_words", "n_features", "weight", "score"]
    short = scored.where(F.col("n_words") < least_words)
    return placed.select(*columns, rank.alias("rank")).unionByName(short.select(*columns, F.lit(None).cast("long").alias("rank")))

"""Corpus pipeline: language ID, line dedup, near-duplicates, decontamination, mixing.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns
a DataFrame, which is written as Parquet and read again as the next stage's ``docs``. All
stages but the last return the columns of documents. Every stage is defined for null
ids and texts, empty and very long texts, repeated rows, empty tables and further columns
(which pass through), as its operator states.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch.llm import decontaminate, langid, mixing, simhash, templates
from churnwatch.llm.common import read, unused
from churnwatch.session import checkpoint_dir

TARGET_WEIGHTS, TARGET_SHARE, MOST_COPIES = (3, 1, 2), 1.5, 2.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language. Goes: no text, no letter, or an entropy far above what is usual. All rows that
    name a language are learned from; where none does, nothing can be learned and nothing is rejected."""
    model = langid.train(docs, lambda i: F.lit(True))
    if model is None:
        return docs
    names = unused(docs.columns, "_lang", "_score", "_rejected", "_entropy")
    tagged = langid.identify(docs, model, names=tuple(names))
    return tagged.where(~F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose template recurs across documents; ``n_chars`` follows the text."""
    return templates.drop_lines(docs, size="n_chars").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the row with the smallest doc_id (ties by text, then the other columns)."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.flag(docs, read(spark, sf_dir, "benchmark")).where("n_items = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document taken, with its number of ``copies`` and the words they make; documents with no copy go."""
    return mixing.mix_to_targets(docs, TARGET_WEIGHTS, TARGET_SHARE, MOST_COPIES, keep=docs.columns).where("copies > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]

# fitted models, hashes of shingles and Newton steps: not a matter of SQL; tests hold every stage against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written to the shared folder and read again."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/churnwatch/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

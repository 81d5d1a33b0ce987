"""Encoders whose categories are a table: fitted, kept and joined in Spark, however many there are.

``fit_categories`` counts the filled values of all columns in one pass and numbers each column's categories in
sorted order. Numbers come from value ranges (sorted on their own, offset by the ranges before), so no column's categories meet in one
task and none comes to the driver. Rows get their codes by a join per column on the value; Spark broadcasts a
small table and splits a skewed key by itself. One-hot columns are sparse vectors, as wide as there are categories.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.operators import features as FE
from churnwatch.session import cut_lineage

UNKNOWN = -1.0


def filled(column: str, fill: dict) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(fill.get(column)).cast("string"))


def _melt(df: DataFrame, columns: list[str], fill: dict, keep: list[str]) -> DataFrame:
    args = [x for c in columns for x in (F.lit(c), filled(c, fill))]
    return df.select(*keep, F.stack(F.lit(len(columns)), *args).alias("column", "category"))


def fit_categories(train: DataFrame, columns: list[str], fill: dict) -> DataFrame:
    """(column, category, code, n): each column's distinct filled values, numbered from 0 in sorted order, with their counts.

    Values are compared as text, by code point. A column that is NULL throughout and has no fill has no category."""
    spark = train.sparkSession
    if not columns:
        return spark.createDataFrame([], "column string, category string, code double, n long")
    counts = _melt(train, columns, fill, []).where(F.col("category").isNotNull()).groupBy("column", "category").agg(F.count("*").alias("n"))
    # bounds of ranges are sampled, so the dealt rows are written before anything reads their range
    dealt = cut_lineage(counts.repartitionByRange("column", "category").withColumn("part", F.spark_partition_id()), "categories")
    sizes = dealt.groupBy("column", "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("column", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("off"))
    inside = Window.partitionBy("column", "part").orderBy("category")
    coded = dealt.join(offsets, ["column", "part"]).withColumn("code", (F.col("off") + F.row_number().over(inside) - 1).cast("double"))
    return cut_lineage(coded.select("column", "category", "code", "n"), "category-codes")


def with_codes(df: DataFrame, categories: DataFrame, columns: list[str], fill: dict, suffix: str = "") -> DataFrame:
    """``df`` with each column (name plus ``suffix``) as its code; values that the fit has not seen, and NULL without a fill, are -1."""
    out = df
    for k, c in enumerate(columns):
        own = categories.where(F.col("column") == c).select(F.col("category").alias(f"_category_{k}"), F.col("code").alias(f"_code_{k}"))
        out = out.join(own, filled(c, fill) == F.col(f"_category_{k}"), "left")
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"_code_{k}"), F.lit(UNKNOWN))).drop(f"_category_{k}", f"_code_{k}")
    return out


@dataclass
class TableEncoder:
    """A fitted preprocessing: numbers per column (``pre``), categories as a table."""

    pre: FE.FittedPreprocessor
    categories: DataFrame
    fill: dict

    def _numbers(self) -> list[tuple[str, Column]]:
        columns = self.pre.numeric if self.pre.kind == "tree" else self.pre.scaled + self.pre.unscaled
        return list(zip(columns, self.pre.number_expressions()))

    def long(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """(keep, column, value): every encoded column of every row; one-hot columns are ``<column>_<category>``."""
        args = [x for c, e in self._numbers() for x in (F.lit(c), e.cast("double"))]
        parts = [df.select(*keep, F.stack(F.lit(len(args) // 2), *args).alias("column", "value"))] if args else []
        if self.pre.binary:
            melted = _melt(df, self.pre.binary, self.fill, keep)
            parts.append(melted.join(self.categories.select("column", "category", "code"), ["column", "category"], "left").select(
                *keep, "column", F.coalesce("code", F.lit(UNKNOWN)).alias("value")))
        if self.pre.onehot:
            melted = _melt(df, self.pre.onehot, self.fill, keep).withColumnRenamed("category", "own")
            parts.append(melted.join(self.categories.select("column", "category"), "column").select(
                *keep, F.concat_ws("_", "column", "category").alias("column"), F.coalesce(F.col("own") == F.col("category"), F.lit(False)).cast("double").alias("value")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def vectors(self, df: DataFrame, keep: list[str], name: str = "features") -> DataFrame:
        """(keep, features): numbers, codes of binary columns, and one-hot columns as one sparse vector per row.

        A value that the fit has not seen is all zeros in its one-hot part."""
        coded = with_codes(df, self.categories, self.pre.binary, self.fill, "_code")
        coded = with_codes(coded, self.categories, self.pre.onehot, self.fill, "_code")
        numbers = [(f"_number_{i}", e.cast("double").alias(f"_number_{i}")) for i, (_, e) in enumerate(self._numbers())]
        flat = coded.select(*keep, *[e for _, e in numbers], *[F.col(f"`{c}_code`").alias(f"_binary_{i}") for i, c in enumerate(self.pre.binary)],
                            *[F.col(f"`{c}_code`").alias(f"_onehot_{i}") for i, c in enumerate(self.pre.onehot)])
        inputs = [n for n, _ in numbers] + [f"_binary_{i}" for i in range(len(self.pre.binary))]
        if self.pre.onehot:
            hot, wide = [f"_onehot_{i}" for i in range(len(self.pre.onehot))], [f"_wide_{i}" for i in range(len(self.pre.onehot))]
            # one row per column: the widths come from the largest codes; an unknown code is the last place, which is dropped
            size = {r["column"]: r["m"] for r in self.categories.groupBy("column").agg(F.max("code").alias("m")).collect()}
            tops = df.sparkSession.createDataFrame([tuple(float(size.get(c, 0.0)) for c in self.pre.onehot)], ", ".join(f"{h} double" for h in hot))
            encoder = OneHotEncoder(inputCols=hot, outputCols=wide, handleInvalid="keep", dropLast=True).fit(tops)
            flat = encoder.transform(flat)
            inputs += wide
        return VectorAssembler(inputCols=inputs, outputCol=name, handleInvalid="keep").transform(flat).select(*keep, name)


def fit_encoder(train: DataFrame, kind: str = "tree") -> TableEncoder:
    """Fits numbers as ``features.fit_preprocessor`` does, and all categories in one pass."""
    pre = FE.fit_numbers(train, kind)
    fill = {c: pre.modes[c] for c in pre.binary} | {c: C.MISSING_TOKEN for c in pre.onehot}
    return TableEncoder(pre, fit_categories(train, pre.binary + pre.onehot, fill), fill)

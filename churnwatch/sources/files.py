"""Files of the outside world: CSV tables, JSON run metrics, fitted bundles.

CSV tables are read with every column as text, as the cleaning operators expect them.
All paths go through Spark's file systems, so they may lie in any store that Spark reads.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch.operators.features import FittedPreprocessor
from churnwatch.session import path_exists

# white space inside fields is data here; cleaning strips it later
CSV = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"', "encoding": "UTF-8"}


def require_path(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    return path


def check_header(df: DataFrame, required: list[str]) -> DataFrame:
    """Trims header names and fails, listing the required columns that are missing."""
    df = df.toDF(*[str(c).strip() for c in df.columns])
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"scan is missing required columns {missing}; header has {df.columns}")
    return df


def read_csv(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """A CSV table with a header, all columns text; ``required`` names are checked against the trimmed header."""
    df = spark.read.options(**CSV).csv(require_path(spark, path))
    return df if required is None else check_header(df, required)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).csv(path)


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """(model, metric, value) from JSON objects that map metric names to numbers; ``model`` is their
    "model" text, null without one. Fields that are no numbers are left out."""
    lines = spark.read.text(require_path(spark, path), wholetext=False)
    fields = F.from_json("value", "map<string,string>")
    pairs = lines.select(F.element_at(fields, "model").alias("model"), F.explode(fields).alias("metric", "text"))
    value = F.col("text").try_cast("double")
    return pairs.where((F.col("metric") != "model") & value.isNotNull()).select("model", "metric", value.alias("value"))


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """One JSON object per model from long rows (model, metric, value); the metrics are a short list."""
    metrics.groupBy("model").pivot("metric").agg(F.first("value")).write.mode("overwrite").json(path)


def read_bundle(spark: SparkSession, path: str) -> tuple[FittedPreprocessor, dict]:
    """The fitted preprocessor of a bundle and what was stored beside it (split settings, fitted high-charge threshold)."""
    doc = json.loads(spark.read.text(require_path(spark, path)).first()["value"])
    own = set(FittedPreprocessor.__dataclass_fields__)
    return FittedPreprocessor(**{k: v for k, v in doc.items() if k in own}), {k: v for k, v in doc.items() if k not in own}

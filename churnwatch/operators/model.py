"""Model training and scoring with Spark ML (distributed fits; no single-machine trainer).

Classifiers take the model-ready table (encoded doubles + label). Class weights are a
column computed by one aggregate; probabilities come out of ``vector_to_array``.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.operators import clean as CL
from churnwatch.operators import evaluate as EV
from churnwatch.operators import features as FE
from churnwatch.session import cut_lineage

WEIGHT = "class_weight"


def with_balanced_weights(df: DataFrame, label: str = C.TARGET_COLUMN) -> DataFrame:
    """Adds ``class_weight`` = n / (classes * n_class); the per-class table is tiny."""
    return df.withColumn(WEIGHT, balanced_weight({r[label]: r["count"] for r in df.groupBy(label).count().collect()}, label))


def balanced_weight(counts: dict, label: str = C.TARGET_COLUMN) -> Column:
    """n / (classes * n_class) of a row's class, from the rows per class."""
    total, k = sum(counts.values()), len(counts)
    m = F.create_map(*[x for y, n in counts.items() for x in (F.lit(y), F.lit(total / (k * n)))])
    return F.element_at(m, F.col(label))


def classifier(kind: str, label: str = C.TARGET_COLUMN, weighted: bool = True, seed: int = C.RANDOM_STATE, **params):
    common = {"featuresCol": "features", "labelCol": label}
    if weighted:
        common["weightCol"] = WEIGHT
    if kind == "logreg":
        return LogisticRegression(maxIter=params.pop("maxIter", 1000), **common, **params)
    if kind == "forest":
        return RandomForestClassifier(minInstancesPerNode=params.pop("minInstancesPerNode", 2), seed=seed, **common,
                                      **params)
    if kind == "gbt":
        return GBTClassifier(maxDepth=params.pop("maxDepth", 4), maxIter=params.pop("maxIter", 50), seed=seed,
                             **common, **params)
    raise ValueError(f"unknown classifier {kind!r}")


def train_classifier(train: DataFrame, feature_cols: list[str], kind: str = "gbt", label: str = C.TARGET_COLUMN,
                     weighted: bool = True, **params) -> PipelineModel:
    data = with_balanced_weights(train, label) if weighted else train
    assembler = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, classifier(kind, label, weighted, **params)]).fit(data)


VALIDATION = "is_validation"


def train_boosted(train: DataFrame, feature_cols: list[str], validation: Column, label: str = C.TARGET_COLUMN,
                  max_iter: int = C.BOOSTING_ITERATIONS, tolerance: float = C.BOOSTING_TOLERANCE, **params) -> PipelineModel:
    """Boosted trees up to the configured number; the data choose how many.

    Rows for which ``validation`` is true are not fitted: after each tree their loss is taken, and fitting ends when it
    no longer falls by the tolerance (a share of the loss). The model keeps the trees up to the lowest loss;
    ``boosting_iterations`` tells how many. NULL counts as a row to fit."""
    held = train.withColumn(VALIDATION, F.coalesce(validation, F.lit(False)))
    return train_classifier(held, feature_cols, "gbt", label, maxIter=max_iter, validationIndicatorCol=VALIDATION, validationTol=tolerance, **params)


def boosting_iterations(model: PipelineModel) -> int:
    return model.stages[-1].getNumTrees


# ---------------------------------------------------------------------------
# saved models
# ---------------------------------------------------------------------------
def save_model(model: PipelineModel, path: str, parameters: dict) -> None:
    """The fitted pipeline (``<path>/model``) beside its parameters (``<path>/parameters``: one JSON row).

    ``parameters`` has ``feature_columns``, in the order of the fit, and whatever scoring needs (threshold, charge limit)."""
    if "feature_columns" not in parameters:
        raise ValueError("parameters must name the feature_columns of the fit")
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    text = json.dumps(parameters, sort_keys=True)
    spark.createDataFrame([(text,)], "parameters string").coalesce(1).write.mode("overwrite").text(f"{path}/parameters")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """A saved pipeline and its parameters."""
    parameters = json.loads(spark.read.text(f"{path}/parameters").first()[0])
    return PipelineModel.load(f"{path}/model"), parameters


def score_saved(spark: SparkSession, path: str, encoded: DataFrame, keep: list[str]) -> DataFrame:
    """Encoded rows scored by a saved model, after a strict check of the columns: one that is missing or no number is an error, not a fill."""
    model, parameters = load_model(spark, path)
    aligned = CL.align_columns_strict(encoded, parameters["feature_columns"], keep)
    return score_batch(model, aligned, parameters.get("threshold", C.SELECTED_THRESHOLD), parameters.get("model_name", "gbt"), keep)


def score_batch(model: PipelineModel, df: DataFrame, threshold: float = C.SELECTED_THRESHOLD,
                model_name: str = "gbt", keep: list[str] | None = None) -> DataFrame:
    """Input columns (or ``keep``) + churn_probability, prediction, threshold, model_name."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    cols = keep if keep is not None else df.columns
    return out.select(
        *cols,
        p.alias("churn_probability"),
        (p >= F.lit(threshold)).cast("int").alias("prediction"),
        F.lit(threshold).alias("threshold"),
        F.lit(model_name).alias("model_name"),
    )


def score_raw(model: PipelineModel, pre, raw: DataFrame, high_charge: float, threshold: float = C.SELECTED_THRESHOLD,
              model_name: str = "gbt") -> DataFrame:
    """Raw rows to scores: clean, derive features with the fitted high-charge threshold, align to
    the fitted columns (one that is absent counts as missing), encode, score. Keeps the id."""
    cleaned, _ = CL.clean_table(raw)
    cleaned = cut_lineage(cleaned, "score-clean")  # bounds the projection chain before encoding
    ft, _ = FE.feature_table(cleaned.withColumn("_key", F.col(C.ID_COLUMN)), high_charge)
    encoded = pre.transform(pre.align(ft), keep=["_key"])
    scored = score_batch(model, encoded, threshold, model_name, keep=["_key"])
    return scored.withColumnRenamed("_key", C.ID_COLUMN)


def top_features(importances: DataFrame, n: int = 10) -> DataFrame:
    """The n largest importances, ties by name (a report, so the limit is the feature)."""
    return importances.orderBy(F.desc("importance"), "source").limit(n)


def importance_rollup(model: PipelineModel, feature_cols: list[str], onehot_sources: dict[str, str]) -> list[tuple]:
    """(source column, importance) with one-hot columns summed into their source, descending."""
    imp = model.stages[-1].featureImportances.toArray()
    agg: dict[str, float] = {}
    for name, v in zip(feature_cols, imp):
        src = onehot_sources.get(name, name)
        agg[src] = agg.get(src, 0.0) + float(v)
    return sorted(agg.items(), key=lambda kv: (-kv[1], kv[0]))


def draw_settings(space: dict[str, list], trials: int, seed: int = C.RANDOM_STATE) -> list[dict]:
    """Distinct settings, drawn without replacement from all combinations; all of them if there are no more than ``trials``."""
    names = sorted(space)
    size = math.prod(len(space[n]) for n in names)
    places = sorted(random.Random(seed).sample(range(size), trials)) if trials < size else range(size)
    out = []
    for place in places:
        setting = {}
        for n in reversed(names):
            place, k = divmod(place, len(space[n]))
            setting[n] = space[n][k]
        out.append({n: setting[n] for n in names})
    return out


def random_search_cv(train: DataFrame, feature_cols: list[str], space: dict[str, list], trials: int = 3,
                     folds: int = 3, fold_col: str = "fold", kind: str = "logreg", seed: int = C.RANDOM_STATE,
                     label: str = C.TARGET_COLUMN, parallel: int = 4) -> DataFrame:
    """Distinct random settings from ``space``, each scored by the eight metrics of its out-of-fold predictions.

    One row per trial: ``trial``, the setting, the metrics. Rows are assembled once, written with their folds and kept in memory, or on
    disk where they do not fit; the classes of all folds are counted in one pass. The fits of all trials and folds, each a distributed Spark ML
    job, are submitted a few at a time. Out-of-fold scores are evaluated for all trials together, in one pass. Folds come from the row hash
    (``features.stratified_folds``)."""
    assembler = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep")
    data = cut_lineage(assembler.transform(train).select("features", label, fold_col), "search-train").persist()  # read three times by every fit
    settings = draw_settings(space, trials, seed)
    try:
        # one row per class: its rows outside each fold
        classes = data.groupBy(label).agg(*[F.count_if(F.col(fold_col) != k).alias(f"outside_{k}") for k in range(folds)]).collect()

        def held_out(job: tuple[int, int]) -> DataFrame:
            trial, fold = job
            weight = balanced_weight({r[label]: n for r in classes if (n := r[f"outside_{fold}"])}, label)
            model = classifier(kind, label, True, **dict(settings[trial])).fit(data.where(F.col(fold_col) != fold).withColumn(WEIGHT, weight))
            p = vector_to_array(F.col("probability"))[1]
            return model.transform(data.where(F.col(fold_col) == fold)).select(F.lit(str(trial)).alias("trial"), p.alias("p"), F.col(label).alias("label"))

        jobs = list(itertools.product(range(len(settings)), range(folds)))
        with ThreadPoolExecutor(parallel) as pool:  # only submits; the fits run on the executors
            parts = list(pool.map(held_out, jobs))
        scored = parts[0]
        for p in parts[1:]:
            scored = scored.unionByName(p)
        scored = cut_lineage(scored, "out-of-fold")
    finally:
        data.unpersist()
    metrics = EV.evaluate_models(scored, "p", "label", group="trial")
    names = sorted(space)
    table = data.sparkSession.createDataFrame([(str(t), *[s[n] for n in names]) for t, s in enumerate(settings)], ["group", *names])
    return table.join(metrics, "group").withColumn("trial", F.col("group").cast("int")).drop("group")

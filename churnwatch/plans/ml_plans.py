"""Model jobs over the model-ready churn table (rows-only checks: a fitted model has no
SQL equivalent; the invariants are covered by tests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.functions.scalar import rnd
from churnwatch.operators import evaluate as EV
from churnwatch.operators import features as FE
from churnwatch.operators import model as M
from churnwatch.plans import feature_plans as FP
from churnwatch.plans.registry import register
from churnwatch.session import cut_lineage
from churnwatch.sources import churn as CH
from churnwatch.streaming.log_stream import work_dir

VALIDATION_SEED = 11


def model_ready(spark, sf_dir, kind="tree"):
    ft, pre = FP.fitted(spark, sf_dir, kind)
    wide = pre.transform(ft, keep=[FP.KEY, C.TARGET_COLUMN, C.SPLIT_COLUMN])
    return wide, pre


def fitted_charge(spark, sf_dir):
    """The charge threshold that the model's features were made with: that of the whole cleaned table."""
    return FE.high_charge_threshold(FP.cleaned(spark, sf_dir))


_fits: dict = {}  # models fitted in this application, by table folder and kind: five queries score with the same one


def _fit(spark, sf_dir, kind="gbt"):
    wide, pre = model_ready(spark, sf_dir, "tree" if kind != "logreg" else "linear")
    cols = pre.output_columns()
    train = wide.where(F.col(C.SPLIT_COLUMN) == "train")
    name = (spark.sparkContext.applicationId, sf_dir, kind)
    if name not in _fits:
        # a fifth of the train rows, by hash, says when to stop
        held = FE.row_hash(F.col(FP.KEY), VALIDATION_SEED) % 5 == 0
        _fits[name] = M.train_boosted(train, cols, held) if kind == "gbt" else M.train_classifier(train, cols, kind)
    return wide, pre, cols, _fits[name]


@register("train_classifier")
def q_train_classifier(spark, sf_dir):
    """Fit the boosted-tree preset on train rows; the eight metrics on the test rows, and how many trees the validation rows chose."""
    wide, _, _, model = _fit(spark, sf_dir, "gbt")
    scored = M.score_batch(model, wide.where(F.col(C.SPLIT_COLUMN) == "test"), keep=[C.TARGET_COLUMN])
    ev = EV.evaluate_models(scored, "churn_probability", C.TARGET_COLUMN, group=None)
    return ev.select(*[rnd(F.col(c)).alias(c) if c != "group" else F.col(c) for c in ev.columns],
                     F.lit(M.boosting_iterations(model)).alias("iterations"), F.lit(C.BOOSTING_ITERATIONS).alias("allowed"))


@register("train_forest")
def q_train_forest(spark, sf_dir):
    """Random-forest preset, metrics on the test rows."""
    wide, _, _, model = _fit(spark, sf_dir, "forest")
    scored = M.score_batch(model, wide.where(F.col(C.SPLIT_COLUMN) == "test"), keep=[C.TARGET_COLUMN])
    ev = EV.evaluate_models(scored, "churn_probability", C.TARGET_COLUMN, group=None)
    return ev.select(*[rnd(F.col(c)).alias(c) if c != "group" else F.col(c) for c in ev.columns])


@register("score_batch")
def q_score_batch(spark, sf_dir):
    """Raw rows (without the label and one optional column) through the whole scoring chain."""
    _, pre, _, model = _fit(spark, sf_dir, "gbt")
    view = CH.churn_view(spark, sf_dir)
    return M.score_raw(model, pre, view.drop("Churn", "StreamingTV"), fitted_charge(spark, sf_dir))


@register("train_logreg")
def q_train_logreg(spark, sf_dir):
    """Balanced logistic regression on the scaled (linear) table, metrics on test rows."""
    wide, _, _, model = _fit(spark, sf_dir, "logreg")
    scored = M.score_batch(model, wide.where(F.col(C.SPLIT_COLUMN) == "test"), keep=[C.TARGET_COLUMN])
    ev = EV.evaluate_models(scored, "churn_probability", C.TARGET_COLUMN, group=None)
    return ev.select(*[rnd(F.col(c)).alias(c) if c != "group" else F.col(c) for c in ev.columns])


@register("importance_rollup")
def q_importance(spark, sf_dir):
    wide, pre, cols, model = _fit(spark, sf_dir, "gbt")
    sources = {f"{c}_{v}": c for c in pre.onehot for v in pre.onehot_categories[c]}
    rows = M.importance_rollup(model, cols, sources)
    # one row per source column of the fitted model
    return spark.createDataFrame(rows, "source string, importance double").select(
        "source", rnd(F.col("importance")).alias("importance"))


@register("top_features")
def q_top_features(spark, sf_dir):
    return M.top_features(q_importance(spark, sf_dir), 5)


SEARCH_SPACE = {"regParam": [0.0, 0.001, 0.003, 0.01, 0.03, 0.1], "elasticNetParam": [0.0, 0.25, 0.5, 0.75, 1.0]}


@register("random_search_cv")
def q_random_search(spark, sf_dir):
    """Ten different settings of thirty, the eight metrics of each."""
    wide, pre = model_ready(spark, sf_dir, "linear")
    train = FE.stratified_folds(wide.where(F.col(C.SPLIT_COLUMN) == "train"), key=FP.KEY, k=5)
    res = M.random_search_cv(train, pre.output_columns(), SEARCH_SPACE, trials=10, folds=5, kind="logreg")
    return res.select(*[F.col(c) if c in ("trial", *SEARCH_SPACE) else rnd(F.col(c)).alias(c) for c in res.columns])


@register("model_round_trip", FP._w("SELECT data_split, count(*) AS rows, 0 AS differing FROM splitted GROUP BY data_split"))
def q_model_round_trip(spark, sf_dir):
    """Scores of the fitted model and of the one saved, loaded and aligned strictly: rows, and how many differ."""
    wide, _, cols, model = _fit(spark, sf_dir, "logreg")
    path = work_dir(spark, "model")
    M.save_model(model, path, {"feature_columns": cols, "threshold": C.SELECTED_THRESHOLD, "model_name": "logreg"})
    key = [FP.KEY, C.SPLIT_COLUMN]
    numbered = cut_lineage(wide.withColumn("_row", F.monotonically_increasing_id()), "round-trip")
    before = M.score_batch(model, numbered, keep=["_row", *key]).select("_row", C.SPLIT_COLUMN, "churn_probability", "prediction")
    after = M.score_saved(spark, path, numbered.drop(C.TARGET_COLUMN), ["_row", *key]).select("_row", F.col("churn_probability").alias("p"), F.col("prediction").alias("y"))
    both = before.join(after, "_row", "left")
    differs = ~(F.col("churn_probability").eqNullSafe(F.col("p")) & F.col("prediction").eqNullSafe(F.col("y")))
    return both.groupBy(C.SPLIT_COLUMN).agg(F.count("*").alias("rows"), F.count_if(differs).alias("differing"))

"""Trees chosen by validation rows, saved models, settings without repeats."""

import pytest
from pyspark.sql import functions as F

from churnwatch.operators import clean as CL
from churnwatch.operators import model as M
from churnwatch.streaming.log_stream import work_dir


@pytest.fixture(scope="module")
def rows(spark):
    x = F.rand(1) * 2 - 1
    df = spark.range(600).select("id", x.alias("a"), (F.rand(2) * 2 - 1).alias("b"), F.rand(3).alias("noise"))
    return df.withColumn("churn_status", (F.col("a") + F.col("b") + (F.col("noise") - 0.5) * 2 > 0).cast("int")).cache()


def test_validation_rows_choose_the_number_of_trees(rows):
    held = F.col("id") % 4 == 0
    one = M.train_boosted(rows, ["a", "b"], held, max_iter=60)
    assert 1 <= M.boosting_iterations(one) < 60  # noisy labels: more trees do not help
    assert M.boosting_iterations(M.train_boosted(rows, ["a", "b"], held, max_iter=2, tolerance=0.0)) <= 2
    # rows held out for validation are not fitted: their labels do not change the first tree
    flipped = rows.withColumn("churn_status", F.when(held, 1 - F.col("churn_status")).otherwise(F.col("churn_status")))
    a, b = (M.train_boosted(df, ["a", "b"], held, max_iter=1, tolerance=0.0, weighted=False) for df in (rows, flipped))
    assert M.score_batch(a, rows, keep=["id"]).exceptAll(M.score_batch(b, rows, keep=["id"])).count() == 0


def test_saved_model_scores_alike_and_checks_its_columns(spark, rows):
    model = M.train_classifier(rows, ["a", "b"], "gbt", maxIter=3)
    path = work_dir(spark, "model")
    M.save_model(model, path, {"feature_columns": ["a", "b"], "threshold": 0.3, "model_name": "m"})
    before = M.score_batch(model, rows.select("id", "a", "b"), 0.3, "m", ["id"])
    after = M.score_saved(spark, path, rows.select("noise", "b", "id", "a"), ["id"])
    assert before.exceptAll(after).count() == 0 and after.count() == 600
    _, parameters = M.load_model(spark, path)
    assert parameters == {"feature_columns": ["a", "b"], "threshold": 0.3, "model_name": "m"}
    with pytest.raises(ValueError, match="a: missing"):
        M.score_saved(spark, path, rows.select("id", "b"), ["id"])
    with pytest.raises(ValueError, match="b: string"):
        M.score_saved(spark, path, rows.select("id", "a", F.col("b").cast("string")), ["id"])
    with pytest.raises(ValueError):
        M.save_model(model, path, {})
    assert CL.column_mismatch(rows, ["a", "b"]) == []


def test_settings_do_not_repeat():
    space = {"x": [1, 2, 3], "y": ["p", "q"]}
    every = M.draw_settings(space, 100)
    assert len(every) == 6 and len({tuple(s.items()) for s in every}) == 6
    some = M.draw_settings(space, 4, seed=3)
    assert len({tuple(s.items()) for s in some}) == 4 and some == M.draw_settings(space, 4, seed=3)


def test_search_gives_every_metric_of_every_setting(spark, rows):
    folds = rows.withColumn("fold", (F.col("id") % 3).cast("int"))
    found = M.random_search_cv(folds, ["a", "b"], {"regParam": [0.0, 0.1, 10.0], "elasticNetParam": [0.0, 1.0]}, trials=4, folds=3)
    r = found.collect()
    assert sorted(x["trial"] for x in r) == [0, 1, 2, 3] and len({(x["regParam"], x["elasticNetParam"]) for x in r}) == 4
    for name in ("accuracy", "precision", "recall", "f1_score", "predicted_positive_rate", "roc_auc", "pr_auc", "log_loss"):
        assert all(x[name] is not None for x in r)
    good = [x["roc_auc"] for x in r if x["regParam"] < 1]
    assert min(good, default=1) > 0.7


def test_search_reads_its_rows_once(spark, rows, monkeypatch):
    """However many fits there are, the written rows are read once; class counts and fits take them from memory."""
    read, written = spark.sparkContext.accumulator(0), M.cut_lineage

    def seen(fold):
        read.add(1)
        return fold

    counted = F.udf(seen, "int").asNondeterministic()
    monkeypatch.setattr(M, "cut_lineage", lambda df, name: written(df, name).withColumn("fold", counted("fold")) if name == "search-train" else written(df, name))
    folds = rows.withColumn("fold", (F.col("id") % 3).cast("int"))
    found = M.random_search_cv(folds, ["a", "b"], {"regParam": [0.0, 0.1]}, trials=2, folds=3)
    assert found.count() == 2 and read.value == 600


def test_classes_are_weighed_without_the_held_out_fold(spark, rows, monkeypatch):
    """Rows of no fold are in no fit; a class that only one fold has does not count where that fold is held out."""
    weights, classifier = [], M.classifier

    class Seen:
        def __init__(self, inner):
            self.inner = inner

        def fit(self, df):
            weights.append(sorted((r.churn_status, round(r[M.WEIGHT], 9), r["count"]) for r in df.groupBy("churn_status", M.WEIGHT).count().collect()))
            return self.inner.fit(df)

    monkeypatch.setattr(M, "classifier", lambda *a, **k: Seen(classifier(*a, **k)))
    fold = F.when(F.col("id") < 30, None).when(F.col("id") < 200, 0).otherwise(1)
    status = F.when(F.col("id") < 20, 2).when(F.col("id") < 50, 0).otherwise(1)
    M.random_search_cv(rows.withColumn("fold", fold).withColumn("churn_status", status), ["a", "b"], {"regParam": [0.1]}, trials=1, folds=2, parallel=1)
    assert weights == [[(1, 1.0, 400)], [(0, 4.25, 20), (1, round(170 / 300, 9), 150)]]

"""End-to-end jobs and sinks: preprocessing, drift inputs, scoring with the three logs,
run metrics with baseline promotion, the fitted bundle, and the monitoring report.

Jobs write parquet tables under a folder in the shared checkpoint location (a real
deployment passes its own table paths); each registered query returns what the job
wrote, read back, so the driver sees the persisted result."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.operators import clean as CL
from churnwatch.operators import contract as CT
from churnwatch.operators import evaluate as EV
from churnwatch.operators import features as FE
from churnwatch.operators import model as M
from churnwatch.plans import contract_plans as CP
from churnwatch.plans import eval_plans as EP
from churnwatch.plans import feature_plans as FP
from churnwatch.plans.registry import register
from churnwatch.session import cut_lineage
from churnwatch.sources import churn as CH
from churnwatch.sources import files
from churnwatch.sources.batch_log import BatchLog
from churnwatch.sources import tables as S
from churnwatch.streaming.log_stream import work_dir


# ---------------------------------------------------------------------------
# sinks
# ---------------------------------------------------------------------------
def sink_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def sink_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def sink_run_metrics(metrics_long: DataFrame, path: str, run_id: str) -> None:
    """(run_id, model, metric, value) partitioned by run; rewriting a run replaces only it."""
    (metrics_long.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(path))


def promote_baseline(path: str, spark: SparkSession, run_id: str, baseline_path: str) -> None:
    """Copy one run's metrics as the baseline (overwrite the baseline table)."""
    spark.read.parquet(path).where(F.col("run_id") == run_id).write.mode("overwrite").parquet(baseline_path)


def sink_fit_bundle(pre: FE.FittedPreprocessor, path: str, spark: SparkSession, extra: dict | None = None) -> None:
    """Fitted parameters (column lists, medians, modes, scales, categories) as one JSON row."""
    doc = json.loads(pre.to_json())
    doc.update(extra or {})
    spark.createDataFrame([(json.dumps(doc, sort_keys=True),)], "bundle string").coalesce(1).write.mode(
        "overwrite").text(path)


# ---------------------------------------------------------------------------
# jobs
# ---------------------------------------------------------------------------
def preprocess_job(spark: SparkSession, raw: DataFrame, out: str) -> dict:
    """clean (strict, label required) -> features -> split -> fit on train -> transform all
    -> tree and linear tables (partitioned by split) + bundle. Returns the output paths."""
    cleaned, _ = CL.clean_table(raw, strict_schema=True, require_target=True)
    split = FE.stratified_assign(cut_lineage(cleaned, "cleaned"))
    high_charge = FE.high_charge_threshold(split)  # one value: the tables use it, the bundle keeps it, scoring reads it there
    ft, dropped = FE.feature_table(split, high_charge)
    ft = cut_lineage(ft, "features")  # read by every fit pass and both transforms
    train = ft.where(F.col(C.SPLIT_COLUMN) == "train")
    paths = {}
    for kind in ("tree", "linear"):
        pre = FE.fit_preprocessor(train, kind)
        paths[kind] = f"{out}/{kind}"
        sink_table(pre.transform(ft), paths[kind], [C.SPLIT_COLUMN])
        sink_fit_bundle(pre, f"{out}/bundle_{kind}", spark, {
            "dropped_columns": dropped, "test_size": C.TEST_SIZE, "random_state": C.RANDOM_STATE, "high_charge": high_charge})
    return paths


def drift_input_job(reference_raw: DataFrame, current_raw: DataFrame, out: str) -> dict:
    ref, _ = CL.clean_reference(reference_raw)
    cur, _ = CL.clean_current(current_raw)
    sink_table(ref, f"{out}/reference")
    sink_table(cur, f"{out}/current")
    return {"reference": f"{out}/reference", "current": f"{out}/current"}


SCORE_LOGS = ("raw", "clean", "encoded", "rejected")


def score_log_job(spark: SparkSession, batch: DataFrame, log_path: str, model, pre: FE.FittedPreprocessor,
                  high_charge: float, now: str, batch_id: str | None = None) -> dict:
    """Contract and batch rules -> reject table; accepted rows whose id is new -> clean ->
    features -> encode -> score -> the raw, clean and encoded logs, stamped with the UTC time ``now``.

    The four tables are one ``BatchLog`` batch (``batch_id``, by default the digits of ``now``): a run that fails between two of them
    leaves nothing to be read, the id check does not see its rows, and running it again gives each row once. A batch that
    is committed is not scored again."""
    paths = {k: f"{log_path}/{k}" for k in SCORE_LOGS}
    log = BatchLog(spark, log_path)
    batch_id = batch_id or "".join(ch for ch in now if ch.isdigit())
    if log.is_committed(batch_id):
        return paths
    batch = cut_lineage(batch, "batch")  # the arriving batch, read by every rule below
    logged = log.read("raw")
    logged = logged.select(C.ID_COLUMN) if logged is not None else batch.select(C.ID_COLUMN).limit(0)
    checked = CT.contract_check(batch)
    contract_bad = checked.where(~F.col("accepted")).select("row_no", F.explode("violations").alias("rule"))
    batch_bad = CT.batch_rules(batch, logged).select("row_no", "rule")
    rejected = cut_lineage(contract_bad.unionByName(batch_bad), "rejected")
    accepted = cut_lineage(batch.join(rejected.select("row_no").distinct(), "row_no", "left_anti"), "accepted")
    # the id column carries the row number through cleaning, so padded ids find their raw row again
    numbered = accepted.withColumn(C.ID_COLUMN, F.col("row_no").cast("string")).drop("row_no")
    cleaned, _ = CL.clean_table(numbered)
    cleaned = cut_lineage(cleaned, "score-clean")  # bounds the projection chain before encoding
    ft, _ = FE.feature_table(cleaned.withColumn("_key", F.col(C.ID_COLUMN)), high_charge)
    enc = cut_lineage(pre.transform(pre.align(ft), keep=["_key"]), "score-encoded")
    scored = cut_lineage(M.score_batch(model, enc, keep=enc.columns).drop("features"), "scored")
    ts = F.lit(now).cast("timestamp")
    probs = scored.select(F.col("_key").alias(C.ID_COLUMN), F.col("churn_probability").alias("prediction"))
    raw = accepted.join(probs.withColumnRenamed(C.ID_COLUMN, "_key"), F.col("row_no").cast("string") == F.col("_key"))
    log.append(batch_id, {
        "raw": raw.drop("_key").withColumn("timestamp", ts),
        "clean": cleaned.join(probs, C.ID_COLUMN).drop(C.ID_COLUMN).withColumn("timestamp", ts),
        "encoded": scored.drop("_key").withColumn("timestamp", ts),
        "rejected": rejected,
    })
    return paths


def monitoring_report(spark: SparkSession, reference: DataFrame | None, log: DataFrame | None,
                      baseline: DataFrame | None, current: DataFrame | None, strict: bool = False,
                      now: str | None = None) -> DataFrame:
    """(check, status, detail, checked_at): one row each for feature drift (left to the alert rules), performance
    against the baseline, and whether the inputs are there. ``strict`` raises where one is not."""
    inputs = {"reference": reference, "log": log, "baseline": baseline, "current": current}
    absent = sorted(name for name, table in inputs.items() if table is None)
    if strict and absent:
        raise FileNotFoundError(f"monitoring needs these tables: {', '.join(absent)}")
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()

    def row(check: str, status: Column, detail: Column, of: DataFrame) -> DataFrame:
        return of.select(F.lit(check).alias("check"), status.alias("status"), detail.alias("detail"), at.alias("checked_at"))

    def lacking(*names: str) -> str:
        return ", ".join(n for n in names if n in absent)

    one = spark.range(1)
    drift_note = f"no table for: {lacking('reference', 'log')}" if lacking("reference", "log") else "left to the alert rules"
    if lacking("baseline", "current"):
        performance = row("performance_degradation", F.lit("SKIPPED"), F.lit(f"no table for: {lacking('baseline', 'current')}"), one)
    else:
        models = EV.degradation_status(EV.metric_degradation(baseline, current, ["model"]), ["model"])
        line = F.format_string("%s %d of %d worse", F.col("model"), F.col("degraded_metrics"), F.col("total_checked_metrics"))
        total = models.agg(F.max((F.col("status") == "ALERT").cast("int")).alias("bad"), F.array_join(F.sort_array(F.collect_list(line)), ", ").alias("text"))
        performance = row("performance_degradation", F.when(F.col("bad") == 1, "ALERT").otherwise("OK"), F.col("text"), total)
    logged = (log.limit(1) if log is not None else one.limit(0)).agg(F.count("*").alias("n"))
    problems = F.array_compact(F.array(
        F.when(F.lit(bool(absent)), F.lit(f"no table for: {', '.join(absent)}")),
        F.when(F.lit(log is not None) & (F.col("n") == 0), F.lit("the scoring log has no rows")),
    ))
    quality = row("data_quality", F.when(F.size(problems) > 0, "WARN").otherwise("OK"), F.array_join(problems, "; "), logged)
    return row("feature_drift", F.lit("SKIPPED"), F.lit(drift_note), one).unionByName(performance).unionByName(quality)


# ---------------------------------------------------------------------------
# registered queries (rows-only: side-effecting jobs, checked by tests)
# ---------------------------------------------------------------------------
@register("preprocess_job", FP._w("""SELECT t."table", data_split, count(*) AS rows, CAST(sum(high_monthly_charge) AS BIGINT) AS high_charges
FROM fe CROSS JOIN (VALUES ('tree'), ('linear')) t("table") GROUP BY ALL"""))
def q_preprocess_job(spark, sf_dir):
    out = work_dir(spark, "preprocess")
    paths = preprocess_job(spark, CH.churn_view(spark, sf_dir), out)
    parts = [spark.read.parquet(p).groupBy(C.SPLIT_COLUMN).agg(F.count("*").alias("rows"), F.sum("high_monthly_charge").cast("bigint").alias("high_charges"))
             .select(F.lit(k).alias("table"), C.SPLIT_COLUMN, "rows", "high_charges") for k, p in paths.items()]
    return parts[0].unionByName(parts[1])


@register("sink_fit_bundle", FP._w(
    f"SELECT 'high_charge' AS parameter, round({FP._quantile_sql('splitted', 'MonthlyCharges', C.HIGH_CHARGE_QUANTILE)}, 9) AS value UNION ALL "
    + " UNION ALL ".join(f"SELECT 'median {c}', round({FP._median_sql('train', c)}, 9)" for c in FP.NUMERIC)))
def q_sink_fit_bundle(spark, sf_dir):
    """The numbers that the written bundle holds: the charge threshold and the medians."""
    out = work_dir(spark, "preprocess")
    preprocess_job(spark, CH.churn_view(spark, sf_dir), out)
    b = spark.read.text(f"{out}/bundle_tree")
    medians = b.select(F.explode(F.from_json(F.get_json_object("value", "$.medians"), "map<string,double>")).alias("c", "value"))
    charge = b.select(F.lit("high_charge").alias("parameter"), F.round(F.get_json_object("value", "$.high_charge").cast("double"), 9).alias("value"))
    return charge.unionByName(medians.select(F.concat(F.lit("median "), "c").alias("parameter"), F.round("value", 9).alias("value")))


@register("sink_table")
def q_sink_table(spark, sf_dir):
    path = work_dir(spark, "clean")
    cleaned, _ = CL.clean_table(CH.churn_view(spark, sf_dir), strict_schema=True, require_target=True)
    sink_table(cleaned, path)
    return spark.read.parquet(path)


@register("sink_append_log")
def q_sink_append_log(spark, sf_dir):
    path = work_dir(spark, "append-log")
    s = EP.scored(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    sink_append(s.where(early), path)  # first batch creates the log with its header/schema
    sink_append(s.where(~early), path)
    return spark.read.parquet(path)


@register("sink_run_metrics")
def q_sink_run_metrics(spark, sf_dir):
    path, base = work_dir(spark, "runs"), work_dir(spark, "baseline")
    base_m, cur_m = EP._period_metrics(spark, sf_dir)
    sink_run_metrics(base_m, path, "run-1")
    sink_run_metrics(cur_m, path, "run-2")
    promote_baseline(path, spark, "run-1", base)
    runs = spark.read.parquet(path).unionByName(spark.read.parquet(base).withColumn("run_id", F.lit("baseline")))
    return runs.select("model", "metric", "value", "run_id")


@register("run_metrics_json", f"WITH {EP._period_sql()} SELECT model, metric, round(value, 9) AS value FROM b_long")
def q_run_metrics_json(spark, sf_dir):
    """A run's metrics written as JSON objects and read back as long rows."""
    path = work_dir(spark, "run-json")
    files.write_metrics_json(EP._period_metrics(spark, sf_dir)[0], path)
    return files.read_metrics_json(spark, path).withColumn("value", F.round("value", 9))


@register("drift_input_job")
def q_drift_input_job(spark, sf_dir):
    v = CH.churn_view(spark, sf_dir)
    key = F.col(" customerID").cast("long")
    out = work_dir(spark, "drift-inputs")
    paths = drift_input_job(v.where(key % 2 == 0), v.where(key % 2 == 1).drop("Churn"), out)
    return spark.read.parquet(paths["reference"]).select(F.lit("reference").alias("side")).unionByName(
        spark.read.parquet(paths["current"]).select(F.lit("current").alias("side"))).groupBy("side").count()


@register("score_log_job", f"""WITH {CP.batch_ctes()}, b AS (SELECT *, {CP._nid('customerID')} AS nid FROM batch),
bad AS (SELECT row_no FROM ({CP.rules_sql()}) UNION ALL SELECT row_no FROM b WHERE nid IS NULL
  UNION ALL SELECT row_no FROM (SELECT row_no, count(*) OVER (PARTITION BY nid) AS k FROM b WHERE nid IS NOT NULL) WHERE k > 1
  UNION ALL SELECT row_no FROM batch WHERE {CP._n('TotalCharges')} < {CP._n('MonthlyCharges')}),
good AS (SELECT * FROM batch ANTI JOIN bad USING (row_no))
SELECT l.log, count(*) AS count FROM good CROSS JOIN (VALUES ('raw'), ('clean'), ('encoded')) l(log) GROUP BY l.log
UNION ALL SELECT 'rejected', count(*) FROM bad""")
def q_score_log_job(spark, sf_dir):
    from churnwatch.plans import ml_plans as ML

    wide, pre, cols, model = ML._fit(spark, sf_dir, "gbt")
    hc = ML.fitted_charge(spark, sf_dir)
    log_path = work_dir(spark, "score-log")
    score_log_job(spark, CP.batch(spark, sf_dir), log_path, model, pre, hc, "2024-02-01 00:00:00")
    log = BatchLog(spark, log_path)
    out = None
    for name in SCORE_LOGS:
        one = log.read(name).select(F.lit(name).alias("log"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("log").count()


@register("monitoring_report", f"""WITH {EP._period_sql()}, {EP._deg_sql()},
per AS (SELECT model, count(*) FILTER (WHERE degraded) AS bad, count(*) AS total FROM deg GROUP BY model)
SELECT 'feature_drift' AS "check", 'SKIPPED' AS status, 'left to the alert rules' AS detail
UNION ALL SELECT 'performance_degradation', CASE WHEN max(bad) > 0 THEN 'ALERT' ELSE 'OK' END,
  string_agg(model || ' ' || bad || ' of ' || total || ' worse', ', ' ORDER BY model) FROM per
UNION ALL SELECT 'data_quality', 'OK', ''""")
def q_monitoring_report(spark, sf_dir):
    base_m, cur_m = EP._period_metrics(spark, sf_dir)
    ref, cur = S.drift_pair(spark, sf_dir)
    return monitoring_report(spark, ref, cur, base_m, cur_m, now="2024-02-01 00:00:00").select("check", "status", "detail")


def _attach_oracles() -> None:
    """SQL for the jobs whose persisted result SQL can state directly."""
    from churnwatch.plans import clean_plans as CLP
    from churnwatch.plans import series_plans as SP
    from churnwatch.plans.registry import ORACLE

    ORACLE["sink_table"] = CLP._w("SELECT * FROM cleaned")
    ORACLE["sink_run_metrics"] = (
        f"WITH {EP._period_sql()} SELECT *, 'run-1' AS run_id FROM b_long UNION ALL SELECT *, 'run-2' FROM k_long "
        "UNION ALL SELECT *, 'baseline' FROM b_long")
    ORACLE["sink_append_log"] = f"WITH {EP.SCORED_SQL} SELECT * FROM scored"
    ORACLE["drift_input_job"] = CLP._w(
        "SELECT CASE WHEN CAST(customerID AS BIGINT) % 2 = 0 THEN 'reference' ELSE 'current' END AS side, "
        "count(*) AS count FROM cleaned GROUP BY 1")
    ORACLE["stream_prediction_counters"] = SP.ORACLE_COUNTERS


_attach_oracles()

"""Contract, batch-rule and id-join queries. The batch is the churn view (canonical
names, label removed) with a deterministic row number; the inference log is the set of
customers with orders on or after 1998-01-01."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.functions.scalar import NUMBER_PATTERN
from churnwatch.operators import clean as CL
from churnwatch.operators import contract as CT
from churnwatch.plans.registry import register
from churnwatch.sources import churn as CH
from churnwatch.sources import tables as S

LOG_SINCE = "1998-01-01"
RAW = [n for n, _ in CH.churn_columns()]
CANON = {" customerID": "customerID", "GENDER": "gender"}


def batch(spark, sf_dir):
    v = CH.churn_view(spark, sf_dir, with_row_no=True)
    named = CL.canonical_columns(v)
    return named.drop("Churn")


def inference_log(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderdate") >= F.lit(LOG_SINCE).cast("timestamp_ntz")).select(
        F.col("o_custkey").cast("string").alias(C.ID_COLUMN))


# ---------------------------------------------------------------------------
# SQL
# ---------------------------------------------------------------------------
def _t(c: str) -> str:
    return f"regexp_replace(CAST(\"{c}\" AS VARCHAR), '^\\s+|\\s+$', '', 'g')"


def _n(c: str) -> str:
    return f"(CASE WHEN regexp_matches({_t(c)}, '{NUMBER_PATTERN}') THEN TRY_CAST({_t(c)} AS DOUBLE) END)"


def batch_ctes() -> str:
    cols = ", ".join(f'"{r}" AS "{CANON.get(r, r)}"' for r in RAW if r != "Churn")
    log = (f"log AS (SELECT DISTINCT lower(regexp_replace(CAST(o_custkey AS VARCHAR), '^\\s+|\\s+$', '', 'g')) AS id "
           f"FROM orders WHERE o_orderdate >= TIMESTAMP '{LOG_SINCE} 00:00:00')")
    return f"{CH.churn_view_sql(True)}, batch AS (SELECT row_no, {cols} FROM churn_raw), {log}"


def rules_sql() -> str:
    parts = []
    for c in C.FEATURE_COLUMNS:
        miss = f"(\"{c}\" IS NULL OR {_t(c)} = '')"
        parts.append(f"SELECT row_no, '{c}:required' AS rule FROM batch WHERE {miss}")
        if c in C.DOMAINS:
            vals = ", ".join(f"'{v}'" for v in C.DOMAINS[c])
            parts.append(f"SELECT row_no, '{c}:allowed' FROM batch WHERE NOT {miss} AND {_t(c)} NOT IN ({vals})")
        elif c in ("SeniorCitizen", "tenure"):
            is_int = f"regexp_matches({_t(c)}, '{CT.INT_PATTERN}')"
            parts.append(f"SELECT row_no, '{c}:integer' FROM batch WHERE NOT {miss} AND NOT {is_int}")
            bad = "< 0 OR TRY_CAST({t} AS BIGINT) > 1" if c == "SeniorCitizen" else "< 0"
            parts.append(f"SELECT row_no, '{c}:range' FROM batch WHERE {is_int} AND (TRY_CAST({_t(c)} AS BIGINT) "
                         + bad.format(t=_t(c)) + ")")
        elif c in ("MonthlyCharges", "TotalCharges"):
            parts.append(f"SELECT row_no, '{c}:number' FROM batch WHERE NOT {miss} AND {_n(c)} IS NULL")
            parts.append(f"SELECT row_no, '{c}:range' FROM batch WHERE {_n(c)} < 0")
    parts.append(f"SELECT row_no, 'TotalCharges:lt_monthly' FROM batch WHERE {_n('TotalCharges')} < {_n('MonthlyCharges')}")
    return " UNION ALL ".join(parts)


@register("contract_check", f"WITH {batch_ctes()} SELECT row_no, rule FROM ({rules_sql()})")
def q_contract_check(spark, sf_dir):
    return CT.violations_long(CT.contract_check(batch(spark, sf_dir)))


@register("contract_split", f"""WITH {batch_ctes()}, bad AS (SELECT DISTINCT row_no FROM ({rules_sql()}))
SELECT b.row_no NOT IN (SELECT row_no FROM bad) AS accepted, count(*) AS rows FROM batch b GROUP BY 1""")
def q_contract_split(spark, sf_dir):
    return CT.contract_check(batch(spark, sf_dir)).groupBy("accepted").agg(F.count("*").alias("rows"))


RESULT_SQL = """WITH s AS (SELECT event_id AS row_no, value / 400.0 AS churn_probability,
    CASE WHEN value / 400.0 >= 0.6 THEN 1 ELSE 0 END AS prediction, 0.6 AS threshold, 'gbt' AS model_name FROM events)
SELECT row_no, 'churn_probability:range' AS rule FROM s WHERE churn_probability IS NULL OR churn_probability < 0
  OR churn_probability > 1"""


@register("result_contract", RESULT_SQL)
def q_result_contract(spark, sf_dir):
    e = S.table(spark, sf_dir, "events")
    p = F.col("value") / F.lit(400.0)
    scored = e.select(F.col("event_id").alias("row_no"), p.alias("churn_probability"),
                      (p >= 0.6).cast("int").alias("prediction"), F.lit(0.6).alias("threshold"),
                      F.lit("gbt").alias("model_name"))
    return CT.violations_long(CT.result_contract(scored))


@register("result_contract_all", """WITH s AS (SELECT event_id AS row_no,
    CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN -0.1 ELSE value / 400.0 END AS p,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 1.5 ELSE 0.6 END AS t,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS y,
    CASE WHEN event_id % 19 <> 0 THEN 'gbt' END AS m FROM events)
SELECT row_no, 'churn_probability:range' AS rule FROM s WHERE p IS NULL OR p < 0 OR p > 1
UNION ALL SELECT row_no, 'threshold:range' FROM s WHERE t IS NULL OR t < 0 OR t > 1
UNION ALL SELECT row_no, 'prediction:allowed' FROM s WHERE y IS NULL OR y NOT IN (0, 1)
UNION ALL SELECT row_no, 'model_name:required' FROM s WHERE m IS NULL""")
def q_result_contract_all(spark, sf_dir):
    """Results that break every rule of the contract, alone and together."""
    k = F.col("event_id")
    scored = S.table(spark, sf_dir, "events").select(
        k.alias("row_no"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 7 == 0, -0.1).otherwise(F.col("value") / 400.0).alias("churn_probability"),
        F.when(k % 13 == 0, F.lit(None)).when(k % 5 == 0, 1.5).otherwise(0.6).alias("threshold"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 3 == 0, 2).otherwise(1).alias("prediction"),
        F.when(k % 19 != 0, "gbt").alias("model_name"),
    )
    return CT.violations_long(CT.result_contract(scored))


def _nid(c: str) -> str:
    x = f"lower({_t(c)})"
    return f"(CASE WHEN {x} <> '' THEN {x} END)"


@register("batch_rules", f"""WITH {batch_ctes()}, b AS (SELECT *, {_nid('customerID')} AS nid FROM batch)
SELECT 'blank_id' AS rule, row_no FROM b WHERE nid IS NULL
UNION ALL SELECT 'duplicate_id', row_no FROM (SELECT row_no, count(*) OVER (PARTITION BY nid) AS k FROM b
  WHERE nid IS NOT NULL) WHERE k > 1
UNION ALL SELECT 'id_in_log', row_no FROM b WHERE nid IN (SELECT id FROM log)
UNION ALL SELECT 'total_lt_monthly', row_no FROM batch WHERE {_n('TotalCharges')} < {_n('MonthlyCharges')}""")
def q_batch_rules(spark, sf_dir):
    return CT.batch_rules(batch(spark, sf_dir), inference_log(spark, sf_dir))


@register("batch_rules_all", f"""WITH {batch_ctes()}, faulty AS (SELECT * REPLACE (CASE WHEN row_no % 31 = 0 THEN ' ' ELSE customerID END AS customerID,
  CASE WHEN row_no % 29 = 0 THEN '0.5' ELSE TotalCharges END AS TotalCharges, CASE WHEN row_no % 29 = 0 THEN '70' ELSE MonthlyCharges END AS MonthlyCharges) FROM batch),
b AS (SELECT *, {_nid('customerID')} AS nid FROM faulty)
SELECT 'blank_id' AS rule, row_no FROM b WHERE nid IS NULL
UNION ALL SELECT 'duplicate_id', row_no FROM (SELECT row_no, count(*) OVER (PARTITION BY nid) AS k FROM b WHERE nid IS NOT NULL) WHERE k > 1
UNION ALL SELECT 'id_in_log', row_no FROM b WHERE nid IN (SELECT id FROM log)
UNION ALL SELECT 'total_lt_monthly', row_no FROM faulty WHERE {_n('TotalCharges')} < {_n('MonthlyCharges')}""")
def q_batch_rules_all(spark, sf_dir):
    """The batch with blank ids and totals below the monthly charge put in: every rule yields rows."""
    k = F.col("row_no")
    faulty = (batch(spark, sf_dir).withColumn(C.ID_COLUMN, F.when(k % 31 == 0, " ").otherwise(F.col(C.ID_COLUMN)))
              .withColumn("TotalCharges", F.when(k % 29 == 0, "0.5").otherwise(F.col("TotalCharges")))
              .withColumn("MonthlyCharges", F.when(k % 29 == 0, "70").otherwise(F.col("MonthlyCharges"))))
    return CT.batch_rules(faulty, inference_log(spark, sf_dir))


@register("existing_id_semi_join", f"""WITH {batch_ctes()}
SELECT row_no, customerID FROM batch WHERE {_nid('customerID')} IN (SELECT id FROM log)""")
def q_existing_ids(spark, sf_dir):
    return CT.existing_ids(batch(spark, sf_dir), inference_log(spark, sf_dir)).select("row_no", C.ID_COLUMN)


@register("new_id_anti_join", f"""WITH {batch_ctes()}
SELECT row_no, customerID FROM batch WHERE {_nid('customerID')} IS NOT NULL
  AND {_nid('customerID')} NOT IN (SELECT id FROM log)""")
def q_new_ids(spark, sf_dir):
    return CT.new_ids(batch(spark, sf_dir), inference_log(spark, sf_dir)).select("row_no", C.ID_COLUMN)

"""The churn view: a 21-column customer table of dirty strings derived from ``customer``
and ``orders`` (so its size follows the data). The column expressions are plain SQL
accepted by both Spark and DuckDB; the DuckDB oracle builds the same view from them.

Dirt covered: header whitespace and case (' customerID', 'GENDER'), padded values,
mixed-case yes/no, out-of-range and non-numeric numbers, blank totals, null and
fractional SeniorCitizen, exact duplicate rows and duplicate ids with other values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch.sources.tables import table

K = "c_custkey"


def _three(i: int, a: str, b: str, c: str) -> str:
    return f"CASE ({K} + {i}) % 3 WHEN 0 THEN '{a}' WHEN 1 THEN '{b}' ELSE '{c}' END"


def churn_columns(variant: str = "base") -> list[tuple[str, str]]:
    """(output name, SQL expression over customer + order total ``tot``)."""
    monthly = f"CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING)"
    if variant == "iddup":
        monthly = "'0.00'"
    return [
        (" customerID", f"CAST({K} AS STRING)"),
        ("GENDER", f"CASE WHEN {K} % 2 = 0 THEN ' Female ' ELSE 'Male' END"),
        ("SeniorCitizen",
         f"CASE WHEN {K} % 11 = 0 THEN '2' WHEN {K} % 13 = 0 THEN NULL WHEN {K} % 17 = 0 THEN '1.5' "
         f"WHEN {K} % 7 = 0 THEN '1' ELSE '0' END"),
        ("Partner", f"CASE WHEN {K} % 2 = 0 THEN 'yes' ELSE 'No' END"),
        ("Dependents", f"CASE WHEN {K} % 5 < 2 THEN 'Yes' ELSE 'no' END"),
        ("tenure",
         f"CASE WHEN {K} % 97 = 0 THEN '-3' WHEN {K} % 89 = 0 THEN 'abc' ELSE CAST({K} % 80 AS STRING) END"),
        ("PhoneService", f"CASE WHEN {K} % 6 = 0 THEN 'No' ELSE 'Yes' END"),
        ("MultipleLines", _three(1, "Yes", "No", "No phone service")),
        ("InternetService", _three(2, "DSL", "Fiber optic", "No")),
        ("OnlineSecurity", _three(3, "Yes", "No", "No internet service")),
        ("OnlineBackup", _three(4, "Yes", "No", "No internet service")),
        ("DeviceProtection", _three(5, "Yes", "No", "No internet service")),
        ("TechSupport", _three(6, "Yes", "No", "No internet service")),
        ("StreamingTV", _three(7, "Yes", "No", "No internet service")),
        ("StreamingMovies", _three(8, "Yes", "No", "No internet service")),
        ("Contract", f"CASE {K} % 3 WHEN 0 THEN 'Month-to-month' WHEN 1 THEN 'one year' ELSE 'Two year' END"),
        ("PaperlessBilling", f"CASE WHEN {K} % 3 = 0 THEN ' YES' ELSE 'No' END"),
        ("PaymentMethod",
         f"CASE {K} % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'mailed check' "
         "WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END"),
        ("MonthlyCharges", monthly),
        ("TotalCharges",
         f"CASE WHEN {K} % 19 = 0 THEN ' ' ELSE CAST(coalesce(tot, CAST(0 AS DECIMAL(18,2))) AS STRING) END"),
        ("Churn", f"CASE WHEN {K} % 4 = 1 THEN 'Yes ' ELSE 'no' END"),
    ]


# rows repeated exactly, and rows repeated with another MonthlyCharges (same id)
EXACT_DUP = f"{K} % 10 = 0"
ID_DUP = f"{K} % 45 = 0"


def churn_view(spark: SparkSession, sf_dir: str, with_row_no: bool = False) -> DataFrame:
    """The raw view; ``with_row_no`` adds a deterministic row number (key x 3 + copy index)."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    totals = o.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("tot"))
    base = c.join(totals, c.c_custkey == totals.o_custkey, "left")

    # each customer once, then its copies: the join is done a single time
    copies = F.expr(f"array_compact(array(0, CASE WHEN {EXACT_DUP} THEN 1 END, CASE WHEN {ID_DUP} THEN 2 END))")
    rows = base.select("*", F.explode(copies).alias("_copy"))
    dup = dict(churn_columns("iddup"))
    extra = [(F.col(K) * 3 + F.col("_copy")).alias("row_no")] if with_row_no else []
    return rows.select(*extra, *[
        (F.expr(e) if dup[n] == e else F.when(F.col("_copy") == 2, F.expr(dup[n])).otherwise(F.expr(e))).alias(n)
        for n, e in churn_columns("base")
    ])


def churn_view_sql(with_row_no: bool = False) -> str:
    copies = iter(range(3))

    def sel(variant: str, cond: str | None) -> str:
        cols = ", ".join(f'{e} AS "{n}"' for n, e in churn_columns(variant))
        if with_row_no:
            cols = f"{K} * 3 + {next(copies)} AS row_no, " + cols
        where = f" WHERE {cond}" if cond else ""
        return f"SELECT {cols} FROM cv_base{where}"

    return (
        "cv_tot AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS tot FROM orders GROUP BY o_custkey),\n"
        "cv_base AS (SELECT * FROM customer LEFT JOIN cv_tot ON c_custkey = o_custkey),\n"
        f"churn_raw AS ({sel('base', None)} UNION ALL {sel('base', EXACT_DUP)} UNION ALL {sel('iddup', ID_DUP)})"
    )

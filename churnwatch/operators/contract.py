"""Row contracts and batch rules as predicates: every row gets the list of rules it
breaks (an array built from ``when`` expressions), batch rules use a window count on
the key and a semi-join with the log. Nothing is checked row by row in Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.functions.scalar import strip_ws, to_number

INT_PATTERN = r"^[+-]?[0-9]+$"


def _text(c: str) -> Column:
    return strip_ws(F.col(c).cast("string"))


def contract_rules(columns: list[str]) -> list[tuple[str, Column]]:
    """(rule name, violated?) for the scoring-input contract, given the batch's columns."""
    rules: list[tuple[str, Column]] = []
    for extra in [c for c in columns if c not in C.FEATURE_COLUMNS]:
        rules.append((f"extra:{extra}", F.lit(True)))
    for c in C.FEATURE_COLUMNS:
        if c not in columns:
            rules.append((f"{c}:required", F.lit(True)))
            continue
        t = _text(c)
        missing = F.col(c).isNull() | (t == "")
        rules.append((f"{c}:required", missing))
        if c in C.DOMAINS:
            rules.append((f"{c}:allowed", ~missing & ~t.isin(C.DOMAINS[c])))
        elif c in ("SeniorCitizen", "tenure"):
            is_int = t.rlike(INT_PATTERN)
            rules.append((f"{c}:integer", ~missing & ~is_int))
            v = t.try_cast("long")
            if c == "SeniorCitizen":
                rules.append((f"{c}:range", is_int & ((v < 0) | (v > 1))))
            else:
                rules.append((f"{c}:range", is_int & (v < 0)))
        elif c in ("MonthlyCharges", "TotalCharges"):
            x = to_number(F.col(c))
            rules.append((f"{c}:number", ~missing & x.isNull()))
            rules.append((f"{c}:range", x < 0))
    if "MonthlyCharges" in columns and "TotalCharges" in columns:
        rules.append(("TotalCharges:lt_monthly", to_number(F.col("TotalCharges")) < to_number(F.col("MonthlyCharges"))))
    return rules


def with_violations(df: DataFrame, rules: list[tuple[str, Column]], out: str = "violations") -> DataFrame:
    flags = [F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules]
    return df.withColumn(out, F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>"))


def contract_check(df: DataFrame, keys: tuple[str, ...] = ("row_no",)) -> DataFrame:
    """Adds ``violations`` (array of broken rule names) and ``accepted`` (no violation).
    ``keys`` are bookkeeping columns, not part of the payload."""
    v = with_violations(df, contract_rules([c for c in df.columns if c not in keys]))
    return v.withColumn("accepted", F.size("violations") == 0)


def violations_long(checked: DataFrame, key: str = "row_no", col: str = "violations") -> DataFrame:
    return checked.select(key, F.explode(col).alias("rule"))


def result_rules() -> list[tuple[str, Column]]:
    p, t, y = F.col("churn_probability"), F.col("threshold"), F.col("prediction")
    return [
        ("churn_probability:range", p.isNull() | (p < 0) | (p > 1)),
        ("threshold:range", t.isNull() | (t < 0) | (t > 1)),
        ("prediction:allowed", y.isNull() | ~y.isin(0, 1)),
        ("model_name:required", F.col("model_name").isNull()),
    ]


def result_contract(scored: DataFrame) -> DataFrame:
    return with_violations(scored, result_rules()).withColumn("accepted", F.size("violations") == 0)


# ---------------------------------------------------------------------------
# batch rules and the id joins
# ---------------------------------------------------------------------------
def norm_id(c: str | Column) -> Column:
    """Identifier as compared everywhere: stripped and case-folded; blank -> NULL."""
    x = F.lower(strip_ws((F.col(c) if isinstance(c, str) else c).cast("string")))
    return F.when(x != "", x)


def existing_ids(batch: DataFrame, log: DataFrame, key: str = C.ID_COLUMN, log_key: str = C.ID_COLUMN) -> DataFrame:
    """Rows of ``batch`` whose normalised id is already in ``log`` (left semi-join)."""
    ids = log.select(norm_id(log_key).alias("_id")).where(F.col("_id").isNotNull())
    return batch.withColumn("_id", norm_id(key)).join(ids, "_id", "left_semi").drop("_id")


def new_ids(batch: DataFrame, log: DataFrame, key: str = C.ID_COLUMN, log_key: str = C.ID_COLUMN) -> DataFrame:
    """Rows of ``batch`` allowed to be scored: id not blank and not yet logged (left anti-join)."""
    ids = log.select(norm_id(log_key).alias("_id")).where(F.col("_id").isNotNull())
    b = batch.withColumn("_id", norm_id(key))
    return b.where(F.col("_id").isNotNull()).join(ids, "_id", "left_anti").drop("_id")


def batch_rules(batch: DataFrame, log: DataFrame, key: str = C.ID_COLUMN, row_no: str = "row_no",
                log_key: str = C.ID_COLUMN) -> DataFrame:
    """(rule, row_no): blank id, duplicate id inside the batch (all occurrences), id already
    in the log, TotalCharges < MonthlyCharges (NULLs pass)."""
    b = batch.withColumn("_id", norm_id(key))
    blank = b.where(F.col("_id").isNull()).select(F.lit("blank_id").alias("rule"), row_no)
    # ids seen more than once: map-side partial counts, so a hot id never lands whole in one task
    repeated = b.where(F.col("_id").isNotNull()).groupBy("_id").count().where(F.col("count") > 1).select("_id")
    dup = b.join(repeated, "_id", "left_semi").select(F.lit("duplicate_id").alias("rule"), row_no)
    logged = existing_ids(batch, log, key, log_key).select(F.lit("id_in_log").alias("rule"), row_no)
    total, monthly = to_number(F.col("TotalCharges")), to_number(F.col("MonthlyCharges"))
    lt = batch.where(F.coalesce(total < monthly, F.lit(False))).select(F.lit("total_lt_monthly").alias("rule"), row_no)
    return blank.unionByName(dup).unionByName(logged).unionByName(lt)

"""Cleaning-family queries over the churn view (built from customer + orders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.functions.scalar import NUMBER_PATTERN
from churnwatch.operators import clean as CL
from churnwatch.plans.registry import register
from churnwatch.sources import churn as CH
from churnwatch.sources import files
from churnwatch.sources import tables as S
from churnwatch.streaming.log_stream import work_dir

# ---------------------------------------------------------------------------
# DuckDB text of the same chain, written column by column from the definitions
# ---------------------------------------------------------------------------
RAW = [n for n, _ in CH.churn_columns()]
CANON = {" customerID": "customerID", "GENDER": "gender"}
NAMED = [CANON.get(n, n) for n in RAW]


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _num(x: str) -> str:
    t = _strip(f"CAST({x} AS VARCHAR)")
    return f"(CASE WHEN regexp_matches({t}, '{NUMBER_PATTERN}') THEN TRY_CAST({t} AS DOUBLE) END)"


def _casted(c: str) -> str:
    if c == "TotalCharges":
        return f"coalesce({_num(c)}, 0.0)"
    if c == "SeniorCitizen":
        return f"CAST(round_even(coalesce({_num(c)}, 0.0), 0) AS INTEGER)"
    if c in C.NUMERIC_CANDIDATES:
        return _num(c)
    return c


def _clipped(c: str) -> str:
    if c == "SeniorCitizen":
        return "CASE WHEN SeniorCitizen < 0 THEN 0 WHEN SeniorCitizen > 1 THEN 1 ELSE SeniorCitizen END"
    if c in C.SANITY_BOUNDS:
        return f"CASE WHEN {c} < 0 THEN 0.0 ELSE {c} END"
    return c


LABEL_SQL = ("CASE lower(Churn) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 WHEN '0' THEN 0 WHEN '1' THEN 1 END")
FINAL = [c for c in NAMED if c != "Churn"] + [C.TARGET_COLUMN]


def chain_ctes() -> str:
    named = ", ".join(f'"{r}" AS "{n}"' for r, n in zip(RAW, NAMED))
    trimmed = ", ".join(f'{_strip(chr(34) + n + chr(34))} AS "{n}"' for n in NAMED)
    casted = ", ".join(f'{_casted(n)} AS "{n}"' for n in NAMED)
    clipped = ", ".join(f'{_clipped(n)} AS "{n}"' for n in NAMED)
    labelled = ", ".join([f'"{n}"' for n in NAMED if n != "Churn"] + [f"CAST({LABEL_SQL} AS INTEGER) AS churn_status"])
    return f"""{CH.churn_view_sql()},
named AS (SELECT {named} FROM churn_raw),
trimmed AS (SELECT {trimmed} FROM named),
deduped AS (SELECT DISTINCT * FROM trimmed),
casted AS (SELECT {casted} FROM deduped),
clipped AS (SELECT {clipped} FROM casted),
cleaned AS (SELECT {labelled} FROM clipped)"""


def _w(body: str) -> str:
    return f"WITH {chain_ctes()}\n{body}"


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CH.churn_view(spark, sf_dir)


def _named(spark, sf_dir):
    return CL.trim_strings(CL.canonical_columns(_view(spark, sf_dir)))


# ---------------------------------------------------------------------------
# scans and checks
# ---------------------------------------------------------------------------
def scan_checked(df: DataFrame, required: list[str] = C.RAW_REQUIRED_COLUMNS) -> DataFrame:
    """Trim header names and fail listing the required columns that are missing."""
    return files.check_header(df, required)


@register(
    "scan_checked",
    f"WITH {CH.churn_view_sql()} SELECT " + ", ".join(f'"{r}" AS "{r.strip() if r != "GENDER" else "gender"}"' for r in RAW)
    + " FROM churn_raw",
)
def q_scan_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the header of the raw view is 'GENDER'; this scan reads it under a padded lower-case header
    v = _view(spark, sf_dir).withColumnRenamed("GENDER", "gender ")
    return scan_checked(v)


@register("csv_round_trip", _w("SELECT * FROM cleaned"))
def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw view written as CSV, scanned with all columns text and a checked header, then cleaned."""
    path = work_dir(spark, "churn-csv")
    files.write_csv(_view(spark, sf_dir), path)
    cleaned, _ = CL.clean_table(files.read_csv(spark, path, ["customerID", "tenure"]), strict_schema=True, require_target=True)
    return cleaned


def table_minimum_check(df: DataFrame, name: str) -> DataFrame:
    """One row: table, n_columns, has_rows (a 1-row probe, not a count), passed."""
    probe = df.limit(1).agg(F.count("*").alias("n"))
    return probe.select(
        F.lit(name).alias("table_name"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        (F.col("n") > 0).alias("has_rows"),
        ((F.col("n") > 0) & F.lit(len(df.columns) >= 2)).alias("passed"),
    )


_MIN_TABLES = ["customer", "orders", "lineitem", "events", "part", "supplier", "nation", "region"]


@register(
    "table_minimum_check",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM duckdb_columns() WHERE table_name = '{t}') AS n_columns, "
        f"(SELECT count(*) FROM (SELECT 1 FROM {t} LIMIT 1)) > 0 AS has_rows, "
        f"(SELECT count(*) FROM (SELECT 1 FROM {t} LIMIT 1)) > 0 AND "
        f"(SELECT count(*) FROM duckdb_columns() WHERE table_name = '{t}') >= 2 AS passed"
        for t in _MIN_TABLES
    ),
)
def q_table_minimum_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for t in _MIN_TABLES:
        one = table_minimum_check(S.table(spark, sf_dir, t), t)
        out = one if out is None else out.unionByName(one)
    return out


@register("row_count", "SELECT count(*) AS rows FROM events")
def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "events").agg(F.count("*").alias("rows"))


# ---------------------------------------------------------------------------
# column operators
# ---------------------------------------------------------------------------
@register("canonical_columns", _w("SELECT * FROM named"))
def q_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.canonical_columns(_view(spark, sf_dir))


@register("trim_strings", _w("SELECT * FROM trimmed"))
def q_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir)


@register("dedupe_rows", _w("SELECT * FROM deduped"))
def q_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).dropDuplicates()


@register("coerce_numeric", _w("SELECT * FROM casted"))
def q_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.numeric_casts(_named(spark, sf_dir).dropDuplicates())


@register("clip_bounds", _w("SELECT * FROM clipped"))
def q_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.clip_bounds(CL.numeric_casts(_named(spark, sf_dir).dropDuplicates()))


@register("encode_label", _w("SELECT * FROM cleaned"))
def q_encode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.encode_label(CL.clip_bounds(CL.numeric_casts(_named(spark, sf_dir).dropDuplicates())))


@register("clean_table", _w("SELECT * FROM cleaned"))
def q_clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, _ = CL.clean_table(_view(spark, sf_dir), strict_schema=True, require_target=True)
    return cleaned


def _report_sql() -> str:
    parts = ["SELECT 'customerID_duplicates' AS item, '' AS \"column\", "
             "count(*) - count(DISTINCT customerID) - coalesce(max(CASE WHEN customerID IS NULL THEN 1 ELSE 0 END), 0) "
             "AS value FROM deduped"]
    for c in C.NUMERIC_CANDIDATES:
        parts.append(f"SELECT 'invalid_casts', '{c}', count(*) FILTER (WHERE {c} IS NOT NULL AND {_num(c)} IS NULL) "
                     "FROM deduped")
    parts.append(f"SELECT 'TotalCharges_filled_with_zero', '', count(*) FILTER (WHERE {_num('TotalCharges')} IS NULL) "
                 "FROM deduped")
    for c, (lo, hi) in C.SANITY_BOUNDS.items():
        cond = " OR ".join(x for x in [f"{c} < {lo}" if lo is not None else "", f"{c} > {hi}" if hi is not None else ""] if x)
        parts.append(f"SELECT 'sanity_clipped', '{c}', count(*) FILTER (WHERE {cond}) FROM casted")
    for c in FINAL:
        parts.append(f"SELECT 'remaining_missing', '{c}', count(*) FILTER (WHERE \"{c}\" IS NULL) FROM cleaned "
                     f"HAVING count(*) FILTER (WHERE \"{c}\" IS NULL) > 0")
    parts.append("SELECT 'duplicates_removed', '', (SELECT count(*) FROM trimmed) - (SELECT count(*) FROM deduped)")
    parts.append("SELECT 'target_source_column', 'Churn', 1")
    return _w("SELECT item, \"column\", CAST(value AS BIGINT) AS value FROM (" + " UNION ALL ".join(parts) + ")")


@register("clean_report", _report_sql())
def q_clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = CL.clean_table(_view(spark, sf_dir), strict_schema=True, require_target=True)
    return report


@register("clean_reference", _w("SELECT * EXCLUDE (customerID) FROM cleaned"))
def q_clean_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, _ = CL.clean_reference(_view(spark, sf_dir))
    return cleaned


@register("clean_current", _w("SELECT * EXCLUDE (customerID, churn_status) FROM cleaned"))
def q_clean_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, _ = CL.clean_current(_view(spark, sf_dir).drop("Churn"))
    return cleaned


@register("drop_columns", _w("SELECT * EXCLUDE (customerID, Contract) FROM cleaned"))
def q_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, _ = CL.clean_table(_view(spark, sf_dir))
    out, _ = CL.drop_columns(cleaned, ["customerID", "Contract", "not_there"])
    return out


ALIGN_TO = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen", "is_monthly_contract", "service_yes_count"]


@register("align_columns", _w(
    "SELECT tenure, MonthlyCharges, TotalCharges, SeniorCitizen, 0 AS is_monthly_contract, 0 AS service_yes_count "
    "FROM cleaned"))
def q_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, _ = CL.clean_table(_view(spark, sf_dir))
    return CL.align_columns(cleaned, ALIGN_TO)


@register("duplicate_key_count", _w(
    "SELECT CAST(count(*) - count(DISTINCT customerID) - max(CASE WHEN customerID IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
    " AS n FROM deduped"))
def q_dup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.duplicate_key_count(_named(spark, sf_dir).dropDuplicates())


@register("duplicate_row_count", _w("SELECT (SELECT count(*) FROM churn_raw) - (SELECT count(*) FROM (SELECT DISTINCT * "
                                    "FROM churn_raw)) AS n"))
def q_dup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.duplicate_row_count(_view(spark, sf_dir))


_SOME_NULL_IDS = "CASE WHEN CAST(customerID AS BIGINT) % 50 = 0 THEN NULL ELSE customerID END"


def _with_null_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows, exact and id duplicates included, with every fiftieth id NULL."""
    return _named(spark, sf_dir).withColumn("customerID", F.when(F.col("customerID").cast("long") % 50 != 0, F.col("customerID")))


@register("keep_first_duplicates", _w(
    f"SELECT id AS customerID, row_number() OVER (PARTITION BY id ORDER BY MonthlyCharges, TotalCharges) > 1 AS is_duplicate "
    f"FROM (SELECT *, {_SOME_NULL_IDS} AS id FROM trimmed)"))
def q_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _with_null_ids(spark, sf_dir)
    return CL.keep_first_duplicates(d, "customerID", ["MonthlyCharges", "TotalCharges"]).select(
        "customerID", "is_duplicate")


@register("flag_all_duplicates", _w(
    f"SELECT id AS customerID, count(*) OVER (PARTITION BY id) > 1 AS is_duplicate FROM (SELECT {_SOME_NULL_IDS} AS id FROM trimmed)"))
def q_flag_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _with_null_ids(spark, sf_dir)
    return CL.flag_all_duplicates(d, "customerID").select("customerID", "is_duplicate")


@register("null_counts", f"WITH {CH.churn_view_sql()} SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{r}' AS \"column\", count(*) FILTER (WHERE \"{r}\" IS NULL) AS nulls FROM churn_raw" for r in RAW
) + ") WHERE nulls > 0")
def q_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.null_counts(_view(spark, sf_dir))

"""Feature, split and fitted-preprocessing queries over the cleaned churn view."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch import config as C
from churnwatch.functions.scalar import is_yes, rnd
from churnwatch.operators import categories as CG
from churnwatch.operators import clean as CL
from churnwatch.operators import features as FE
from churnwatch.plans import clean_plans as CP
from churnwatch.plans.registry import register
from churnwatch.session import cut_lineage
from churnwatch.sources import churn as CH

KEY = "row_key"
SEED_VALIDATION = 7


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned churn table, written once: the split, threshold and fit passes all read it."""
    c, _ = CL.clean_table(CH.churn_view(spark, sf_dir), strict_schema=True, require_target=True)
    return cut_lineage(c, "cleaned")


def split_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.stratified_assign(cleaned(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows with split flag, engineered features and the id kept as ``row_key``;
    written once because fitting reads it several times."""
    s = split_cleaned(spark, sf_dir).withColumn(KEY, F.col(C.ID_COLUMN))
    ft, _ = FE.feature_table(s)
    return cut_lineage(ft, "features")


def fitted(spark: SparkSession, sf_dir: str, kind: str):
    ft = features(spark, sf_dir)
    train = ft.where(F.col(C.SPLIT_COLUMN) == "train").drop(KEY)
    return ft, FE.fit_preprocessor(train, kind)


def encoder(spark: SparkSession, sf_dir: str, kind: str):
    ft = features(spark, sf_dir)
    return ft, CG.fit_encoder(ft.where(F.col(C.SPLIT_COLUMN) == "train").drop(KEY), kind)


def long_encoded(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    ft, enc = encoder(spark, sf_dir, kind)
    return enc.long(ft, [KEY, C.TARGET_COLUMN, C.SPLIT_COLUMN]).select(KEY, "column", rnd(F.col("value")).alias("value"), C.TARGET_COLUMN, C.SPLIT_COLUMN)


# ---------------------------------------------------------------------------
# SQL side
# ---------------------------------------------------------------------------
def _strip(x: str) -> str:
    return CP._strip(x)


def _yes(c: str) -> str:
    return f"CASE WHEN lower({_strip(c)}) = 'yes' THEN 1 ELSE 0 END"


def _quantile_sql(src: str, col: str, q: float) -> str:
    """NumPy-linear quantile of a column as a scalar subquery."""
    return f"""(SELECT CASE WHEN max(n) IS NULL THEN 0.0 ELSE
    (CASE WHEN max(g) >= 0.5 THEN max(b) - (max(b) - max(a)) * (1.0 - max(g)) ELSE max(a) + (max(b) - max(a)) * max(g) END)
  END FROM (
  SELECT n, g, max(v) FILTER (WHERE rn = lo + 1) AS a, max(v) FILTER (WHERE rn = hi + 1) AS b FROM (
    SELECT v, rn, n,
      CASE WHEN (n - 1) * {q!r} >= n - 1 THEN n - 1 ELSE CAST(floor((n - 1) * {q!r}) AS BIGINT) END AS lo,
      CASE WHEN (n - 1) * {q!r} >= n - 1 THEN n - 1 ELSE CAST(floor((n - 1) * {q!r}) AS BIGINT) + 1 END AS hi,
      CASE WHEN (n - 1) * {q!r} >= n - 1 THEN 0.0 ELSE (n - 1) * {q!r} - floor((n - 1) * {q!r}) END AS g
    FROM (SELECT CAST({col} AS DOUBLE) AS v, row_number() OVER (ORDER BY CAST({col} AS DOUBLE)) AS rn,
                 count(*) OVER () AS n FROM {src} WHERE {col} IS NOT NULL))
  GROUP BY n, g))"""


def _median_sql(src: str, col: str) -> str:
    return f"""(SELECT CASE WHEN max(n) % 2 = 1 THEN max(v) FILTER (WHERE rn = n // 2 + 1)
  ELSE (max(v) FILTER (WHERE rn = n // 2) + max(v) FILTER (WHERE rn = n // 2 + 1)) / 2 END
  FROM (SELECT CAST({col} AS DOUBLE) AS v, row_number() OVER (ORDER BY CAST({col} AS DOUBLE)) AS rn,
               count(*) OVER () AS n FROM {src} WHERE {col} IS NOT NULL))"""


def _mode_sql(src: str, col: str) -> str:
    return f"(SELECT v FROM (SELECT {col} AS v, count(*) AS k FROM {src} WHERE {col} IS NOT NULL GROUP BY {col}) " \
           "ORDER BY k DESC, v LIMIT 1)"


FEATURE_BASE = [c for c in CP.FINAL if c not in ("customerID", "Contract")]
SERVICE = C.SERVICE_COLUMNS
NUMERIC = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges", "is_monthly_contract", "is_electronic_check",
           "has_security", "has_techsupport", "high_monthly_charge", "service_yes_count",
           "high_monthly_charge_x_is_monthly_contract"]
BINARY = ["Partner", "Dependents", "PhoneService", "PaperlessBilling"]
ONEHOT = ["gender", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
          "TechSupport", "StreamingTV", "StreamingMovies", "PaymentMethod", "tenure_group"]


def feature_ctes() -> str:
    b, lab = C.TENURE_BINS, C.TENURE_LABELS
    tg = f"CASE WHEN t >= {b[0]} AND t <= {b[1]} THEN '{lab[0]}' " + " ".join(
        f"WHEN t > {b[i]} AND t <= {b[i + 1]} THEN '{lab[i]}'" for i in range(1, len(lab))) + " END"
    other = ", ".join(f'"{c}"' for c in FEATURE_BASE if c != "tenure")
    svc = " + ".join(_yes(c) for c in SERVICE)
    return f"""{CP.chain_ctes()},
hashed AS (SELECT *, ('0x' || substr(md5(CAST(customerID AS VARCHAR) || '|{C.RANDOM_STATE}'), 1, 13))::BIGINT AS h
  FROM cleaned),
classes AS (SELECT churn_status, count(*) AS n FROM cleaned GROUP BY churn_status),
strat AS (SELECT count(*) > 1 AND min(n) >= 2 AS ok FROM classes),
ranked AS (
  SELECT hashed.*, row_number() OVER (PARTITION BY CASE WHEN (SELECT ok FROM strat) THEN churn_status END ORDER BY h)
    AS rk,
    count(*) OVER (PARTITION BY CASE WHEN (SELECT ok FROM strat) THEN churn_status END) AS grp_n
  FROM hashed),
splitted AS (
  SELECT * EXCLUDE (h, rk, grp_n),
    CASE WHEN rk <= round_even({C.TEST_SIZE!r} * grp_n, 0) THEN 'test' ELSE 'train' END AS data_split
  FROM ranked),
fe0 AS (
  SELECT customerID AS row_key, {other}, data_split,
    coalesce(tenure, 0.0) AS tenure,
    CASE WHEN lower({_strip('Contract')}) = 'month-to-month' THEN 1 ELSE 0 END AS is_monthly_contract,
    CASE WHEN lower({_strip('PaymentMethod')}) = 'electronic check' THEN 1 ELSE 0 END AS is_electronic_check,
    {_yes('OnlineSecurity')} AS has_security,
    {_yes('TechSupport')} AS has_techsupport,
    CASE WHEN MonthlyCharges >= {_quantile_sql('splitted', 'MonthlyCharges', C.HIGH_CHARGE_QUANTILE)} THEN 1 ELSE 0 END
      AS high_monthly_charge,
    {svc} AS service_yes_count
  FROM splitted),
fe AS (
  SELECT *, (SELECT {tg} FROM (SELECT fe0.tenure AS t)) AS tenure_group,
    high_monthly_charge * is_monthly_contract AS high_monthly_charge_x_is_monthly_contract
  FROM fe0),
train AS (SELECT * FROM fe WHERE data_split = 'train')"""


def tree_long_sql(kind: str = "tree") -> str:
    parts = []
    if kind == "tree":
        for c in NUMERIC:
            parts.append(f"SELECT row_key, '{c}' AS \"column\", coalesce(CAST({c} AS DOUBLE), "
                         f"{_median_sql('train', c)}) AS value, churn_status, data_split FROM fe")
    else:
        for c in NUMERIC:
            if c in C.LINEAR_SCALE_COLUMNS:
                filled = f"coalesce(CAST({c} AS DOUBLE), {_median_sql('train', c)})"
                stats = (f"(SELECT avg(x) FROM (SELECT coalesce(CAST({c} AS DOUBLE), {_median_sql('train', c)}) AS x "
                         f"FROM train))")
                sd = (f"(SELECT CASE WHEN stddev_pop(x) = 0 OR stddev_pop(x) IS NULL THEN 1.0 ELSE stddev_pop(x) END "
                      f"FROM (SELECT coalesce(CAST({c} AS DOUBLE), {_median_sql('train', c)}) AS x FROM train))")
                parts.append(f"SELECT row_key, '{c}' AS \"column\", ({filled} - {stats}) / {sd} AS value, churn_status, "
                             "data_split FROM fe")
            else:
                parts.append(f"SELECT row_key, '{c}' AS \"column\", coalesce(CAST({c} AS DOUBLE), "
                             f"CAST({_mode_sql('train', c)} AS DOUBLE)) AS value, churn_status, data_split FROM fe")
    for c in BINARY:
        mode = _mode_sql("train", c)
        parts.append(
            f"SELECT fe.row_key, '{c}', coalesce((SELECT CAST(count(*) AS DOUBLE) FROM "
            f"(SELECT DISTINCT coalesce({c}, {mode}) AS v FROM train) cats WHERE cats.v < coalesce(fe.{c}, {mode}) "
            f"HAVING bool_or(true) OR true) * CASE WHEN coalesce(fe.{c}, {mode}) IN "
            f"(SELECT coalesce({c}, {mode}) FROM train) THEN 1 END, -1.0), churn_status, data_split FROM fe")
    for c in ONEHOT:
        parts.append(
            f"SELECT fe.row_key, '{c}_' || cats.v, CASE WHEN coalesce(fe.{c}, 'missing') = cats.v THEN 1.0 ELSE 0.0 END, "
            f"churn_status, data_split FROM fe CROSS JOIN (SELECT DISTINCT coalesce({c}, 'missing') AS v FROM train) cats")
    body = " UNION ALL ".join(parts)
    return f"""WITH {feature_ctes()}
SELECT row_key, "column", round(value, 9) AS value, churn_status, data_split FROM ({body})"""


def _w(body: str) -> str:
    return f"WITH {feature_ctes()}\n{body}"


# ---------------------------------------------------------------------------
# registered queries
# ---------------------------------------------------------------------------
FLAG_COLS = ["is_monthly_contract", "is_electronic_check", "has_security", "has_techsupport"]


@register("feature_flags", _w("SELECT row_key, " + ", ".join(FLAG_COLS) + " FROM fe"))
def q_feature_flags(spark, sf_dir):
    c = cleaned(spark, sf_dir).withColumn(KEY, F.col(C.ID_COLUMN))
    return FE.feature_flags(c).select(KEY, *FLAG_COLS)


@register("quantile_threshold", _w(
    f"SELECT round({_quantile_sql('splitted', 'MonthlyCharges', C.HIGH_CHARGE_QUANTILE)}, 9) AS threshold"))
def q_quantile_threshold(spark, sf_dir):
    t = FE.high_charge_threshold(cleaned(spark, sf_dir))
    return cleaned(spark, sf_dir).agg(F.lit(t).alias("t")).select(rnd(F.col("t")).alias("threshold"))


@register("high_charge_flag", _w("SELECT row_key, MonthlyCharges, high_monthly_charge FROM fe"))
def q_high_charge(spark, sf_dir):
    c = cleaned(spark, sf_dir).withColumn(KEY, F.col(C.ID_COLUMN))
    return FE.high_charge_flag(c).select(KEY, "MonthlyCharges", "high_monthly_charge")


@register("tenure_bucket", _w("SELECT row_key, tenure, tenure_group FROM fe"))
def q_tenure_bucket(spark, sf_dir):
    c = cleaned(spark, sf_dir).withColumn(KEY, F.col(C.ID_COLUMN))
    return FE.tenure_bucket(c).select(KEY, "tenure", "tenure_group")


@register("service_count", _w("SELECT row_key, service_yes_count FROM fe"))
def q_service_count(spark, sf_dir):
    c = cleaned(spark, sf_dir).withColumn(KEY, F.col(C.ID_COLUMN))
    return FE.service_count(c).select(KEY, "service_yes_count")


@register("interaction", _w("SELECT row_key, high_monthly_charge_x_is_monthly_contract FROM fe"))
def q_interaction(spark, sf_dir):
    c = cleaned(spark, sf_dir).withColumn(KEY, F.col(C.ID_COLUMN))
    ft, _ = FE.feature_table(c)
    return ft.select(KEY, "high_monthly_charge_x_is_monthly_contract")


@register("feature_table", _w("SELECT * EXCLUDE (data_split) FROM fe"))
def q_feature_table(spark, sf_dir):
    c = cleaned(spark, sf_dir).withColumn(KEY, F.col(C.ID_COLUMN))
    ft, _ = FE.feature_table(c)
    return ft


@register("predicate_yes", _w(f"SELECT customerID, PhoneService, {_yes('PhoneService')} AS is_yes FROM cleaned"))
def q_predicate_yes(spark, sf_dir):
    return cleaned(spark, sf_dir).select(C.ID_COLUMN, "PhoneService", is_yes("PhoneService").alias("is_yes"))


@register("is_binary_column", _w(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) > 0 AND count(*) FILTER (WHERE {c} IS NOT NULL AND lower({_strip(c)}) "
    f"NOT IN ('yes', 'no')) = 0 AS is_binary FROM fe" for c in BINARY + ONEHOT)))
def q_is_binary(spark, sf_dir):
    ft = features(spark, sf_dir)
    cands = BINARY + ONEHOT
    binary = set(FE.binary_columns(ft, cands))
    return ft.agg(F.count("*").alias("n")).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(c in binary).alias("is_binary")) for c in cands]))
        .alias("s")).select("s.column", "s.is_binary")


@register("stratified_assign", _w("SELECT customerID, churn_status, data_split FROM splitted"))
def q_stratified_assign(spark, sf_dir):
    return split_cleaned(spark, sf_dir).select(C.ID_COLUMN, C.TARGET_COLUMN, C.SPLIT_COLUMN)


@register("split_filter", _w(
    "SELECT data_split, count(*) AS rows, count(*) FILTER (WHERE churn_status = 1) AS positives FROM splitted "
    "GROUP BY data_split"))
def q_split_filter(spark, sf_dir):
    s = split_cleaned(spark, sf_dir)
    out = None
    for name, part in FE.split_filter(s).items():
        one = part.agg(F.lit(name).alias("data_split"), F.count("*").alias("rows"),
                       F.count_if(F.col(C.TARGET_COLUMN) == 1).alias("positives"))
        out = one if out is None else out.unionByName(one)
    return out


@register("validation_split", _w(f"""SELECT customerID, churn_status,
  CASE WHEN row_number() OVER (PARTITION BY churn_status ORDER BY
    ('0x' || substr(md5(CAST(customerID AS VARCHAR) || '|{SEED_VALIDATION}'), 1, 13))::BIGINT)
    <= round_even({C.TEST_SIZE!r} * count(*) OVER (PARTITION BY churn_status), 0) THEN 'validation' ELSE 'train' END
  AS fit_split
FROM splitted WHERE data_split = 'train'"""))
def q_validation_split(spark, sf_dir):
    train = split_cleaned(spark, sf_dir).where(F.col(C.SPLIT_COLUMN) == "train")
    v = FE.stratified_assign(train, seed=SEED_VALIDATION, out_col="fit_split", names=("train", "validation"))
    return v.select(C.ID_COLUMN, C.TARGET_COLUMN, "fit_split")


@register("stratified_folds", _w(
    "SELECT customerID, CAST((rank() OVER (PARTITION BY churn_status ORDER BY "
    f"('0x' || substr(md5(CAST(customerID AS VARCHAR) || '|{C.RANDOM_STATE}'), 1, 13))::BIGINT) - 1) % 5 AS INTEGER) AS fold FROM cleaned"))
def q_stratified_folds(spark, sf_dir):
    return FE.stratified_folds(cleaned(spark, sf_dir)).select(C.ID_COLUMN, "fold")


@register("impute_median", _w(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round({_median_sql('train', c)}, 9) AS median" for c in NUMERIC)))
def q_impute_median(spark, sf_dir):
    ft, pre = fitted(spark, sf_dir, "tree")
    rows = [(c, float(v) if v is not None else None) for c, v in pre.medians.items()]
    return _param_table(ft, rows, "median")


@register("impute_mode", _w(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({_mode_sql('train', c)} AS VARCHAR) AS mode"
    for c in [n for n in NUMERIC if n not in C.LINEAR_SCALE_COLUMNS] + BINARY)))
def q_impute_mode(spark, sf_dir):
    ft, pre = fitted(spark, sf_dir, "linear")
    rows = [(c, None if v is None else (str(int(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) and
                                         float(v).is_integer() else str(v))) for c, v in pre.modes.items()]
    return _param_table(ft, rows, "mode", "string")


@register("impute_constant", _w(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS filled FROM fe" for c in ONEHOT)))
def q_impute_constant(spark, sf_dir):
    ft = features(spark, sf_dir)
    return ft.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ONEHOT]).select(
        F.stack(F.lit(len(ONEHOT)), *[x for c in ONEHOT for x in (F.lit(c), F.col(c))]).alias("column", "filled"))


@register("scale_standard", _w(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(x), 9) AS mean, "
    f"round(CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END, 9) AS scale "
    f"FROM (SELECT coalesce(CAST({c} AS DOUBLE), {_median_sql('train', c)}) AS x FROM train)"
    for c in [n for n in NUMERIC if n in C.LINEAR_SCALE_COLUMNS])))
def q_scale_standard(spark, sf_dir):
    ft, pre = fitted(spark, sf_dir, "linear")
    rows = [(c, pre.means[c], pre.scales[c]) for c in pre.scaled]
    # fitted parameters (computed over the whole train table): one row per scaled column
    return ft.sparkSession.createDataFrame(rows, "column string, mean double, scale double").select(
        "column", rnd(F.col("mean")).alias("mean"), rnd(F.col("scale")).alias("scale"))


@register("encode_ordinal", _w(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", v AS category, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code "
    f"FROM (SELECT DISTINCT coalesce({c}, {_mode_sql('train', c)}) AS v FROM train)" for c in BINARY)))
def q_encode_ordinal(spark, sf_dir):
    _, enc = encoder(spark, sf_dir, "tree")
    return enc.categories.where(F.col("column").isin(enc.pre.binary)).select("column", "category", "code")


@register("encode_onehot", _w(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", v AS category, '{c}_' || v AS output_column "
    f"FROM (SELECT DISTINCT coalesce({c}, 'missing') AS v FROM train)" for c in ONEHOT)))
def q_encode_onehot(spark, sf_dir):
    _, enc = encoder(spark, sf_dir, "tree")
    return enc.categories.where(F.col("column").isin(enc.pre.onehot)).select("column", "category", F.concat_ws("_", "column", "category").alias("output_column"))


@register("tree_table", tree_long_sql("tree"))
def q_tree_table(spark, sf_dir):
    return long_encoded(spark, sf_dir, "tree")


@register("linear_table", tree_long_sql("linear"))
def q_linear_table(spark, sf_dir):
    return long_encoded(spark, sf_dir, "linear")


@register("model_ready_output", f"""SELECT data_split, "column", count(*) AS rows, round(sum(value), 2) AS total
FROM ({tree_long_sql('tree')}) GROUP BY data_split, "column\"""")
def q_model_ready(spark, sf_dir):
    lg = long_encoded(spark, sf_dir, "tree")
    return lg.groupBy(C.SPLIT_COLUMN, "column").agg(F.count("*").alias("rows"), F.round(F.sum("value"), 2).alias("total"))


def _param_table(ft: DataFrame, rows: list[tuple], name: str, typ: str = "double") -> DataFrame:
    """Fitted parameters (computed over the whole train table) as a frame, one row per column."""
    out = ft.sparkSession.createDataFrame(rows, f"column string, {name} {typ}")
    return out.select("column", rnd(F.col(name)).alias(name)) if typ == "double" else out


@register("encode_vectors", f"""WITH l AS ({tree_long_sql('tree')})
SELECT row_key, round(sum(value), 6) AS total, count(*) FILTER (WHERE value <> 0) AS non_zero, count(*) AS width FROM l GROUP BY row_key""")
def q_encode_vectors(spark, sf_dir):
    """The encoded rows as sparse vectors, read back: sum, places that are not zero, and width."""
    ft, enc = encoder(spark, sf_dir, "tree")
    v = enc.vectors(ft, [KEY])
    dense = vector_to_array("features")
    return v.groupBy(KEY).agg(  # rows of one key together
        F.round(F.sum(F.aggregate(dense, F.lit(0.0), lambda a, x: a + x)), 6).alias("total"),
        F.sum(F.size(F.filter(dense, lambda x: x != 0))).alias("non_zero"), F.sum(F.size(dense)).alias("width"))

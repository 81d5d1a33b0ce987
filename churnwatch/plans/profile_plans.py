"""Profile queries (null profile, describe, frequencies, class balance, group means,
correlations, crosstab, histogram) over the driver tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from churnwatch.functions.scalar import rnd
from churnwatch.operators import profile as P
from churnwatch.plans import clean_plans as CP
from churnwatch.plans.feature_plans import _quantile_sql
from churnwatch.plans.registry import register
from churnwatch.sources import churn as CH
from churnwatch.sources import tables as S

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FREQ = ["l_returnflag", "l_linestatus"]


def _r(df, keep):
    return df.select(*[F.col(c) if c in keep else rnd(F.col(c)).alias(c) for c in df.columns])


@register("null_profile", f"WITH {CH.churn_view_sql()}, n AS (SELECT count(*) AS n FROM churn_raw) SELECT * FROM (" +
          " UNION ALL ".join(f"SELECT '{r}' AS \"column\", count(*) FILTER (WHERE \"{r}\" IS NULL) AS nulls, "
                             f"round(coalesce(CAST(count(*) FILTER (WHERE \"{r}\" IS NULL) AS DOUBLE) / nullif(count(*), 0),"
                             f" 0.0), 9) AS rate FROM churn_raw" for r in CP.RAW) + ")")
def q_null_profile(spark, sf_dir):
    return _r(P.null_profile(CH.churn_view(spark, sf_dir)), ["column", "nulls"])


@register("dtype_profile", "SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', '{t}')" for c, t in [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                                  ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                                  ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                                  ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")])
          + ") t(\"column\", dtype) JOIN (SELECT * FROM (" + " UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", count({c}) AS non_null FROM lineitem" for c in
              ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
               "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]) + ")) USING (\"column\")")
def q_dtype_profile(spark, sf_dir):
    return P.dtype_profile(S.table(spark, sf_dir, "lineitem"))


@register("describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 9) AS mean, round(stddev_samp({c}), 9) AS std,
  round(min({c}), 9) AS min, round({_quantile_sql('lineitem', c, 0.25)}, 9) AS q25,
  round({_quantile_sql('lineitem', c, 0.5)}, 9) AS q50, round({_quantile_sql('lineitem', c, 0.75)}, 9) AS q75,
  round(max({c}), 9) AS max FROM lineitem""" for c in LI_NUM))
def q_describe(spark, sf_dir):
    return _r(P.describe(S.table(spark, sf_dir, "lineitem"), LI_NUM), ["column", "count"])


@register("value_frequency", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {c} AS value, count(*) AS n,
  round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 9) AS share FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}"""
    for c in FREQ))
def q_value_frequency(spark, sf_dir):
    return _r(P.value_frequency(S.table(spark, sf_dir, "lineitem"), FREQ), ["feature", "value", "n"])


@register("class_balance", """WITH c AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality)
SELECT label, n, round(CAST(n AS DOUBLE) / (SELECT sum(n) FROM c), 9) AS share, (SELECT min(n) FROM c) AS min_class,
  round(CAST((SELECT sum(n) FROM c WHERE label = 0) AS DOUBLE) / (SELECT sum(n) FROM c WHERE label = 1), 9)
    AS neg_pos_ratio FROM c""")
def q_class_balance(spark, sf_dir):
    return _r(P.class_balance(S.table(spark, sf_dir, "labels"), "quality"), ["label", "n", "min_class"])


@register("group_means", """SELECT l.quality, round(avg(CAST(d.n_chars AS DOUBLE)), 9) AS mean_n_chars,
  round(avg(CAST(l.toxic AS DOUBLE)), 9) AS mean_toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.quality""")
def q_group_means(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents").join(S.table(spark, sf_dir, "labels"), "doc_id")
    g = P.group_means(d.withColumnRenamed("n_chars", "n_chars"), "quality", ["n_chars", "toxic"])
    return _r(g, ["quality"])


@register("correlation_matrix", " UNION ALL ".join(
    [f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS r FROM lineitem UNION ALL "
     f"SELECT '{b}', '{a}', round(corr({a}, {b}), 9) FROM lineitem" for a, b in combinations(LI_NUM, 2)]
    + [f"SELECT '{c}', '{c}', 1.0" for c in LI_NUM]))
def q_correlation(spark, sf_dir):
    return _r(P.correlation_matrix(S.table(spark, sf_dir, "lineitem"), LI_NUM), ["a", "b"])


@register("crosstab_rates", """SELECT d.lang AS category, l.quality AS label, count(*) AS n,
  round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY d.lang), 9) AS rate
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang, l.quality""")
def q_crosstab(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents").join(S.table(spark, sf_dir, "labels"), "doc_id")
    return _r(P.crosstab_rates(d, "lang", "quality"), ["category", "label", "n"])


@register("histogram", """WITH b AS (SELECT CAST(min(p_size) AS DOUBLE) AS lo, CAST(max(p_size) AS DOUBLE) AS hi FROM part)
SELECT CAST(least(floor((p_size - lo) / (hi - lo) * 10), 9) AS INTEGER) AS bin,
  round(lo + least(floor((p_size - lo) / (hi - lo) * 10), 9) * ((hi - lo) / 10), 9) AS lo,
  round(lo + (least(floor((p_size - lo) / (hi - lo) * 10), 9) + 1) * ((hi - lo) / 10), 9) AS hi, count(*) AS n
FROM part, b WHERE p_size IS NOT NULL GROUP BY 1, 2, 3""")
def q_histogram(spark, sf_dir):
    return _r(P.histogram(S.table(spark, sf_dir, "part"), "p_size", 10), ["bin", "n"])

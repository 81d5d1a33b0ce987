"""Readers for the driver tables and the frames derived from them.

Every derived frame is a lazy plan over the parquet scans, so filters and column
pruning reach the scan. Nothing here collects data to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# drift inputs on the order tables: split date and feature roles
DRIFT_SPLIT_DATE = "1998-07-01"
DRIFT_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "o_totalprice", "c_acctbal"]
DRIFT_CATEGORICAL = ["l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority", "c_mktsegment"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan with fewer splits than the session has cores: a file of one row group
    is read by one task, which would then do all of the melt. It costs one shuffle of the
    selected columns of such a narrow table; a table with as many splits as cores passes as it is."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x customer; Catalyst prunes to the columns a query uses.

    Join strategy is left to the planner: small dimension sides are broadcast only
    when their size is known to be under ``spark.sql.autoBroadcastJoinThreshold``
    (or AQE proves it at runtime); otherwise sort-merge on the keys.
    """
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"))
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)


def drift_frame(spark: SparkSession, sf_dir: str, shifted: bool = False) -> DataFrame:
    """Both drift samples in one frame: ``is_ref`` = order date before the split date.

    ``shifted`` moves the current side: quantity x1.3, priorities 4 and 5 folded into
    3, and segment MACHINERY renamed to a label the reference never saw.
    """
    j = order_lines(spark, sf_dir)
    is_ref = F.col("o_orderdate") < F.lit(DRIFT_SPLIT_DATE).cast("timestamp_ntz")
    cols = [is_ref.alias("is_ref")]
    for c in DRIFT_NUMERIC + DRIFT_CATEGORICAL:
        x = F.col(c)
        if shifted and c == "l_quantity":
            x = F.when(is_ref, x).otherwise(x * F.lit(1.3))
        if shifted and c == "o_orderpriority":
            x = F.when(is_ref, x).when(F.substring(x, 1, 1).isin("4", "5"), F.lit("3-MEDIUM")).otherwise(x)
        if shifted and c == "c_mktsegment":
            x = F.when(is_ref, x).when(x == "MACHINERY", F.lit("ROBOTICS")).otherwise(x)
        cols.append(x.alias(c))
    return j.select(*cols)


def drift_pair(spark: SparkSession, sf_dir: str, shifted: bool = False) -> tuple[DataFrame, DataFrame]:
    """(reference, current) as two frames, for operators that take the pair."""
    d = drift_frame(spark, sf_dir, shifted)
    feats = DRIFT_NUMERIC + DRIFT_CATEGORICAL
    return d.where("is_ref").select(*feats), d.where("not is_ref").select(*feats)


# ---------------------------------------------------------------------------
# events as a scoring log, an evaluation table and a request log
# ---------------------------------------------------------------------------
def score_of(value: str) -> Column:
    return F.least(F.col(value) / F.lit(500.0), F.lit(1.0))


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, ts, user_id, model, score, label)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        "ts",
        "user_id",
        (F.col("user_id") % 2).cast("string").alias("model"),
        score_of("value").alias("score"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
    )


# FIXED VALUES: request-log mapping of event types to endpoints
ENDPOINT_OF_EVENT = {
    "view": "/predict",
    "click": "/batch-predict",
    "purchase": "/predict",
    "signup": "/health",
    "error": "/batch-predict",
}


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, ts, endpoint, method, status, status_class, latency)."""
    e = table(spark, sf_dir, "events")
    m = F.create_map(*[x for k, v in ENDPOINT_OF_EVENT.items() for x in (F.lit(k), F.lit(v))])
    status = (
        F.when(F.col("event_id") % 20 == 0, F.lit(500))
        .when(F.col("event_id") % 20 == 1, F.lit(422))
        .otherwise(F.lit(200))
    )
    return e.select(
        "event_id",
        "ts",
        F.element_at(m, F.col("event_type")).alias("endpoint"),
        F.when(F.col("event_type") == "signup", F.lit("GET")).otherwise(F.lit("POST")).alias("method"),
        status.alias("status"),
        F.concat((status / 100).cast("int").cast("string"), F.lit("xx")).alias("status_class"),
        (F.col("value") / F.lit(1000.0)).alias("latency"),
        score_of("value").alias("score"),
    )


# ---------------------------------------------------------------------------
# events as a monitored log with known faults
# ---------------------------------------------------------------------------
MONITOR_FROM = "2024-01-08 00:00:00"  # rows before are the reference
MONITOR_NUMERIC = ["amount", "k"]
MONITOR_CATEGORICAL = ["event_type", "segment"]
# fault: first and last instant (excluded) in which it holds
FAULTS = {
    "amounts_up": ("2024-01-10", "2024-01-13"),
    "slow": ("2024-01-12", "2024-01-13"),
    "renamed": ("2024-01-15", "2024-01-17"),
    "amounts_missing": ("2024-01-18", "2024-01-20"),
    "out_of_range": ("2024-01-16", "2024-01-21"),
    "no_segment": ("2024-01-22", "2024-01-24"),
    "silent": ("2024-01-24 06:00:00", "2024-01-25 12:00:00"),
    "failing": ("2024-01-27", "2024-01-27 12:00:00"),
}


def _during(fault: str) -> Column:
    first, last = FAULTS[fault]
    ts = F.col("ts")
    return (ts >= F.lit(first).cast("timestamp_ntz")) & (ts < F.lit(last).cast("timestamp_ntz"))


def monitored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, ts, is_ref, amount, k, event_type, segment, endpoint, status_class, latency).

    The rows after ``MONITOR_FROM`` hold the faults of ``FAULTS``: amounts rise or go missing, a category is renamed, a
    number leaves its range, a column is empty, the log is silent, requests are slow or all fail.
    """
    e = table(spark, sf_dir, "events").where(~_during("silent"))
    m = F.create_map(*[x for k, v in ENDPOINT_OF_EVENT.items() for x in (F.lit(k), F.lit(v))])
    k = F.get_json_object("props", "$.k").cast("double")
    status = F.when(_during("failing") | (F.col("event_id") % 20 == 0), "5xx").when(F.col("event_id") % 20 == 1, "4xx").otherwise("2xx")
    amount = F.when(_during("amounts_missing") & (F.col("event_id") % 4 == 0), F.lit(None)).when(_during("amounts_up"), F.col("value") * 4.0).otherwise(F.col("value"))
    return e.select(
        "event_id",
        "ts",
        (F.col("ts") < F.lit(MONITOR_FROM).cast("timestamp_ntz")).alias("is_ref"),
        amount.alias("amount"),
        F.when(_during("out_of_range"), k + 1000).otherwise(k).alias("k"),
        F.when(_during("renamed") & (F.col("event_type") == "click"), "tap").otherwise(F.col("event_type")).alias("event_type"),
        F.when(~_during("no_segment"), F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string"))).alias("segment"),
        F.element_at(m, F.col("event_type")).alias("endpoint"),
        status.alias("status_class"),
        (F.col("value") / F.when(_during("slow"), 50.0).otherwise(1000.0)).alias("latency"),
    )

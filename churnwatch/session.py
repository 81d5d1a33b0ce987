"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the library assumes. The driver owns the session on a cluster; these
# are applied only when this module builds the session itself (tests, bench).
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "churnwatch") -> SparkSession:
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read as is; without it a
    cluster session is refused, since executors could not see each other's files. Only a
    local session (tests, bench) gets a folder under the system temp dir, once.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        # a static setting, so the folder is kept on the context
        configured = getattr(spark.sparkContext, "_churnwatch_work", None) or tempfile.mkdtemp(prefix="churnwatch-ckpt-")
        spark.sparkContext._churnwatch_work = configured
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


# rows and bytes of one Arrow batch: buffers of long texts stay small on both sides
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def ready_python(spark: SparkSession) -> None:
    """Makes Python workers able to run this package's functions, wherever they are.

    Functions are pickled by reference to their modules, so the source goes to the
    executors, once per Spark application. Arrow batches get bounds fit for long texts
    unless the application was started with bounds of its own.
    """
    sc = spark.sparkContext
    started = sc.getConf()
    for key, value in ARROW_BATCH.items():
        if not started.contains(key):
            spark.conf.set(key, value)
    if getattr(sc, "_churnwatch_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="churnwatch-src-"))
    path = os.path.join(folder, "churnwatch_src.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for top, _, files in os.walk(home):
            for name in sorted(f for f in files if f.endswith(".py")):
                full = os.path.join(top, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(home)))
    sc.addPyFile(path)
    sc._churnwatch_shipped = True


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any file system that Spark reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table under the shared checkpoint folder and read it back.

    One job (a reliable RDD checkpoint would compute the plan twice); the result has no
    lineage back to the sources, so a lost executor never re-runs the upstream scan.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/churnwatch/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

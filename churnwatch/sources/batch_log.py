"""Several log tables that a batch appends to as one: all of its rows are seen, or none.

Every table has one folder per batch, ``<log>/<table>/batch_id=b<id>``, written with overwrite. A batch counts
once its marker ``<log>/commits/batch_id=b<id>`` is there, which is written after all of its tables and by
one file move. Readers see committed batches only, so a batch that failed half-way is not there; run again under the
same id it replaces what it had written. A committed batch is never written again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch.session import path_exists

BATCH = "batch_id"


class BatchLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, table: str, batch_id: str) -> str:
        # the letter keeps ids text, whatever they look like
        return f"{self.path}/{table}/{BATCH}=b{batch_id}"

    def is_committed(self, batch_id: str) -> bool:
        return path_exists(self.spark, f"{self._folder('commits', batch_id)}/_SUCCESS")

    def append(self, batch_id: str, tables: dict[str, DataFrame]) -> bool:
        """Writes a batch's rows of all tables, then its marker. False, and nothing written, if it is already there.

        The frames must not depend on this batch's own rows in the log."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id) or "commits" in tables:
            raise ValueError(f"batch id {batch_id!r} must be letters, digits, '_', '.' or '-', and no table may be called 'commits'")
        if self.is_committed(batch_id):
            return False
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(self._folder(name, batch_id))
        marker = self.spark.range(1).select(F.lit(",".join(sorted(tables))).alias("tables"), F.current_timestamp().alias("committed_at"))
        marker.coalesce(1).write.mode("overwrite").parquet(self._folder("commits", batch_id))
        return True

    def commits(self) -> DataFrame | None:
        """(batch_id, tables, committed_at); None before the first batch."""
        if not path_exists(self.spark, f"{self.path}/commits"):
            return None
        return self.spark.read.parquet(f"{self.path}/commits").select(F.expr(f"substring({BATCH}, 2)").alias(BATCH), "tables", "committed_at")

    def read(self, table: str) -> DataFrame | None:
        """The rows of all committed batches, with ``batch_id``; None before the first batch.

        The marker table has one row per batch; the semi-join is on the partition column."""
        done = self.commits()
        if done is None:
            return None
        rows = self.spark.read.parquet(f"{self.path}/{table}").withColumn(BATCH, F.expr(f"substring({BATCH}, 2)"))
        return rows.join(done.select(BATCH), BATCH, "left_semi")

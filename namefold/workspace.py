"""Durable intermediate tables.

Iterative steps cut their lineage by writing Parquet into the shared checkpoint folder of the session.
A written table survives lost executors, is read back column by column, and has a known size, so Spark
decides broadcasts from facts instead of estimates.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

def _session_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder, or else a folder in its warehouse.

    A warehouse on a machine-local file system is refused on a cluster: executors would not share it."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local_master = spark.sparkContext.master.startswith("local")
    if not local_master and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError("set spark.checkpoint.dir to shared storage: the warehouse folder is on a local file system")
    return f"{warehouse}/namefold-work"


class Workspace:
    """A private folder for the tables of one run."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{(root or _session_root(spark)).rstrip('/')}/namefold-{uuid.uuid4().hex}"
        self._tables = 0

    def save(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """Write ``df`` and read it back; ``metrics`` are aggregates collected by the same job."""
        self._tables += 1
        path = f"{self.path}/{self._tables:03d}-{name}"
        observation = Observation()
        source = df.observe(observation, *(c.alias(k) for k, c in metrics.items())) if metrics else df
        source.write.mode("overwrite").parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored._namefold_path = path
        return stored, (observation.get if metrics else {})

    def scratch(self) -> "Workspace":
        """A workspace inside this one, for tables that are not needed to the end."""
        return Workspace(self.spark, self.path)

    def discard(self, stored: DataFrame) -> None:
        """Delete a table written by :meth:`save` that no later step reads."""
        self._delete(stored._namefold_path)

    def close(self) -> None:
        """Delete everything this run wrote. DataFrames built on it can no longer be read."""
        self._delete(self.path)

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *_exc) -> None:
        self.close()

    def _delete(self, path: str) -> None:
        context = self.spark.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)

"""Session helpers: shared scratch folders, checkpoints, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A dimension is broadcast only when it has been counted below this many rows.
BROADCAST_ROWS = 200_000


def tune(spark: SparkSession) -> SparkSession:
    """Planner settings the operators profit from; none changes a result.

    The panel is hash-partitioned by series. Without the second setting the
    price join on (store, item, week) would shuffle it again, and the windows
    after the join a third time. A series has at most one row per day, so
    partitioning the join by series cannot create a hot partition.

    The third setting is the size of the largest method the JVM compiles. The
    feature projections generate longer ones, which would run interpreted;
    below the limit Spark splits them into smaller methods instead.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


@contextmanager
def all_cluster_keys(spark: SparkSession) -> Iterator[None]:
    """Spark's own rule for joins, whatever ``tune`` has set: rows are dealt out by all their keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _shared_root(spark: SparkSession) -> str:
    """The folder all executors see; without one, a private folder in local mode and an error elsewhere."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.sparkContext.getCheckpointDir()
    if root is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="stratacast-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping the cluster's own folder."""
    root = _shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{_shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast after counting; a larger side stays a shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df

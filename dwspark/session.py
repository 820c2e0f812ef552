"""Session helpers: build a local session for tests/bench, read tables, find the checkpoint dir.

Library code never creates its own session; it takes the caller's. These helpers exist for tests,
the bench and ``__spark_entry__``.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# The driver's synthetic tables.
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dwspark") -> SparkSession:
    """Local session with AQE on, UI off, a UTC clock (so results compare with DuckDB) and no Python
    call-site capture."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("DWSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Spark 4 records the Python call site of every Column function for error messages, at
        # several JVM round trips per call; plans with hundreds of expressions spend seconds on it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables(Mapping):
    """The named tables of a folder as DataFrames, each opened on first use (a query that uses
    two tables does not list or size the other twelve)."""

    def __init__(self, spark: SparkSession, sf_dir: str, names: Iterable[str] = DRIVER_TABLES):
        self._spark, self._dir, self._names = spark, sf_dir, list(names)
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._open:
            self._open[name] = read_table(self._spark, self._dir, name)
        return self._open[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def read_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = DRIVER_TABLES) -> Tables:
    """Every table as a lazy DataFrame (nothing is read until an action)."""
    return Tables(spark, sf_dir, names)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``; where that is unset (tests), a
    folder below the session's warehouse, which the executors share as well."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    current = current or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/dwspark-tables/{name}-{uuid.uuid4().hex[:12]}"

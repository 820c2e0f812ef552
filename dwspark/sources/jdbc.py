"""JDBC sources.

The reference reads each database table through one connection in one partition. Here a numeric
key can split the read into ``num_partitions`` range queries run in parallel; the bounds only set
the split points (rows outside them still land in the first/last partition), so they can come from
a cheap ``min``/``max`` query.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10_000


def _reader(spark: SparkSession, url: str, properties: Mapping[str, str] | None, fetch_size: int):
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r


# S2 ----------------------------------------------------------------------------------------------
def read_table(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
    partition_column: str | None = None, lower_bound: int | None = None, upper_bound: int | None = None,
    num_partitions: int | None = None, fetch_size: int = FETCH_SIZE,
) -> DataFrame:
    r = _reader(spark, url, properties, fetch_size).option("dbtable", table)
    if partition_column and num_partitions and num_partitions > 1:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
    return r.load()


def key_bounds(spark: SparkSession, url: str, table: str, column: str, properties: Mapping[str, str] | None = None) -> tuple[int, int]:
    """``(min, max)`` of a numeric column, computed by the database."""
    q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    row = _reader(spark, url, properties, FETCH_SIZE).option("dbtable", q).load().first()
    return int(row[0] or 0), int(row[1] or 0)


# S3 ----------------------------------------------------------------------------------------------
def read_columns(spark: SparkSession, url: str, table: str, columns: Sequence[str],
                 properties: Mapping[str, str] | None = None, fetch_size: int = FETCH_SIZE) -> DataFrame:
    """Only the named columns, pushed into the database as a sub-query."""
    cols = ", ".join('"' + c.replace('"', '""') + '"' for c in columns)
    return _reader(spark, url, properties, fetch_size).option("dbtable", f"(SELECT {cols} FROM {table}) snapshot").load()

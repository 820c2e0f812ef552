"""Catalog listings and table extraction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwspark.operators.profile import column_types  # noqa: F401  (S8: describe columns)
from dwspark.session import read_tables  # noqa: F401  (S9: every table as a lazy frame)


# S7 ----------------------------------------------------------------------------------------------
def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``(database, table_name, table_type, is_temporary)`` ordered by name (catalog metadata)."""
    rows = [(t.database, t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "database string, table_name string, table_type string, is_temporary boolean").orderBy("table_name")


# S10 ---------------------------------------------------------------------------------------------
def as_text(df: DataFrame, columns: Sequence[str] | None = None, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Ordered projection with every column cast to text (the untyped staging form)."""
    renames = renames or {}
    cols = list(columns or df.columns)
    return df.select(*[F.col(f"`{c}`").cast("string").alias(renames.get(c, c)) for c in cols])


# S11 ---------------------------------------------------------------------------------------------
def sample_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in key order (a top-k, deterministic)."""
    return df.orderBy(*(order_by or df.columns[:1])).limit(n)

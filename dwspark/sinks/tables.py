"""Table loads (K1–K5, K8).

Loads are idempotent full refreshes, so a retried task or a re-run job rewrites the same result
(Spark's task retry replaces the reference's retry wrapper). File-table refreshes write to a
staging folder and swap it in only after the write has committed, so no half-written table is
ever at the table's path (the reference truncates first and exposes a half-loaded table meanwhile).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dwspark.operators.aggregate import union_all

JDBC_BATCH_SIZE = 10_000


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


# K1 ----------------------------------------------------------------------------------------------
def write_counted(df: DataFrame, path: str) -> tuple[str, int]:
    """:func:`write_staging` that also returns how many rows went into the write, counted on their way
    (``observe``), not read back from the files."""
    seen = Observation()
    staging = write_staging(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return staging, int(seen.get["rows"])


def write_staging(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` to a fresh ``<path>.staging-<id>`` folder and return that folder."""
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(staging)
    return staging


def swap_in(spark: SparkSession, staging: str, path: str) -> str:
    """Replace ``path`` with the committed ``staging`` folder by renames: the old table steps aside first
    and is deleted last, so that one complete copy exists at any time; if the second rename fails the
    old table is put back. Between the two renames ``path`` is absent for a moment, and on an object
    store a rename is a copy: there, use catalog tables (:func:`replace_catalog_table`)."""
    fs, target = _fs(spark, path)
    _, src = _fs(spark, staging)
    _, aside = _fs(spark, f"{path.rstrip('/')}.previous-{uuid.uuid4().hex[:12]}")
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(src, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"could not move {staging} to {path}")
    if had:
        fs.delete(aside, True)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def replace_files(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Full refresh of a file table: write everything to a staging folder, then replace ``path``
    with it, so the old table stays readable until the new one is complete. Returns ``path``."""
    return swap_in(df.sparkSession, write_staging(df, path, fmt, partition_by), path)


def replace_catalog_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Full refresh of a catalog table."""
    df.write.mode("overwrite").format(fmt).saveAsTable(table)


def replace_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                 batch_size: int = JDBC_BATCH_SIZE, num_partitions: int | None = None) -> None:
    """Full refresh of a database table: ``TRUNCATE`` (keeping the table definition, grants and
    keys) then batched inserts in read-committed transactions, one connection per partition."""
    w = (df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table)
         .option("truncate", "true").option("batchsize", str(batch_size)).option("isolationLevel", "READ_COMMITTED"))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


# K2 ----------------------------------------------------------------------------------------------
def load_in_order(tables: Mapping[str, DataFrame], order: Sequence[str], write: Callable[[str, DataFrame], None],
                  truncate: Callable[[str], None] | None = None) -> list[str]:
    """Load tables parents-first. ``order`` must list exactly the tables given (the invariant the
    reference enforces); ``truncate`` (if any) runs children-first before any load so foreign keys
    never block it. Returns the load order."""
    if sorted(order) != sorted(tables):
        raise ValueError(f"load order {list(order)} does not match tables {sorted(tables)}")
    if truncate is not None:
        for name in reversed(order):
            truncate(name)
    for name in order:
        write(name, tables[name])
    return list(order)


# K3 ----------------------------------------------------------------------------------------------
def verify_counts(expected: Mapping[str, DataFrame | int], actual: Mapping[str, DataFrame], raise_on_mismatch: bool = True) -> DataFrame:
    """``(table_name, expected_rows, actual_rows, ok)`` for each table: rows that were written (a
    frame or a known count) vs rows read back. Each side is counted in one job (a union of counts)."""
    def counts(frames, col):
        spark = next(v for v in list(actual.values()) if isinstance(v, DataFrame)).sparkSession

        def one(n, v):
            if isinstance(v, DataFrame):
                return v.agg(F.count(F.lit(1)).alias(col)).select(F.lit(n).alias("table_name"), col)
            return spark.createDataFrame([(n, int(v))], f"table_name string, {col} long")

        return union_all(one(n, v) for n, v in frames.items())

    out = counts(expected, "expected_rows").join(counts(actual, "actual_rows"), "table_name", "full_outer").select(
        "table_name", "expected_rows", "actual_rows",
        F.coalesce(F.col("expected_rows") == F.col("actual_rows"), F.lit(False)).alias("ok"),
    ).orderBy("table_name")
    if raise_on_mismatch:
        bad = out.where(~F.col("ok")).collect()  # at most one row per table
        if bad:
            raise ValueError("row count mismatch: " + ", ".join(f"{r.table_name} {r.expected_rows}!={r.actual_rows}" for r in bad))
    return out


# K4 ----------------------------------------------------------------------------------------------
def common_columns(src: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Source columns that the target also has, in source order; error when there are none."""
    keep = [c for c in src.columns if c in set(target_columns)]
    if not keep:
        raise ValueError("source and target have no column in common")
    return src.select(*[F.col(f"`{c}`") for c in keep])


# K5 ----------------------------------------------------------------------------------------------
def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> DataFrame:
    """Expose each frame as a temporary view ``<prefix><name>`` and return their row counts."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return union_all(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(f"{prefix}{name}").alias("view_name"), "row_count")
        for name, df in tables.items()
    )


def sync_layer(spark: SparkSession, tables: Mapping[str, DataFrame], database: str, fmt: str = "parquet") -> DataFrame:
    """K5: make the catalog tables ``<database>.<name>`` equal to the given frames, and report one row per table:
    ``table_name, action, added, dropped, retyped, rows``. A table whose columns and types are unchanged keeps its definition and is
    refreshed (``refreshed``); one whose source has drifted is rebuilt with the new columns (``rebuilt``); a missing one
    is created. Column order alone is no drift."""
    report = []
    for name, df in tables.items():
        table = f"{database}.{name}"
        now = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        was = {f.name: f.dataType.simpleString() for f in spark.table(table).schema.fields} if spark.catalog.tableExists(table) else None
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        added, dropped = sorted(set(now) - set(was or now)), sorted(set(was or ()) - set(now))
        retyped = sorted(f"{c}: {was[c]} -> {now[c]}" for c in set(was or ()) & set(now) if was[c] != now[c])
        if was and not (added or dropped or retyped):
            counted.select(*[F.col(f"`{c}`") for c in spark.table(table).columns]).write.mode("overwrite").insertInto(table)
            action = "refreshed"
        else:
            counted.write.mode("overwrite").format(fmt).saveAsTable(table)
            action = "rebuilt" if was else "created"
        report.append((name, action, added, dropped, retyped, int(seen.get["rows"])))
    return spark.createDataFrame(report, "table_name string, action string, added array<string>, dropped array<string>, retyped array<string>, rows long")


# K8 ----------------------------------------------------------------------------------------------
LOG_SCHEMA = ("log_id string, step string, component string, status string, table_name string, "
              "etl_date timestamp, error_msg string, batch_id string")


def log_step(spark: SparkSession, path: str, step: str, component: str, status: str,
             table_name: str | None = None, error_msg: str | None = None, at: datetime | None = None, batch_id: str | None = None) -> None:
    """Append one step-log row (``log_id`` is a new UUID)."""
    at = at or datetime.now(UTC).replace(tzinfo=None)
    row = [(str(uuid.uuid4()), step, component, status, table_name, at, error_msg, batch_id)]
    spark.createDataFrame(row, LOG_SCHEMA).write.mode("append").parquet(path)


def read_log_tail(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    """Newest ``n`` log rows (top-k, not a full sort)."""
    return spark.read.parquet(path).orderBy(F.desc("etl_date"), F.desc("log_id")).limit(n)

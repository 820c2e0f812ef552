"""Run audit trail (R1–R5) as append-only Parquet tables.

The reference keeps a run row that it updates in place, plus profile and change rows keyed by run.
Updates in place do not fit files, so a run is a series of status events (``RUNNING``, then
``SUCCEEDED`` or ``FAILED``) and the current state of a run is its newest event (``max_by``). All
tables live under one base path (the shared warehouse or checkpoint folder on a cluster):

  <base>/runs      run_id, status, event_ts, duration_seconds, error_message
  <base>/profiles  run_id, stage, dataset_name, row_count, column_count, null_count,
                   duplicate_key_count, null_by_column, previous_row_count, row_count_delta
  <base>/changes   run_id, table_name, inserted_count, updated_count, deleted_count, unchanged_count
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwspark.operators.joins import latest_previous

RUNNING, SUCCEEDED, FAILED = "RUNNING", "SUCCEEDED", "FAILED"
RUN_SCHEMA = "run_id string, status string, event_ts timestamp, duration_seconds double, error_message string"
CHANGE_COLUMNS = ["table_name", "inserted_count", "updated_count", "deleted_count", "unchanged_count"]
PROFILE_COLUMNS = ["stage", "dataset_name", "row_count", "column_count", "null_count", "duplicate_key_count", "null_by_column"]


class AuditLog:
    def __init__(self, spark: SparkSession, base_path: str):
        self.spark = spark
        self.base = base_path.rstrip("/")

    # -- storage ---------------------------------------------------------------------------------
    def _path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def _exists(self, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._path(name))
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(path)

    def _read(self, name: str, schema: str) -> DataFrame:
        if self._exists(name):
            return self.spark.read.parquet(self._path(name))
        return self.spark.createDataFrame([], schema)

    # -- R1 --------------------------------------------------------------------------------------
    def _event(self, run_id: str, status: str, duration: float | None = None, error: str | None = None,
               at: datetime | None = None) -> None:
        at = at or datetime.now(UTC).replace(tzinfo=None)
        row = [(run_id, status, at, duration, error)]
        self.spark.createDataFrame(row, RUN_SCHEMA).write.mode("append").parquet(self._path("runs"))

    def start_run(self, run_id: str | None = None, at: datetime | None = None) -> str:
        run_id = run_id or str(uuid.uuid4())
        self._event(run_id, RUNNING, at=at)
        return run_id

    def mark_succeeded(self, run_id: str, duration_seconds: float, at: datetime | None = None) -> None:
        self._event(run_id, SUCCEEDED, duration=duration_seconds, at=at)

    def mark_failed(self, run_id: str, error_message: str, at: datetime | None = None) -> None:
        self._event(run_id, FAILED, error=error_message, at=at)

    def runs(self) -> DataFrame:
        """Current state per run: ``run_id, started_at, status, finished_at, duration_seconds,
        error_message`` (``finished_at`` null while running)."""
        ev = self._read("runs", RUN_SCHEMA)
        latest = F.max_by(F.struct("status", "event_ts", "duration_seconds", "error_message"), "event_ts")
        g = ev.groupBy("run_id").agg(F.min("event_ts").alias("started_at"), latest.alias("_l"))
        return g.select(
            "run_id", "started_at", F.col("_l.status").alias("status"),
            F.when(F.col("_l.status") != RUNNING, F.col("_l.event_ts")).alias("finished_at"),
            F.col("_l.duration_seconds").alias("duration_seconds"), F.col("_l.error_message").alias("error_message"),
        )

    # -- R2 --------------------------------------------------------------------------------------
    def save_profiles(self, run_id: str, profiles: DataFrame) -> DataFrame:
        """Append profiles with the row count of the same (stage, dataset) in the newest earlier
        *succeeded* run (null when none) and the delta to it. Returns what was appended."""
        history = self._read("profiles", "run_id string, stage string, dataset_name string, row_count long")
        done = self.runs().where(F.col("status") == SUCCEEDED).select("run_id", "finished_at")
        earlier = history.select("run_id", "stage", "dataset_name", "row_count").join(done, "run_id").drop("run_id")
        out = latest_previous(profiles.select(*PROFILE_COLUMNS), earlier, ["stage", "dataset_name"], "finished_at", "row_count", "previous_row_count").select(
            F.lit(run_id).alias("run_id"), *PROFILE_COLUMNS, "previous_row_count",
            (F.col("row_count") - F.col("previous_row_count")).alias("row_count_delta"),
        )
        # The history listing is fixed when it is read, so appending to the same folder is safe.
        out.write.mode("append").parquet(self._path("profiles"))
        return out

    # -- R3 --------------------------------------------------------------------------------------
    def save_changes(self, run_id: str, changes: DataFrame) -> None:
        changes.select(F.lit(run_id).alias("run_id"), *CHANGE_COLUMNS).write.mode("append").parquet(self._path("changes"))

    # -- R4 --------------------------------------------------------------------------------------
    def summary(self, run_id: str) -> DataFrame:
        """One row: the run's state plus ``profiles`` and ``changes`` arrays (bounded: one entry per
        dataset/table of the run)."""
        run = self.runs().where(F.col("run_id") == run_id)
        prof = self._read("profiles", "run_id string").where(F.col("run_id") == run_id)
        chg = self._read("changes", "run_id string").where(F.col("run_id") == run_id)
        def by(*fields):
            def cmp(a, b):
                ka, kb = F.concat_ws("|", *[a[f] for f in fields]), F.concat_ws("|", *[b[f] for f in fields])
                return F.when(ka < kb, -1).when(ka > kb, 1).otherwise(0)
            return cmp

        # profiles hold a map column (not orderable), so the arrays are sorted by their names
        p = prof.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in prof.columns if c != "run_id"])),
                                                    by("stage", "dataset_name")).alias("profiles"))
        c = chg.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in chg.columns if c != "run_id"]))).alias("changes"))
        return run.join(p, "run_id", "left").join(c, "run_id", "left")

    # -- O3: latest-run views ---------------------------------------------------------------------
    def latest_run_id(self) -> DataFrame:
        """One row: the run that started last (``max_by``, no sort)."""
        return self.runs().agg(F.max_by("run_id", "started_at").alias("run_id"))

    def latest_profiles(self) -> DataFrame:
        return self._read("profiles", "run_id string").join(self.latest_run_id(), "run_id")

    def latest_changes(self) -> DataFrame:
        return self._read("changes", "run_id string").join(self.latest_run_id(), "run_id")

    def export_summary(self, run_id: str, path: str) -> None:
        from dwspark.sinks.reports import write_json_report

        write_json_report(self.summary(run_id), path)


# R5 ----------------------------------------------------------------------------------------------
def execution_summary(spark: SparkSession, **metrics: float | int | str | None) -> DataFrame:
    """One-row metrics frame (e.g. extraction/staging/processed/loaded/rejected rows, duration). A metric
    without a value is a null text."""
    def kind(value) -> str:
        return {bool: "boolean", int: "long", float: "double"}.get(type(value), "string")

    schema = ", ".join(f"`{name}` {kind(value)}" for name, value in metrics.items())
    return spark.createDataFrame([tuple(metrics.values())], schema)

"""Report and failure-payload sinks (K6, K7)."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# K6 ----------------------------------------------------------------------------------------------
def write_json_report(report: DataFrame, path: str) -> None:
    """Write a report frame as JSON lines in one file. Reports are one row per table / run, so a
    single output partition is bounded by the number of tables, not by the data."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


# K7 ----------------------------------------------------------------------------------------------
def dump_failed_rows(rows: DataFrame, base_path: str, layer: str, job_name: str, batch_id: str,
                     at: datetime | None = None) -> None:
    """Append rows that failed a job (or were rejected by rules) as JSON under
    ``<base>/layer=<layer>/job_name=<job>/batch_id=<batch>/``, stamped with ``failed_at``. The
    reference dumps one payload per failure; the rejected rows themselves, which it only counts,
    go here too."""
    at = at or datetime.now(UTC).replace(tzinfo=None)
    (rows.withColumn("failed_at", F.lit(at))
         .withColumn("layer", F.lit(layer)).withColumn("job_name", F.lit(job_name)).withColumn("batch_id", F.lit(batch_id))
         .write.mode("append").partitionBy("layer", "job_name", "batch_id").json(base_path))


def failure_payload(spark, layer: str, job_name: str, batch_id: str, error: str, details: dict | None = None) -> DataFrame:
    """A one-row payload describing a failed step (error text plus free-form details as JSON)."""
    import json

    row = [(layer, job_name, batch_id, error, json.dumps(details or {}, default=str))]
    return spark.createDataFrame(row, "layer string, job_name string, batch_id string, error string, details string")

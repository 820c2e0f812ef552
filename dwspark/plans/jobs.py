"""Resumable batch jobs: logged steps, failure dumps, and the car-sales job from source to predictions.

A job's state is its step log: every step of a batch appends STARTED and then SUCCESS or FAILED. A step writes only folders
of its own, which a repeated attempt overwrites. When a batch runs again, steps that the log shows as finished are
skipped, and their recorded row counts stand; the failed step and those after it run. A failing step leaves a payload
(its error, and its rows where it has any) and the error goes on to the caller.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwspark.operators import model, rejects
from dwspark.operators.aggregate import regression_metrics
from dwspark.operators.audit import execution_summary
from dwspark.operators.keys import dedupe
from dwspark.plans import car_sales
from dwspark.session import scratch_path
from dwspark.sinks import reports, tables, versions

STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"
NUMERIC = ["year", "brand_car_id", "id_state", "condition", "odometer", "mmr"]
CATEGORICAL = ["transmission", "color", "interior"]
# The columns of the staging tables.
STAGING = {
    "car_sales": ["id_sales", "year", "brand_car", "transmission", "state", "condition", "odometer", "color", "interior", "mmr", "sellingprice"],
    "car_brand": ["brand_car_id", "brand_name"],
    "us_state": ["id_state", "code", "name"],
}


class Batch:
    """The steps of one batch below ``base``: ``log``, ``failed``, and ``batch=<id>/<step>`` for what the steps write."""

    def __init__(self, spark: SparkSession, base: str, batch_id: str, layer: str):
        self.spark, self.base, self.batch_id, self.layer = spark, base.rstrip("/"), batch_id, layer
        self.done = {r.step: json.loads(r.error_msg or "{}") for r in self.log().where(F.col("status") == SUCCESS).collect()}  # one row a step

    def log(self) -> DataFrame:
        """This batch's log rows."""
        path = f"{self.base}/log"
        if not tables.path_exists(self.spark, path):
            return self.spark.createDataFrame([], tables.LOG_SCHEMA)
        return self.spark.read.schema(tables.LOG_SCHEMA).parquet(path).where(F.col("batch_id") == self.batch_id)

    def path(self, step: str) -> str:
        return f"{self.base}/batch={self.batch_id}/{step}"

    def read(self, step: str) -> DataFrame:
        return self.spark.read.parquet(self.path(step))

    def _log(self, step: str, component: str, status: str, table: str | None, text: str | None = None) -> None:
        tables.log_step(self.spark, f"{self.base}/log", step, component, status, table, text, batch_id=self.batch_id)

    def step(self, name: str, component: str, run: Callable[[], Mapping], table: str | None = None, rows: Callable[[], DataFrame] | None = None) -> dict:
        """Run a step unless the batch has finished it; returns its figures, which the log keeps (K8). ``rows`` gives
        the rows that a failure concerns, for the dump (K7)."""
        if name in self.done:
            return self.done[name]
        self._log(name, component, STARTED, table)
        try:
            figures = dict(run())
        except Exception as e:
            try:
                payload = reports.failure_payload(self.spark, self.layer, name, self.batch_id, f"{type(e).__name__}: {e}", {"table": table})
                reports.dump_failed_rows(payload.drop("layer", "batch_id"), f"{self.base}/failed", self.layer, name, self.batch_id)
                if rows:
                    reports.dump_failed_rows(rows(), f"{self.base}/failed_rows", self.layer, name, self.batch_id)
            finally:
                self._log(name, component, FAILED, table, f"{type(e).__name__}: {e}")
            raise
        self.done[name] = figures
        self._log(name, component, SUCCESS, table, json.dumps(figures))
        return figures

    def copy(self, source: DataFrame, table: str, columns: list[str]) -> Callable[[], dict]:
        """K4 as a step: the source's columns that the staging table has, written as a full refresh."""
        def run() -> dict:
            part = tables.common_columns(source, columns)
            staging, rows = tables.write_counted(part, self.path(table))
            tables.swap_in(self.spark, staging, self.path(table))
            return {"rows": rows}

        return run


@dataclass(frozen=True)
class CarSalesSources:
    sales: DataFrame
    brands: DataFrame
    states: DataFrame


def run_car_sales(spark: SparkSession, src: CarSalesSources, base: str, batch_id: str) -> DataFrame:
    """Stage the three sources, split the sales into accepted and rejected rows in one pass, publish the warehouse
    table and the rejected rows together as a version of ``<base>/warehouse``, train and save the model and its
    hold-out predictions; returns the execution summary (R5). May be called again for a batch that failed."""
    started = time.time()
    batch = Batch(spark, base, batch_id, "car_sales")
    staged = {}
    for table, source in (("car_sales", src.sales), ("car_brand", src.brands), ("us_state", src.states)):
        staged[table] = batch.step(f"stage_{table}", "staging", batch.copy(source, table, STAGING[table]), table, rows=lambda s=source: s.limit(0))["rows"]

    def split() -> dict:
        joined = car_sales.with_lookups(batch.read("car_sales"), batch.read("car_brand"), batch.read("us_state"))
        rule_list = car_sales.rules()
        return rejects.write_split(rejects.tag(joined, rule_list), rule_list, batch.path("split"))

    counts = batch.step("transform", "transform", split, "car_sales")

    def load() -> dict:
        commit = versions.Commit(spark, f"{batch.base}/warehouse")
        try:
            rows = commit.write("car_sales", dedupe(rejects.read_accepted(spark, batch.path("split")), ["id_sales_nk"]))
            rejected = commit.write("car_sales_rejected", rejects.read_rejected(spark, batch.path("split")))
            commit.verify()
            return {"rows": rows, "rejected": rejected, "version": commit.publish().version}
        except Exception:
            commit.abandon()
            raise

    loaded = batch.step("load_warehouse", "warehouse", load, "car_sales")

    def train() -> dict:
        sales = versions.snapshot(spark, f"{batch.base}/warehouse", loaded["version"]).read(spark, "car_sales")
        fitted, predictions = model.train_exact(sales, "id_sales_nk", NUMERIC, CATEGORICAL, "selling_price")
        fitted.save(spark, batch.path("model"))
        predictions.write.mode("overwrite").parquet(batch.path("predictions"))
        held = batch.read("predictions")
        m = regression_metrics(held, "actual", "predicted").first()
        return {"nodes": len(fitted.nodes), "r2": m["r2"], "rmse": m["rmse"], "mae": m["mae"], "predictions": m["n"]}

    fitted = batch.step("model", "model", train)
    return execution_summary(
        spark, batch_id=batch_id, status="SUCCESS", duration_seconds=time.time() - started,
        **{f"staged_{t}": n for t, n in staged.items()}, processed_rows=counts["processed_rows"], accepted_rows=counts["accepted_rows"],
        rule_rejected_rows=counts["rule_rejected_rows"], loaded_rows=loaded["rows"], duplicate_rows=counts["accepted_rows"] - loaded["rows"],
        features=",".join(NUMERIC + CATEGORICAL), r2=fitted["r2"], rmse=fitted["rmse"], mae=fitted["mae"], predictions=fitted["predictions"],
        model_path=batch.path("model"), predictions_path=batch.path("predictions"))


def car_sales_summary(t: Mapping[str, DataFrame]) -> DataFrame:
    """The whole car-sales job over the driver tables in a folder of its own, which is deleted afterwards."""
    spark = next(iter(t.values())).sparkSession
    folder = scratch_path(spark, "car-sales-job")
    try:
        src = CarSalesSources(car_sales.sales_source(t), car_sales.brands_reference(t), car_sales.states_reference(t))
        out = run_car_sales(spark, src, folder, "first")
        return out.drop("batch_id", "duration_seconds", "model_path", "predictions_path")  # one row, held by the driver
    finally:
        tables.remove(spark, folder)

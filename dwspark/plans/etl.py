"""Whole bank pipeline with audit (W12): profile sources -> transform -> stage targets -> profile
targets -> detect changes against the current warehouse -> swap targets in load order -> verify row
counts -> record profiles, changes and run status -> export the run summary.

Each target is computed once: it is written to a staging folder (its only full computation), and
profiling and change detection read the staged files. The warehouse folders are replaced only after
every target is staged, in dependency order, so a failure before that point leaves the previous
warehouse untouched.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwspark.operators.audit import AuditLog
from dwspark.operators.changes import change_counts_many
from dwspark.operators.profile import profile_many
from dwspark.plans import bank
from dwspark.session import scratch_path
from dwspark.sinks import tables, versions

log = logging.getLogger(__name__)

# ---- fixed values that must equal the reference's --------------------------------------------
LOAD_ORDER = ["education_status", "marital_status", "marketing_campaign_deposit", "customers", "transactions"]
TARGET_KEYS = {
    "education_status": ["education_id"],
    "marital_status": ["marital_id"],
    "marketing_campaign_deposit": ["loan_data_id"],
    "customers": ["customer_id"],
    "transactions": ["transaction_id"],
}
# ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class BankSources:
    transactions: DataFrame   # the transactions CSV shape (all text)
    campaign: DataFrame       # the campaign table shape
    education: DataFrame      # education_id, value, created_at, updated_at
    marital: DataFrame        # marital_id, value, created_at, updated_at


def concurrently(jobs: Mapping[str, Callable[[], object]], workers: int = 8) -> dict[str, object]:
    """Run independent Spark actions from a thread pool so their jobs share the cluster instead of
    queueing one after another (each target table is its own job). Returns results by name."""
    with ThreadPoolExecutor(max_workers=min(workers, max(1, len(jobs)))) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def transform(src: BankSources, max_valid_year: int = 2025) -> dict[str, DataFrame]:
    return {
        "education_status": bank.lookup_table(src.education, "education_id"),
        "marital_status": bank.lookup_table(src.marital, "marital_id"),
        "marketing_campaign_deposit": bank.marketing_campaign(src.campaign),
        "customers": bank.customers(src.transactions, max_valid_year),
        "transactions": bank.transactions(src.transactions, max_valid_year),
    }


class Folders:
    """One folder a table below ``base``, replaced one after the other in load order."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.staged: dict[str, str] = {}

    def write(self, name: str, df: DataFrame) -> int:
        self.staged[name], rows = tables.write_counted(df, f"{self.base}/{name}")
        return rows

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.staged[name])

    def previous(self, name: str) -> DataFrame | None:
        path = f"{self.base}/{name}"
        return self.spark.read.parquet(path) if tables.path_exists(self.spark, path) else None

    def publish(self) -> dict[str, DataFrame]:
        tables.load_in_order(self.staged, LOAD_ORDER, lambda name, path: tables.swap_in(self.spark, path, f"{self.base}/{name}"))
        return {n: self.spark.read.parquet(f"{self.base}/{n}") for n in LOAD_ORDER}

    def abandon(self) -> None:
        for path in self.staged.values():
            tables.remove(self.spark, path)


class Versions(versions.Commit):
    """All targets published together as one version (see :mod:`dwspark.sinks.versions`)."""

    def previous(self, name: str) -> DataFrame | None:
        return self.before.read(self.spark, name) if name in self.before.tables else None

    def publish(self) -> dict[str, DataFrame]:
        snap = super().publish()
        return {n: snap.read(self.spark, n) for n in LOAD_ORDER}


def run(spark: SparkSession, src: BankSources, warehouse: str, audit_base: str, max_valid_year: int = 2025,
        versioned: bool = False) -> tuple[str, DataFrame]:
    """Run the pipeline; returns ``(run_id, summary)`` where ``summary`` is the R4 document. ``versioned``
    publishes all targets at once; otherwise each target's folder is replaced in load order."""
    audit = AuditLog(spark, audit_base)
    run_id = audit.start_run()
    started = time.time()
    summary_path = f"{audit_base.rstrip('/')}/summaries/{run_id}"
    store: Folders | Versions | None = None
    try:
        store = (Versions if versioned else Folders)(spark, warehouse)
        source_profiles = profile_many([
            ("bank_transactions", src.transactions, ["TransactionID"]),
            ("marketing_campaign_deposit", src.campaign, ["loan_data_id"]),
            ("education_status", src.education, ["education_id"]),
            ("marital_status", src.marital, ["marital_id"]),
        ], "source")
        targets = transform(src, max_valid_year)

        # The sources' profiles are recorded whatever becomes of the targets.
        done = concurrently({"profiles": lambda: audit.save_profiles(run_id, source_profiles),
                             **{n: (lambda n=n, d=d: store.write(n, d)) for n, d in targets.items()}})
        expected = {n: done[n] for n in LOAD_ORDER}
        new = {name: store.read(name) for name in LOAD_ORDER}
        tables.verify_counts(expected, new)
        target_profiles = profile_many([(n, new[n], TARGET_KEYS[n]) for n in LOAD_ORDER], "target")
        before = {n: store.previous(n) for n in LOAD_ORDER}
        previous = {n: spark.createDataFrame([], new[n].schema) if df is None else df for n, df in before.items()}
        changes = change_counts_many([(n, new[n], previous[n], TARGET_KEYS[n]) for n in LOAD_ORDER])
        # Record profiles and changes while both snapshots are still readable.
        concurrently({"profiles": lambda: audit.save_profiles(run_id, target_profiles),
                      "changes": lambda: audit.save_changes(run_id, changes)})
        tables.verify_counts(expected, store.publish())
        audit.mark_succeeded(run_id, time.time() - started)
    except Exception as e:
        # Nothing that goes wrong while the failure is recorded may hide the failure itself.
        for clean_up in (lambda: audit.mark_failed(run_id, f"{type(e).__name__}: {e}"),
                         lambda: audit.export_summary(run_id, summary_path),
                         lambda: store and store.abandon()):
            try:
                clean_up()
            except Exception as second:
                log.warning("while recording a failed run: %s", second)
        raise
    audit.export_summary(run_id, summary_path)
    return run_id, audit.summary(run_id)


def summary_of_first_load(t: Mapping[str, DataFrame]) -> DataFrame:
    """W12 over the driver tables into an empty warehouse of its own, which is deleted afterwards: per target
    its rows and what change detection found, from the run's summary (one row a table)."""
    spark = next(iter(t.values())).sparkSession
    folder = scratch_path(spark, "first-load")
    try:
        _, summary = run(spark, driver_sources(t), f"{folder}/warehouse", f"{folder}/audit", versioned=True)
        found = summary.select(F.explode("changes").alias("c"), "profiles", "status").select("status", "c.*", F.explode("profiles").alias("p")).where(
            "p.stage = 'target' AND p.dataset_name = table_name")
        rows = found.select("table_name", "status", F.col("p.row_count").alias("row_count"), F.col("p.duplicate_key_count").alias("duplicate_key_count"),
                            "inserted_count", "updated_count", "deleted_count", "unchanged_count")
        return spark.createDataFrame(rows.collect(), rows.schema)  # five rows
    finally:
        tables.remove(spark, folder)


def driver_sources(t: Mapping[str, DataFrame]) -> BankSources:
    """Bank-shaped sources derived from the driver tables (events -> transactions CSV, customer ->
    campaign, region / nation -> education / marital lookups)."""
    none_ts = F.lit(None).cast("timestamp_ntz")
    edu = t["region"].select(F.col("r_regionkey").alias("education_id"), F.col("r_name").alias("value"),
                             none_ts.alias("created_at"), none_ts.alias("updated_at"))
    mar = t["nation"].select(
        (F.col("n_nationkey") + 1).alias("marital_id"), F.col("n_name").alias("value"), none_ts.alias("created_at"), none_ts.alias("updated_at"))
    return BankSources(bank.transactions_source(t), bank.campaign_source(t), edu, mar)

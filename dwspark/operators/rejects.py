"""Reject accounting (F4): split rows into accepted and rejected-with-reasons, and count them.

The reference filters rows and reports ``rejected = processed - loaded`` without keeping the
rejected rows. Here the same rule list yields the accepted rows, the rejected rows with an array of
failed rule names, and one summary row — all from the same tagged frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dwspark.functions.rules import Rule

REASONS = "reject_reasons"


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reasons``: the names of the rules the row fails (a null result fails)."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules]
    return df.withColumn(REASONS, F.array_compact(F.array(*failed)))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size(REASONS) == 0).drop(REASONS)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size(REASONS) > 0)


def summary(tagged: DataFrame, rules: Sequence[Rule], key: str | None = None) -> DataFrame:
    """One row: ``processed_rows``, ``rule_rejected_rows``, per-rule failure counts
    (``<rule>_count``) and, when ``key`` is given, ``loaded_rows`` (distinct keys among accepted
    rows, i.e. what a one-row-per-key load keeps), ``duplicate_rows`` and the reference's
    ``rejected_rows = processed - loaded`` (duplicates included)."""
    ok = F.size(REASONS) == 0
    aggs = [
        F.count(F.lit(1)).alias("processed_rows"),
        F.count_if(~ok).alias("rule_rejected_rows"),
        *[F.count_if(F.array_contains(REASONS, name)).alias(f"{name}_count") for name, _ in rules],
    ]
    if key is not None:
        aggs.append(F.count_distinct(F.when(ok, F.col(key))).alias("loaded_rows"))
        aggs.append(F.count_if(ok).alias("_accepted"))
    out = tagged.agg(*aggs)
    if key is not None:
        out = out.withColumn("duplicate_rows", F.col("_accepted") - F.col("loaded_rows")).withColumn(
            "rejected_rows", F.col("processed_rows") - F.col("loaded_rows")
        ).drop("_accepted")
    return out


def write_split(tagged: DataFrame, rules: Sequence[Rule], path: str) -> dict[str, int]:
    """Write accepted and rejected rows from one evaluation of ``tagged``, below ``path`` by ``verdict``, and count them in
    the same job: processed_rows, accepted_rows, rule_rejected_rows and ``<rule>_count`` for every rule."""
    seen = Observation()
    ok = F.size(REASONS) == 0
    counted = tagged.observe(
        seen, F.count(F.lit(1)).alias("processed_rows"), F.count_if(ok).alias("accepted_rows"), F.count_if(~ok).alias("rule_rejected_rows"),
        *[F.count_if(F.array_contains(REASONS, name)).alias(f"{name}_count") for name, _ in rules])
    counted.withColumn("verdict", F.when(ok, "accepted").otherwise("rejected")).write.mode("overwrite").partitionBy("verdict").parquet(path)
    return {name: int(n) for name, n in seen.get.items()}


def _side(spark: SparkSession, path: str, verdict: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("verdict") == verdict).drop("verdict")


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    return _side(spark, path, "accepted").drop(REASONS)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return _side(spark, path, "rejected")

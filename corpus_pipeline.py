"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in
the shared folder and reads it again as the next stage's documents; the tables that a stage made on the way are deleted
once its result is written (their results stay, as the last stage reads lazily). All stages but the last return the columns of ``documents``.

The mixing stage keeps each selected document as often as the mix uses it (its identifier then repeats). The last
stage adds the shard and slot of every document.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dwspark.llm import decontam, mixing, neardup, quality, shards
from dwspark.llm.tables import read, scratch, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.keep_mixed(docs)


def hilbert_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards.keep_in_shards(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("hilbert_shards", hilbert_shards),
]

# Signatures, hashes and the curve are not expressible in DuckDB; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            path = f"{shared_folder(spark)}/pipeline/{name}-{uuid.uuid4().hex[:12]}"
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

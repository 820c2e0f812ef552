"""Profiles that read only new files: one mergeable sketch per file and column, kept in a store (Q10, R2).

A sketch holds counts, lowest and highest value, a HyperLogLog sketch of the distinct values and, for numbers, mean and
squared deviations. Sketches of files add up to the profile of the table in any order, so a re-run scans only the files
that the store does not know (by path, size and change time) and merges the rest. A changed file counts as new; a
deleted file's sketches are no longer used. The store is an append-only Parquet table; a run that fails before its
append has changed nothing, and a file that two runs sketched counts once.

Everything but the distinct count (relative error about 1.6 %) is exact; a profile merged from old and new
sketches equals one made at once, as unions of sketches do not depend on the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.sinks.tables import path_exists

LG_K = 12
FILE = ["file", "size", "changed"]
SCHEMA = ("table_name string, file string, size long, changed timestamp, column_name string, row_count long, missing_count long, "
          "low string, high string, numbers long, mean double, m2 double, low_number double, high_number double, distinct binary")


def _file(prefix: str = "_metadata") -> list[Column]:
    return [F.col(f"{prefix}.file_path").alias("file"), F.col(f"{prefix}.file_size").alias("size"),
            F.col(f"{prefix}.file_modification_time").alias("changed")]


def files(spark: SparkSession, path: str) -> DataFrame:
    """file, size, changed and path of a table's Parquet files, from a listing: no file is opened."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select(*_file(), "path")


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def sketch(df: DataFrame, table: str) -> DataFrame:
    """One row per file of ``df`` (a table read from files) and column, see ``SCHEMA``; one pass over the rows."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        text = F.to_json(F.struct(c)) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")
        text = F.when(c.isNotNull(), text)
        aggs += [F.count(c).alias(f"_c{i}"), F.min(text).alias(f"_lo{i}"), F.max(text).alias(f"_hi{i}"), F.hll_sketch_agg(text, LG_K).alias(f"_d{i}")]
        if _is_number(f.dataType):
            x = F.when(~F.isnan(c.cast("double")), c.cast("double"))
            aggs += [F.count(x).alias(f"_n{i}"), F.avg(x).alias(f"_a{i}"), F.var_pop(x).alias(f"_v{i}"), F.min(x).alias(f"_l{i}"), F.max(x).alias(f"_h{i}")]
    rows = df.select("*", *_file()).groupBy(*FILE).agg(*aggs)
    none = F.lit(None).cast("double")

    def entry(i: int, f: T.StructField) -> Column:
        number = _is_number(f.dataType)
        n = F.col(f"_n{i}") if number else F.lit(0).cast("long")
        return F.struct(
            F.lit(f.name).alias("column_name"), F.col("_rows").alias("row_count"), (F.col("_rows") - F.col(f"_c{i}")).alias("missing_count"),
            F.col(f"_lo{i}").alias("low"), F.col(f"_hi{i}").alias("high"), n.alias("numbers"),
            (F.col(f"_a{i}") if number else none).alias("mean"), (F.col(f"_v{i}") * n if number else none).alias("m2"),
            (F.col(f"_l{i}") if number else none).alias("low_number"), (F.col(f"_h{i}") if number else none).alias("high_number"),
            F.col(f"_d{i}").alias("distinct"))

    return rows.select(F.lit(table).alias("table_name"), *FILE, F.inline(F.array(*[entry(i, f) for i, f in enumerate(fields)])))


def merge(sketches: DataFrame) -> DataFrame:
    """``(table_name, column_name, row_count, missing_count, distinct_count, low, high, mean, std, low_number, high_number)``: ``low`` and
    ``high`` by text, the others of the numbers (sample deviation)."""
    keys = ["table_name", "column_name"]
    n = F.sum("numbers")
    whole = sketches.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.sum("missing_count").alias("missing_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_count"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.try_divide(F.sum(F.col("numbers") * F.col("mean")), n).alias("mean"), F.min("low_number").alias("low_number"),
        F.max("high_number").alias("high_number"), n.alias("_n"))
    around = sketches.join(whole.select(*keys, F.col("mean").alias("_mean")), keys).groupBy(*keys).agg(
        F.sum(F.col("m2") + F.col("numbers") * F.pow(F.col("mean") - F.col("_mean"), 2)).alias("_m2"))
    std = F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1)))
    return whole.join(around, keys).select(
        *keys, "row_count", "missing_count", "distinct_count", "low", "high", "mean", std.alias("std"), "low_number", "high_number")


class Profiles:
    """The store of sketches below ``base`` (a folder that all executors share)."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.path = spark, f"{base.rstrip('/')}/sketches"

    def kept(self, table: str) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path).where(F.col("table_name") == table).dropDuplicates([*FILE, "column_name"])

    def new_files(self, table: str, path: str) -> list[str]:
        """Files of the table that the store has no sketch of."""
        known = self.kept(table).select(*FILE).distinct()
        return [r.path for r in files(self.spark, path).join(known, FILE, "left_anti").select("path").collect()]  # paths, as the scan needs them

    def refresh(self, table: str, path: str) -> DataFrame:
        """Sketch the new files, keep the sketches, and return the profile of all files that are there now."""
        fresh = self.new_files(table, path)
        if fresh:
            sketch(self.spark.read.parquet(*fresh), table).write.mode("append").parquet(self.path)
        return merge(self.kept(table).join(files(self.spark, path).select(*FILE), FILE, "left_semi"))

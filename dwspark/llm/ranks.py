"""Running totals in a global order without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.llm.tables import save


def running_total(df: DataFrame, group: str, order: list[str], value: str, name: str = "before") -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the earlier rows of the same ``group`` (a string
    without nulls) in the given order.

    Rows are range-partitioned by group and order, so a group with a third of all rows spans many
    partitions. Each task adds up its own sorted rows batch by batch (its only state is one total); the
    result is written once; the totals by partition and group, a few rows a partition, give the offsets.
    Fully equal rows stand in an arbitrary order that the written table fixes.
    """
    spark = df.sparkSession
    schema = T.StructType([*df.schema.fields, T.StructField("_pid", T.IntegerType()), T.StructField("_local", T.LongType())])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid, last, total = TaskContext.get().partitionId(), None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            sums = pdf.groupby(group, sort=False)[value].cumsum()
            sums = sums + (pdf[group] == last) * total if last is not None else sums
            last, total = pdf[group].iloc[-1], int(sums.iloc[-1])
            yield pdf.assign(_pid=pid, _local=(sums - pdf[value]).astype("int64"))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
    table = save(ranged.mapInPandas(add, schema), "running")
    earlier = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = table.groupBy("_pid", group).agg(F.sum(value).alias("_sum")).select(
        "_pid", group, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    return table.join(offsets, ["_pid", group]).select(*df.columns, (F.col("_offset") + F.col("_local")).alias(name))

"""Exact order statistics of many columns at once, without a task that holds a column's values (Q11).

The values of all columns form one long table (keys, value). It is counted per distinct value first, so a value
that fills a third of a column is one row; the distinct values are range-partitioned by (keys, value); each
partition gives one row a column: its lowest and highest value and how many rows it stands for. Running totals over those few
rows say which partition holds a wanted rank, and only the values between that partition's bounds are looked
at again. Ranges are carried as values, never as partition numbers, so it does not matter if a lost executor
makes Spark draw the bounds anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(long: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, value, ``n`` for every distinct value that is neither null nor NaN."""
    present = long.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def values_at_ranks(counts: DataFrame, keys: Sequence[str], value: str, ranks: DataFrame) -> DataFrame:
    """keys, ``rank``, value: the value at each wanted rank (from 0, by value) of each group of ``keys``.

    ``counts``: keys, value, n (see :func:`value_counts`); ``ranks``: keys, rank, a bounded number per group."""
    spark = counts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = counts.repartitionByRange(parts, *keys, value).groupBy(F.spark_partition_id().alias("_part"), *keys).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"), F.sum("n").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    inside = (F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("_rows"))
    wanted = ranges.join(ranks.distinct(), list(keys)).where(inside).select(*keys, "rank", "_low", "_high", "_before")
    # One row a wanted rank: a few per group, whatever the data.
    near = counts.join(F.broadcast(wanted), list(keys)).where(F.col(value).between(F.col("_low"), F.col("_high")))
    upto = Window.partitionBy(*keys, "rank").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("_upto", F.col("_before") + F.sum("n").over(upto))
    return near.where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("n"))).select(*keys, "rank", value)


def percentiles(long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """keys, ``prob``, value: percentiles that interpolate linearly between the two nearest ranks."""
    counts = value_counts(long, keys, value)
    each = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    places = counts.groupBy(*keys).agg(F.sum("n").alias("_n")).select(*keys, each.alias("prob"), ((F.col("_n") - 1)).alias("_last"))
    places = places.withColumn("_at", F.col("_last") * F.col("prob")).withColumns(
        {"_lo": F.floor("_at"), "_hi": F.ceil("_at"), "_part": F.col("_at") - F.floor("_at")})
    points = places.select(*keys, "prob", "_part", F.explode(F.array("_lo", "_hi")).alias("rank"))
    found = values_at_ranks(counts, keys, value, points.select(*keys, "rank")).withColumn(value, F.col(value).cast("double"))
    low, high = F.min(value), F.max(value)  # of the two ranks
    return points.join(found, [*keys, "rank"]).groupBy(*keys, "prob").agg((low + (high - low) * F.max("_part")).alias(value))

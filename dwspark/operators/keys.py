"""Deterministic deduplication (A6) and dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwspark.session import scratch_path


# A6 ----------------------------------------------------------------------------------------------
def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None, keep: str = "first") -> DataFrame:
    """One row per key, chosen deterministically.

    The survivor is the row with the smallest (``keep="first"``) or largest (``"last"``) value of
    ``order_by`` followed by all other columns, so ties are broken by the whole row. It is computed as
    ``min``/``max`` of a struct: a partial aggregate, so a key holding a third of the table is
    reduced to one row per map task before the shuffle (a ``row_number`` window would pull the whole
    group into one task). Null keys form one group, like ``dropDuplicates``.
    """
    keys = list(keys)
    order_by = [c for c in (order_by or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    fields = order_by + rest
    if not fields:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(fields)])
    pick = F.min(packed) if keep == "first" else F.max(packed)
    out = df.groupBy(*keys).agg(pick.alias("_row"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_row._f{fields.index(c)}").alias(c) for c in df.columns])


# A7 ----------------------------------------------------------------------------------------------
def with_surrogate_key(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "sk",
    start: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add a dense key ``start, start+1, ...`` in ``order_by`` order (ties broken by all columns),
    equal to ``row_number() OVER (ORDER BY order_by) + start - 1`` without a single-partition
    window.

    Plan: range-partition + sort within partitions; tag each row with its partition position
    (``monotonically_increasing_id``: partition index in the high bits, position in the low bits);
    write that once as a Parquet table under the shared checkpoint folder, so a lost executor cannot
    renumber rows and nothing is computed twice; count rows per partition index (one row per
    partition, so broadcasting the offsets is bounded by the partition count, not the data); add the
    running offset.
    """
    spark = df.sparkSession
    order_by = list(order_by)
    tie = [c for c in df.columns if c not in order_by]
    cols = order_by + tie
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        # Range bounds over the full order (key, then every other column), so the sampled bounds
        # can split a natural key that holds a large share of the rows.
        df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in cols])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in cols])
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    path = scratch_path(spark, "surrogate-key")
    ranged.write.mode("overwrite").parquet(path)
    tagged = spark.read.parquet(path).withColumn("_part", F.shiftright(F.col("_mid"), 33))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
    )
    local = F.col("_mid") - F.shiftleft(F.col("_part"), 33)
    keyed = tagged.join(F.broadcast(offsets), "_part")
    return keyed.select((F.col("_off") + local + F.lit(start)).cast("long").alias(name), *[F.col(c) for c in df.columns])

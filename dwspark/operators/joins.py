"""Join operators.

No side is marked for broadcast: Catalyst and AQE choose from statistics in bytes (broadcast, shuffled
hash or sort-merge join, with AQE's skew-join split for hot keys).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwspark.functions.clean import join_key

# J1 ----------------------------------------------------------------------------------------------
def lookup_join(
    df: DataFrame,
    ref: DataFrame,
    left_col: str,
    right_col: str,
    value_cols: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Left lookup on normalised keys (``lower(trim())`` on both sides). Null or unmatched keys give
    null values, to be rejected later by a required rule. The reference side is narrowed to key +
    values. Null keys can never match; each is salted with a number of its own (a non-matching key), so
    that a column of mostly nulls does not land in one partition of a shuffled join."""
    key, salt = f"_jk_{left_col}", f"_salt_{left_col}"
    right = ref.select(join_key(right_col).alias(key), F.lit(0).alias(salt), *value_cols).where(F.col(key).isNotNull())
    # Constant for the rows that can match; the row's own hash for those that cannot.
    own = F.when(join_key(left_col).isNull(), F.abs(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) % 1000).cast("int") + 1).otherwise(0)
    return df.withColumns({key: F.coalesce(join_key(left_col), F.lit("")), salt: own}).join(right, [key, salt], how).drop(key, salt)


# J2 ----------------------------------------------------------------------------------------------
def join_ignore_case(
    df: DataFrame, ref: DataFrame, left_col: str, right_col: str, value_cols: Sequence[str], how: str = "left"
) -> DataFrame:
    """``lower(a) = lower(b)`` written as an equi-join on a derived key, so it stays a hash/sort-merge
    join instead of a nested loop."""
    key = f"_ci_{left_col}"
    right = ref.select(F.lower(F.col(right_col)).alias(key), *value_cols)
    return df.withColumn(key, F.lower(F.col(left_col))).join(right, key, how).drop(key)


# J6 ----------------------------------------------------------------------------------------------
def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Full outer join on ``keys``. With ``null_safe`` null keys match each other (``<=>``)."""
    if not null_safe:
        return left.join(right, list(keys), "full_outer")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    joined = left.join(right, cond, "full_outer")
    return joined.select(
        *[F.coalesce(left[k], right[k]).alias(k) for k in keys],
        *[left[c] for c in left.columns if c not in keys],
        *[right[c] for c in right.columns if c not in keys],
    )


# J8 ----------------------------------------------------------------------------------------------
def latest_previous(
    df: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    order_col: str,
    value_col: str,
    alias: str,
) -> DataFrame:
    """Left-join each row of ``df`` to the ``value_col`` of the newest ``history`` row with the same
    keys (``ORDER BY order_col DESC LIMIT 1`` per key, as ``max_by``)."""
    latest = history.groupBy(*keys).agg(F.max_by(value_col, order_col).alias(alias))
    return df.join(latest, list(keys), "left")


BLOCKS = 1024  # of the time range


def as_of(df: DataFrame, history: DataFrame, keys: Sequence[str], time: str, history_time: str, values: Sequence[str],
          tie: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """J8 for every row at its own time: ``df`` with the ``values`` of the newest ``history`` row of the same keys whose
    time is not after the row's (null if there is none). Of several at that time the largest by ``tie`` counts.

    Both sides are sorted together by (keys, time) and the last history row is carried on. That happens within blocks
    of the time range first; a block without a history row before a given row takes the last one of the key's
    earlier blocks, from a table of one row per key and block. A key with a third of all rows is spread over the blocks,
    and no key's rows are joined with each other. Null keys or times match nothing."""
    packed = F.struct(F.col(history_time).alias("at"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    present = " AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, history_time])
    newest = history.where(present).groupBy(*keys, F.col(history_time).alias("_time")).agg(F.max(packed).alias("_last"))
    moment = F.col("_time").cast("timestamp").cast("double")
    ends = newest.agg(F.min(moment).alias("lo"), F.max(moment).alias("hi")).first()  # one row
    lo, hi = (ends["lo"] or 0.0), (ends["hi"] or 0.0)
    place = F.floor((moment - lo) / (hi - lo) * BLOCKS) if hi > lo else F.when(moment < lo, -1).otherwise(0)
    block = F.greatest(F.least(place, F.lit(BLOCKS)), F.lit(-1)).cast("int").alias("_block")

    rows = df.withColumns({"_time": F.col(time), "_row": F.struct(*[F.col(f"`{c}`") for c in df.columns])}).select(*keys, "_time", "_row")
    both = rows.unionByName(newest, allowMissingColumns=True).withColumn("_block", block)
    inside = Window.partitionBy(*keys, "_block").orderBy("_time", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("_found", F.last("_last", ignorenulls=True).over(inside)).where("_row IS NOT NULL")
    ends_of = newest.withColumn("_block", block).groupBy(*keys, "_block").agg(F.max("_last").alias("_last"))
    needed = both.select(*keys, "_block").distinct().withColumn("_ask", F.lit(True))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    asked = needed.join(ends_of, [*keys, "_block"], "full").withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).where("_ask")
    found = both.join(asked.select(*keys, "_block", "_carried"), [*keys, "_block"], "left").withColumn(
        "_found", F.when(F.col("_time").isNotNull(), F.coalesce("_found", "_carried")))
    return found.select("_row.*", *[F.col(f"_found.v{i}").alias(f"{prefix}{c}") for i, c in enumerate(values)])


# J9 ----------------------------------------------------------------------------------------------
def missing_from(df: DataFrame, ref: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """Rows of ``df`` whose non-null ``left_col`` has no match in ``ref.right_col``.

    This is the anti join behind ``x NOT IN (SELECT y ...)`` checks, minus SQL's surprise: a null in
    the list does not empty the result, and null ``x`` rows are not reported (as ``NOT IN`` does not)."""
    right = ref.select(F.col(right_col).alias("_anti_key")).where(F.col("_anti_key").isNotNull())
    return df.where(F.col(left_col).isNotNull()).join(right, F.col(left_col) == F.col("_anti_key"), "left_anti")

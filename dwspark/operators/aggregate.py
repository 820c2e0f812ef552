"""Aggregation, sort/limit and union operators.

Every aggregate here is a declarative Spark aggregate, so the physical plan does a map-side partial
aggregation before the shuffle: a hot key is reduced to one row per map task before it moves.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwspark.functions.clean import safe_divide


# A1 ----------------------------------------------------------------------------------------------
def item_summary(
    detail: DataFrame,
    group_col: str,
    product_col: str,
    quantity_col: str,
    amount_col: str,
    prefix: str = "",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Per header row: ``min(product)``, ``sum(quantity)``, ``sum(amount)`` and the weighted unit
    price ``sum(amount) / sum(quantity)`` (null when the quantity sum is 0), and ``extra`` aggregates."""
    qty, amt = F.sum(quantity_col), F.sum(amount_col)
    return detail.groupBy(group_col).agg(
        F.min(product_col).alias(f"{prefix}product_id"),
        qty.alias(f"{prefix}quantity"),
        safe_divide(amt, qty).alias(f"{prefix}unit_price"),
        amt.alias(f"{prefix}subtotal"),
        *extra,
    )


# A2 ----------------------------------------------------------------------------------------------
def conditional_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """One pass, one row: ``count_if(predicate)`` for each named predicate."""
    return df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in predicates.items()])


def count_distinct(df: DataFrame, columns: Sequence[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """One row with the distinct count of each column. ``approx`` uses HyperLogLog++ (no shuffle,
    fixed memory); exact counting shuffles each column's distinct values."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


# A5 ----------------------------------------------------------------------------------------------
def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """R², RMSE and MAE in one aggregation: ``r2 = 1 - SSres / SStot`` with
    ``SStot = n · var_pop(actual)`` (Spark's variance merge is numerically stable)."""
    a, p = F.col(actual), F.col(predicted)
    n = F.count(F.lit(1))
    ss_res = F.sum((a - p) * (a - p))
    ss_tot = F.var_pop(a) * n
    return df.where(a.isNotNull() & p.isNotNull()).agg(
        (F.lit(1.0) - safe_divide(ss_res, ss_tot)).alias("r2"),
        F.sqrt(ss_res / n).alias("rmse"),
        F.avg(F.abs(a - p)).alias("mae"),
        n.alias("n"),
    )


# O1/O2 -------------------------------------------------------------------------------------------
def sort_by(df: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """``order`` is ``[(column, ascending)]``; nulls go first when ascending, last when descending."""
    return df.orderBy(*[F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order])


def top_k(df: DataFrame, order: Sequence[tuple[str, bool]], k: int) -> DataFrame:
    """Sort + limit: Spark plans this as TakeOrderedAndProject (a k-row heap per task, then a merge
    of k rows per task), never a full sort. Add a unique column to ``order`` for a total order."""
    return sort_by(df, order).limit(k)


# O3 ----------------------------------------------------------------------------------------------
def latest_per_group(df: DataFrame, keys: Sequence[str], order_col: str, value_cols: Sequence[str]) -> DataFrame:
    """Per group, the values of the row with the greatest ``order_col`` (``max_by``; partial
    aggregation keeps a hot group to one row per task)."""
    latest = F.max_by(F.struct(*[F.col(c) for c in value_cols]), F.col(order_col)).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in value_cols])


# U1 ----------------------------------------------------------------------------------------------
def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)

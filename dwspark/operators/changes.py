"""Snapshot change detection.

A row's payload (all non-key columns, sorted by name, with the previous snapshot's types aligned to
the current one's) is rendered as ``to_json(struct(...))`` with null fields kept, so null, absent
and the text ``"null"`` all differ, and hashed: ``sha2(..., 256)`` for a stored row hash (C1); two
64-bit xxhash64 values (a 128-bit fingerprint) inside the counting, which keeps it a hash
aggregation.

Both snapshots are first reduced to one row per key — row count plus an order-independent digest of
the payload hashes — with a partial aggregation, then full-outer-joined on the key. The
aggregation leaves its output hash-partitioned on the key, so the join adds no further shuffle; and
because each side has at most one row per key, a key repeated a billion times costs one row in the
join instead of a billion-squared pairs.

Counting (C2) is in current-snapshot rows: ``inserted`` rows whose key is absent from the previous
snapshot, ``updated``/``unchanged`` rows whose key is present with a different/equal payload, and
``deleted`` previous rows whose key is gone. With unique keys this is exactly the reference's
row-pair count, and ``inserted + updated + unchanged`` is always the current row count. Null keys
never match (each null-key row is an insert and, on the other side, a delete, as in the reference)
unless ``null_safe=True``. For a repeated key the reference counts every current×previous pair; here
the key's rows are compared as a multiset of payload hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwspark.operators.aggregate import union_all

HASH = "_row_hash"


# C1 ----------------------------------------------------------------------------------------------
def payload_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    payload = sorted(c for c in df.columns if c not in keys)
    struct = F.struct(*[F.col(f"`{c}`").alias(c) for c in payload])
    return F.sha2(F.to_json(struct, {"ignoreNullFields": "false"}), 256)


def with_row_hash(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys plus ``_row_hash`` of the payload."""
    return df.select(*keys, payload_hash(df, keys).alias(HASH))


DRIFT = "_drift"


def align(previous: DataFrame, current: DataFrame) -> DataFrame:
    """The previous snapshot with the current snapshot's columns (missing columns null). Where types
    differ the previous value is read as the current type, so that the same value hashes the same on
    both sides (``1.50`` decimal vs ``1.5`` double); a value that the type cannot hold becomes null."""
    return _aligned(previous, current).drop(DRIFT)


def _aligned(previous: DataFrame, current: DataFrame) -> DataFrame:
    """:func:`align` with a flag for the rows in which a value became null: they differ from every
    current row, also from one with a null there."""
    cols, lost = [], F.lit(False)
    types = dict(previous.dtypes)
    for f in current.schema.fields:
        name = F.col(f"`{f.name}`")
        if f.name in previous.columns and types[f.name] == f.dataType.simpleString():
            cols.append(name)
        elif f.name in previous.columns:
            cols.append(name.try_cast(f.dataType).alias(f.name))
            lost = lost | (name.isNotNull() & name.try_cast(f.dataType).isNull())
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return previous.select(*cols, lost.alias(DRIFT))


def _digests(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """One row per key: row count and an order-independent digest of the payloads.

    The digest is built from two 64-bit hashes of the same JSON payload C1 hashes (a 128-bit
    fingerprint), folded with XOR and with sums of their 32-bit halves, so every buffer is a fixed
    width number and Spark keeps the partial aggregation a hash aggregate (a string min/max would
    force a sort of every map partition)."""
    payload = sorted(c for c in df.columns if c not in keys)
    js = F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in payload]), {"ignoreNullFields": "false"})
    h = df.select(*keys, F.xxhash64(js, F.lit(1)).alias("_h1"), F.xxhash64(js, F.lit(2)).alias("_h2"))
    low = F.lit(0xFFFFFFFF)
    return h.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"_{side}_n"),
        F.struct(
            F.count(F.lit(1)).alias("n"), F.bit_xor("_h1").alias("x1"), F.bit_xor("_h2").alias("x2"),
            F.sum(F.shiftright("_h1", 32)).alias("s1"), F.sum(F.col("_h2").bitwiseAND(low)).alias("s2"),
        ).alias(f"_{side}_digest"),
    )


def _joined(current: DataFrame, previous: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    previous = _aligned(previous, current)
    cur, prev = _digests(current.withColumn(DRIFT, F.lit(False)), keys, "cur"), _digests(previous, keys, "prev")
    if not null_safe:
        return cur.join(prev, list(keys), "full_outer")
    cond = None
    for k in keys:
        c = cur[k].eqNullSafe(prev[k])
        cond = c if cond is None else cond & c
    j = cur.join(prev, cond, "full_outer")
    return j.select(*[F.coalesce(cur[k], prev[k]).alias(k) for k in keys], "_cur_n", "_cur_digest", "_prev_n", "_prev_digest")


def _change_type() -> Column:
    cur, prev = F.col("_cur_n").isNotNull(), F.col("_prev_n").isNotNull()
    same = F.col("_cur_digest") == F.col("_prev_digest")
    return (
        F.when(cur & ~prev, "insert").when(~cur & prev, "delete").when(same, "unchanged").otherwise("update")
    )


# C2 / C3 -----------------------------------------------------------------------------------------
def change_counts(current: DataFrame, previous: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """One row: ``inserted_count, updated_count, deleted_count, unchanged_count``. An empty previous
    snapshot makes every current row an insert (C3) without a separate path."""
    j = _joined(current, previous, keys, null_safe).withColumn("_type", _change_type())
    n_cur, n_prev = F.col("_cur_n"), F.col("_prev_n")
    return j.agg(
        F.coalesce(F.sum(F.when(F.col("_type") == "insert", n_cur)), F.lit(0)).cast("long").alias("inserted_count"),
        F.coalesce(F.sum(F.when(F.col("_type") == "update", n_cur)), F.lit(0)).cast("long").alias("updated_count"),
        F.coalesce(F.sum(F.when(F.col("_type") == "delete", n_prev)), F.lit(0)).cast("long").alias("deleted_count"),
        F.coalesce(F.sum(F.when(F.col("_type") == "unchanged", n_cur)), F.lit(0)).cast("long").alias("unchanged_count"),
    )


# C4 ----------------------------------------------------------------------------------------------
def change_feed(
    current: DataFrame, previous: DataFrame, keys: Sequence[str], null_safe: bool = False, include_unchanged: bool = False
) -> DataFrame:
    """One row per key: ``keys..., change_type, current_rows, previous_rows`` (``insert``,
    ``update``, ``delete`` and, if asked, ``unchanged``)."""
    j = _joined(current, previous, keys, null_safe).withColumn("change_type", _change_type())
    if not include_unchanged:
        j = j.where(F.col("change_type") != "unchanged")
    return j.select(
        *keys, "change_type",
        F.coalesce(F.col("_cur_n"), F.lit(0)).cast("long").alias("current_rows"),
        F.coalesce(F.col("_prev_n"), F.lit(0)).cast("long").alias("previous_rows"),
    )


def changed_rows(current: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The feed with the data: every changed key's rows as they are now (``image`` = ``after``: inserts
    and updates) and as they were (``before``: updates and deletes), tagged with ``change_type``. A
    repeated key gives all its rows of each image, never pairs of them."""
    feed = change_feed(current, previous, keys).select(*keys, "change_type")
    after = current.join(feed.where(F.col("change_type") != "delete"), list(keys)).withColumn("image", F.lit("after"))
    before = align(previous, current).join(feed.where(F.col("change_type") != "insert"), list(keys)).withColumn("image", F.lit("before"))
    return after.unionByName(before)


# C5 ----------------------------------------------------------------------------------------------
def change_counts_many(snapshots: Sequence[tuple[str, DataFrame, DataFrame, Sequence[str]]], null_safe: bool = False) -> DataFrame:
    """C2 for ``[(table, current, previous, keys)]``, one row per table, in the given order
    (``position`` 1, 2, ...)."""
    return union_all(
        change_counts(cur, prev, keys, null_safe).select(
            F.lit(i + 1).alias("position"), F.lit(name).alias("table_name"), "*")
        for i, (name, cur, prev, keys) in enumerate(snapshots)
    )

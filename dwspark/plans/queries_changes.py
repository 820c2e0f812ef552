"""Registered change-detection queries (C2, C4, C5, J6) with their DuckDB oracles.

The previous snapshot is the table as an earlier load would have seen it: orders placed from 2001 on
did not exist yet (they are inserts now), orders fulfilled during 2000 were still open (updates), and
pending orders placed before 1996 were later purged (they exist only in the previous snapshot, under
keys past the current range: deletes). The oracle compares the columns themselves instead of hashes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dwspark.operators import changes
from dwspark.plans.catalog import register

PURGED_KEY_OFFSET = 1_000_000_000
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def previous_orders(orders):
    ts = F.col("o_orderdate")
    older = orders.where(ts < F.expr("timestamp_ntz'2001-01-01 00:00:00'")).select(
        "o_orderkey", "o_custkey",
        F.when((F.col("o_orderstatus") == "F") & (ts >= F.expr("timestamp_ntz'2000-01-01 00:00:00'")), F.lit("O"))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice", "o_orderdate", "o_orderpriority",
    )
    purged = orders.where((F.col("o_orderstatus") == "P") & (ts < F.expr("timestamp_ntz'1996-01-01 00:00:00'"))).select(
        (F.col("o_orderkey") + PURGED_KEY_OFFSET).alias("o_orderkey"), *ORDER_COLS[1:])
    return older.unionByName(purged)


def previous_customers(customer):
    return customer.where(F.col("c_nationkey") < 24).select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment",
    )


PREV_ORDERS_SQL = f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-01-01' THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'
UNION ALL
SELECT o_orderkey + {PURGED_KEY_OFFSET}, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01'
"""

PREV_CUSTOMERS_SQL = """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer WHERE c_nationkey < 24
"""


def _joined_sql(cur: str, prev: str, key: str, cols: list[str]) -> str:
    same = " AND ".join(f"c.{c} IS NOT DISTINCT FROM p.{c}" for c in cols if c != key)
    return (f"SELECT c.{key} AS ck, p.{key} AS pk, coalesce(c.{key}, p.{key}) AS k, ({same}) AS same "
            f"FROM ({cur}) c FULL OUTER JOIN ({prev}) p ON c.{key} = p.{key}")


def _counts_sql(joined: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE pk IS NULL) AS inserted_count,
       count(*) FILTER (WHERE ck IS NOT NULL AND pk IS NOT NULL AND NOT same) AS updated_count,
       count(*) FILTER (WHERE ck IS NULL) AS deleted_count,
       count(*) FILTER (WHERE ck IS NOT NULL AND pk IS NOT NULL AND same) AS unchanged_count
FROM ({joined})"""


ORDERS_JOINED_SQL = _joined_sql("SELECT * FROM orders", PREV_ORDERS_SQL, "o_orderkey", ORDER_COLS)
CUSTOMERS_JOINED_SQL = _joined_sql("SELECT * FROM customer", PREV_CUSTOMERS_SQL, "c_custkey", CUSTOMER_COLS)


@register("c2_change_counts", _counts_sql(ORDERS_JOINED_SQL), headline=True)
def c2_change_counts(t):
    return changes.change_counts(t["orders"], previous_orders(t["orders"]), ["o_orderkey"])


@register("c4_change_feed", f"""
SELECT k AS o_orderkey,
       CASE WHEN pk IS NULL THEN 'insert' WHEN ck IS NULL THEN 'delete' ELSE 'update' END AS change_type,
       CAST(CASE WHEN ck IS NULL THEN 0 ELSE 1 END AS BIGINT) AS current_rows,
       CAST(CASE WHEN pk IS NULL THEN 0 ELSE 1 END AS BIGINT) AS previous_rows
FROM ({ORDERS_JOINED_SQL}) WHERE NOT (ck IS NOT NULL AND pk IS NOT NULL AND same)
""")
def c4_change_feed(t):
    return changes.change_feed(t["orders"], previous_orders(t["orders"]), ["o_orderkey"])


_CHANGED = f"SELECT k, ck, pk FROM ({ORDERS_JOINED_SQL}) WHERE NOT (ck IS NOT NULL AND pk IS NOT NULL AND same)"


@register("c4_changed_rows", f"""
SELECT c.*, CASE WHEN j.pk IS NULL THEN 'insert' ELSE 'update' END AS change_type, 'after' AS image
FROM orders c JOIN ({_CHANGED}) j ON j.ck = c.o_orderkey
UNION ALL
SELECT p.*, CASE WHEN j.ck IS NULL THEN 'delete' ELSE 'update' END AS change_type, 'before' AS image
FROM ({PREV_ORDERS_SQL}) p JOIN ({_CHANGED}) j ON j.pk = p.o_orderkey
""")
def c4_changed_rows(t):
    return changes.changed_rows(t["orders"], previous_orders(t["orders"]), ["o_orderkey"])


@register("c1_row_hash", """
SELECT c_custkey, sha256('{"c_acctbal":' || CAST(c_acctbal AS VARCHAR) || ',"c_mktsegment":"' || c_mktsegment
       || '","c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}') AS _row_hash
FROM customer
""")
def c1_row_hash(t):
    return changes.with_row_hash(t["customer"], ["c_custkey"])


@register("c3_first_snapshot", """
SELECT count(*) AS inserted_count, CAST(0 AS BIGINT) AS updated_count, CAST(0 AS BIGINT) AS deleted_count,
       CAST(0 AS BIGINT) AS unchanged_count FROM orders
""")
def c3_first_snapshot(t):
    return changes.change_counts(t["orders"], t["orders"].where(F.lit(False)), ["o_orderkey"])


@register("c5_change_summary", f"""
SELECT 1 AS position, 'orders' AS table_name, * FROM ({_counts_sql(ORDERS_JOINED_SQL)})
UNION ALL
SELECT 2, 'customer', * FROM ({_counts_sql(CUSTOMERS_JOINED_SQL)})
""")
def c5_change_summary(t):
    return changes.change_counts_many([
        ("orders", t["orders"], previous_orders(t["orders"]), ["o_orderkey"]),
        ("customer", t["customer"], previous_customers(t["customer"]), ["c_custkey"]),
    ])


@register("j6_snapshot_full_outer", f"""
SELECT k AS o_orderkey, ck IS NOT NULL AS in_current, pk IS NOT NULL AS in_previous FROM ({ORDERS_JOINED_SQL})
""")
def j6_snapshot_full_outer(t):
    from dwspark.operators.joins import full_outer

    cur = t["orders"].select("o_orderkey", F.lit(True).alias("in_current"))
    prev = previous_orders(t["orders"]).select("o_orderkey", F.lit(True).alias("in_previous"))
    j = full_outer(cur, prev, ["o_orderkey"])
    return j.select("o_orderkey", F.coalesce("in_current", F.lit(False)).alias("in_current"),
                    F.coalesce("in_previous", F.lit(False)).alias("in_previous"))

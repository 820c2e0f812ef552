"""Registered warehouse-model queries (W*, A1, J*, P10–P12) with their DuckDB oracles."""

from __future__ import annotations

from dwspark.plans import warehouse as wh
from dwspark.plans.catalog import register

# Shared SQL pieces (DuckDB).
ITEM_SUMMARY_SQL = """
SELECT l_orderkey AS order_id,
       min(l_partkey) AS product_id,
       sum(l_quantity) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(sum(l_quantity), 0) AS unit_price,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS subtotal
FROM lineitem GROUP BY l_orderkey
"""

PRODUCTS_SQL = """
WITH src AS (
  SELECT p_partkey, p_name, p_type, p_brand, p_size,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price,
         CASE WHEN p_size <= 2 THEN -1 ELSE 1 END
           * ((CAST(round(p_retailprice * 100) AS BIGINT) * (p_partkey % 10 + 11)) // 20) AS cost_cents
  FROM part
), txt AS (
  SELECT p_partkey, p_name, p_type, p_brand,
         CASE p_partkey % 4 WHEN 0 THEN CAST(price AS VARCHAR)
                            WHEN 1 THEN '$' || CAST(price AS VARCHAR)
                            WHEN 2 THEN CAST(price AS VARCHAR) || ' USD'
                            ELSE 'IDR ' || CAST(price AS VARCHAR) END AS unit_price,
         CASE (p_partkey + 1) % 4
              WHEN 0 THEN CAST(CAST(cost_cents / 100.0 AS DECIMAL(18,2)) AS VARCHAR)
              WHEN 1 THEN '$' || CAST(CAST(cost_cents / 100.0 AS DECIMAL(18,2)) AS VARCHAR)
              WHEN 2 THEN CAST(CAST(cost_cents / 100.0 AS DECIMAL(18,2)) AS VARCHAR) || ' USD'
              ELSE 'IDR ' || CAST(CAST(cost_cents / 100.0 AS DECIMAL(18,2)) AS VARCHAR) END AS cost_price,
         CASE p_partkey % 8 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'available'
              WHEN 3 THEN 'Out of Stock' WHEN 4 THEN '1' WHEN 5 THEN '0' WHEN 6 THEN 'maybe' ELSE '' END AS in_stock
  FROM src
), brands AS (
  SELECT brand_name, row_number() OVER (ORDER BY brand_name) AS sk_brand_id
  FROM (SELECT DISTINCT upper(p_brand) AS brand_name FROM part)
)
SELECT row_number() OVER (ORDER BY p_partkey) AS sk_product_id,
       p_partkey AS nk_product_id, p_name AS product_name, p_type AS category,
       TRY_CAST(NULLIF(regexp_replace(unit_price, '[^0-9.-]', '', 'g'), '') AS DECIMAL(18,2)) AS unit_price,
       TRY_CAST(NULLIF(regexp_replace(cost_price, '[^0-9.-]', '', 'g'), '') AS DECIMAL(18,2)) AS cost_price,
       CASE WHEN lower(in_stock) IN ('true','t','1','yes','y','available','in stock') THEN true
            WHEN lower(in_stock) IN ('false','f','0','no','n','unavailable','out of stock') THEN false END AS in_stock,
       b.sk_brand_id
FROM txt LEFT JOIN brands b ON lower(b.brand_name) = lower(txt.p_brand)
"""

CUSTOMERS_SQL = """
SELECT row_number() OVER (ORDER BY c_custkey) AS sk_customer_id,
       c_custkey AS nk_customer_id, c_name AS customer_name, c_nationkey AS nation_id,
       CAST(c_acctbal AS DECIMAL(18,2)) AS account_balance, c_mktsegment AS market_segment
FROM customer
"""


@register("w5_fct_order", f"""
WITH s AS ({ITEM_SUMMARY_SQL}),
c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS sk_customer_id FROM customer),
p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS sk_product_id FROM part),
e AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS sk_employee_id FROM supplier),
f AS (SELECT l_orderkey, min(l_suppkey) AS employee_id FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey AS nk_order_id, c.sk_customer_id, p.sk_product_id, e.sk_employee_id,
       CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS order_date,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_amount,
       s.quantity, s.unit_price, s.subtotal,
       o.o_orderpriority AS order_priority, o.o_orderstatus AS order_status
FROM orders o
LEFT JOIN s ON s.order_id = o.o_orderkey
LEFT JOIN c ON c.c_custkey = o.o_custkey
LEFT JOIN p ON p.p_partkey = s.product_id
LEFT JOIN f ON f.l_orderkey = o.o_orderkey
LEFT JOIN e ON e.s_suppkey = f.employee_id
""", headline=True)
def w5_fct_order(t):
    return wh.fct_order(t)


@register("a1_order_item_summary", ITEM_SUMMARY_SQL)
def a1_order_item_summary(t):
    return wh.order_item_summary(t)


@register("w1_dim_customers", CUSTOMERS_SQL)
def w1_dim_customers(t):
    return wh.dim_customers(t)


@register("w4_dim_products", PRODUCTS_SQL, headline=True)
def w4_dim_products(t):
    return wh.dim_products(t)


@register("w3_dim_brand", """
SELECT row_number() OVER (ORDER BY brand_name) AS sk_brand_id, brand_name
FROM (SELECT DISTINCT upper(p_brand) AS brand_name FROM part)
""")
def w3_dim_brand(t):
    return wh.dim_brand(t)


@register("w6_fct_inventory", """
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, p.sk_product_id,
       CAST(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE -l.l_quantity END AS INTEGER) AS quantity_change,
       CAST(strftime(l.l_shipdate, '%Y%m%d') AS INTEGER) AS change_date,
       CASE WHEN l.l_returnflag = 'R' THEN 'Return' ELSE 'Sale' END AS reason
FROM lineitem l
LEFT JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS sk_product_id FROM part) p
  ON p.p_partkey = l.l_partkey
""")
def w6_fct_inventory(t):
    return wh.fct_inventory(t)


@register("w7_dim_date", """
WITH b AS (
  SELECT min(d) AS lo, max(d) AS hi
  FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)
), days AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b
)
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_id, date,
       CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
       CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name,
       dayofweek(date) IN (0, 6) AS is_weekend
FROM days
""")
def w7_dim_date(t):
    return wh.dim_date(t)


@register("w2_dim_employees", """
SELECT row_number() OVER (ORDER BY s_suppkey) AS sk_employee_id, s_suppkey AS nk_employee_id, s_name AS employee_name,
       s_nationkey AS nation_id, CAST(strftime(f.first_ship, '%Y%m%d') AS INTEGER) AS hire_date
FROM supplier LEFT JOIN (SELECT l_suppkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1) f ON f.l_suppkey = s_suppkey
""")
def w2_dim_employees(t):
    return wh.dim_employees(t)


@register("j7_order_lines", """
SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def j7_order_lines(t):
    from pyspark.sql import functions as F

    o, li = t["orders"], t["lineitem"]
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "inner").select(
        "o_orderkey", "o_orderdate", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


@register("o2_top_customers", """
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue, count(*) AS orders
FROM orders GROUP BY o_custkey ORDER BY revenue DESC, o_custkey ASC LIMIT 20
""")
def o2_top_customers(t):
    from pyspark.sql import functions as F

    from dwspark.operators.aggregate import top_k

    g = t["orders"].groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("revenue"),
        F.count(F.lit(1)).alias("orders"))
    return top_k(g, [("revenue", False), ("o_custkey", True)], 20)


@register("o3_latest_order_per_customer", """
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice, max(o_orderdate) AS o_orderdate
FROM orders GROUP BY o_custkey
""")
def o3_latest_order_per_customer(t):
    from pyspark.sql import functions as F

    from dwspark.operators.aggregate import latest_per_group

    o = t["orders"].withColumn("_order", F.struct("o_orderdate", "o_orderkey"))
    return latest_per_group(o, ["o_custkey"], "_order", ["o_orderkey", "o_totalprice", "o_orderdate"])

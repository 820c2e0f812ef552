"""Registered bank and car-sales model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from dwspark.operators.joins import as_of, latest_previous
from dwspark.plans import bank, car_sales
from dwspark.plans import derive as d
from dwspark.plans import etl, jobs
from dwspark.plans.catalog import REGISTRY, register

# ---- bank source rendered in SQL (same formulas as bank.transactions_source) -----------------------
BANK_SRC_SQL = f"""
SELECT ' ' || CAST(user_id AS VARCHAR) AS CustomerID,
       {d.sql_legacy_date_text('(CAST(ts AS DATE) - CAST((user_id * 97 + event_id) % 20000 AS INTEGER))', 'event_id')} AS CustomerDOB,
       {d.sql_gender_code('event_id')} AS CustGender,
       event_type AS CustLocation,
       {d.sql_amount_text('value * 100', 'event_id')} AS CustAccountBalance,
       CAST(event_id AS VARCHAR) AS TransactionID,
       {d.sql_legacy_date_text('ts', 'event_id + 4')} AS TransactionDate,
       {d.sql_digit_time_text('ts', 'event_id')} AS TransactionTime,
       {d.sql_money_text('value')} AS "TransactionAmount (INR)"
FROM events
"""


@register("w8_bank_customers", f"""
WITH src AS ({BANK_SRC_SQL}),
c AS (
  SELECT trim(CustomerID) AS customer_id, {d.sql_legacy_date('CustomerDOB')} AS birth_date,
         {d.sql_gender_label('CustGender')} AS gender, trim(CustLocation) AS location,
         TRY_CAST(CustAccountBalance AS DECIMAL(18,2)) AS account_balance
  FROM src
)
SELECT customer_id, birth_date, gender, location, account_balance FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY birth_date NULLS FIRST, gender NULLS FIRST,
                                location NULLS FIRST, account_balance NULLS FIRST) AS r
  FROM c WHERE customer_id IS NOT NULL AND customer_id <> '') WHERE r = 1
""")
def w8_bank_customers(t):
    return bank.customers(bank.transactions_source(t))


@register("w9_bank_transactions", f"""
WITH src AS ({BANK_SRC_SQL}),
c AS (
  SELECT trim(TransactionID) AS transaction_id, trim(CustomerID) AS customer_id,
         {d.sql_legacy_date('TransactionDate')} AS transaction_date,
         {d.sql_normalize_time('TransactionTime')} AS transaction_time,
         TRY_CAST("TransactionAmount (INR)" AS DECIMAL(18,2)) AS transaction_amount
  FROM src
)
SELECT transaction_id, customer_id, transaction_date, transaction_time, transaction_amount FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY customer_id NULLS FIRST, transaction_date NULLS FIRST,
                                transaction_time NULLS FIRST, transaction_amount NULLS FIRST) AS r
  FROM c WHERE transaction_id IS NOT NULL AND transaction_id <> '' AND customer_id IS NOT NULL AND customer_id <> '') WHERE r = 1
""")
def w9_bank_transactions(t):
    return bank.transactions(bank.transactions_source(t))


CAMPAIGN_BALANCE_SQL = """'$' || CASE WHEN CAST(trunc(c_acctbal) AS BIGINT) < 0 THEN '-' ELSE '' END ||
  CASE WHEN abs(CAST(trunc(c_acctbal) AS BIGINT)) >= 1000
       THEN CAST(abs(CAST(trunc(c_acctbal) AS BIGINT)) // 1000 AS VARCHAR) || ',' || lpad(CAST(abs(CAST(trunc(c_acctbal) AS BIGINT)) % 1000 AS VARCHAR), 3, '0')
       ELSE CAST(abs(CAST(trunc(c_acctbal) AS BIGINT)) AS VARCHAR) END"""


@register("w10_marketing_campaign", f"""
SELECT c_custkey AS loan_data_id, CAST(20 + c_custkey % 50 AS INTEGER) AS age, c_mktsegment AS job,
       CAST(c_custkey % 3 + 1 AS INTEGER) AS marital_id, CAST(c_nationkey % 4 + 1 AS INTEGER) AS education_id,
       c_acctbal < 0 AS "default",
       TRY_CAST(regexp_replace({CAMPAIGN_BALANCE_SQL}, '[$,]', '', 'g') AS INTEGER) AS balance,
       c_custkey % 2 = 0 AS housing, c_custkey % 5 = 0 AS loan, 'cellular' AS contact,
       CAST(c_custkey % 28 + 1 AS INTEGER) AS day, 'may' AS month,
       CAST((c_custkey * 7) % 3000 AS INTEGER) AS duration,
       CAST(floor(CAST((c_custkey * 7) % 3000 AS INTEGER) / 365) AS INTEGER) AS duration_in_year,
       c_nationkey AS campaign, CAST((c_custkey % 400) - 1 AS INTEGER) AS days_since_last_campaign,
       CAST(c_custkey % 4 AS INTEGER) AS previous_campaign_contacts, 'unknown' AS previous_campaign_outcome,
       c_custkey % 9 = 0 AS subscribed_deposit, CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
FROM customer
""")
def w10_marketing_campaign(t):
    return bank.marketing_campaign(bank.campaign_source(t))


# ---- car sales ------------------------------------------------------------------------------------
CAR_SRC_SQL = f"""
SELECT CAST(k AS VARCHAR) AS id_sales,
       CASE WHEN k % 13 = 0 THEN 'n/a' ELSE CAST(year(l_shipdate) - l_partkey % 30 AS VARCHAR) END AS year,
       {d.sql_messy_label("'Brand#' || CAST(l_suppkey % 30 AS VARCHAR)", 'k')} AS brand_car,
       CASE l_linenumber % 3 WHEN 0 THEN 'automatic' WHEN 1 THEN 'manual' ELSE '' END AS transmission,
       {d.sql_messy_label('n_name', 'k + 3')} AS state,
       CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) AS condition,
       CAST(CAST(l_quantity AS BIGINT) * 1000 - 5000 AS VARCHAR) AS odometer,
       CASE l_partkey % 4 WHEN 0 THEN 'black' WHEN 1 THEN 'white' WHEN 2 THEN ' Red ' ELSE 'none' END AS color,
       CASE WHEN l_partkey % 2 = 0 THEN 'gray' ELSE '—' END AS interior,
       CASE WHEN k % 19 = 0 THEN '-' ELSE {d.sql_money_text('l_extendedprice')} END AS mmr,
       CAST(CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))) // 100 / 100.0
            AS DECIMAL(18,2)) AS VARCHAR) AS sellingprice
FROM (SELECT *, l_orderkey * 10 + l_linenumber AS k FROM lineitem) l
LEFT JOIN nation ON l.l_suppkey % 27 = nation.n_nationkey
"""

CAR_TYPED_SQL = f"""
WITH src AS ({CAR_SRC_SQL}),
brands AS (SELECT TRY_CAST(regexp_extract(brand_name, '([0-9]+)', 1) AS INTEGER) AS brand_car_id, brand_name FROM (SELECT DISTINCT p_brand AS brand_name FROM part)),
typed AS (
  SELECT {d.sql_to_int('id_sales')} AS id_sales_nk,
         {d.sql_to_int('year')} AS year,
         {d.sql_clean_text('brand_car')} AS brand_car, {d.sql_clean_text('transmission')} AS transmission,
         {d.sql_clean_text('state')} AS state,
         {d.sql_parse_number('condition')} AS condition, {d.sql_parse_number('odometer')} AS odometer,
         {d.sql_clean_text('color')} AS color, {d.sql_clean_text('interior')} AS interior,
         {d.sql_parse_number('mmr')} AS mmr, {d.sql_parse_number('sellingprice')} AS selling_price
  FROM src
),
joined AS (
  SELECT t.id_sales_nk, t.year, b.brand_car_id, t.transmission, CAST(n.n_nationkey AS INTEGER) AS id_state, t.condition,
         t.odometer, t.color, t.interior, t.mmr, t.selling_price
  FROM typed t
  LEFT JOIN brands b ON lower(trim(b.brand_name)) = lower(trim(t.brand_car))
  LEFT JOIN nation n ON lower(trim(n.n_name)) = lower(trim(t.state))
),
tagged AS (
  SELECT *, (id_sales_nk IS NOT NULL AND year IS NOT NULL AND brand_car_id IS NOT NULL AND id_state IS NOT NULL
             AND condition IS NOT NULL AND odometer IS NOT NULL AND mmr IS NOT NULL AND selling_price IS NOT NULL
             AND coalesce(year >= 1980, true) AND coalesce(odometer >= 0, true) AND coalesce(mmr > 0, true)
             AND coalesce(selling_price > 0, true)) AS ok
  FROM joined
)
"""


CAR_LOADED_SQL = CAR_TYPED_SQL + """, loaded AS (
SELECT id_sales_nk, year, brand_car_id, transmission, id_state, condition, odometer, color, interior, mmr, selling_price
FROM (SELECT *, row_number() OVER (PARTITION BY id_sales_nk ORDER BY year NULLS FIRST, brand_car_id NULLS FIRST,
        transmission NULLS FIRST, id_state NULLS FIRST, condition NULLS FIRST, odometer NULLS FIRST, color NULLS FIRST,
        interior NULLS FIRST, mmr NULLS FIRST, selling_price NULLS FIRST) AS r
      FROM tagged WHERE ok) WHERE r = 1)
"""


@register("w11_car_sales", CAR_LOADED_SQL + "SELECT * FROM loaded", headline=True)
def w11_car_sales(t):
    return car_sales.transform(car_sales.sales_source(t), car_sales.brands_reference(t), car_sales.states_reference(t)).loaded


@register("f4_reject_summary", CAR_TYPED_SQL + """
SELECT count(*) AS processed_rows, count(*) FILTER (WHERE NOT ok) AS rule_rejected_rows,
       count(*) FILTER (WHERE id_sales_nk IS NULL) AS id_sales_nk_missing_count,
       count(*) FILTER (WHERE year IS NULL) AS year_missing_count,
       count(*) FILTER (WHERE brand_car_id IS NULL) AS brand_car_id_missing_count,
       count(*) FILTER (WHERE id_state IS NULL) AS id_state_missing_count,
       count(*) FILTER (WHERE condition IS NULL) AS condition_missing_count,
       count(*) FILTER (WHERE odometer IS NULL) AS odometer_missing_count,
       count(*) FILTER (WHERE mmr IS NULL) AS mmr_missing_count,
       count(*) FILTER (WHERE selling_price IS NULL) AS selling_price_missing_count,
       count(*) FILTER (WHERE year < 1980) AS year_out_of_range_count,
       count(*) FILTER (WHERE odometer < 0) AS odometer_out_of_range_count,
       count(*) FILTER (WHERE mmr <= 0) AS mmr_out_of_range_count,
       count(*) FILTER (WHERE selling_price <= 0) AS selling_price_out_of_range_count,
       count(DISTINCT CASE WHEN ok THEN id_sales_nk END) AS loaded_rows,
       count(*) FILTER (WHERE ok) - count(DISTINCT CASE WHEN ok THEN id_sales_nk END) AS duplicate_rows,
       count(*) - count(DISTINCT CASE WHEN ok THEN id_sales_nk END) AS rejected_rows
FROM tagged
""")
def f4_reject_summary(t):
    return car_sales.transform(car_sales.sales_source(t), car_sales.brands_reference(t), car_sales.states_reference(t)).summary


@register("f3_rejected_rows", CAR_TYPED_SQL + """
SELECT id_sales_nk, year, brand_car_id, id_state, odometer, mmr, selling_price,
       concat_ws(',', 
         CASE WHEN id_sales_nk IS NULL THEN 'id_sales_nk_missing' END, CASE WHEN year IS NULL THEN 'year_missing' END,
         CASE WHEN brand_car_id IS NULL THEN 'brand_car_id_missing' END, CASE WHEN id_state IS NULL THEN 'id_state_missing' END,
         CASE WHEN condition IS NULL THEN 'condition_missing' END, CASE WHEN odometer IS NULL THEN 'odometer_missing' END,
         CASE WHEN mmr IS NULL THEN 'mmr_missing' END, CASE WHEN selling_price IS NULL THEN 'selling_price_missing' END,
         CASE WHEN year < 1980 THEN 'year_out_of_range' END, CASE WHEN odometer < 0 THEN 'odometer_out_of_range' END,
         CASE WHEN mmr <= 0 THEN 'mmr_out_of_range' END, CASE WHEN selling_price <= 0 THEN 'selling_price_out_of_range' END) AS reject_reasons
FROM tagged WHERE NOT ok
""")
def f3_rejected_rows(t):
    r = car_sales.transform(car_sales.sales_source(t), car_sales.brands_reference(t), car_sales.states_reference(t)).rejected
    return r.select("id_sales_nk", "year", "brand_car_id", "id_state", "odometer", "mmr", "selling_price",
                    F.array_join("reject_reasons", ",").alias("reject_reasons"))


# ---- the text cleaners on their own (P7, P8, P9) --------------------------------------------------
@register("p7_legacy_dates", f"""
SELECT o_orderkey, date_text, {d.sql_legacy_date('date_text')} AS parsed_date
FROM (SELECT o_orderkey, {d.sql_legacy_date_text('o_orderdate', 'o_orderkey')} AS date_text FROM orders)
""")
def p7_legacy_dates(t):
    from dwspark.functions import clean

    o = t["orders"].select("o_orderkey", d.legacy_date_text(F.col("o_orderdate"), F.col("o_orderkey")).alias("date_text"))
    return o.select("o_orderkey", "date_text", clean.legacy_date("date_text").alias("parsed_date"))


@register("p8_time_normalize", f"""
SELECT event_id, time_text, {d.sql_normalize_time('time_text')} AS normalized_time
FROM (SELECT event_id, {d.sql_digit_time_text('ts', 'event_id')} AS time_text FROM events)
""")
def p8_time_normalize(t):
    from dwspark.functions import clean

    e = t["events"].select("event_id", d.digit_time_text(F.col("ts"), F.col("event_id")).alias("time_text"))
    return e.select("event_id", "time_text", clean.normalize_time("time_text").alias("normalized_time"))


@register("p9_numeric_cleanup", f"""
SELECT l_orderkey, l_linenumber, amount_text, {d.sql_numeric_text('amount_text')} AS cleaned_text,
       {d.sql_clean_number('amount_text')} AS amount
FROM (SELECT l_orderkey, l_linenumber, {d.sql_amount_text('l_extendedprice', 'l_orderkey + l_linenumber')} AS amount_text FROM lineitem)
""")
def p9_numeric_cleanup(t):
    from dwspark.functions import clean

    li = t["lineitem"].select("l_orderkey", "l_linenumber",
                              d.amount_text(F.col("l_extendedprice"), F.col("l_orderkey") + F.col("l_linenumber")).alias("amount_text"))
    return li.select("l_orderkey", "l_linenumber", "amount_text", clean.numeric_text("amount_text").alias("cleaned_text"),
                     clean.clean_number("amount_text").alias("amount"))


# ---- lookup tables of the bank (W10), stringify (P16), as text (P18), missing flag (P20), fallback
@register("w10_education_status", "SELECT r_regionkey AS education_id, r_name AS value, CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at FROM region")
def w10_education_status(t):
    return bank.lookup_table(etl.driver_sources(t).education, "education_id")


@register("w10_marital_status", "SELECT n_nationkey + 1 AS marital_id, n_name AS value, CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at FROM nation")
def w10_marital_status(t):
    return bank.lookup_table(etl.driver_sources(t).marital, "marital_id")


@register("p16_customer_text", """
SELECT coalesce(CAST(c_custkey AS VARCHAR), '') AS c_custkey, coalesce(c_name, '') AS c_name, coalesce(CAST(c_nationkey AS VARCHAR), '') AS c_nationkey,
       coalesce(CAST(c_acctbal AS VARCHAR), '') AS c_acctbal, coalesce(c_mktsegment, '') AS c_mktsegment FROM customer
""")
def p16_customer_text(t):
    from dwspark.functions import clean

    return clean.stringify(t["customer"])


@register("p20_order_flags", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS order_text, l.l_orderkey IS NULL AS has_no_lines,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE 'Unknown' END AS priority
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l ON l.l_orderkey = o_orderkey
""")
def p20_order_flags(t):
    from dwspark.functions import clean

    lines = t["lineitem"].select("l_orderkey").distinct()
    return t["orders"].join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", clean.as_text("o_orderkey").alias("order_text"), clean.is_missing_flag("l_orderkey").alias("has_no_lines"),
        clean.category_or_unknown("o_orderpriority", ["1-URGENT", "2-HIGH"]).alias("priority"))


@register("j8_latest_previous_order", """
SELECT c_custkey, o.previous_total FROM customer LEFT JOIN (
  SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS previous_total FROM orders GROUP BY o_custkey) o ON o.o_custkey = c_custkey
""")
def j8_latest_previous_order(t):
    history = t["orders"].select(F.col("o_custkey").alias("c_custkey"), "o_totalprice", F.struct("o_orderdate", "o_orderkey").alias("at"))
    return latest_previous(t["customer"].select("c_custkey"), history, ["c_custkey"], "at", "o_totalprice", "previous_total")


@register("j8_as_of_order", """
SELECT e.event_id, e.user_id, e.ts, o.o_orderkey AS last_orderkey, o.o_totalprice AS last_totalprice
FROM events e ASOF LEFT JOIN (
  SELECT o_custkey, CAST(o_orderdate AS TIMESTAMP) AS at, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice
  FROM orders GROUP BY 1, 2) o ON e.user_id = o.o_custkey AND CAST(e.ts AS TIMESTAMP) >= o.at
""")
def j8_as_of_order(t):
    orders = t["orders"].select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"), "o_orderkey", "o_totalprice")
    events = t["events"].select("event_id", "user_id", "ts").withColumn("_at", F.col("ts").cast("timestamp_ntz"))
    return as_of(events, orders, ["user_id"], "_at", "at", ["o_orderkey", "o_totalprice"], ["o_orderkey"]).select(
        "event_id", "user_id", "ts", F.col("o_orderkey").alias("last_orderkey"), F.col("o_totalprice").alias("last_totalprice"))


# The whole audited pipeline, shown by its summary ----------------------------------------------
W12_TARGETS = {
    "education_status": "w10_education_status", "marital_status": "w10_marital_status",
    "marketing_campaign_deposit": "w10_marketing_campaign", "customers": "w8_bank_customers", "transactions": "w9_bank_transactions",
}


@register("w12_pipeline_summary", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, 'SUCCEEDED' AS status, count(*) AS row_count, CAST(0 AS BIGINT) AS duplicate_key_count, count(*) AS inserted_count, "
    f"CAST(0 AS BIGINT) AS updated_count, CAST(0 AS BIGINT) AS deleted_count, CAST(0 AS BIGINT) AS unchanged_count FROM ({REGISTRY[query].sql}) {table}"
    for table, query in W12_TARGETS.items()))
def w12_pipeline_summary(t):
    return etl.summary_of_first_load(t)


# The car-sales job: staging, one-pass split, load, model; its figures are those of F4, W11 and L5.
@register("w11_car_sales_job", CAR_LOADED_SQL.replace("WITH src AS", "WITH src AS MATERIALIZED", 1) + """
SELECT 'SUCCESS' AS status, (SELECT count(*) FROM src) AS staged_car_sales, (SELECT count(*) FROM (SELECT DISTINCT p_brand FROM part)) AS staged_car_brand,
       (SELECT count(*) FROM nation) AS staged_us_state, count(*) AS processed_rows, count(*) FILTER (WHERE ok) AS accepted_rows,
       count(*) FILTER (WHERE NOT ok) AS rule_rejected_rows, (SELECT count(*) FROM loaded) AS loaded_rows,
       count(*) FILTER (WHERE ok) - (SELECT count(*) FROM loaded) AS duplicate_rows
FROM tagged
""")
def w11_car_sales_job(t):
    return jobs.car_sales_summary(t).drop("features", "r2", "rmse", "mae", "predictions")

"""Registered profiling and quality-check queries (Q*, F5, P9) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from dwspark.operators import checks, heavy_hitters, profile, validate
from dwspark.operators.aggregate import union_all
from dwspark.plans import derive
from dwspark.plans import warehouse as wh
from dwspark.plans.catalog import REGISTRY, register
from dwspark.plans.driver_schema import DRIVER_COLUMNS, DRIVER_KEYS, DRIVER_NUMBERS

ALL = list(DRIVER_COLUMNS)


def _q(name: str) -> str:
    return '"' + name + '"'


# Q1 / Q25 ----------------------------------------------------------------------------------------
@register("q1_table_shapes", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, {len(cols)} AS column_count FROM {t}"
    for t, cols in DRIVER_COLUMNS.items()))
def q1_table_shapes(t):
    return profile.table_shapes({n: t[n] for n in ALL})


@register("q25_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL))
def q25_row_counts(t):
    return profile.row_counts({n: t[n] for n in ALL})


# Schema metadata. The oracle reads DuckDB's column catalog and spells its type names the
# way Spark's ``simpleString`` does (arrays element-wise; DECIMAL(p,s) only needs lower case).
# ---- fixed values: DuckDB type name -> Spark type name ---------------------------------------------
DUCKDB_TO_SPARK_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "TINYINT": "tinyint",
    "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp", "BLOB": "binary",
}
# -----------------------------------------------------------------------------------------------------


def _spark_type_sql(expr: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DUCKDB_TO_SPARK_TYPE.items())
    return f"CASE {expr} {cases} ELSE lower({expr}) END"


def _column_types_sql() -> str:
    base = "regexp_replace(data_type, '(\\[\\])+$', '')"
    depth = "CAST((length(data_type) - length(regexp_replace(data_type, '(\\[\\])+$', ''))) / 2 AS INTEGER)"
    names = ", ".join(f"'{n}'" for n in ALL)
    return f"""
SELECT table_name, CAST(ordinal_position AS INTEGER) AS position, column_name,
       repeat('array<', {depth}) || {_spark_type_sql(base)} || repeat('>', {depth}) AS data_type,
       is_nullable = 'YES' AS nullable
FROM information_schema.columns WHERE table_name IN ({names})
"""


@register("q2_column_types", _column_types_sql())
def q2_column_types(t):
    any_df = next(iter(t.values()))
    return profile.column_types(any_df.sparkSession, {n: t[n] for n in ALL})


# Q3 ----------------------------------------------------------------------------------------------
UNIQUE_CONFIG = {
    "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "customer": ["c_mktsegment"],
    "events": ["event_type"],
    "documents": ["lang", "source"],
    "conversations": ["role"],
    "inventory": ["reason"],  # not a driver table: reported as a warning row
}


def _unique_sql() -> str:
    parts = []
    for table, cols in UNIQUE_CONFIG.items():
        if table not in DRIVER_COLUMNS:
            parts.append(f"SELECT '{table}' AS table_name, NULL AS column_name, "
                         f"'Table ''{table}'' not found in source database.' AS value, 'warning' AS status")
            continue
        for c in cols:
            parts.append(f"SELECT DISTINCT '{table}' AS table_name, '{c}' AS column_name, trim(CAST({c} AS VARCHAR)) AS value, "
                         f"'ok' AS status FROM {table} WHERE {c} IS NOT NULL AND trim(CAST({c} AS VARCHAR)) <> ''")
    return " UNION ALL ".join(parts)


@register("q3_unique_values", _unique_sql())
def q3_unique_values(t):
    return profile.unique_values({n: t[n] for n in ALL}, UNIQUE_CONFIG)


# Q5 / Q6 / Q21 -----------------------------------------------------------------------------------
def _missing_sql() -> str:
    parts = []
    for table, cols in DRIVER_COLUMNS.items():
        for c, text in cols:
            blank = (f"count(*) FILTER (WHERE lower(trim({_q(c)})) IN ('', 'na', 'n/a', 'null', 'none', 'nan'))"
                     if text else "CAST(0 AS BIGINT)")
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                         f"count(*) FILTER (WHERE {_q(c)} IS NULL) AS missing_count, {blank} AS blank_like_count FROM {table}")
    return " UNION ALL ".join(parts)


@register("q5_missing_values", _missing_sql())
def q5_missing_values(t):
    return profile.missing_report({n: t[n] for n in ALL})


# Q7 / Q8 / Q9 ------------------------------------------------------------------------------------
PROFILED = ALL


def _profile_sql() -> str:
    parts = []
    for table in PROFILED:
        cols = DRIVER_COLUMNS[table]
        keys = ", ".join(DRIVER_KEYS[table])
        nulls = " + ".join(f"count(*) FILTER (WHERE {_q(c)} IS NULL OR trim(CAST({_q(c)} AS VARCHAR)) = '')" for c, _ in cols)
        parts.append(
            f"SELECT 'source' AS stage, '{table}' AS dataset_name, count(*) AS row_count, {len(cols)} AS column_count, "
            f"CAST({nulls} AS BIGINT) AS null_count, "
            f"(SELECT count(*) FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)) AS duplicate_key_count, "
            f"(SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys} HAVING count(*) > 1)) AS duplicate_rows "
            f"FROM {table}"
        )
    return " UNION ALL ".join(parts)


@register("q7_profile", _profile_sql(), headline=True)
def q7_profile(t):
    out = profile.profile_many([(n, t[n], DRIVER_KEYS[n]) for n in PROFILED], "source")
    return out.drop("null_by_column")


def _null_counts_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS dataset_name, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {_q(c)} IS NULL OR trim(CAST({_q(c)} AS VARCHAR)) = '') AS null_count FROM {table}"
        for table, cols in DRIVER_COLUMNS.items() for c, _ in cols)


@register("q7_null_by_column", _null_counts_sql())
def q7_null_by_column(t):
    out = profile.profile_many([(n, t[n], DRIVER_KEYS[n]) for n in PROFILED], "source")
    return out.select("dataset_name", F.explode("null_by_column").alias("column_name", "null_count"))


@register("q8_duplicate_key_groups", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS duplicate_groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows "
    f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"
    for table, keys in DRIVER_KEYS.items()))
def q8_duplicate_key_groups(t):
    return union_all(profile.duplicate_keys(t[n], keys).select(F.lit(n).alias("table_name"), "*") for n, keys in DRIVER_KEYS.items())


# Q10 ---------------------------------------------------------------------------------------------
def _stats_sql(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
        f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS missing_pct, "
        f"count(DISTINCT {c}) AS distinct_count FROM {table}"
        for c, _ in DRIVER_COLUMNS[table]
    )


@register("q10_column_stats", _stats_sql("lineitem") + " UNION ALL " + _stats_sql("orders"))
def q10_column_stats(t):
    return profile.column_stats(t["lineitem"], "lineitem").unionByName(profile.column_stats(t["orders"], "orders"))


# Q11 ---------------------------------------------------------------------------------------------
DESCRIBE = [("lineitem", "l_quantity"), ("lineitem", "l_extendedprice"), ("lineitem", "l_discount"), ("lineitem", "l_tax")]


@register("q11_numeric_describe", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std, "
    f"round(min({c}), 2) AS min, round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50, "
    f"round(quantile_cont({c}, 0.75), 2) AS p75, round(max({c}), 2) AS max FROM {t}"
    for t, c in DESCRIBE))
def q11_numeric_describe(t):
    return profile.numeric_describe(t["lineitem"], [c for _, c in DESCRIBE])


@register("q11_describe_all_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS count, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std, "
    f"round(min({c})::DOUBLE, 2) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 2) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 2) AS p50, "
    f"round(quantile_cont({c}::DOUBLE, 0.75), 2) AS p75, round(max({c})::DOUBLE, 2) AS max FROM {t}"
    for t, columns in DRIVER_NUMBERS.items() for c in columns))
def q11_describe_all_tables(t):
    return profile.describe_tables({name: (t[name], columns) for name, columns in DRIVER_NUMBERS.items()})


# Q12 ---------------------------------------------------------------------------------------------
TOP_COLUMNS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@register("q12_top_values", " UNION ALL ".join(
    f"""SELECT column_name, top_value, top_count, distinct_count FROM (
          SELECT '{c}' AS column_name, value AS top_value, n AS top_count,
                 count(value) OVER () AS distinct_count,
                 row_number() OVER (ORDER BY n DESC, value ASC NULLS FIRST) AS r
          FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n FROM orders GROUP BY 1)) WHERE r = 1"""
    for c in TOP_COLUMNS))
def q12_top_values(t):
    return profile.top_values(t["orders"], TOP_COLUMNS)


# Every text column of every table, by bounded summaries.
TEXT_COLUMNS = {table: [c for c, text in columns if text] for table, columns in DRIVER_COLUMNS.items()}


@register("q12_most_frequent", " UNION ALL ".join(
    f"(SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS top_value, count(*) AS top_count FROM {t} GROUP BY {c} "
    f"ORDER BY count(*) DESC, {c} NULLS FIRST LIMIT 1)" for t, columns in TEXT_COLUMNS.items() for c in columns))
def q12_most_frequent(t):
    return heavy_hitters.most_frequent({name: (t[name], columns) for name, columns in TEXT_COLUMNS.items()})


# Q13 ---------------------------------------------------------------------------------------------
DATE_CONFIG = {"order_date_text": "%Y-%m-%d", "o_orderdate": "%Y-%m-%d", "o_deliverydate": "%Y-%m-%d"}


def _examples_sql(values: str, src: str, where: str, k: int = 5) -> str:
    return (f"(SELECT coalesce(string_agg(v, '|' ORDER BY v), '') FROM "
            f"(SELECT {values} AS v FROM {src} WHERE {where} ORDER BY v LIMIT {k}))")


def _dates_src_sql() -> str:
    return f"(SELECT o_orderdate, {derive.sql_iso_date_text('o_orderdate', 'o_orderkey')} AS order_date_text FROM orders) s"


def _dates_sql() -> str:
    src = _dates_src_sql()
    bad = "order_date_text IS NOT NULL AND try_strptime(trim(order_date_text), '%Y-%m-%d') IS NULL"
    return f"""
SELECT 'orders' AS table_name, 'order_date_text' AS column_name,
       CASE WHEN count(*) FILTER (WHERE {bad}) = 0 THEN 'valid' ELSE 'invalid' END AS status,
       count(order_date_text) AS total_checked, count(*) FILTER (WHERE {bad}) AS invalid_count,
       {_examples_sql('trim(order_date_text)', src, bad)} AS invalid_examples,
       '%Y-%m-%d' AS expected_format, 'format_based' AS validation_mode
FROM {src}
UNION ALL
SELECT 'orders', 'o_orderdate', 'valid', count(o_orderdate), 0, '', '%Y-%m-%d', 'dtype_based' FROM orders
UNION ALL
SELECT 'orders', 'o_deliverydate', 'invalid', 0, 0, 'Column ''o_deliverydate'' not found.', '%Y-%m-%d', 'warning'
"""


def _joined(df, cols):
    for c in cols:
        df = df.withColumn(c, F.array_join(c, "|"))
    return df


@register("q13_date_validation", _dates_sql())
def q13_date_validation(t):
    o = t["orders"].select("o_orderkey", "o_orderdate", derive.iso_date_text(F.col("o_orderdate"), F.col("o_orderkey")).alias("order_date_text"))
    return _joined(validate.validate_dates(o, "orders", DATE_CONFIG), ["invalid_examples"])


# Q14 ---------------------------------------------------------------------------------------------
def _numeric_src_spark(t):
    li = t["lineitem"].select(derive.amount_text(F.col("l_extendedprice"), F.col("l_orderkey") + F.col("l_linenumber")).alias("price_text"))
    cu = t["customer"].select(derive.amount_text(F.col("c_acctbal"), F.col("c_custkey")).alias("balance_text"))
    return li, cu


def _numeric_sql_one(table: str, col: str, src: str) -> str:
    txt = f"trim(CAST({col} AS VARCHAR))"
    checked = f"{col} IS NOT NULL AND {txt} <> ''"
    invalid = f"{checked} AND {derive.sql_parse_number(col)} IS NULL"
    rec = f"{invalid} AND {derive.sql_clean_number(col)} IS NOT NULL"
    unrec = f"{invalid} AND {derive.sql_clean_number(col)} IS NULL"
    return f"""
SELECT '{table}' AS table_name, '{col}' AS column_name,
       CASE WHEN count(*) FILTER (WHERE {invalid}) = 0 THEN 'valid' ELSE 'invalid' END AS status,
       count(*) FILTER (WHERE {checked}) AS total_checked,
       count(*) FILTER (WHERE {invalid}) AS invalid_count,
       {_examples_sql(txt, src, invalid)} AS invalid_examples,
       count(*) FILTER (WHERE {rec}) AS recoverable_after_cleaning_count,
       {_examples_sql(txt, src, rec)} AS recoverable_examples,
       count(*) FILTER (WHERE {unrec}) AS unrecoverable_count,
       {_examples_sql(txt, src, unrec)} AS unrecoverable_examples
FROM {src}"""


NUM_SRC_LI = f"(SELECT {derive.sql_amount_text('l_extendedprice', 'l_orderkey + l_linenumber')} AS price_text FROM lineitem) s"
NUM_SRC_CU = f"(SELECT {derive.sql_amount_text('c_acctbal', 'c_custkey')} AS balance_text FROM customer) s"


@register("q14_numeric_validation", _numeric_sql_one("lineitem", "price_text", NUM_SRC_LI) + " UNION ALL "
          + _numeric_sql_one("customer", "balance_text", NUM_SRC_CU))
def q14_numeric_validation(t):
    li, cu = _numeric_src_spark(t)
    out = validate.validate_numeric(li, "lineitem", ["price_text"]).unionByName(validate.validate_numeric(cu, "customer", ["balance_text"]))
    return _joined(out, ["invalid_examples", "recoverable_examples", "unrecoverable_examples"])


# Q15 ---------------------------------------------------------------------------------------------
def _negative_sql_one(table: str, col: str, src: str, allow: bool = False) -> str:
    num = derive.sql_clean_number(col)
    prepared = derive.sql_numeric_text(col)
    status = "'valid'" if allow else f"CASE WHEN count(*) FILTER (WHERE {num} < 0) = 0 THEN 'valid' ELSE 'invalid' END"
    ex = (f"(SELECT coalesce(string_agg(CAST(CAST(v AS DECIMAL(18,2)) AS VARCHAR), '|' ORDER BY v), '') FROM "
          f"(SELECT {num} AS v FROM {src} WHERE {num} < 0 ORDER BY v LIMIT 5))")
    return f"""
SELECT '{table}' AS table_name, '{col}' AS column_name, {status} AS status,
       count({num}) AS total_checked, count(*) FILTER (WHERE {num} < 0) AS negative_count,
       {ex} AS negative_examples, count({prepared}) - count({num}) AS unparsed_count
FROM {src}"""


@register("q15_negative_validation", _negative_sql_one("customer", "c_acctbal", "customer") + " UNION ALL "
          + _negative_sql_one("customer_text", "balance_text", NUM_SRC_CU) + " UNION ALL "
          + _negative_sql_one("supplier", "s_acctbal", "supplier", allow=True))
def q15_negative_validation(t):
    _, cu = _numeric_src_spark(t)
    out = (validate.validate_negative(t["customer"], "customer", ["c_acctbal"])
           .unionByName(validate.validate_negative(cu, "customer_text", ["balance_text"]))
           .unionByName(validate.validate_negative(t["supplier"], "supplier", ["s_acctbal"], allow_negative=True)))
    return out.withColumn("negative_examples", F.array_join(F.transform("negative_examples", lambda x: x.cast("decimal(18,2)").cast("string")), "|"))


# Q16 ---------------------------------------------------------------------------------------------
EXPECTED_VALUES = {
    "orders": {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
    "customer": {"c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]},
    "events": {"event_type": ["view", "click", "purchase"]},
}


def _unexpected_sql() -> str:
    parts = []
    for table, cols in EXPECTED_VALUES.items():
        for c, allowed in cols.items():
            lst = ", ".join(f"'{a}'" for a in allowed)
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, trim({c}) AS unexpected_value, count(*) AS occurrences "
                         f"FROM {table} WHERE {c} IS NOT NULL AND trim({c}) NOT IN ({lst}) GROUP BY 3")
    return " UNION ALL ".join(parts)


@register("q16_unexpected_categorical", _unexpected_sql())
def q16_unexpected_categorical(t):
    return validate.unexpected_categorical({n: t[n] for n in EXPECTED_VALUES}, EXPECTED_VALUES)


# Q17 / F5 ----------------------------------------------------------------------------------------
PRODUCT_TEXT_SQL = f"""(SELECT p_partkey,
  {derive.sql_price_text('p_retailprice', 'p_partkey')} AS unit_price,
  {derive.sql_price_text('(CASE WHEN p_size <= 2 THEN -1 ELSE 1 END) * ((CAST(round(p_retailprice * 100) AS BIGINT) * (p_partkey % 10 + 11)) // 20) / 100.0', 'p_partkey + 1')} AS cost_price
  FROM part) p"""


@register("q17_price_rules", f"""
SELECT count(*) FILTER (WHERE u < 0) AS negative_unit_price_count,
       count(*) FILTER (WHERE c < 0) AS negative_cost_price_count,
       count(*) FILTER (WHERE c > u) AS cost_greater_than_unit_count
FROM (SELECT {derive.sql_clean_number('unit_price')} AS u, {derive.sql_clean_number('cost_price')} AS c FROM {PRODUCT_TEXT_SQL})
""")
def q17_price_rules(t):
    return validate.price_rules(wh.products_source(t), "unit_price", "cost_price")


@register("f5_offending_products", f"""
SELECT p_partkey AS product_id, unit_price, cost_price FROM {PRODUCT_TEXT_SQL}
WHERE coalesce({derive.sql_clean_number('unit_price')} < 0 OR {derive.sql_clean_number('cost_price')} < 0
      OR {derive.sql_clean_number('cost_price')} > {derive.sql_clean_number('unit_price')}, false)
""")
def f5_offending_products(t):
    from dwspark.functions import clean, rules

    p = wh.products_source(t)
    return p.where(rules.bad_price(clean.clean_number("unit_price"), clean.clean_number("cost_price"))).select(
        "product_id", "unit_price", "cost_price")


# Q18 ---------------------------------------------------------------------------------------------
@register("q18_direction_rules", """
SELECT count(*) FILTER (WHERE reason IN ('Damaged', 'Expired') AND q > 0) AS damaged_or_expired_positive_count,
       count(*) FILTER (WHERE reason = 'Restock' AND q < 0) AS restock_negative_count
FROM (SELECT CASE l_returnflag WHEN 'R' THEN 'Restock' WHEN 'A' THEN 'Damaged' ELSE 'Expired' END AS reason,
             CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE -l_quantity END AS q FROM lineitem)
""")
def q18_direction_rules(t):
    li = t["lineitem"].select(
        F.when(F.col("l_returnflag") == "R", "Restock").when(F.col("l_returnflag") == "A", "Damaged").otherwise("Expired").alias("reason"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(-F.col("l_quantity")).cast("string").alias("quantity_change"),
    )
    return validate.direction_rules(li, "reason", "quantity_change")


# Q23 ---------------------------------------------------------------------------------------------
@register("q23_order_reconciliation", """
SELECT o.o_orderkey, CAST(o.o_totalprice AS DECIMAL(18,2)) AS header_total,
       CAST(s.t AS DECIMAL(18,2)) AS detail_total, CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) - s.t AS DECIMAL(18,2)) AS difference
FROM orders o JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS t FROM lineitem GROUP BY 1) s
  ON s.l_orderkey = o.o_orderkey
WHERE CAST(o.o_totalprice AS DECIMAL(18,2)) <> s.t
""")
def q23_order_reconciliation(t):
    return checks.reconcile(t["orders"], t["lineitem"], "o_orderkey", "l_orderkey", "o_totalprice", "l_extendedprice")


# Q24 / J9 ----------------------------------------------------------------------------------------
# The built warehouse against a calendar of the order dates only, so that a shipment after the last
# order's day is found.
@register("q24_warehouse_checks", """
WITH d AS (SELECT CAST(strftime(CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE), '%Y%m%d') AS INTEGER) AS date_id
           FROM (SELECT min(CAST(o_orderdate AS DATE)) lo, max(CAST(o_orderdate AS DATE)) hi FROM orders))
SELECT 'fct_order_date_not_in_dim_date' AS check_name,
       count(*) FILTER (WHERE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) NOT IN (SELECT date_id FROM d)) AS failing_count
FROM orders
UNION ALL
SELECT 'fct_inventory_date_not_in_dim_date',
       count(*) FILTER (WHERE CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) NOT IN (SELECT date_id FROM d)) FROM lineitem
UNION ALL
SELECT 'dim_customers_duplicate_natural_keys', count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)
UNION ALL
SELECT 'dim_products_duplicate_natural_keys', count(*) FROM (SELECT p_partkey FROM part GROUP BY 1 HAVING count(*) > 1)
UNION ALL
SELECT 'fct_order_duplicate_natural_keys', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
""")
def q24_warehouse_checks(t):
    order_days = {"orders": t["orders"], "lineitem": t["lineitem"].where(F.lit(False))}
    customers, products = wh.dim_customers(t), wh.dim_products(t)
    orders, inventory = wh.fct_order(t, customers, products), wh.fct_inventory(t, products)
    return checks.warehouse_checks(
        {"fct_order": (orders, "order_date"), "fct_inventory": (inventory, "change_date")}, wh.dim_date(order_days),
        {"dim_customers": (customers, ["nk_customer_id"]), "dim_products": (products, ["nk_product_id"]),
         "fct_order": (orders, ["nk_order_id"])})


@register("j9_orders_without_lines", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)
""")
def j9_orders_without_lines(t):
    from dwspark.operators.joins import missing_from

    return missing_from(t["orders"], t["lineitem"], "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey")


# Q4 / Q19 / Q20 / Q22: nested reports and the rule-driven recommendations -------------------------
def _checks(t):
    tables = {n: t[n] for n in ALL}
    missing = profile.missing_report(tables)
    o = t["orders"].select("o_orderdate", derive.iso_date_text(F.col("o_orderdate"), F.col("o_orderkey")).alias("order_date_text"))
    dates = validate.validate_dates(o, "orders", DATE_CONFIG)
    li, cu = _numeric_src_spark(t)
    nums = validate.validate_numeric(li, "lineitem", ["price_text"]).unionByName(validate.validate_numeric(cu, "customer", ["balance_text"]))
    negs = validate.validate_negative(t["customer"], "customer", ["c_acctbal"]).unionByName(
        validate.validate_negative(t["supplier"], "supplier", ["s_acctbal"], allow_negative=True))
    return missing, dates, nums, negs


def _rollup_sql() -> str:
    dates = _dates_sql()
    nums = _numeric_sql_one("lineitem", "price_text", NUM_SRC_LI) + " UNION ALL " + _numeric_sql_one("customer", "balance_text", NUM_SRC_CU)
    negs = _negative_sql_one("customer", "c_acctbal", "customer") + " UNION ALL " + _negative_sql_one("supplier", "s_acctbal", "supplier", allow=True)

    def invalid(cte: str) -> str:
        return (f"coalesce((SELECT string_agg(column_name, ', ' ORDER BY column_name) FROM {cte} "
                f"WHERE {cte}.table_name = m.table_name AND status = 'invalid'), '-')")

    return f"""
WITH d AS ({dates}), n AS ({nums}), g AS ({negs}), m AS ({_missing_sql()})
SELECT m.table_name,
       CAST(sum(missing_count) AS BIGINT) AS total_missing_values,
       count(*) FILTER (WHERE missing_count > 0) AS columns_with_missing_values,
       CAST(sum(blank_like_count) AS BIGINT) AS total_blank_like_values,
       {invalid('d')} AS invalid_date_columns,
       {invalid('n')} AS invalid_numeric_columns,
       {invalid('g')} AS invalid_negative_columns
FROM m GROUP BY m.table_name
"""


@register("q20_quality_rollup", _rollup_sql())
def q20_quality_rollup(t):
    return validate.quality_rollup(*_checks(t))


@register("q19_quality_report", None)
def q19_quality_report(t):
    return checks.quality_report(*_checks(t))


# The nested report as JSON text with its entries in order, so that SQL can spell the same.
def _report_sql() -> str:
    types = _column_types_sql()
    return f"""
WITH s AS ({" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n, {len(c)} AS k FROM {t}" for t, c in DRIVER_COLUMNS.items())}),
y AS (SELECT table_name, string_agg(column_name || ':' || data_type, ',' ORDER BY column_name) AS data_types FROM ({types}) GROUP BY 1),
u AS (SELECT table_name, column_name, string_agg(value, '|' ORDER BY value) AS v FROM ({_unique_sql()}) WHERE status = 'ok' GROUP BY 1, 2),
w AS (SELECT table_name, string_agg(column_name || ':' || v, ',' ORDER BY column_name) AS unique_values FROM u GROUP BY 1)
SELECT s.table_name, s.n AS row_count, s.k AS column_count, y.data_types, w.unique_values
FROM s LEFT JOIN y USING (table_name) LEFT JOIN w USING (table_name)
"""


@register("q4_profiling_report", _report_sql())
def q4_profiling_report(t):
    tables = {n: t[n] for n in ALL}
    spark = t["orders"].sparkSession
    report = checks.profiling_report(profile.table_shapes(tables), profile.column_types(spark, tables), profile.unique_values(tables, UNIQUE_CONFIG))

    def listed(entries, show):
        return F.array_join(F.transform(F.array_sort(F.map_entries(entries)), lambda e: F.concat(e["key"], F.lit(":"), show(e["value"]))), ",")

    return report.select(
        "table_name", F.col("shape.rows").alias("row_count"), F.col("shape.columns").alias("column_count"),
        listed("data_types", lambda v: v).alias("data_types"), listed("unique_values", lambda v: F.array_join(v, "|")).alias("unique_values"))


def _sql_text(x) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


def _recommendations_sql() -> str:
    dates = _dates_sql()
    nums = _numeric_sql_one("lineitem", "price_text", NUM_SRC_LI) + " UNION ALL " + _numeric_sql_one("customer", "balance_text", NUM_SRC_CU)
    negs = _negative_sql_one("customer", "c_acctbal", "customer") + " UNION ALL " + _negative_sql_one("supplier", "s_acctbal", "supplier", allow=True)
    rules = ", ".join(
        f"({_sql_text(r.metric)}, {_sql_text(r.priority)}, {_sql_text(r.finding)}, {_sql_text(r.recommendation)}, "
        f"{_sql_text(r.table)}, {_sql_text(r.column)}, {float(r.threshold)})"
        for r in checks.DEFAULT_RULES)
    a = checks.ALWAYS
    return f"""
WITH d AS ({dates}), n AS ({nums}), g AS ({negs}), m AS ({_missing_sql()}), u AS ({_unexpected_sql()}),
f AS (
  SELECT table_name, column_name, 'missing_count' AS metric, CAST(missing_count AS BIGINT) AS value FROM m
  UNION ALL SELECT table_name, column_name, 'date_invalid_count', CAST(invalid_count AS BIGINT) FROM d
  UNION ALL SELECT table_name, column_name, 'numeric_invalid_count', CAST(invalid_count AS BIGINT) FROM n
  UNION ALL SELECT table_name, column_name, 'negative_count', CAST(negative_count AS BIGINT) FROM g WHERE status = 'invalid'
  UNION ALL SELECT table_name, column_name, 'unexpected_value_count', CAST(sum(occurrences) AS BIGINT) FROM u GROUP BY 1, 2
),
r(metric, priority, finding, recommendation, r_table, r_column, threshold) AS (VALUES {rules})
SELECT r.priority, f.table_name, f.column_name,
       replace(replace(replace(r.finding, '{{table}}', f.table_name), '{{column}}', f.column_name), '{{value}}', CAST(f.value AS VARCHAR)) AS finding,
       r.recommendation
FROM f JOIN r ON r.metric = f.metric
WHERE f.value > r.threshold AND (r.r_table IS NULL OR r.r_table = f.table_name) AND (r.r_column IS NULL OR r.r_column = f.column_name)
UNION ALL
SELECT {_sql_text(a.priority)}, NULL, NULL, {_sql_text(a.finding)}, {_sql_text(a.recommendation)}
"""


@register("q22_recommendations", _recommendations_sql())
def q22_recommendations(t):
    missing, dates, nums, negs = _checks(t)
    unexpected = validate.unexpected_categorical({n: t[n] for n in EXPECTED_VALUES}, EXPECTED_VALUES)
    f = checks.findings_from_checks(missing, dates, nums, negs, unexpected)
    return checks.recommendations(t["orders"].sparkSession, f)


# Price and movement findings (Q17, Q18) as recommendations.
PRICE_COLUMNS = {"negative_unit_price_count": "unit_price", "negative_cost_price_count": "cost_price", "cost_greater_than_unit_count": "cost_price"}
MOVE_COLUMNS = {"damaged_or_expired_positive_count": "quantity_change", "restock_negative_count": "quantity_change"}


def _business_sql() -> str:
    parts = [f"SELECT 'products' AS table_name, '{c}' AS column_name, '{m}' AS metric, {m} AS value, (SELECT count(*) FROM part) AS total "
             f"FROM ({REGISTRY['q17_price_rules'].sql})" for m, c in PRICE_COLUMNS.items()]
    parts += [f"SELECT 'inventory_tracking', '{c}', '{m}', {m}, (SELECT count(*) FROM lineitem) FROM ({REGISTRY['q18_direction_rules'].sql})" for m, c in MOVE_COLUMNS.items()]
    rules = ", ".join(f"({_sql_text(r.metric)}, {_sql_text(r.priority)}, {_sql_text(r.finding)}, {_sql_text(r.recommendation)})" for r in checks.BUSINESS_RULES)
    return f"""
WITH f AS ({" UNION ALL ".join(parts)}), r(metric, priority, finding, recommendation) AS (VALUES {rules})
SELECT r.priority, f.table_name, f.column_name, replace(replace(replace(replace(r.finding, '{{table}}', f.table_name), '{{column}}', f.column_name),
       '{{value}}', CAST(f.value AS VARCHAR)), '{{total}}', CAST(f.total AS VARCHAR)) AS finding, r.recommendation
FROM f JOIN r ON r.metric = f.metric WHERE f.value > 0
"""


@register("q22_business_recommendations", _business_sql())
def q22_business_recommendations(t):
    li = t["lineitem"].select(
        F.when(F.col("l_returnflag") == "R", "Restock").when(F.col("l_returnflag") == "A", "Damaged").otherwise("Expired").alias("reason"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(-F.col("l_quantity")).cast("string").alias("quantity_change"))
    prices = checks.business_findings(validate.price_rules(wh.products_source(t), "unit_price", "cost_price", total="total"), "products", PRICE_COLUMNS)
    moves = checks.business_findings(validate.direction_rules(li, "reason", "quantity_change", total="total"), "inventory_tracking", MOVE_COLUMNS)
    return checks.recommendations(t["part"].sparkSession, prices.unionByName(moves), checks.BUSINESS_RULES, always=None)


# The nested quality report (Q19) as text with its entries in order, so that SQL can spell the same.
def _quality_report_sql() -> str:
    nums = _numeric_sql_one("lineitem", "price_text", NUM_SRC_LI) + " UNION ALL " + _numeric_sql_one("customer", "balance_text", NUM_SRC_CU)
    negs = _negative_sql_one("customer", "c_acctbal", "customer") + " UNION ALL " + _negative_sql_one("supplier", "s_acctbal", "supplier", allow=True)
    listed = lambda *v: f"string_agg(column_name || ':' || {' || chr(47) || '.join(f'CAST({x} AS VARCHAR)' for x in v)}, ',' ORDER BY column_name)"
    per = lambda cte, name, *v: (f"{name} AS (SELECT table_name, {listed('status')} AS {name}_validity, {listed(*v)} AS {name}_details FROM {cte} GROUP BY 1)")
    return f"""
WITH d AS ({_dates_sql()}), n AS ({nums}), g AS ({negs}), m AS ({_missing_sql()}),
base AS (SELECT table_name, {listed('missing_count')} AS missing_values, {listed('blank_like_count')} AS blank_like_values FROM m GROUP BY 1),
{per('d', 'dates', 'total_checked', 'invalid_count', 'invalid_examples')},
{per('n', 'numbers', 'total_checked', 'invalid_count', 'recoverable_after_cleaning_count', 'unrecoverable_count', 'unrecoverable_examples')},
{per('g', 'negatives', 'total_checked', 'negative_count', 'negative_examples')}
SELECT * FROM base LEFT JOIN dates USING (table_name) LEFT JOIN numbers USING (table_name) LEFT JOIN negatives USING (table_name)
"""


@register("q19_quality_report_text", _quality_report_sql())
def q19_quality_report_text(t):
    report = checks.quality_report(*_checks(t))

    def listed(entries, *show):
        shown = lambda e: F.concat(e["key"], F.lit(":"), F.concat_ws("/", *[s(e["value"]) for s in show]))
        return F.array_join(F.transform(F.array_sort(F.map_entries(entries)), shown), ",")

    def of(*names):
        def text(name):
            if name == "negative_examples":
                return lambda v: F.array_join(F.transform(v[name], lambda x: x.cast("decimal(18,2)").cast("string")), "|")
            return (lambda v: F.array_join(v[name], "|")) if name.endswith("examples") else (lambda v: v[name].cast("string"))
        return [text(n) for n in names]

    plain = lambda v: v.cast("string")
    return report.select(
        "table_name", listed("missing_values", plain).alias("missing_values"), listed("blank_like_values", plain).alias("blank_like_values"),
        listed("date_validity", plain).alias("dates_validity"),
        listed("date_validity_details", *of("total_checked", "invalid_count", "invalid_examples")).alias("dates_details"),
        listed("numeric_validity", plain).alias("numbers_validity"),
        listed("numeric_validity_details", *of("total_checked", "invalid_count", "recoverable_after_cleaning_count", "unrecoverable_count",
                                               "unrecoverable_examples")).alias("numbers_details"),
        listed("negative_validity", plain).alias("negatives_validity"),
        listed("negative_validity_details", *of("total_checked", "negative_count", "negative_examples")).alias("negatives_details"))

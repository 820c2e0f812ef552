"""Star-schema models built on the driver tables.

The cafe warehouse of the reference (customers, products, orders + order details, inventory
movements, a date dimension) maps onto the driver tables as:

  dim_customers  <- customer         dim_products <- part (+ brand dimension via a name join)
  dim_employees  <- supplier (hire date = the first day the supplier shipped a line item)
  fct_order      <- orders + lineitem summary      fct_inventory <- lineitem (one movement per line)
  dim_date       <- every day between the first and last order / ship date

Each function takes a ``dict`` of table DataFrames and returns a DataFrame; where surrogate keys are
numbered, building it writes the numbered keys once. Dimension surrogate keys are dense ``1..N`` in natural-key order (A7); facts look them up with left joins, so a fact row
is never dropped for a missing dimension row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from dwspark.functions import clean
from dwspark.operators.aggregate import item_summary
from dwspark.operators.joins import join_ignore_case
from dwspark.operators.keys import with_surrogate_key
from dwspark.plans import derive

Tables = Mapping[str, DataFrame]
MONEY = DecimalType(18, 2)


# W1 ----------------------------------------------------------------------------------------------
def dim_customers(t: Tables) -> DataFrame:
    c = t["customer"].select(
        F.col("c_custkey").alias("nk_customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").cast(MONEY).alias("account_balance"),
        F.col("c_mktsegment").alias("market_segment"),
    )
    return with_surrogate_key(c, ["nk_customer_id"], "sk_customer_id")


# W2 ----------------------------------------------------------------------------------------------
def dim_employees(t: Tables) -> DataFrame:
    """Suppliers as the staff dimension; the hire date is each supplier's first ship date (a partial
    ``min`` per supplier over lineitem), stored as an int ``YYYYMMDD`` key like the reference."""
    first = t["lineitem"].groupBy("l_suppkey").agg(F.min("l_shipdate").alias("first_ship"))
    s = t["supplier"].join(first, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
        F.col("s_suppkey").alias("nk_employee_id"),
        F.col("s_name").alias("employee_name"),
        F.col("s_nationkey").alias("nation_id"),
        clean.date_key("first_ship").alias("hire_date"),
    )
    return with_surrogate_key(s, ["nk_employee_id"], "sk_employee_id")


# W4 ----------------------------------------------------------------------------------------------
def dim_brand(t: Tables) -> DataFrame:
    """Brand dimension (the reference's store-branch dimension, W3): distinct upper-cased brand names
    with a dense key."""
    brands = t["part"].select(F.upper(F.col("p_brand")).alias("brand_name")).distinct()
    return with_surrogate_key(brands, ["brand_name"], "sk_brand_id")


def products_source(t: Tables) -> DataFrame:
    """Part rows rendered as the reference's product source: prices as text, stock as words."""
    p = t["part"]
    key = F.col("p_partkey")
    # cost = 55%..100% of the price, in whole cents (integer arithmetic, so it is exact everywhere);
    # the smallest sizes get a negative cost, the rule violations the quality checks look for.
    price_cents = F.round(F.col("p_retailprice") * 100).cast("long")
    cost_cents = ((price_cents * (key % 10 + 11)) / 20).cast("long")
    cost_cents = F.when(F.col("p_size") <= 2, -cost_cents).otherwise(cost_cents)
    cost = cost_cents.cast(DecimalType(18, 0)) / F.lit(100)
    return p.select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        derive.price_text(F.col("p_retailprice"), key).alias("unit_price"),
        derive.price_text(cost, key + 1).alias("cost_price"),
        derive.stock_word(key).alias("in_stock"),
        F.col("p_brand").alias("brand"),
    )


def dim_products(t: Tables, brands: DataFrame | None = None) -> DataFrame:
    src = products_source(t)
    brands = brands if brands is not None else dim_brand(t)
    prod = src.select(
        F.col("product_id").alias("nk_product_id"),
        "product_name",
        "category",
        clean.strip_to_decimal("unit_price").alias("unit_price"),
        clean.strip_to_decimal("cost_price").alias("cost_price"),
        clean.tri_state_bool("in_stock").alias("in_stock"),
        "brand",
    )
    prod = join_ignore_case(prod, brands, "brand", "brand_name", ["sk_brand_id"]).drop("brand")
    return with_surrogate_key(prod, ["nk_product_id"], "sk_product_id")


# W5 ----------------------------------------------------------------------------------------------
def order_item_summary(t: Tables, staff: bool = False) -> DataFrame:
    """A1 on lineitem: one row per order; money summed as exact decimals. ``staff`` adds ``employee_id``, the first supplier of
    the order's lines, in the same pass."""
    li = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_quantity", F.col("l_extendedprice").cast(MONEY).alias("amount"), *(["l_suppkey"] if staff else [])
    )
    s = item_summary(li, "l_orderkey", "l_partkey", "l_quantity", "amount", extra=[F.min("l_suppkey").alias("employee_id")] if staff else [])
    return s.select(
        F.col("l_orderkey").alias("order_id"),
        "product_id",
        "quantity",
        clean.safe_divide(F.col("subtotal").cast("double"), F.col("quantity")).alias("unit_price"),
        F.col("subtotal").cast(MONEY).alias("subtotal"),
        *(["employee_id"] if staff else []),
    )


def _keys(source: DataFrame, key: str, name: str) -> DataFrame:
    """Natural and surrogate keys alone, numbered as the full dimension numbers them (by natural key), so
    that a fact needs no other column of a dimension that was not handed to it."""
    return with_surrogate_key(source.select(F.col(key).alias(f"nk_{name}_id")), [f"nk_{name}_id"], f"sk_{name}_id")


def fct_order(
    t: Tables, customers: DataFrame | None = None, products: DataFrame | None = None, employees: DataFrame | None = None,
) -> DataFrame:
    """One row per order: header left-joined to its line summary and its customer, employee (the
    first supplier of its lines) and product keys, with the order date as an int key. The line
    summaries are grouped on ``l_orderkey`` and therefore already hash-partitioned on the join key;
    only the orders side moves for those joins. Saved dimensions can be handed in; else only their
    keys are numbered, which writes one narrow table a dimension while the query is built."""
    customers = customers if customers is not None else _keys(t["customer"], "c_custkey", "customer")
    products = products if products is not None else _keys(t["part"], "p_partkey", "product")
    employees = employees if employees is not None else _keys(t["supplier"], "s_suppkey", "employee")
    o = t["orders"]
    s = order_item_summary(t, staff=True)
    fact = (
        o.join(s, o["o_orderkey"] == s["order_id"], "left")
        .join(customers.select("nk_customer_id", "sk_customer_id"), F.col("o_custkey") == F.col("nk_customer_id"), "left")
        .join(employees.select("nk_employee_id", "sk_employee_id"), F.col("employee_id") == F.col("nk_employee_id"), "left")
        .join(products.select("nk_product_id", "sk_product_id"), F.col("product_id") == F.col("nk_product_id"), "left")
    )
    return fact.select(
        F.col("o_orderkey").alias("nk_order_id"),
        "sk_customer_id",
        "sk_product_id",
        "sk_employee_id",
        clean.date_key("o_orderdate").alias("order_date"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        "quantity",
        "unit_price",
        "subtotal",
        F.col("o_orderpriority").alias("order_priority"),
        F.col("o_orderstatus").alias("order_status"),
    )


# W6 ----------------------------------------------------------------------------------------------
def fct_inventory(t: Tables, products: DataFrame | None = None) -> DataFrame:
    """Each line item is a stock movement out (negative quantity) or, when returned (``R``), back in."""
    products = products if products is not None else _keys(t["part"], "p_partkey", "product")
    li = t["lineitem"]
    qty = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(-F.col("l_quantity"))
    moves = li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        "l_partkey",
        qty.cast("int").alias("quantity_change"),
        clean.date_key("l_shipdate").alias("change_date"),
        F.when(F.col("l_returnflag") == "R", "Return").otherwise("Sale").alias("reason"),
    )
    joined = moves.join(
        products.select("nk_product_id", "sk_product_id"), F.col("l_partkey") == F.col("nk_product_id"), "left"
    )
    return joined.select("order_id", "line_number", "sk_product_id", "quantity_change", "change_date", "reason")


# W7 ----------------------------------------------------------------------------------------------
def dim_date(t: Tables) -> DataFrame:
    """Every day from the first order or ship date to the last. The bounds are one global aggregate
    over both date columns (partial min/max per task); the day rows come from
    ``explode(sequence(...))``, one row per calendar day however large the tables are."""
    dates = t["orders"].select(F.col("o_orderdate").cast("date").alias("d")).unionByName(
        t["lineitem"].select(F.col("l_shipdate").cast("date").alias("d"))
    )
    bounds = dates.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    return days.select(
        clean.date_key("date").alias("date_id"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.dayofweek("date").alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"),
        (F.dayofweek("date").isin(1, 7)).alias("is_weekend"),
    )

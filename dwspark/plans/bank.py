"""Bank warehouse models (W8–W10) on the reference's source shapes, plus a source derived from the
driver tables.

Source shapes (all text, as read from CSV without inference):
  transactions CSV: CustomerID, CustomerDOB, CustGender, CustLocation, CustAccountBalance,
                    TransactionID, TransactionDate, TransactionTime, TransactionAmount (INR)
  campaign table:   loan_data_id, age, job, marital_id, education_id, default, balance, housing, loan,
                    contact, day, month, duration, campaign, pdays, previous, poutcome,
                    subscribed_deposit, created_at, updated_at
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.functions import clean, rules
from dwspark.operators.keys import dedupe
from dwspark.plans import derive

AMOUNT_COL = "TransactionAmount (INR)"
CAMPAIGN_COLUMNS = [
    "loan_data_id", "age", "job", "marital_id", "education_id", "default", "balance", "housing", "loan", "contact",
    "day", "month", "duration", "campaign", "pdays", "previous", "poutcome", "subscribed_deposit", "created_at",
    "updated_at",
]


# W8 ----------------------------------------------------------------------------------------------
def customers(src: DataFrame, max_valid_year: int = clean.MAX_VALID_YEAR) -> DataFrame:
    """One row per trimmed, present customer id (deterministic survivor: smallest row)."""
    out = src.select(
        clean.trimmed("CustomerID").alias("customer_id"),
        clean.legacy_date("CustomerDOB", max_valid_year).alias("birth_date"),
        clean.gender_label("CustGender").alias("gender"),
        clean.trimmed("CustLocation").alias("location"),
        clean.to_decimal("CustAccountBalance").alias("account_balance"),
    ).where(rules.is_present("customer_id"))
    return dedupe(out, ["customer_id"])


# W9 ----------------------------------------------------------------------------------------------
def transactions(src: DataFrame, max_valid_year: int = clean.MAX_VALID_YEAR) -> DataFrame:
    out = src.select(
        clean.trimmed("TransactionID").alias("transaction_id"),
        clean.trimmed("CustomerID").alias("customer_id"),
        clean.legacy_date("TransactionDate", max_valid_year).alias("transaction_date"),
        clean.normalize_time("TransactionTime").alias("transaction_time"),
        clean.to_decimal(F.col(f"`{AMOUNT_COL}`")).alias("transaction_amount"),
    ).where(rules.is_present("transaction_id") & rules.is_present("customer_id"))
    return dedupe(out, ["transaction_id"])


# W10 ---------------------------------------------------------------------------------------------
def marketing_campaign(src: DataFrame) -> DataFrame:
    """Campaign rows: balance text to int (P2), duration in years (P3), source-to-target renames."""
    out = []
    for c in CAMPAIGN_COLUMNS:
        if c == "balance":
            out.append(clean.currency_to_int("balance").alias("balance"))
        elif c == "duration":
            out += [F.col("duration"), clean.days_to_years("duration").alias("duration_in_year")]
        else:
            out.append(F.col(f"`{c}`").alias(clean.CAMPAIGN_RENAMES.get(c, c)))
    return src.select(*out)


def lookup_table(src: DataFrame, id_col: str) -> DataFrame:
    """Education / marital status tables: a plain projection."""
    return src.select(id_col, "value", "created_at", "updated_at")


# Sources derived from the driver tables ----------------------------------------------------------
def transactions_source(t: Mapping[str, DataFrame]) -> DataFrame:
    """One text row per event: the event is the transaction, its user the customer. Birth dates
    fall between 1969 and 2024 so the two-digit-year pivot is exercised."""
    e = t["events"]
    key = F.col("event_id")
    dob = F.date_sub(F.col("ts").cast("date"), ((F.col("user_id") * 97 + key) % 20000).cast("int"))
    return e.select(
        F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("CustomerID"),
        derive.legacy_date_text(dob.cast("timestamp"), key).alias("CustomerDOB"),
        derive.gender_code(key).alias("CustGender"),
        F.col("event_type").alias("CustLocation"),
        derive.amount_text(F.col("value") * 100, key).alias("CustAccountBalance"),
        key.cast("string").alias("TransactionID"),
        derive.legacy_date_text(F.col("ts"), key + 4).alias("TransactionDate"),
        derive.digit_time_text(F.col("ts"), key).alias("TransactionTime"),
        derive.money_text(F.col("value")).alias(AMOUNT_COL),
    )


def campaign_source(t: Mapping[str, DataFrame]) -> DataFrame:
    """One campaign row per customer, with balances written as ``$-1,372``."""
    c = t["customer"]
    k = F.col("c_custkey")
    whole = F.col("c_acctbal").cast("long")
    a = F.abs(whole)
    digits = F.when(a >= 1000, F.concat((a / 1000).cast("long").cast("string"), F.lit(","), F.lpad((a % 1000).cast("string"), 3, "0"))).otherwise(a.cast("string"))
    balance = F.concat(F.lit("$"), F.when(whole < 0, F.lit("-")).otherwise(F.lit("")), digits)
    return c.select(
        k.alias("loan_data_id"),
        (F.lit(20) + k % 50).cast("int").alias("age"),
        F.col("c_mktsegment").alias("job"),
        (k % 3 + 1).cast("int").alias("marital_id"),
        (F.col("c_nationkey") % 4 + 1).cast("int").alias("education_id"),
        (F.col("c_acctbal") < 0).alias("default"),
        balance.alias("balance"),
        (k % 2 == 0).alias("housing"),
        (k % 5 == 0).alias("loan"),
        F.lit("cellular").alias("contact"),
        (k % 28 + 1).cast("int").alias("day"),
        F.lit("may").alias("month"),
        ((k * 7) % 3000).cast("int").alias("duration"),
        F.col("c_nationkey").alias("campaign"),
        ((k % 400) - 1).cast("int").alias("pdays"),
        (k % 4).cast("int").alias("previous"),
        F.lit("unknown").alias("poutcome"),
        (k % 9 == 0).alias("subscribed_deposit"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )

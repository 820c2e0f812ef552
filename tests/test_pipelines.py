import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dwspark.operators.audit import AuditLog
from dwspark.plans import bank, car_sales, etl, warehouse
from dwspark.sinks import tables as tables_module

TXN_COLS = ["CustomerID", "CustomerDOB", "CustGender", "CustLocation", "CustAccountBalance",
            "TransactionID", "TransactionDate", "TransactionTime", "TransactionAmount (INR)"]


def txn_frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in TXN_COLS))


def test_bank_customers(spark):
    # repeated id, null id, null gender, year above the pivot
    rows = [
        ("C100", "10/1/94", "F", "JAMSHEDPUR", "17819.05", "T1", "2/8/16", "143207", "25"),
        ("C100", "10/1/94", "F", "JAMSHEDPUR", "17819.05", "T2", "2/8/16", "143207", "25"),
        (None, "4/4/87", "M", "DELHI", "2270.69", "T3", "2/8/16", "141858", "27999"),
        ("C200", "21/6/65", None, " MUMBAI ", "abc", "T4", "2/8/16", "923", "459"),
    ]
    out = {r.customer_id: r for r in bank.customers(txn_frame(spark, rows)).collect()}
    assert set(out) == {"C100", "C200"}
    assert out["C100"].birth_date == dt.date(1994, 1, 10) and out["C100"].gender == "Female"
    assert out["C200"].birth_date == dt.date(1965, 6, 21) and out["C200"].gender == "Other"
    assert out["C200"].location == "MUMBAI" and out["C200"].account_balance is None
    assert out["C100"].account_balance == Decimal("17819.05")


def test_bank_transactions(spark):
    # short time, repeated id, missing customer
    rows = [
        ("C1", "1/1/90", "M", "X", "1", "T1", "2/8/16", "923", "25"),
        ("C1", "1/1/90", "M", "X", "1", "T1", "2/8/16", "923", "25"),
        ("", "1/1/90", "M", "X", "1", "T2", "2/8/16", "143207", "1.5"),
        ("C2", "1/1/90", "M", "X", "1", "T3", "31/2/16", "1234567", "x"),
    ]
    out = {r.transaction_id: r for r in bank.transactions(txn_frame(spark, rows)).collect()}
    assert set(out) == {"T1", "T3"}
    assert out["T1"].transaction_time == "00:09:23" and out["T1"].transaction_date == dt.date(2016, 8, 2)
    assert out["T3"].transaction_time is None and out["T3"].transaction_date is None and out["T3"].transaction_amount is None


def test_marketing_campaign(spark):
    cols = bank.CAMPAIGN_COLUMNS
    row = (1, 58, "management", 1, 2, False, "$-1,372", True, False, "unknown", 5, "may", 730, 1, -1, 0, "unknown", False,
           dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    schema = ("loan_data_id int, age int, job string, marital_id int, education_id int, default boolean, balance string, "
              "housing boolean, loan boolean, contact string, day int, month string, duration int, campaign int, pdays int, "
              "previous int, poutcome string, subscribed_deposit boolean, created_at timestamp, updated_at timestamp")
    out = bank.marketing_campaign(spark.createDataFrame([row], schema)).first()
    assert out.balance == -1372 and out.duration_in_year == 2 and out.days_since_last_campaign == -1
    assert "pdays" not in out.asDict() and len(cols) == 20


def car_rows():
    good = ("1", "2015", "Ford", "automatic", "ca", "30", "12000", "white", "black", "20500", "21500")
    return [
        good,
        good,  # repeated id
        ("2", "2014", " KIA ", "manual", "CA", "25", "5000", "-", "—", "15000", "14000"),
        ("3", "1975", "ford", "manual", "ca", "25", "5000", "red", "gray", "15000", "14000"),      # year < 1980
        ("4", "2016", "Unknown", "manual", "ca", "25", "5000", "red", "gray", "15000", "14000"),   # brand not found
        ("5", "2016", "ford", "manual", "zz", "25", "-10", "red", "gray", "0", "14000"),          # state, odometer, mmr
        ("6", "nan", "ford", "manual", "ca", "NULL", "5000", "red", "gray", "15000", "14000"),    # null tokens
        ("7.0", "2016.0", "ford", "", "ca", "25", "5000", None, None, "15000", "14000"),           # float-text ids
    ]


def test_car_sales_transform_accounts_for_every_row(spark):
    src = spark.createDataFrame(car_rows(), ", ".join(f"{c} string" for c in
        ["id_sales", "year", "brand_car", "transmission", "state", "condition", "odometer", "color", "interior", "mmr", "sellingprice"]))
    brands = spark.createDataFrame([(1, "Ford"), (2, "Kia")], "brand_car_id int, brand_name string")
    states = spark.createDataFrame([(10, "CA", "California")], "id_state int, code string, name string")
    res = car_sales.transform(src, brands, states)
    loaded = {r.id_sales_nk: r for r in res.loaded.collect()}
    assert set(loaded) == {1, 2, 7}
    assert loaded[2].brand_car_id == 2 and loaded[2].color is None and loaded[2].interior is None
    assert loaded[7].transmission is None and loaded[7].year == 2016
    rejected = {r.id_sales_nk: set(r.reject_reasons) for r in res.rejected.collect()}
    assert rejected[3] == {"year_out_of_range"}
    assert rejected[4] == {"brand_car_id_missing"}
    assert rejected[5] == {"id_state_missing", "odometer_out_of_range", "mmr_out_of_range"}
    assert rejected[6] == {"year_missing", "condition_missing"}
    s = res.summary.first()
    assert (s.processed_rows, s.loaded_rows, s.rule_rejected_rows, s.duplicate_rows, s.rejected_rows) == (8, 3, 4, 1, 5)
    # invariant: accepted + rejected = processed
    assert s.loaded_rows + s.duplicate_rows + s.rule_rejected_rows == s.processed_rows


def test_driver_table_models(spark, tables):
    fact = warehouse.fct_order(tables)
    assert fact.count() == tables["orders"].count()
    assert fact.where(F.col("sk_customer_id").isNull()).count() == 0
    dates = warehouse.dim_date(tables)
    assert dates.count() == dates.select("date_id").distinct().count()
    prods = warehouse.dim_products(tables)
    assert prods.agg(F.min("sk_product_id"), F.max("sk_product_id")).first() == (1, tables["part"].count())


def test_whole_pipeline_detects_changes_and_records_history(spark, tables, tmp):
    src = etl.driver_sources(tables)
    run1, s1 = etl.run(spark, src, f"{tmp}/wh", f"{tmp}/audit")
    r1 = s1.first()
    assert r1.status == "SUCCEEDED"
    assert all(c.deleted_count == 0 and c.updated_count == 0 for c in r1.changes)
    # second run over a changed campaign source: balances move, one customer row disappears
    changed = etl.BankSources(src.transactions, src.campaign.where(F.col("loan_data_id") != 0).withColumn("balance", F.lit("$1")),
                              src.education, src.marital)
    run2, s2 = etl.run(spark, changed, f"{tmp}/wh", f"{tmp}/audit")
    r2 = s2.first()
    camp = [c for c in r2.changes if c.table_name == "marketing_campaign_deposit"][0]
    n = tables["customer"].count()
    assert camp.deleted_count == 1 and camp.inserted_count == 0 and camp.updated_count + camp.unchanged_count == n - 1
    prof = [p for p in r2.profiles if p.stage == "target" and p.dataset_name == "marketing_campaign_deposit"][0]
    assert prof.previous_row_count == n and prof.row_count_delta == -1
    assert spark.read.parquet(f"{tmp}/wh/marketing_campaign_deposit").count() == n - 1
    assert spark.read.json(f"{tmp}/audit/summaries/{run2}").count() == 1


def test_failed_run_keeps_its_source_profiles_and_says_why(spark, tables, tmp, monkeypatch):
    src = etl.driver_sources(tables)
    write = tables_module.write_counted
    monkeypatch.setattr(tables_module, "write_counted", lambda df, path: (lambda p, n: (p, n + 1))(*write(df, path)))  # one row got lost
    with pytest.raises(ValueError):
        etl.run(spark, src, f"{tmp}/wh", f"{tmp}/audit")
    run = AuditLog(spark, f"{tmp}/audit").runs().first()
    assert run.status == "FAILED" and "ValueError" in run.error_message
    assert {r.stage for r in spark.read.parquet(f"{tmp}/audit/profiles").collect()} == {"source"}
    assert spark.read.json(f"{tmp}/audit/summaries/{run.run_id}").first().status == "FAILED"
    import os
    assert not os.path.exists(f"{tmp}/wh/customers") and not [x for x in os.listdir(f"{tmp}/wh") if ".staging-" in x]

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from dwspark.functions import clean


def col_values(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_currency_to_int(spark):
    assert col_values(spark, ["$-1,372", "$2,143", "29", "abc", None], clean.currency_to_int) == [-1372, 2143, 29, None, None]


def test_days_to_years(spark):
    assert col_values(spark, [730, 364, 0], clean.days_to_years, "int") == [2, 0, 0]


def test_gender_label(spark):
    assert col_values(spark, ["M", " f ", "x", None, "F"], clean.gender_label) == ["Male", "Female", "Other", "Other", "Female"]


def test_to_decimal(spark):
    assert col_values(spark, ["17819.05", "bad", None, " 12 "], clean.to_decimal) == [Decimal("17819.05"), None, None, Decimal("12.00")]


def test_legacy_date_pivot(spark):
    got = col_values(spark, ["10/1/94", "21/6/65", "5/11/24", "31/2/90", "", "nan", "1/1/1800", " 7/3/99 ", "1/1/26"], clean.legacy_date)
    assert got == [
        dt.date(1994, 1, 10), dt.date(1965, 6, 21), dt.date(2024, 11, 5), None, None, None,
        dt.date(1800, 1, 1), dt.date(1999, 3, 7), dt.date(1926, 1, 1),
    ]


def test_normalize_time(spark):
    got = col_values(spark, ["143207", "923", "00:09:23", "1234567", "", None, "995959"], clean.normalize_time)
    assert got == ["14:32:07", "00:09:23", "00:09:23", None, None, None, "99:59:59"]
    ranged = col_values(spark, ["995959", "235959"], lambda c: clean.normalize_time(c, check_range=True))
    assert ranged == [None, "23:59:59"]


def test_numeric_text_and_clean_number(spark):
    vals = [" $47.00 ", "$-15.00", "(1,200)", "NA", "N/A", "None", "nan", "na", "", "1e3", "12abc", "NaN", "1.5d"]
    assert col_values(spark, vals, clean.clean_number) == [47.0, -15.0, -1200.0, None, None, None, None, None, None, 1000.0, None, None, None]


def test_strip_to_decimal(spark):
    got = col_values(spark, ["$47.00", "IDR 900.10", "$-15.00", "", "abc", "1.2.3"], clean.strip_to_decimal)
    assert got == [Decimal("47.00"), Decimal("900.10"), Decimal("-15.00"), None, None, None]


def test_tri_state_bool(spark):
    got = col_values(spark, ["Yes", "no", "In Stock", "out of stock", "1", "0", "maybe", None], clean.tri_state_bool)
    assert got == [True, False, True, False, True, False, None, None]


def test_date_key(spark):
    df = spark.createDataFrame([(dt.datetime(1998, 3, 7, 13, 5),)], "ts timestamp_ntz")
    assert df.select(clean.date_key("ts")).first()[0] == 19980307


def test_clean_text_and_join_key(spark):
    assert col_values(spark, ["  Ford ", "-", "—", "NULL", "<NA>", "none", "", "Kia"], clean.clean_text) == [
        "Ford", None, None, None, None, None, None, "Kia"]
    assert col_values(spark, ["  BMW "], clean.join_key) == ["bmw"]


def test_to_int_truncates_like_legacy_cast(spark):
    assert col_values(spark, ["2015", "2015.0", " 7.9 ", "-3.5", "x", None, "1e3"], clean.to_int) == [2015, 2015, 7, -3, None, None, None]


def test_stringify_and_safe_divide(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "a int, b string, c double")
    assert clean.stringify(df).first().asDict() == {"a": "1", "b": "", "c": "2.5"}
    r = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0)], "a double, b double").select(clean.safe_divide("a", "b")).collect()
    assert [x[0] for x in r] == [None, 2.5]


def test_prepare_model_frame(spark):
    df = spark.createDataFrame([("1", "a", "5"), ("x", None, "6"), ("2", None, None), ("3", None, "7")], "n string, c string, y string")
    out = clean.prepare_model_frame(df, ["n"], ["c"], "y").collect()
    assert [(r.n, r.c, r.y) for r in out] == [(1.0, "a", 5.0), (3.0, "unknown", 7.0)]


def test_category_fallback_and_flag(spark):
    assert col_values(spark, ["Cash", "ERROR", None], lambda c: clean.category_or_unknown(c, ["Cash", "Credit Card"])) == [
        "Cash", "Unknown", "Unknown"]
    assert col_values(spark, [None, "7"], clean.is_missing_flag) == [True, False]


def test_rename_columns(spark):
    df = spark.createDataFrame([(1, 2, "x")], "pdays int, previous int, poutcome string")
    assert clean.rename_columns(df, clean.CAMPAIGN_RENAMES).columns == [
        "days_since_last_campaign", "previous_campaign_contacts", "previous_campaign_outcome"]

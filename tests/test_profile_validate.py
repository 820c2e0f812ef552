import datetime as dt

from pyspark.sql import functions as F

from dwspark.operators import checks, profile, validate


def test_profile_sample_nulls_blanks_duplicates(spark):
    # profile sample: 3 rows, one null, one blank, one repeated key
    df = spark.createDataFrame([("1", "a"), ("1", None), ("2", " ")], "id string, value string")
    r = profile.profile(df, "sample", ["id"], "source").first()
    assert (r.row_count, r.column_count, r.null_count, r.duplicate_key_count, r.duplicate_rows) == (3, 2, 2, 1, 1)
    assert r.null_by_column == {"id": 0, "value": 2}


def test_profile_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    r = profile.profile(df, "t", ["k"]).first()
    assert r.duplicate_key_count == 1 and r.null_count == 2


def test_profile_without_keys(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    assert profile.profile(df, "t").first().duplicate_key_count == 0


def test_shapes_counts_types(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(1,), (2,)], "c long")
    shapes = {r.table_name: (r.row_count, r.column_count) for r in profile.table_shapes({"a": a, "b": b}).collect()}
    assert shapes == {"a": (1, 2), "b": (2, 1)}
    assert [tuple(r) for r in profile.row_counts({"b": b, "a": a}).collect()] == [("a", 1), ("b", 2)]
    types = profile.column_types(spark, {"a": a}).collect()
    assert [(r.position, r.column_name, r.data_type) for r in types] == [(1, "a", "int"), (2, "b", "string")]


def test_unique_values_with_alias_and_missing_table(spark):
    inv = spark.createDataFrame([(" Restock",), ("Damaged",), ("",), (None,), ("Restock",)], "reason string")
    out = profile.unique_values({"inventory_tracking": inv}, {"inventory": ["reason"], "nope": ["x"]},
                                aliases={"inventory": "inventory_tracking"}).collect()
    vals = [(r.table_name, r.value, r.status) for r in out]
    assert ("inventory_tracking", "Damaged", "ok") in vals and ("inventory_tracking", "Restock", "ok") in vals
    assert len([v for v in vals if v[0] == "inventory_tracking"]) == 2
    assert ("nope", "Table 'nope' not found in source database.", "warning") in vals


def test_missing_and_blank_like(spark):
    df = spark.createDataFrame([(1, " NA "), (None, "none"), (3, "ok"), (4, None)], "n int, s string")
    out = {r.column_name: (r.missing_count, r.blank_like_count) for r in profile.missing_report({"t": df}).collect()}
    assert out == {"n": (1, 0), "s": (1, 2)}


def test_column_stats_and_describe(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (3.0, None), (4.0, "b")], "x double, c string")
    st = {r.column_name: (r.missing_count, r.missing_pct, r.distinct_count) for r in profile.column_stats(df, "t").collect()}
    assert st == {"x": (0, 0.0, 4), "c": (1, 25.0, 2)}
    d = profile.numeric_describe(df, ["x"]).first()
    assert (d["count"], d["mean"], d["std"], d["min"], d["p25"], d["p50"], d["p75"], d["max"]) == (4, 2.5, 1.29, 1.0, 1.75, 2.5, 3.25, 4.0)
    approx = profile.numeric_describe(df, ["x"], exact=False).first()
    assert approx["min"] == 1.0 and approx["max"] == 4.0


def test_top_values_counts_null_as_value(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",), ("a",)], "c string")
    r = profile.top_values(df, ["c"]).first()
    assert (r.top_value, r.top_count, r.distinct_count) == (None, 2, 2)


def test_validate_dates_modes(spark):
    df = spark.createDataFrame(
        [("2024-01-05", dt.date(2024, 1, 5), None), ("2024-02-30", None, None), (" 05/01/2024 ", dt.date(2024, 1, 6), None), (None, None, None)],
        "txt string, d date, empty string")
    out = {r.column_name: r for r in validate.validate_dates(df, "t", {"txt": "%Y-%m-%d", "d": "%Y-%m-%d", "empty": "%Y-%m-%d", "gone": "%Y"}).collect()}
    assert (out["txt"].status, out["txt"].total_checked, out["txt"].invalid_count, out["txt"].validation_mode) == ("invalid", 3, 2, "format_based")
    assert out["txt"].invalid_examples == ["05/01/2024", "2024-02-30"]
    assert (out["d"].status, out["d"].validation_mode) == ("valid", "dtype_based")
    assert (out["empty"].status, out["empty"].validation_mode) == ("valid", "empty")
    assert (out["gone"].status, out["gone"].validation_mode, out["gone"].invalid_examples) == ("invalid", "warning", ["Column 'gone' not found."])
    missing_table = validate.validate_dates(None, "ghost", {"x": "%Y"}).first()
    assert (missing_table.column_name, missing_table.validation_mode) == ("_warning", "warning")


def test_validate_numeric(spark):
    df = spark.createDataFrame([("$47.00",), ("12.5",), ("NA",), ("",), (None,), ("(3)",), ("abc",)], "p string")
    r = validate.validate_numeric(df, "products", ["p"]).first()
    assert (r.total_checked, r.invalid_count, r.recoverable_after_cleaning_count, r.unrecoverable_count) == (5, 4, 2, 2)
    assert r.recoverable_examples == ["$47.00", "(3)"] or r.recoverable_examples == sorted(["$47.00", "(3)"])
    assert r.unrecoverable_examples == ["NA", "abc"]
    assert r.status == "invalid"


def test_validate_negative_and_allow(spark):
    df = spark.createDataFrame([("$-15.00",), ("10",), ("x",), (None,), ("-2",)], "v string")
    r = validate.validate_negative(df, "p", ["v"]).first()
    assert (r.status, r.total_checked, r.negative_count, r.unparsed_count) == ("invalid", 3, 2, 1)
    assert r.negative_examples == [-15.0, -2.0]
    assert validate.validate_negative(df, "p", ["v"], allow_negative=True).first().status == "valid"


def test_examples_are_bounded(spark):
    df = spark.range(1000).select(F.concat(F.lit("bad"), F.col("id").cast("string")).alias("v"))
    r = validate.validate_numeric(df, "t", ["v"], max_examples=5).first()
    assert r.invalid_count == 1000 and len(r.invalid_examples) == 5


def test_unexpected_and_business_rules(spark):
    orders = spark.createDataFrame([("Cash",), ("ERROR",), (" ERROR ",), (None,), ("Debit Card",)], "payment_method string")
    out = validate.unexpected_categorical({"orders": orders}, {"orders": {"payment_method": ["Cash", "Credit Card", "Debit Card"]}}).collect()
    assert [(r.unexpected_value, r.occurrences) for r in out] == [("ERROR", 2)]
    products = spark.createDataFrame([("$47.00", "$20.00"), ("$-15.00", "$3.00"), ("$10.00", "$-1.00"), ("$5.00", "$9.00")], "unit_price string, cost_price string")
    p = validate.price_rules(products, "unit_price", "cost_price").first()
    assert (p.negative_unit_price_count, p.negative_cost_price_count, p.cost_greater_than_unit_count) == (1, 1, 2)
    inv = spark.createDataFrame([("Damaged", "5"), ("Expired", "-1"), ("Restock", "-3"), ("Restock", "4")], "reason string, q string")
    d = validate.direction_rules(inv, "reason", "q").first()
    assert (d.damaged_or_expired_positive_count, d.restock_negative_count) == (1, 1)


def test_rollup_and_reports(spark):
    missing = spark.createDataFrame([("a", "x", 2, 1), ("a", "y", 0, 0), ("b", "z", 0, 3)], "table_name string, column_name string, missing_count long, blank_like_count long")
    dates = spark.createDataFrame([("a", "d2", "invalid"), ("a", "d1", "invalid"), ("b", "d", "valid")], "table_name string, column_name string, status string")
    roll = {r.table_name: r for r in validate.quality_rollup(missing, dates, None, None).collect()}
    assert (roll["a"].total_missing_values, roll["a"].columns_with_missing_values, roll["a"].invalid_date_columns) == (2, 1, "d1, d2")
    assert roll["b"].invalid_date_columns == "-" and roll["b"].total_blank_like_values == 3
    rep = {r.table_name: r for r in checks.quality_report(missing, dates).collect()}
    assert rep["a"].missing_values == {"x": 2, "y": 0} and rep["a"].date_validity == {"d2": "invalid", "d1": "invalid"}


def test_recommendations_rule_table(spark):
    findings = spark.createDataFrame([("orders", "customer_id", "missing_count", 250), ("orders", "x", "missing_count", 0)],
                                     "table_name string, column_name string, metric string, value long")
    out = checks.recommendations(spark, findings).collect()
    assert out[0].priority == "High" and "250" in out[0].finding and "orders.customer_id" in out[0].finding
    assert len(out) == 2  # the fired rule + the always-on one


def test_reconcile_and_warehouse_checks(spark):
    header = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 1.0)], "id int, total double")
    detail = spark.createDataFrame([(1, 4.0), (1, 6.0), (2, 4.99)], "oid int, amt double")
    out = checks.reconcile(header, detail, "id", "oid", "total", "amt").collect()
    assert [(r.id, float(r.difference)) for r in out] == [(2, 0.01)]
    dim_date = spark.createDataFrame([(20240101,), (None,)], "date_id int")
    fact = spark.createDataFrame([(20240101,), (20240102,), (None,)], "d int")
    dim = spark.createDataFrame([(1,), (1,), (2,)], "nk int")
    res = {r.check_name: r.failing_count for r in checks.warehouse_checks({"f": (fact, "d")}, dim_date, {"dim": (dim, ["nk"])}).collect()}
    assert res == {"f_date_not_in_dim_date": 1, "dim_duplicate_natural_keys": 1}

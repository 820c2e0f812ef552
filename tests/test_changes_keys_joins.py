from pyspark.sql import Window
from pyspark.sql import functions as F

from dwspark.operators import aggregate, changes, joins, keys


def counts(df):
    r = df.first()
    return (r.inserted_count, r.updated_count, r.deleted_count, r.unchanged_count)


def test_change_counts_one_of_each(spark):
    # change snapshots: one inserted, one updated, one deleted, one unchanged
    cur = spark.createDataFrame([("1", "Jakarta"), ("2", "Bandung"), ("4", "Bali")], "customer_id string, location string")
    prev = spark.createDataFrame([("1", "Jakarta"), ("2", "Surabaya"), ("3", "Medan")], "customer_id string, location string")
    assert counts(changes.change_counts(cur, prev, ["customer_id"])) == (1, 1, 1, 1)
    feed = {r.customer_id: r.change_type for r in changes.change_feed(cur, prev, ["customer_id"]).collect()}
    assert feed == {"4": "insert", "2": "update", "3": "delete"}
    rows = {(r.customer_id, r.change_type, r.image, r.location) for r in changes.changed_rows(cur, prev, ["customer_id"]).collect()}
    assert rows == {("4", "insert", "after", "Bali"), ("2", "update", "before", "Surabaya"), ("2", "update", "after", "Bandung"),
                    ("3", "delete", "before", "Medan")}


def test_empty_previous_is_all_inserts(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert counts(changes.change_counts(cur, spark.createDataFrame([], cur.schema), ["k"])) == (2, 0, 0, 0)


def test_null_payload_differs_from_text_null(spark):
    cur = spark.createDataFrame([(1, None), (2, "null")], "k int, v string")
    prev = spark.createDataFrame([(1, "null"), (2, "null")], "k int, v string")
    assert counts(changes.change_counts(cur, prev, ["k"])) == (0, 1, 0, 1)


def test_types_are_aligned_before_hashing(spark):
    cur = spark.createDataFrame([(1, 1.5)], "k int, v double").select("k", F.col("v").cast("decimal(18,2)").alias("v"))
    prev = spark.createDataFrame([(1, 1.5)], "k int, v double")
    assert counts(changes.change_counts(cur, prev, ["k"])) == (0, 0, 0, 1)


def test_null_keys_never_match_unless_null_safe(spark):
    cur = spark.createDataFrame([(None, "a")], "k int, v string")
    prev = spark.createDataFrame([(None, "a")], "k int, v string")
    assert counts(changes.change_counts(cur, prev, ["k"])) == (1, 0, 1, 0)
    assert counts(changes.change_counts(cur, prev, ["k"], null_safe=True)) == (0, 0, 0, 1)


def test_hot_duplicate_key_does_not_multiply(spark):
    cur = spark.range(3000).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    prev = spark.range(3000).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    # one hot key: compared as one multiset, not 9 million pairs
    assert counts(changes.change_counts(cur, prev, ["k"])) == (0, 0, 0, 3000)


def test_change_counts_many_keeps_order(spark):
    a = spark.createDataFrame([(1,)], "k int")
    out = changes.change_counts_many([("z", a, a, ["k"]), ("a", a, a.limit(0), ["k"])]).collect()
    assert [(r.position, r.table_name, r.unchanged_count, r.inserted_count) for r in out] == [(1, "z", 1, 0), (2, "a", 0, 1)]


def test_dedupe_is_deterministic_and_skew_safe(spark):
    df = spark.createDataFrame([("1", "b", 2), ("1", "a", 9), ("2", "c", 1), (None, "x", 1), (None, "y", 1)], "id string, v string, n int")
    out = {r.id: (r.v, r.n) for r in keys.dedupe(df, ["id"]).collect()}
    assert out == {"1": ("a", 9), "2": ("c", 1), None: ("x", 1)}
    last = {r.id: r.v for r in keys.dedupe(df, ["id"], order_by=["n"], keep="last").collect()}
    assert last["1"] == "a"
    plan = keys.dedupe(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan or "Partial" in plan


def test_surrogate_key_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("nk"), (F.col("id") % 3).alias("v"))
    sk = keys.with_surrogate_key(df, ["nk"], "sk", num_partitions=7)
    expected = df.select("nk", F.row_number().over(Window.orderBy("nk")).alias("sk"))
    assert sk.select("nk", "sk").exceptAll(expected).count() == 0
    assert sk.count() == 5000 and sk.agg(F.min("sk"), F.max("sk")).first() == (1, 5000)


def test_lookup_join_normalised(spark):
    sales = spark.createDataFrame([(" FORD ",), ("kia",), (None,), ("unknown",)], "brand string")
    ref = spark.createDataFrame([(1, "Ford"), (2, "Kia ")], "brand_id int, name string")
    out = [r.brand_id for r in joins.lookup_join(sales, ref, "brand", "name", ["brand_id"]).orderBy("brand").collect()]
    assert sorted(out, key=lambda x: (x is None, x)) == [1, 2, None, None]
    assert joins.lookup_join(sales, ref, "brand", "name", ["brand_id"]).columns == ["brand", "brand_id"]


def test_type_drift_is_a_change(spark):
    cur = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k int, v int")
    prev = spark.createDataFrame([(1, "5"), (2, "x"), (3, " 7")], "k int, v string")
    feed = {r.k: r.change_type for r in changes.change_feed(cur, prev, ["k"], include_unchanged=True).collect()}
    assert feed == {1: "unchanged", 2: "update", 3: "unchanged"}


def test_join_ignore_case_and_missing_from(spark):
    p = spark.createDataFrame([("Main St",), ("north",)], "branch string")
    b = spark.createDataFrame([("MAIN ST", 10)], "store_name string, sk int")
    out = {r.branch: r.sk for r in joins.join_ignore_case(p, b, "branch", "store_name", ["sk"]).collect()}
    assert out == {"Main St": 10, "north": None}
    fact = spark.createDataFrame([(1,), (2,), (None,)], "d int")
    dim = spark.createDataFrame([(1,), (None,)], "date_id int")
    assert [r.d for r in joins.missing_from(fact, dim, "d", "date_id").collect()] == [2]


def test_latest_previous_and_full_outer(spark):
    hist = spark.createDataFrame([("s", "a", 10, 1), ("s", "a", 20, 2), ("s", "b", 5, 1)], "stage string, ds string, n int, t int")
    cur = spark.createDataFrame([("s", "a"), ("s", "c")], "stage string, ds string")
    out = {r.ds: r.prev for r in joins.latest_previous(cur, hist, ["stage", "ds"], "t", "n", "prev").collect()}
    assert out == {"a": 20, "c": None}
    l = spark.createDataFrame([(None, 1)], "k int, a int")
    r = spark.createDataFrame([(None, 2)], "k int, b int")
    assert joins.full_outer(l, r, ["k"]).count() == 2
    assert joins.full_outer(l, r, ["k"], null_safe=True).count() == 1


def test_aggregates(spark):
    d = spark.createDataFrame([(1, 7, 2, 10.0), (1, 3, 0, 0.0), (2, 5, 0, 4.0)], "o int, p int, q int, amt double")
    s = {r.o: r for r in aggregate.item_summary(d, "o", "p", "q", "amt").collect()}
    assert (s[1].product_id, s[1].quantity, s[1].unit_price, s[1].subtotal) == (3, 2, 5.0, 10.0)
    assert s[2].unit_price is None
    m = aggregate.regression_metrics(spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "a double, p double"), "a", "p").first()
    assert abs(m.r2 - 0.5) < 1e-12 and abs(m.mae - 1 / 3) < 1e-12
    top = aggregate.top_k(spark.range(100), [("id", False)], 3).collect()
    assert [r.id for r in top] == [99, 98, 97]
    c = aggregate.conditional_counts(d, {"zero_qty": F.col("q") == 0}).first()
    assert c.zero_qty == 2
    latest = aggregate.latest_per_group(spark.createDataFrame([("r", 1, "RUNNING"), ("r", 2, "SUCCEEDED")], "id string, t int, s string"), ["id"], "t", ["s"]).first()
    assert latest.s == "SUCCEEDED"
    assert aggregate.count_distinct(d, ["o"]).first().o == 2

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dwspark.operators.joins import as_of
from dwspark.sinks import tables
from dwspark.sources import files


def write(tmp, name, text):
    path = f"{tmp}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_keeps_bad_rows_with_file_and_text(spark, tmp):
    path = write(tmp, "a.csv", 'id,name,price\n1,x,2.5\ntwo,y,3\n3,"z, z",4\n4,w\n5,v,6,7\n,,\n')
    good, bad = files.read_csv_checked(spark, path, "id int, name string, price double")
    assert [tuple(r) for r in good.orderBy("id").collect()] == [(None, None, None), (1, "x", 2.5), (3, "z, z", 4.0)]
    assert good.count() == 3 and good.select("name").count() == 3  # the same rows whatever is looked at
    rows = bad.collect()
    assert sorted(r.record for r in rows) == ["4,w", "5,v,6,7", "two,y,3"] and bad.count() == 3
    assert all(r.file.endswith("a.csv") and r.block_start == 0 for r in rows)


@pytest.mark.parametrize("text", ['{"regions": [{"code": "CA", "id": 1}, {"code": null, "id": 2}]}', ' [{"id": 1, "code": "CA", "more": []}, {"id": 2}]\n'])
def test_json_records_by_schema(spark, tmp, text):
    path = write(tmp, "s.json", text)
    out = files.read_json_records(spark, path, schema="id int, code string", required=["code"])
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, "CA"), (2, None)]
    with pytest.raises(ValueError):
        files.read_json_records(spark, path, schema="id int", required=["code"])


@pytest.mark.parametrize("text", ["{", '{"other": []}', '[{"id": "x"}]', '{"regions": [{"id": 1}'])
def test_json_that_is_no_such_document_is_an_error(spark, tmp, text):
    with pytest.raises(Exception):
        files.read_json_records(spark, write(tmp, "s.json", text), schema="id int").collect()


def test_bad_timestamp_is_an_error_when_strict(spark, tmp):
    path = write(tmp, "t.csv", "id,at\n1,1/2/2024 03:04:05\n2,13/13/2024 00:00:00\n3,\n")
    assert files.read_csv_with_timestamps(spark, path, ["at"]).where("at IS NULL").count() == 2
    strict = files.read_csv_with_timestamps(spark, path, ["at"], strict=True)
    with pytest.raises(Exception, match="13/13/2024"):
        strict.collect()
    assert strict.where("id = '1'").first().at == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_as_of_equals_a_search_row_by_row(spark):
    r = random.Random(4)
    day = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=r.randint(0, 4000) * (1 if r.random() < 0.9 else 500))
    key = lambda: r.choice([None, 1, 1, 1, 2, 3, 4])  # noqa: E731  # one key with many rows
    hist = [(key() if i else 9, day() if r.random() > 0.05 else None, i, f"v{i}") for i in range(700)]
    hist += [(k, t, i + 1000, None) for k, t, i, _ in hist[:60]]  # several at the same time, null values
    rows = [(i, r.choice([None, 1, 2, 3, 5]), day() if r.random() > 0.05 else None) for i in range(600)] + [(0, 1, day())] * 2
    df = spark.createDataFrame(rows, "id int, k int, t timestamp_ntz").repartition(4)
    history = spark.createDataFrame(hist, "k int, at timestamp_ntz, n int, v string").repartition(4)
    got = sorted(map(str, as_of(df, history, ["k"], "t", "at", ["v", "n"], ["n"]).collect()))

    def search(k, t):
        found = [(at, n, v) for hk, at, n, v in hist if hk == k and at is not None and t is not None and k is not None and at <= t]
        return (max(found)[2], max(found)[1]) if found else (None, None)

    want = df.sparkSession.createDataFrame([(i, k, t, *search(k, t)) for i, k, t in rows], "id int, k int, t timestamp_ntz, v string, n int")
    assert got == sorted(map(str, want.collect()))


def test_as_of_edges(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, None)], "k int, t date")
    none = spark.createDataFrame([], "k int, at date, v int")
    assert [tuple(x) for x in as_of(df, none, ["k"], "t", "at", ["v"], prefix="last_").orderBy("k").collect()] == [(1, dt.date(2024, 1, 1), None), (2, None, None)]
    one = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5)], "k int, at date, v int")
    assert [x.v for x in as_of(df, one, ["k"], "t", "at", ["v"]).orderBy("k").collect()] == [5, None]
    earlier = df.withColumn("t", F.date_sub("t", 1))
    assert [x.v for x in as_of(earlier, one, ["k"], "t", "at", ["v"]).orderBy("k").collect()] == [None, None]
    assert as_of(df.limit(0), one, ["k"], "t", "at", ["v"]).collect() == []


def test_layer_sync_follows_a_drifting_source(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sync_layer_test")
    try:
        a = spark.createDataFrame([(1, "x")], "id int, name string")
        first = {r.table_name: r for r in tables.sync_layer(spark, {"a": a, "b": spark.range(4)}, "sync_layer_test").collect()}
        assert (first["a"].action, first["b"].action, first["b"].rows) == ("created", "created", 4)
        same = tables.sync_layer(spark, {"a": spark.createDataFrame([("y", 2), ("z", 3)], "name string, id int")}, "sync_layer_test").first()
        assert (same.action, same.rows) == ("refreshed", 2)
        assert sorted(map(tuple, spark.table("sync_layer_test.a").collect())) == [(2, "y"), (3, "z")]
        drift = tables.sync_layer(spark, {"a": spark.createDataFrame([(7, 1.5)], "id long, price double")}, "sync_layer_test").first()
        assert (drift.action, drift.added, drift.dropped, drift.retyped) == ("rebuilt", ["price"], ["name"], ["id: int -> bigint"])
        assert spark.table("sync_layer_test.a").first().price == 1.5
    finally:
        spark.sql("DROP DATABASE IF EXISTS sync_layer_test CASCADE")

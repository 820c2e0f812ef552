import os
import shutil

import pytest
from pyspark.sql import functions as F

from dwspark.operators import sketches


def rows(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def write(spark, path, start, n):
    spark.range(start, start + n).select(
        "id", (F.col("id") % 7).cast("double").alias("v"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), F.col("id"))).alias("s"),
        F.array(F.col("id") % 2).alias("a")).coalesce(1).write.mode("append").parquet(path)


def test_second_profile_reads_only_the_added_file(spark, tmp, monkeypatch):
    path = f"{tmp}/table with blank"
    write(spark, path, 0, 400)
    write(spark, path, 400, 300)
    store = sketches.Profiles(spark, f"{tmp}/store")
    assert len(store.new_files("t", path)) == 2
    first = rows(store.refresh("t", path))
    assert {r[1]: r[2] for r in first} == {"id": 700, "v": 700, "s": 700, "a": 700}
    seen = []
    real = sketches.sketch
    monkeypatch.setattr(sketches, "sketch", lambda df, t: seen.append(df.inputFiles()) or real(df, t))
    assert rows(store.refresh("t", path)) == first and seen == []  # nothing new: nothing scanned
    write(spark, path, 700, 500)
    second = rows(store.refresh("t", path))
    assert [len(x) for x in seen] == [1]
    fresh = rows(sketches.Profiles(spark, f"{tmp}/other").refresh("t", path))
    assert second == fresh and second != first
    exact = spark.read.parquet(path).agg(F.avg("v"), F.stddev_samp("v"), F.min("v"), F.max("v"), F.count_if(F.col("s").isNull()), F.count_distinct("s")).first()
    got = {r[1]: r for r in second}
    assert got["v"][7:] == tuple(pytest.approx(x) for x in exact[:4])
    assert got["s"][3] == exact[4] and abs(got["s"][4] - exact[5]) <= 0.05 * exact[5]


def test_changed_and_deleted_files(spark, tmp):
    path = f"{tmp}/t"
    write(spark, path, 0, 100)
    write(spark, path, 100, 100)
    store = sketches.Profiles(spark, f"{tmp}/store")
    store.refresh("t", path)
    parts = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    os.remove(f"{path}/{parts[0]}")
    left = spark.read.parquet(path).count()
    assert {r.row_count for r in store.refresh("t", path).collect()} == {left} == {100}
    spark.range(7).select("id", F.lit(1.0).alias("v"), F.lit("x").alias("s"), F.array("id").alias("a")).coalesce(1).write.parquet(f"{tmp}/u")
    part = next(f for f in os.listdir(f"{tmp}/u") if f.endswith(".parquet"))
    shutil.copy(f"{tmp}/u/{part}", f"{path}/{parts[1]}")
    crc = f"{path}/.{parts[1]}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert {r.row_count for r in store.refresh("t", path).collect()} == {7}


def test_tables_share_a_store_and_null_columns(spark, tmp):
    spark.createDataFrame([(None, float("nan")), (None, 1.0)], "x int, y double").coalesce(1).write.parquet(f"{tmp}/a")
    spark.range(3).coalesce(1).write.parquet(f"{tmp}/b")
    store = sketches.Profiles(spark, f"{tmp}/store")
    a = {r.column_name: r for r in store.refresh("a", f"{tmp}/a").collect()}
    assert (a["x"].missing_count, a["x"].distinct_count, a["x"].mean, a["x"].std) == (2, 0, None, None)
    assert (a["y"].mean, a["y"].std, a["y"].low_number) == (1.0, None, 1.0)
    assert [r.row_count for r in store.refresh("b", f"{tmp}/b").collect()] == [3]

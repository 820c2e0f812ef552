import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from dwspark.operators.audit import AuditLog, execution_summary
from dwspark.sinks import reports, tables
from dwspark.sources import catalog, files, jdbc


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_csv_reads_text_and_fails_fast(spark, tmp):
    # store branch CSV with M/d/yyyy HH:mm:ss timestamps
    p = write(f"{tmp}/store.csv", "store_id,store_name,created_at\n1,Main St,1/5/2024 08:03:01\n2,North,12/31/2023 23:59:59\n3,South,bad\n")
    df = files.read_csv(spark, p)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string"] * 3 and df.count() == 3
    ts = files.read_csv_with_timestamps(spark, p, ["created_at"]).orderBy("store_id").collect()
    assert ts[0].created_at == dt.datetime(2024, 1, 5, 8, 3, 1) and ts[2].created_at is None
    bad = write(f"{tmp}/bad.csv", "a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception):
        files.read_csv(spark, bad, schema="a int, b int").collect()


def test_tsv_required_columns(spark, tmp):
    p = write(f"{tmp}/brand.tsv", "brand_car_id\tbrand_name\n1\tFord\n2\tKia\n")
    assert files.read_tsv(spark, p, ["brand_car_id", "brand_name"]).count() == 2
    with pytest.raises(ValueError):
        files.read_tsv(spark, p, ["brand_car_id", "country"])


def test_json_object_or_bare_array(spark, tmp):
    obj = write(f"{tmp}/obj.json", json.dumps({"regions": [{"id_state": 1, "code": "CA", "name": "California"}, {"id_state": 2, "code": "NY", "name": "New York"}]}))
    arr = write(f"{tmp}/arr.json", json.dumps([{"id_state": 1, "code": "CA", "name": "California"}]))
    assert sorted(r.code for r in files.read_json_records(spark, obj, required=["id_state", "code"]).collect()) == ["CA", "NY"]
    assert files.read_json_records(spark, arr, required=["code"]).count() == 1


def test_jdbc_roundtrip_on_in_memory_derby(spark):
    url = "jdbc:derby:memory:dwtest;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.range(1, 101).select(F.col("id").cast("int").alias("ID"), (F.col("id") * 2).cast("int").alias("V"))
    df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", "T1").option("driver", props["driver"]).save()
    tables.replace_jdbc(df.where("ID <= 50"), url, "T1", props)
    assert jdbc.read_table(spark, url, "T1", props).count() == 50
    lo, hi = jdbc.key_bounds(spark, url, "T1", "ID", props)
    part = jdbc.read_table(spark, url, "T1", props, "ID", lo, hi, 4)
    assert part.rdd.getNumPartitions() == 4 and part.count() == 50
    assert jdbc.read_columns(spark, url, "T1", ["V"], props).columns == ["V"]


def test_replace_files_and_verify(spark, tmp):
    path = f"{tmp}/t"
    tables.replace_files(spark.range(10), path)
    tables.replace_files(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    ok = tables.verify_counts({"t": 3}, {"t": spark.read.parquet(path)}).first()
    assert ok.ok and ok.actual_rows == 3
    with pytest.raises(ValueError):
        tables.verify_counts({"t": spark.range(4)}, {"t": spark.read.parquet(path)})


def test_load_order_and_common_columns(spark):
    seen = []
    frames = {"a": spark.range(1), "b": spark.range(2)}
    tables.load_in_order(frames, ["b", "a"], lambda n, d: seen.append(("load", n)), truncate=lambda n: seen.append(("trunc", n)))
    assert seen == [("trunc", "a"), ("trunc", "b"), ("load", "b"), ("load", "a")]
    with pytest.raises(ValueError):
        tables.load_in_order(frames, ["a"], lambda n, d: None)
    src = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int")
    assert tables.common_columns(src, ["z", "x", "w"]).columns == ["x", "z"]
    with pytest.raises(ValueError):
        tables.common_columns(src, ["w"])
    counts = {r.view_name: r.row_count for r in tables.register_views(frames, "stg_").collect()}
    assert counts == {"stg_a": 1, "stg_b": 2} and spark.table("stg_b").count() == 2


def test_step_log_failures_and_reports(spark, tmp):
    for i in range(3):
        tables.log_step(spark, f"{tmp}/log", f"step{i}", "staging", "SUCCESS", "orders", at=dt.datetime(2024, 1, 1, 0, i))
    tail = tables.read_log_tail(spark, f"{tmp}/log", 2).collect()
    assert [r.step for r in tail] == ["step2", "step1"]
    rows = spark.createDataFrame([(1, "bad")], "id int, reason string")
    reports.dump_failed_rows(rows, f"{tmp}/failed", "staging", "orders_job", "b1")
    assert os.path.isdir(f"{tmp}/failed/layer=staging/job_name=orders_job/batch_id=b1")
    payload = reports.failure_payload(spark, "warehouse", "load", "b2", "boom", {"table": "x"})
    reports.dump_failed_rows(payload, f"{tmp}/failed", "warehouse", "load", "b2")
    reports.write_json_report(spark.createDataFrame([("a", 1)], "table_name string, n int"), f"{tmp}/report")
    assert spark.read.json(f"{tmp}/report").first().n == 1


def test_audit_runs_profiles_changes(spark, tmp):
    audit = AuditLog(spark, f"{tmp}/audit")
    prof_schema = "stage string, dataset_name string, row_count long, column_count int, null_count long, duplicate_key_count long, null_by_column map<string,long>"

    def profiles(n):
        return spark.createDataFrame([("target", "customers", n, 5, 0, 0, {"a": 0})], prof_schema)

    r1 = audit.start_run(at=dt.datetime(2024, 1, 1))
    audit.save_profiles(r1, profiles(100))
    audit.mark_succeeded(r1, 1.5, at=dt.datetime(2024, 1, 1, 0, 1))
    r2 = audit.start_run(at=dt.datetime(2024, 1, 2))
    audit.save_profiles(r2, profiles(120))
    audit.mark_failed(r2, "x" * 5000, at=dt.datetime(2024, 1, 2, 0, 1))
    r3 = audit.start_run(at=dt.datetime(2024, 1, 3))
    out = audit.save_profiles(r3, profiles(90)).first()
    # previous comes from the newest *succeeded* run only
    assert (out.previous_row_count, out.row_count_delta) == (100, -10)
    audit.save_changes(r3, spark.createDataFrame([("customers", 1, 2, 3, 4)], "table_name string, inserted_count long, updated_count long, deleted_count long, unchanged_count long"))
    runs = {r.run_id: r for r in audit.runs().collect()}
    assert runs[r1].status == "SUCCEEDED" and runs[r2].status == "FAILED" and runs[r3].status == "RUNNING"
    assert len(runs[r2].error_message) == 5000 and runs[r3].finished_at is None
    s = audit.summary(r3).first()
    assert s.changes[0].updated_count == 2 and s.profiles[0].row_count == 90
    audit.export_summary(r3, f"{tmp}/summary")
    assert spark.read.json(f"{tmp}/summary").count() == 1
    assert execution_summary(spark, processed_rows=10, loaded_rows=9).first().loaded_rows == 9
    assert execution_summary(spark, processed_rows=10, seconds=1.5, error=None).first().asDict() == {"processed_rows": 10, "seconds": 1.5, "error": None}
    assert [r.row_count for r in audit.latest_profiles().collect()] == [90]
    assert [r.table_name for r in audit.latest_changes().collect()] == ["customers"]


def test_catalog_listing_and_text_projection(spark):
    spark.range(2).createOrReplaceTempView("zz_view")
    names = [r.table_name for r in catalog.list_tables(spark).collect()]
    assert "zz_view" in names
    t = catalog.as_text(spark.createDataFrame([(1, 2.5)], "a int, b double"), renames={"a": "id"})
    assert t.columns == ["id", "b"] and t.first().b == "2.5"
    assert [r.id for r in catalog.sample_rows(spark.range(100), 3, ["id"]).collect()] == [0, 1, 2]


def test_a_rewritten_table_shows_its_new_schema(spark, tmp):
    from dwspark.session import read_table

    spark.range(3).write.parquet(f"{tmp}/t.parquet")
    assert read_table(spark, tmp, "t").columns == ["id"]
    spark.range(3).selectExpr("id AS a", "id AS b").write.mode("overwrite").parquet(f"{tmp}/t.parquet")
    assert read_table(spark, tmp, "t").columns == ["a", "b"]

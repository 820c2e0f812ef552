"""The car-sales job end to end: one-pass split, failure at each step, resumption."""

import os

import pytest
from pyspark.sql import functions as F

from dwspark.operators import model, rejects, tree
from dwspark.plans import car_sales, jobs
from dwspark.sinks import tables as tables_module
from dwspark.sinks import versions


@pytest.fixture(scope="module")
def sources(spark, tables):
    return jobs.CarSalesSources(car_sales.sales_source(tables).withColumn("extra", F.lit(1)), car_sales.brands_reference(tables), car_sales.states_reference(tables))


def log(spark, base, batch):
    return [(r.step, r.status) for r in spark.read.parquet(f"{base}/log").where(F.col("batch_id") == batch).orderBy("etl_date").collect()]


def test_whole_job_counts_as_f4_and_keeps_rejected_rows(spark, sources, tmp):
    out = jobs.run_car_sales(spark, sources, tmp, "b1").first()
    plain = car_sales.transform(sources.sales, sources.brands, sources.states)
    f4 = plain.summary.first()
    assert (out.processed_rows, out.rule_rejected_rows, out.loaded_rows, out.duplicate_rows) == (
        f4.processed_rows, f4.rule_rejected_rows, f4.loaded_rows, f4.duplicate_rows)
    warehouse = versions.snapshot(spark, f"{tmp}/warehouse")
    assert warehouse.read(spark, "car_sales").exceptAll(plain.loaded).count() == 0
    assert warehouse.read(spark, "car_sales_rejected").exceptAll(plain.rejected).count() == 0
    assert out.predictions > 0 and out.r2 > 0.5 and out.staged_car_sales == out.processed_rows
    again = tree.load(spark, f"{tmp}/batch=b1/model")
    held = spark.read.parquet(f"{tmp}/batch=b1/predictions")
    scored = again.predict(held.drop("predicted"))
    assert scored.exceptAll(held.select(*scored.columns)).count() == 0
    steps = ["stage_car_sales", "stage_car_brand", "stage_us_state", "transform", "load_warehouse", "model"]
    assert log(spark, tmp, "b1") == [(s, x) for s in steps for x in ("STARTED", "SUCCESS")]
    assert "extra" not in spark.read.parquet(f"{tmp}/batch=b1/car_sales").columns  # common columns only


@pytest.mark.parametrize("step, module, name", [
    ("stage_car_brand", tables_module, "common_columns"), ("transform", rejects, "write_split"),
    ("load_warehouse", versions.Commit, "publish"), ("model", model, "train_exact")])
def test_a_failed_batch_goes_on_where_it_stopped(spark, sources, tmp, monkeypatch, step, module, name):
    full = model.train_exact
    shallow = lambda *a, **kw: full(*a, max_depth=2, **kw)  # noqa: E731  # the failure is the test, not the tree
    monkeypatch.setattr(model, "train_exact", shallow)
    real, calls = getattr(module, name), []

    def fails(*args, **kw):
        calls.append(1)
        if step != "stage_car_brand" or len(calls) == 2:
            raise RuntimeError("out of order")
        return real(*args, **kw)

    monkeypatch.setattr(module, name, fails)
    with pytest.raises(RuntimeError, match="out of order"):
        jobs.run_car_sales(spark, sources, tmp, "b1")
    monkeypatch.setattr(module, name, real)
    before = log(spark, tmp, "b1")
    assert before[-2:] == [(step, "STARTED"), (step, "FAILED")] and [s for s, x in before if x == "FAILED"] == [step]
    payload = spark.read.json(f"{tmp}/failed/layer=car_sales/job_name={step}/batch_id=b1").first()
    assert "out of order" in payload.error
    if step in ("transform", "load_warehouse"):
        assert versions.versions(spark, f"{tmp}/warehouse") == []  # nothing half loaded
    out = jobs.run_car_sales(spark, sources, tmp, "b1").first()
    assert out.status == "SUCCESS" and out.loaded_rows > 0
    after = log(spark, tmp, "b1")[len(before):]
    finished = [s for s, x in before if x == "SUCCESS"]
    assert not set(finished) & {s for s, _ in after} and after[0] == (step, "STARTED")
    assert versions.versions(spark, f"{tmp}/warehouse") == [1]


def test_split_reads_its_source_once(spark, tmp):
    spark.range(100).write.parquet(f"{tmp}/in")
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    src = spark.read.parquet(f"{tmp}/in").mapInArrow(count, "id long")
    rule = [("even", F.col("id") % 2 == 0), ("small", F.col("id") < 10)]
    got = rejects.write_split(rejects.tag(src, rule), rule, f"{tmp}/out")
    assert got == {"processed_rows": 100, "accepted_rows": 5, "rule_rejected_rows": 95, "even_count": 50, "small_count": 90}
    assert rows.value == 100
    assert rejects.read_accepted(spark, f"{tmp}/out").count() == 5 and rejects.read_rejected(spark, f"{tmp}/out").count() == 95
    empty = rejects.write_split(rejects.tag(src.where("id < 0"), rule), rule, f"{tmp}/none")
    assert empty["processed_rows"] == 0 and os.path.isdir(f"{tmp}/none")

import pytest
from pyspark.sql import functions as F

from dwspark.operators import model
from dwspark.plans import car_sales


def test_hash_split_is_stable_and_disjoint(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = model.hash_split(df, "k")
    train2, test2 = model.hash_split(df.repartition(7), "k")
    assert train.count() + test.count() == 2000 and train.join(test, "k").count() == 0
    assert test.exceptAll(test2).count() == 0 and 300 < test.count() < 500


def test_min_rows_guard(spark):
    with pytest.raises(ValueError):
        model.require_rows(spark.range(4))
    model.require_rows(spark.range(5))


def test_train_evaluate_score_and_save(spark, tables, tmp):
    res = car_sales.transform(car_sales.sales_source(tables), car_sales.brands_reference(tables), car_sales.states_reference(tables))
    data = res.loaded.withColumn("brand", F.col("brand_car_id").cast("string"))
    out = model.train_and_evaluate(data, "id_sales_nk", ["year", "condition", "odometer", "mmr"], ["transmission", "brand"], "selling_price")
    m = out.metrics.first()
    assert m.n > 0 and m.r2 > 0.5 and m.rmse > 0
    model.save_model(out.model, f"{tmp}/m")
    loaded = model.load_model(f"{tmp}/m")
    scored = model.score(loaded, data.limit(10), ["id_sales_nk"])
    assert scored.count() == 10 and scored.where(F.col("predicted").isNull()).count() == 0
    model.save_predictions(out.predictions, f"{tmp}/pred", "csv")
    assert spark.read.option("header", True).csv(f"{tmp}/pred").count() == out.predictions.count()


def test_unseen_category_is_all_zeros(spark):
    train = spark.createDataFrame([(float(i), "ab"[i % 2], 10.0 * (i % 2)) for i in range(40)], "x double, c string, y double")
    fitted = model.build_pipeline(["x"], ["c"], "y").fit(train)
    out = fitted.transform(spark.createDataFrame([(1.0, "zzz", 0.0), (1.0, "a", 0.0)], "x double, c string, y double")).collect()
    assert [list(r["c__ohe"].toArray()) for r in out] == [[0.0, 0.0], [1.0, 0.0]]


def test_holdout_beats_the_mean(spark, tables):
    data = car_sales.transform(car_sales.sales_source(tables), car_sales.brands_reference(tables), car_sales.states_reference(tables)).loaded
    from dwspark.plans.queries_model import CATEGORICAL, NUMERIC

    out = model.train_and_evaluate(data, "id_sales_nk", NUMERIC, CATEGORICAL, "selling_price")
    rows = out.predictions.select("actual", "predicted").collect()
    mean = sum(r.actual for r in rows) / len(rows)
    assert sum((r.actual - r.predicted) ** 2 for r in rows) < 0.5 * sum((r.actual - mean) ** 2 for r in rows)

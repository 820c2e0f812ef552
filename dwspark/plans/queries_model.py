"""Registered model queries.

The regression metrics of a formula prediction (A5), the prepared model frame (L1) and the train/test
split by MD5 (L2) have exact SQL oracles; the exact-split tree (L5, L6) is spelled in SQL level by level.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dwspark.operators import model, tree
from dwspark.operators.aggregate import regression_metrics
from dwspark.functions.clean import prepare_model_frame
from dwspark.plans import car_sales
from dwspark.plans.catalog import register
from dwspark.plans.queries_pipelines import CAR_LOADED_SQL

# The reference's features.
NUMERIC = ["year", "brand_car_id", "id_state", "condition", "odometer", "mmr"]
CATEGORICAL = ["transmission", "color", "interior"]


@register("a5_regression_metrics", """
SELECT round(1 - sum((a - p) * (a - p)) / (count(*) * var_pop(a)), 6) AS r2,
       round(sqrt(sum((a - p) * (a - p)) / count(*)), 6) AS rmse,
       round(avg(abs(a - p)), 6) AS mae, count(*) AS n
FROM (SELECT l.l_extendedprice AS a, l.l_quantity * p.p_retailprice AS p
      FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)
""")
def a5_regression_metrics(t):
    j = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_extendedprice").alias("a"), (F.col("l_quantity") * F.col("p_retailprice")).alias("p"))
    m = regression_metrics(j, "a", "p")
    return m.select(*[F.round(c, 6).alias(c) for c in ("r2", "rmse", "mae")], "n")


def _training_frame(t):
    return car_sales.transform(car_sales.sales_source(t), car_sales.brands_reference(t), car_sales.states_reference(t)).loaded


_BUCKET_SQL = "CAST('0x' || substr(md5(CAST(id_sales_nk AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 100"


_FRAME_SQL = """
SELECT id_sales_nk, CAST(year AS DOUBLE) AS year, CAST(brand_car_id AS DOUBLE) AS brand_car_id, CAST(id_state AS DOUBLE) AS id_state,
       condition, odometer, mmr, coalesce(transmission, 'unknown') AS transmission, coalesce(color, 'unknown') AS color,
       coalesce(interior, 'unknown') AS interior, selling_price
FROM loaded
"""
_TREE_SQL = f"""{CAR_LOADED_SQL},
frame AS MATERIALIZED ({_FRAME_SQL}),
train AS (SELECT * FROM frame WHERE {_BUCKET_SQL} >= 20),
test AS (SELECT * FROM frame WHERE {_BUCKET_SQL} < 20),
{tree.sql("train", "test", "id_sales_nk", NUMERIC, CATEGORICAL, "selling_price")}
"""


@register("l6_holdout_predictions", _TREE_SQL + f"""
SELECT id_sales_nk, {", ".join(NUMERIC + CATEGORICAL)}, selling_price AS actual, predicted FROM test JOIN predictions USING (id_sales_nk)
""", headline=True)
def l6_holdout_predictions(t):
    return model.train_exact(_training_frame(t), "id_sales_nk", NUMERIC, CATEGORICAL, "selling_price")[1]


@register("l5_model_metrics", _TREE_SQL + """
SELECT round(1 - sum((a - p) * (a - p)) / (count(*) * var_pop(a)), 6) AS r2, round(sqrt(sum((a - p) * (a - p)) / count(*)), 6) AS rmse,
       round(avg(abs(a - p)), 6) AS mae, count(*) AS n
FROM (SELECT selling_price AS a, predicted AS p FROM test JOIN predictions USING (id_sales_nk))
""")
def l5_model_metrics(t):
    _, predictions = model.train_exact(_training_frame(t), "id_sales_nk", NUMERIC, CATEGORICAL, "selling_price")
    m = regression_metrics(predictions, "actual", "predicted")
    return m.select(*[F.round(c, 6).alias(c) for c in ("r2", "rmse", "mae")], "n")


@register("l1_model_frame", CAR_LOADED_SQL + """
SELECT id_sales_nk, CAST(year AS DOUBLE) AS year, CAST(brand_car_id AS DOUBLE) AS brand_car_id, CAST(id_state AS DOUBLE) AS id_state,
       condition, odometer, mmr, coalesce(transmission, 'unknown') AS transmission, coalesce(color, 'unknown') AS color,
       coalesce(interior, 'unknown') AS interior, selling_price
FROM loaded
""")
def l1_model_frame(t):
    return prepare_model_frame(_training_frame(t), NUMERIC, CATEGORICAL, "selling_price", keep=["id_sales_nk"])


@register("l2_hash_split", CAR_LOADED_SQL + f"""
SELECT CASE WHEN {_BUCKET_SQL} >= 20 THEN 'train' ELSE 'test' END AS side, id_sales_nk FROM loaded
""")
def l2_hash_split(t):
    side = F.when(model.in_test("id_sales_nk"), "test").otherwise("train")
    return _training_frame(t).select(side.alias("side"), "id_sales_nk")

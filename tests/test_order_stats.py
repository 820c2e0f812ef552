import numpy as np
import pytest
from pyspark.sql import functions as F

from dwspark.operators import order_stats, profile


@pytest.mark.parametrize("seed", [1, 2])
def test_percentiles_equal_numpy(spark, seed):
    r = np.random.default_rng(seed)
    columns = {"normal": r.normal(size=3001), "hot": np.where(r.random(3000) < 0.4, 7.0, r.integers(0, 50, 3000)), "one": np.array([2.5]),
               "two": np.array([1.0, 4.0]), "equal": np.full(500, -3.0)}
    rows = [(k, float(x)) for k, v in columns.items() for x in v] + [("normal", None), ("hot", float("nan")), ("none", None)]
    long = spark.createDataFrame(rows, "k string, v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(x.k, x.prob): x.v for x in order_stats.percentiles(long, ["k"], "v", probs).collect()}
    assert set(got) == {(k, p) for k in columns for p in probs}
    for k, v in columns.items():
        assert np.allclose([got[k, p] for p in probs], np.percentile(v, [100 * p for p in probs]))


def test_no_percentile_state_and_every_rank(spark):
    long = spark.range(1000).select(F.lit("a").alias("k"), (F.col("id") % 100).alias("v"))
    counts = order_stats.value_counts(long, ["k"], "v")
    ranks = spark.range(0, 1000, 7).select(F.lit("a").alias("k"), F.col("id").alias("rank"))
    found = order_stats.values_at_ranks(counts, ["k"], "v", ranks)
    assert {r.rank: r.v for r in found.collect()} == {i: i // 10 for i in range(0, 1000, 7)}
    plan = profile.describe_tables({"t": (long, ["v"])})._jdf.queryExecution().toString().lower()
    assert "percentile" not in plan and "collect_" not in plan


def test_describe_edges(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, 1.0)], "x int, y double")
    out = {r.column_name: r for r in profile.numeric_describe(df, ["x", "y"]).collect()}
    assert (out["x"]["count"], out["x"].mean, out["x"].p50) == (0, None, None)
    assert (out["y"]["count"], out["y"].p25, out["y"].max) == (1, 1.0, 1.0)
    assert profile.numeric_describe(df.limit(0), ["y"]).first()["count"] == 0

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dwspark.operators import heavy_hitters


def top(values):
    counts = Counter(values)
    return min(((-n, v is not None, v or "") for v, n in counts.items()))


@pytest.mark.parametrize("k", [1, 3, 50])
def test_most_frequent_is_exact_for_any_summary_size(spark, k):
    r = random.Random(k)
    columns = {
        "hot": [r.choice(["a"] * 40 + [str(i) for i in range(60)]) for _ in range(900)],
        "flat": [str(i) for i in range(900)], "ties": [r.choice("xy") if i > 1 else "xy"[i] for i in range(898)] + ["x", "y"],
        "nulls": [None if i % 3 else str(i) for i in range(900)], "two": ["b", "a"] * 450, "late": [str(i % 300) if i < 880 else "zz" for i in range(900)],
    }
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).repartition(6)
    got = {x.column_name: (-x.top_count, x.top_value is not None, x.top_value or "") for x in heavy_hitters.most_frequent({"t": (df, list(columns))}, k).collect()}
    assert got == {c: top(v) for c, v in columns.items()}


def test_summary_rows_are_bounded_and_decide_hot_columns(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v")).repartition(4)
    rows = df.mapInArrow(heavy_hitters._summaries(16), "i int, value string, n long, taken boolean")
    assert rows.count() <= 4 * 17
    found = heavy_hitters.candidates({"t": (df, ["v"])}, 16).collect()
    assert [(r.value, r.sure) for r in found] == [("hot", True)]


def test_edges(spark):
    empty = spark.createDataFrame([], "v string")
    assert heavy_hitters.most_frequent({"t": (empty, ["v"]), "u": (spark.createDataFrame([(1,)], "n int"), ["n"])}).collect() == [("u", "n", "1", 1)]
    mixed = {"t": (spark.createDataFrame([(None,), (None,), ("a",)], "v string"), ["v"])}
    assert heavy_hitters.most_frequent(mixed).collect() == [("t", "v", None, 2)]

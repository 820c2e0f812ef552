import random

import pytest
from pyspark.sql import functions as F

from dwspark.operators import model, tree


def grown(rows, n_num, depth, least, node=1, level=0):
    """Plain recursive exact tree over rows (features..., y in cents): {node: (rows, total, split)}."""
    n, s = len(rows), sum(r[-1] for r in rows)
    best = None
    if level < depth and len({r[-1] for r in rows}) > 1:
        for f in range(len(rows[0]) - 1):
            values = sorted({r[f] for r in rows})
            cuts = [(a + b) / 2 for a, b in zip(values, values[1:])] if f < n_num else values
            for cut in cuts:
                left = [r for r in rows if (r[f] <= cut if f < n_num else r[f] != cut)]
                m, t = len(left), sum(r[-1] for r in left)
                if min(m, n - m) < least:
                    continue
                gain = float(t) * float(t) / m + float(s - t) * float(s - t) / (n - m)
                if best is None or gain > best[0]:
                    best = (gain, f, cut)
    out = {node: (n, s, best and best[1:])}
    if best:
        _, f, cut = best
        goes_left = lambda r: r[f] <= cut if f < n_num else r[f] != cut
        out |= grown([r for r in rows if goes_left(r)], n_num, depth, least, 2 * node, level + 1)
        out |= grown([r for r in rows if not goes_left(r)], n_num, depth, least, 2 * node + 1, level + 1)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_equals_recursive_exact_tree(spark, seed, tmp):
    r = random.Random(seed)
    rows = [(float(r.randint(0, 40)), r.choice([1.0, 2.5, 1e6]), r.choice("abc"), r.randint(0, 2000)) for _ in range(400)]
    df = spark.createDataFrame([(*x[:-1], x[-1] / 100) for x in rows], "n1 double, n2 double, c string, y double").repartition(3)
    got = tree.fit(df, ["n1", "n2"], ["c"], "y", max_depth=4)
    want = grown(rows, 2, 4, 5)
    assert {n[0]: (n[2], n[3], None if n[4] is None else (n[4], n[5] if n[5] is not None else n[6])) for n in got.nodes} == want
    out = got.predict(df)
    assert out.count() == 400 and out.columns == [*df.columns, "predicted"]
    got.save(spark, f"{tmp}/tree")
    again = tree.load(spark, f"{tmp}/tree")
    assert again == got
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(again.predict(df)) == key(out)


def test_tree_edges(spark):
    same = spark.createDataFrame([(1.0, "a", 5.0)] * 20, "x double, c string, y double")
    assert len(tree.fit(same, ["x"], ["c"], "y").nodes) == 1  # nothing to split
    assert tree.fit(same, ["x"], ["c"], "y").predict(same).first().predicted == 5.0
    assert tree.fit(same.limit(0), ["x"], [], "y").nodes == ()
    few = spark.createDataFrame([(float(i), None, float(i)) for i in range(9)], "x double, c string, y double")
    assert len(tree.fit(few, ["x"], ["c"], "y").nodes) == 1  # both sides need five rows
    ten = few.unionByName(few.limit(1))
    fitted = tree.fit(ten, ["x"], ["c"], "y")
    odd = spark.createDataFrame([(None, "new"), (0.0, None)], "x double, c string")
    assert [r.predicted for r in fitted.predict(odd).orderBy("x").collect()] == [max(n[3] / n[2] / 100 for n in fitted.nodes[1:]), min(n[3] / n[2] / 100 for n in fitted.nodes[1:])]
    with pytest.raises(ValueError):
        tree.fit(ten, ["x"], [], "y", max_depth=17)


def test_training_leaves_nothing_behind_and_guards_rows(spark, tmp):
    import os

    from dwspark.session import scratch_path

    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 7).alias("x"), F.lit("a").alias("c"), (F.col("id") % 7 * 2).alias("y"))
    _, predictions = model.train_exact(df, "k", ["x"], ["c"], "y")
    assert predictions.where("abs(actual - predicted) > 1e-9").count() == 0
    folder = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    assert not [n for n in (os.listdir(folder) if os.path.isdir(folder) else []) if n.startswith("tree")]
    with pytest.raises(ValueError):
        model.train_exact(df.limit(3), "k", ["x"], ["c"], "y")

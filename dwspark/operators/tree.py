"""Exact-split regression tree, grown level by level with aggregations.

Every level is one job over the prepared training rows: rows find their node through the splits made so far (a
broadcast table of at most ``2 ** depth`` rows), are counted and summed per (node, feature, value), and running totals over a feature's
values give both sides of every possible split, halfway between neighbouring values as in an exact (not
binned) tree. A category is a 0/1 feature, so its split is the category against the rest and needs no order. The best
split of a node is the one of least squared error; equal ones go to the first feature (numeric ones as given, then
categories by column and value) and then to the lowest threshold, so that the same rows always give the same tree.

The target is summed as whole units of ``10 ** -decimals``: sums are exact whatever the order of rows or tasks, and an
overflow is an error. Running totals are taken in two steps (inside a bucket of neighbouring values, over the
buckets of a feature), so no task holds a feature's distinct values. The driver holds the nodes only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dwspark.operators.aggregate import union_all
from dwspark.session import scratch_path
from dwspark.sinks.tables import remove

BUCKETS = 1024  # of a numeric feature's range
MAX_DEPTH = 16  # a deeper tree would be too large a table to broadcast and hold
NODES = "node long, depth int, rows long, total long, feature int, threshold double, category string"


@dataclass(frozen=True)
class Tree:
    """``nodes``: node (root 1, children 2k and 2k + 1), depth, rows, total (target units) and the split, if it has one:
    feature (index), and threshold (rows up to it go to 2k) or category (rows of it go to 2k + 1)."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    decimals: int
    nodes: tuple[tuple, ...]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.nodes), NODES)

    def predict(self, df: DataFrame, name: str = "predicted") -> DataFrame:
        """``df`` with the mean of the leaf that each row falls into. An unseen category takes the way of the
        rest; a missing number takes the way of the higher values."""
        placed = _placed(df, self, max((n[1] for n in self.nodes), default=0) + 1)
        leaves = self.table(df.sparkSession).select(
            F.col("node").alias("_node"), (F.col("total").cast("double") / F.col("rows").cast("double") / 10.0 ** self.decimals).alias(name))
        return placed.join(F.broadcast(leaves), "_node").select(*df.columns, name)

    def save(self, spark: SparkSession, path: str) -> None:
        """K9: the nodes with the features' names, as one small table."""
        names = F.array(*[F.lit(c) for c in self.numeric + self.categorical])
        self.table(spark).select("*", names.alias("features"), F.lit(len(self.numeric)).alias("numeric"), F.lit(self.decimals).alias("decimals")).coalesce(
            1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Tree:
    rows = spark.read.parquet(path).orderBy("node").collect()  # at most 2 ** (MAX_DEPTH + 1) nodes
    names, numeric, decimals = rows[0]["features"], rows[0]["numeric"], rows[0]["decimals"]
    return Tree(tuple(names[:numeric]), tuple(names[numeric:]), decimals, tuple(tuple(r)[:7] for r in rows))


def _pick(columns: Sequence[str], index: Column, offset: int = 0) -> Column:
    value = F.lit(None)
    for i, c in enumerate(columns):
        value = F.when(index == i + offset, F.col(f"`{c}`")).otherwise(value)
    return value


def _placed(df: DataFrame, tree: Tree, levels: int) -> DataFrame:
    """``df`` with ``_node``, where each row is after ``levels`` splits."""
    out = df.withColumn("_node", F.lit(1).cast("long"))
    splits = tree.table(df.sparkSession).where("feature IS NOT NULL").select("node", "depth", "feature", "threshold", "category")
    first = len(tree.numeric)
    for level in range(levels):
        here = [n for n in tree.nodes if n[1] == level and n[4] is not None]
        if not here:
            break
        made = splits.where(F.col("depth") == level).select(
            F.col("node").alias("_node"), F.col("feature").alias("_f"), F.col("threshold").alias("_t"), F.col("category").alias("_c"))
        out = out.join(F.broadcast(made), "_node", "left")  # at most 2 ** level rows
        low = F.coalesce(_pick(tree.numeric, F.col("_f")).cast("double") <= F.col("_t"), F.lit(False))
        member = F.coalesce(_pick(tree.categorical, F.col("_f"), first).cast("string") == F.col("_c"), F.lit(False))
        right = F.when(F.col("_f") < first, ~low).otherwise(member)
        out = out.withColumn("_node", F.when(F.col("_f").isNull(), F.col("_node")).otherwise(F.col("_node") * 2 + right.cast("long"))).drop("_f", "_t", "_c")
    return out


def _gain(n: Column, s: Column, all_n: Column, all_s: Column) -> Column:
    """What a split keeps of the squared sums: the higher, the less squared error it leaves."""
    part = lambda s, n: s.cast("double") * s.cast("double") / n.cast("double")
    return part(s, n) + part(all_s - s, all_n - n)


def _candidates(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """node, feature, threshold, category, and rows ``n`` and total ``s`` of the side up to the threshold (of the
    others, for a category)."""
    sums = [F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s")]
    found = []
    if numeric:
        def entry(i: int, c: str) -> Column:
            low, high = bounds[c]
            at = F.floor((F.col(f"`{c}`") - low) / (high - low) * BUCKETS) if high > low else F.lit(0)
            return F.struct(F.lit(i).alias("feature"), at.cast("int").alias("bucket"), F.col(f"`{c}`").alias("value"))

        values = rows.select("_node", "_y", F.inline(F.array(*[entry(i, c) for i, c in enumerate(numeric)]))).groupBy(
            "_node", "feature", "bucket", "value").agg(*sums)
        inside = Window.partitionBy("_node", "feature", "bucket").orderBy("value")
        over = Window.partitionBy("_node", "feature").orderBy("bucket")
        before = over.rowsBetween(Window.unboundedPreceding, -1)
        buckets = values.groupBy("_node", "feature", "bucket").agg(F.sum("n").alias("_n"), F.sum("s").alias("_s"), F.min("value").alias("_low"))
        buckets = buckets.select(
            "_node", "feature", "bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
            F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s"), F.lead("_low").over(over).alias("_next"))
        upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        values = values.withColumns({"n": F.sum("n").over(upto), "s": F.sum("s").over(upto), "_lead": F.lead("value").over(inside)})
        following = F.coalesce("_lead", "_next")
        found.append(values.join(buckets, ["_node", "feature", "bucket"]).where(following.isNotNull()).select(
            "_node", "feature", ((F.col("value") + following) / 2).alias("threshold"), F.lit(None).cast("string").alias("category"),
            (F.col("n") + F.col("_n")).alias("n"), (F.col("s") + F.col("_s")).alias("s")))
    if categorical:
        pairs = [F.struct(F.lit(len(numeric) + i).alias("feature"), F.col(f"`{c}`").cast("string").alias("category")) for i, c in enumerate(categorical)]
        members = rows.select("_node", "_y", F.inline(F.array(*pairs))).where("category IS NOT NULL").groupBy("_node", "feature", "category").agg(*sums)
        totals = rows.groupBy("_node").agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_s"))
        found.append(members.join(totals, "_node").select(
            "_node", "feature", F.lit(None).cast("double").alias("threshold"), "category", (F.col("_n") - F.col("n")).alias("n"), (F.col("_s") - F.col("s")).alias("s")))
    return union_all(found)


def fit(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, max_depth: int = 8, min_rows_per_leaf: int = 5,
        decimals: int = 2) -> Tree:
    """Grow a tree on ``df`` (no nulls in numeric features or target, see P19)."""
    if max_depth > MAX_DEPTH:
        raise ValueError(f"a tree of depth {max_depth} is beyond {MAX_DEPTH}")
    spark, folder = df.sparkSession, scratch_path(df.sparkSession, "tree")
    numeric, categorical = tuple(numeric), tuple(categorical)
    y = F.round(F.col(target) * 10 ** decimals).cast("long").alias("_y")
    df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in numeric], *[F.col(f"`{c}`").cast("string").alias(c) for c in categorical], y).write.parquet(folder)
    try:
        rows = spark.read.parquet(folder)
        ends = rows.agg(*[f(f"`{c}`") for c in numeric for f in (F.min, F.max)], F.count(F.lit(1))).first()
        bounds = {c: (ends[2 * i], ends[2 * i + 1]) for i, c in enumerate(numeric)}
        tree = Tree(numeric, categorical, decimals, ())
        if not ends[-1]:
            return tree
        for level in range(max_depth + 1):
            tree = _grown(rows, tree, level, level < max_depth, min_rows_per_leaf, bounds)
            if not any(n[1] == level and n[4] is not None for n in tree.nodes):
                break
        return tree
    finally:
        remove(spark, folder)


def _grown(rows: DataFrame, tree: Tree, level: int, may_split: bool, least: int, bounds: dict) -> Tree:
    """The tree with the nodes of one more level."""
    placed = _placed(rows, tree, level).where(F.col("_node") >= 2 ** level)
    totals = placed.groupBy("_node").agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_s"), (F.min("_y") < F.max("_y")).alias("_mixed"))
    if not may_split:
        made = [(r["_node"], level, r["_n"], r["_s"], None, None, None) for r in totals.collect()]  # at most 2 ** level nodes
        return Tree(tree.numeric, tree.categorical, tree.decimals, tree.nodes + tuple(sorted(made)))
    options = _candidates(placed, tree.numeric, tree.categorical, bounds).join(totals.where("_mixed"), "_node")
    options = options.where((F.col("n") >= least) & (F.col("_n") - F.col("n") >= least))
    rank = F.struct(-_gain(F.col("n"), F.col("s"), F.col("_n"), F.col("_s")), "feature", F.col("threshold"), F.col("category"))
    best = options.groupBy("_node").agg(F.min_by(F.struct("feature", "threshold", "category"), rank).alias("_split"))
    found = totals.join(best, "_node", "left").select("_node", "_n", "_s", "_split.*").collect()  # at most 2 ** level nodes
    made = [(r["_node"], level, r["_n"], r["_s"], r["feature"], r["threshold"], r["category"]) for r in found]
    return Tree(tree.numeric, tree.categorical, tree.decimals, tree.nodes + tuple(sorted(made, key=lambda m: m[0])))


def sql(train: str, rows: str, key: str, numeric: Sequence[str], categorical: Sequence[str], target: str, max_depth: int = 8,
        min_rows_per_leaf: int = 5, decimals: int = 2) -> str:
    """CTEs (without ``WITH``) that end in ``predictions`` (key, predicted), one level after the other. ``train`` and ``rows``
    name tables with the key, the features and the target."""
    columns = ", ".join([key, *numeric, *categorical])
    unit = f"CAST(round({target} * {10 ** decimals}) AS BIGINT)"
    parts = [f"t0 AS MATERIALIZED (SELECT {columns}, {unit} AS y, 1::BIGINT AS node FROM {train})",
             f"q0 AS MATERIALIZED (SELECT {columns}, 1::BIGINT AS node FROM {rows})"]
    right = "CASE " + " ".join(
        [f"WHEN b.feature = {i} THEN r.{c} > b.threshold" for i, c in enumerate(numeric)]
        + [f"WHEN b.feature = {len(numeric) + i} THEN r.{c} = b.category" for i, c in enumerate(categorical)]) + " END"
    gain = "s::DOUBLE * s::DOUBLE / n::DOUBLE + (all_s - s)::DOUBLE * (all_s - s)::DOUBLE / (all_n - n)::DOUBLE"
    for d in range(max_depth):
        numbers = " UNION ALL ".join(f"SELECT node, {i} AS feature, {c} AS value, y FROM t{d} WHERE node >= {2 ** d}" for i, c in enumerate(numeric))
        words = " UNION ALL ".join(
            f"SELECT node, {len(numeric) + i} AS feature, {c} AS category, y FROM t{d} WHERE node >= {2 ** d}" for i, c in enumerate(categorical))
        parts += [
            f"a{d} AS (SELECT node, count(*) AS all_n, sum(y)::BIGINT AS all_s FROM t{d} WHERE node >= {2 ** d} GROUP BY node HAVING min(y) < max(y))",
            f"h{d} AS (SELECT node, feature, value, count(*) AS n, sum(y)::BIGINT AS s FROM ({numbers}) GROUP BY ALL)",
            f"""p{d} AS (SELECT node, feature, (value + lead(value) OVER w) / 2 AS threshold, NULL::VARCHAR AS category,
                (sum(n) OVER w)::BIGINT AS n, (sum(s) OVER w)::BIGINT AS s FROM h{d} WINDOW w AS (PARTITION BY node, feature ORDER BY value)
                UNION ALL SELECT c.node, feature, NULL, category, all_n - count(*), all_s - sum(y)::BIGINT FROM ({words}) c JOIN a{d} a ON a.node = c.node
                GROUP BY c.node, feature, category, all_n, all_s)""",
            f"""b{d} AS MATERIALIZED (SELECT p.node, feature, threshold, category FROM p{d} p JOIN a{d} a ON a.node = p.node
                WHERE (threshold IS NOT NULL OR category IS NOT NULL) AND n >= {min_rows_per_leaf} AND all_n - n >= {min_rows_per_leaf}
                QUALIFY row_number() OVER (PARTITION BY p.node ORDER BY {gain} DESC, feature, threshold, category) = 1)""",
        ]
        for x in "tq":
            parts.append(f"{x}{d + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node ELSE 2 * r.node + "
                         f"CASE WHEN {right} THEN 1 ELSE 0 END END AS node FROM {x}{d} r LEFT JOIN b{d} b ON b.node = r.node)")
    parts += [f"leaves AS (SELECT node, sum(y)::BIGINT::DOUBLE / count(*)::DOUBLE / {10.0 ** decimals} AS predicted FROM t{max_depth} GROUP BY node)",
              f"predictions AS (SELECT q.{key}, l.predicted FROM q{max_depth} q JOIN leaves l ON l.node = q.node)"]
    return ",\n".join(parts)

"""The most frequent value of each column, exactly, from bounded summaries (Q12).

Each task keeps a Misra–Gries summary per column: at most ``k`` values with counters; when it overflows, the (k + 1)-th largest counter is
taken from all and the emptied ones go. A value's true count is at least its counters' sum over the tasks and
at most that sum plus what all tasks took away. So only values whose upper limit reaches the best lower limit can be
the most frequent. Where these are at most ``k``, a second scan counts just them (no shuffle but their partial
counts). Where the summary decides nothing (flat columns: too many values could win, or one outside all summaries),
the column is counted in full, the other columns are not. Null counts as a value; equal counts go to the smallest value, nulls first.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwspark.operators.aggregate import union_all

KEYS = ["table_name", "column_name"]
K = 256


def _summaries(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        taken: list[int] = []
        for batch in batches:
            if not held:
                held, taken = [{} for _ in batch.columns], [0] * batch.num_columns
            for i, column in enumerate(batch.columns):
                counters = held[i]
                for pair in pc.value_counts(column):
                    value, n = pair["values"].as_py(), pair["counts"].as_py()
                    counters[value] = counters.get(value, 0) + n
                if len(counters) > k:
                    cut = sorted(counters.values(), reverse=True)[k]
                    taken[i] += cut
                    held[i] = {v: n - cut for v, n in counters.items() if n > cut}
        rows = [(i, v, n, False) for i, counters in enumerate(held) for v, n in counters.items()] + [(i, None, n, True) for i, n in enumerate(taken)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.int64(), pa.bool_()))], names=["i", "value", "n", "taken"])

    return run


def _pairs(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """table_name, column_name, value of every cell."""
    return union_all(
        df.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias(KEYS[0]), F.lit(c).alias(KEYS[1]), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])))
        for name, (df, columns) in tables.items() if columns)


def candidates(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], k: int = K) -> DataFrame:
    """table_name, column_name, value, ``sure``: at most ``k`` values of which one is the most frequent, or one row
    that is not ``sure`` for a column that its summaries do not decide."""
    found = []
    for name, (df, columns) in tables.items():
        if columns:
            text = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
            names = F.array(*[F.lit(c) for c in columns])
            found.append(text.mapInArrow(_summaries(k), "i int, value string, n long, taken boolean").select(
                F.lit(name).alias(KEYS[0]), F.element_at(names, F.col("i") + 1).alias(KEYS[1]), "value", "n", "taken"))
    merged = union_all(found).groupBy(*KEYS, "taken", "value").agg(F.sum("n").alias("n"))
    all_of = Window.partitionBy(*KEYS)
    merged = merged.withColumns({"_error": F.coalesce(F.max(F.when(F.col("taken"), F.col("n"))).over(all_of), F.lit(0)),
                                 "_best": F.max(F.when(~F.col("taken"), F.col("n"))).over(all_of)})
    possible = ~F.col("taken") & (F.col("n") + F.col("_error") >= F.col("_best"))
    merged = merged.withColumn("_possible", F.coalesce(possible, F.lit(False)))
    decided = (F.col("_best") > F.col("_error")) & (F.count_if("_possible").over(all_of) <= k)
    merged = merged.withColumn("sure", F.coalesce(decided, F.lit(False)))
    return merged.where(F.when(F.col("sure"), F.col("_possible")).otherwise(F.col("taken"))).select(*KEYS, "value", "sure")


def most_frequent(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], k: int = K) -> DataFrame:
    """``(table_name, column_name, top_value, top_count)`` for the given columns of each table, values as text. A
    column of an empty table has no row."""
    wanted, pairs = candidates(tables, k), _pairs(tables)
    sure = wanted.where("sure").select(*KEYS, F.col("value").alias("_value"))
    # At most k values a column, and one row a column: broadcast. Null matches null.
    counted = pairs.join(F.broadcast(sure), (pairs[KEYS[0]] == sure[KEYS[0]]) & (pairs[KEYS[1]] == sure[KEYS[1]]) & pairs["value"].eqNullSafe(sure["_value"]),
                         "left_semi")
    unsure = wanted.where("NOT sure").select(*KEYS)
    others = pairs.join(F.broadcast(unsure), KEYS, "left_semi")
    counts = counted.unionByName(others).groupBy(*KEYS, "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*KEYS).agg(F.min(F.struct((-F.col("n")).alias("k"), "value")).alias("_top")).select(
        *KEYS, F.col("_top.value").alias("top_value"), (-F.col("_top.k")).alias("top_count"))

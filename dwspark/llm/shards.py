"""Hilbert-curve ordering: documents close in several metadata dimensions land in the same shard.

Each dimension is mapped to a number that keeps its order, quantised into ``2 ** bits`` equal cells
between its exact minimum and maximum, and the cells give the document's index on a Hilbert curve. The
documents are sorted by (index, doc_id, ...) and the sorted run is cut into shards whose row counts are
at most one apart, so a file's minima and maxima are narrow in every dimension at once.

Only narrow metadata rows are shuffled, never texts. Defined results: a null value takes the lowest
cell; a null or empty text has size 1; equal rows get neighbouring slots; an empty table gives an empty
result; other columns are ignored by :func:`assign` and kept by :func:`keep_in_shards`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwspark.llm.tables import save

N_SHARDS = 16
BITS = 5


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of ``cells`` (rows x dimensions, values below ``2 ** bits``), by
    Skilling's transposition (AIP Conf. Proc. 707, 2004), for all rows at once."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):  # undo the rotations and reflections of each level
        low = (1 << level) - 1
        for d in range(n):
            flip = (x[d] >> level) & 1 == 1
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[d] ^= swap
    for d in range(1, n):
        x[d] ^= x[d - 1]
    carry = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        carry ^= np.where((x[n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= carry
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(n):
            index = (index << 1) | ((x[d] >> level) & 1)
    return index


def text_number(c: Column) -> Column:
    """The first seven UTF-8 bytes as a number: keeps the order of texts as far as these bytes go."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("double")


def with_curve_index(rows: DataFrame, dims: Sequence[Column], bits: int = BITS, name: str = "curve") -> DataFrame:
    """``rows`` with the Hilbert index of the numeric ``dims``; one aggregate finds their bounds."""
    names = [f"_d{i}" for i in range(len(dims))]
    table = rows.select(*rows.columns, *[d.cast("double").alias(n) for d, n in zip(dims, names)])
    bounds = table.agg(*[F.min(n).alias(f"{n}lo") for n in names], *[F.max(n).alias(f"{n}hi") for n in names]).first()

    def cell(n: str) -> Column:
        lo, hi = bounds[f"{n}lo"], bounds[f"{n}hi"]
        if lo is None or lo == hi:
            return F.lit(0)
        scaled = F.floor((F.col(n) - lo) / (hi - lo) * (1 << bits))
        return F.coalesce(F.least(scaled, F.lit((1 << bits) - 1)), F.lit(0)).cast("int")

    @F.pandas_udf("long")
    def index(*cells: pd.Series) -> pd.Series:
        return pd.Series(curve_index(np.column_stack(cells), bits))

    return table.withColumn(name, index(*[cell(n) for n in names])).drop(*names)


def _metadata(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), *more)


def _dims() -> list[Column]:
    return [text_number(F.col("source")), text_number(F.col("lang")), F.log2("size"), F.col("doc_id")]


def _placed(rows: DataFrame, n_shards: int) -> DataFrame:
    """``rows`` with shard and slot. A range sort fixes each row's partition and position, the written
    table keeps them, and the partitions' row counts, one row each, give the places before them."""
    order = ["curve", "doc_id", "size", "text_crc32"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    table = save(ranged, "sorted").withColumns({"_pid": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sizes = table.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    total = table.count()
    placed = table.join(F.broadcast(offsets), "_pid").withColumn("_place", F.col("_before") + F.col("_at"))
    placed = placed.withColumn("shard", F.expr(f"cast((_place * {n_shards}) div {max(total, 1)} as int)"))
    first = F.expr(f"(cast(shard as bigint) * {total} + {n_shards - 1}) div {n_shards}")
    return placed.withColumn("slot", F.col("_place") - first).drop("_pid", "_at", "_n", "_before", "_place")


def assign(docs: DataFrame, n_shards: int = N_SHARDS, bits: int = BITS) -> DataFrame:
    """doc_id, source, lang, size, text_crc32, curve, shard and slot of every row."""
    return _placed(with_curve_index(save(_metadata(docs), "metadata"), _dims(), bits), n_shards)


def keep_in_shards(docs: DataFrame, n_shards: int = N_SHARDS, bits: int = BITS) -> DataFrame:
    """The input rows (all columns) with ``_shard`` and ``_slot``, sorted by them in each file of the
    table that holds them."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    placed = _placed(with_curve_index(_metadata(docs, row), _dims(), bits), n_shards)
    return placed.select("_row.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, bits: int = BITS) -> None:
    """Write the documents in curve order, one folder a shard."""
    keep_in_shards(docs, n_shards, bits).write.partitionBy("_shard").parquet(path)


def query(docs: DataFrame) -> DataFrame:
    return assign(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source", "lang", "curve")

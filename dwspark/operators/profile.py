"""Table profiling.

Each function does one pass per table where it can: every per-column metric of a table is an
expression of a single ``agg``, and the one-row result is turned into long form
(``table_name, column_name, ...``) with ``inline`` — the shape the reference's reports use.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.functions.clean import BLANK_LIKE_TOKENS
from dwspark.operators import order_stats
from dwspark.operators.aggregate import union_all

Tables = Mapping[str, DataFrame]


def _long(row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Explode a one-row frame into one row per struct in ``entries``."""
    return row.select(F.inline(F.array(*entries)))


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


# Q1 ----------------------------------------------------------------------------------------------
def table_shapes(tables: Tables) -> DataFrame:
    """``(table_name, row_count, column_count)`` for every table (one count per table, unioned)."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    )


# Q25 ---------------------------------------------------------------------------------------------
def row_counts(tables: Tables) -> DataFrame:
    """``(table_name, row_count)`` for every table, ordered by name."""
    return table_shapes(tables).select("table_name", "row_count").orderBy("table_name")


# Q2 / S8 -----------------------------------------------------------------------------------------
def column_types(spark: SparkSession, tables: Tables) -> DataFrame:
    """``(table_name, position, column_name, data_type, nullable)`` from the schemas (metadata only,
    no data is read)."""
    rows = [
        (name, i + 1, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    schema = "table_name string, position int, column_name string, data_type string, nullable boolean"
    return spark.createDataFrame(rows, schema)


# Q3 ----------------------------------------------------------------------------------------------
def unique_values(
    tables: Tables, config: Mapping[str, Sequence[str]], aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Distinct trimmed non-blank values of the configured columns, as
    ``(table_name, column_name, value, status)``. A configured table that does not exist (even
    through ``aliases``) gives one ``status='warning'`` row; a missing column gives no values."""
    aliases = aliases or {}
    parts = []
    spark = next(iter(tables.values())).sparkSession
    warn_rows = []
    for requested, columns in config.items():
        name = requested if requested in tables else aliases.get(requested)
        if name not in tables:
            warn_rows.append((requested, None, f"Table '{requested}' not found in source database.", "warning"))
            continue
        df = tables[name]
        present = [c for c in columns if c in df.columns]
        if not present:
            continue
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.trim(F.col(c).cast("string")).alias("value")) for c in present])
        vals = df.select(F.inline(pairs)).where(F.col("value").isNotNull() & (F.col("value") != ""))
        parts.append(vals.distinct().select(F.lit(name).alias("table_name"), "column_name", "value", F.lit("ok").alias("status")))
    if warn_rows:
        parts.append(spark.createDataFrame(warn_rows, "table_name string, column_name string, value string, status string"))
    return union_all(parts).orderBy("table_name", "column_name", "value")


# Q5 / Q6 / Q21 -----------------------------------------------------------------------------------
def column_counts(df: DataFrame, table_name: str) -> DataFrame:
    """Null and blank-like counts of every column in one pass:
    ``(table_name, column_name, missing_count, blank_like_count)``. Blank-like means trimmed
    lower-case text in ``"" na n/a null none nan``; non-text columns have 0."""
    aggs, longest = [], max(map(len, BLANK_LIKE_TOKENS))
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count_if(c.isNull()).alias(f"_m{i}"))
        if _is_text(f.dataType):
            # Only a text that is short once trimmed can be one of the tokens: long ones are not lower-cased.
            short = F.when(F.length(F.trim(c)) <= longest, F.lower(F.trim(c)))
            aggs.append(F.count_if(short.isin(*BLANK_LIKE_TOKENS)).alias(f"_b{i}"))
    row = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.col(f"_m{i}").alias("missing_count"),
            (F.col(f"_b{i}") if _is_text(f.dataType) else F.lit(0).cast("long")).alias("blank_like_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return _long(row, entries)


def missing_report(tables: Tables) -> DataFrame:
    """Q5/Q6 for all tables, sorted by (table, missing count desc, column) as the reference's
    long-form frames are."""
    out = union_all(column_counts(df, name) for name, df in tables.items())
    return out.orderBy("table_name", F.desc("missing_count"), "column_name")


# Q7 / Q8 / Q9 ------------------------------------------------------------------------------------
def profile(df: DataFrame, dataset_name: str, key_columns: Sequence[str] = (), stage: str = "source") -> DataFrame:
    """One row: ``stage, dataset_name, row_count, column_count, null_count, duplicate_key_count,
    duplicate_rows, null_by_column`` where a value counts as null when it is null or its text is
    blank after trimming.

    Two aggregations, combined by a union and a final one-row aggregate (no join):
    * every per-column count is one global aggregation — partial per task, no shuffle of rows;
    * duplicates come from ``groupBy(keys).count()`` over the key columns only (Parquet reads just
      those), partially aggregated so a key holding a third of the rows is one row per task;
      ``duplicate_key_count`` counts keys with more than one row (null keys form a group) and
      ``duplicate_rows`` the rows beyond the first of each such key."""
    cols = df.columns
    # The text of a non-null number, date, timestamp, boolean or nested value is never blank, so
    # only string and binary columns pay for a cast and a trim.
    def missing(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType, T.CharType, T.VarcharType)):
            return c.isNull() | (F.trim(c.cast("string")) == "")
        return c.isNull()

    blank = [F.count_if(missing(f)).cast("long").alias(f"_n{i}") for i, f in enumerate(df.schema.fields)]
    none = F.lit(None).cast("long")
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), *blank).select(
        "*", none.alias("duplicate_key_count"), none.alias("duplicate_rows"))
    if key_columns:
        per_key = df.groupBy(*key_columns).agg(F.count(F.lit(1)).alias("_rows"))
        dups = per_key.agg(
            F.count_if(F.col("_rows") > 1).alias("duplicate_key_count"),
            F.coalesce(F.sum(F.when(F.col("_rows") > 1, F.col("_rows") - 1)), F.lit(0)).cast("long").alias("duplicate_rows"),
        ).select(none.alias("row_count"), *[none.alias(f"_n{i}") for i in range(len(cols))], "duplicate_key_count", "duplicate_rows")
        counts = counts.unionByName(dups)
    row = counts.agg(*[F.max(c).alias(c) for c in counts.columns])
    nulls = [F.coalesce(F.col(f"_n{i}"), F.lit(0)).cast("long") for i in range(len(cols))]
    total = nulls[0] if nulls else F.lit(0)
    for n in nulls[1:]:
        total = total + n
    return row.select(
        F.lit(stage).alias("stage"),
        F.lit(dataset_name).alias("dataset_name"),
        F.coalesce(F.col("row_count"), F.lit(0)).cast("long").alias("row_count"),
        F.lit(len(cols)).alias("column_count"),
        total.cast("long").alias("null_count"),
        F.coalesce(F.col("duplicate_key_count"), F.lit(0)).cast("long").alias("duplicate_key_count"),
        F.coalesce(F.col("duplicate_rows"), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*nulls)).alias("null_by_column"),
    )


def profile_many(datasets: Sequence[tuple[str, DataFrame, Sequence[str]]], stage: str) -> DataFrame:
    """Q7 over ``[(name, frame, keys)]`` in the given order."""
    return union_all(profile(df, name, keys, stage) for name, df, keys in datasets)


def duplicate_keys(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """Q8/Q9 alone: ``(duplicate_groups, duplicate_rows)`` — groups of the key with more than one
    row, and the rows beyond the first in those groups."""
    g = df.groupBy(*key_columns).agg(F.count(F.lit(1)).alias("_rows"))
    return g.agg(
        F.count_if(F.col("_rows") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(F.col("_rows") > 1, F.col("_rows") - 1)), F.lit(0)).cast("long").alias("duplicate_rows"),
    )


# Q10 ---------------------------------------------------------------------------------------------
def column_stats(df: DataFrame, table_name: str, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """``(table_name, column_name, missing_count, missing_pct, distinct_count)`` per column.
    ``missing_pct`` is rounded to 2 places; the distinct count ignores nulls.

    Exact counts take one branch a column, each a scan of that column alone whose values are made
    distinct on the map side first (one aggregation of all columns would copy every row once per
    column). ``exact=False`` counts all columns in one pass without a shuffle (HyperLogLog++)."""
    columns = list(columns or df.columns)
    rows, missing = F.count(F.lit(1)), lambda c: F.count_if(F.col(f"`{c}`").isNull())

    def entry(c: str, rows: Column, missing: Column, distinct: Column) -> Column:
        return F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(c).alias("column_name"),
            missing.alias("missing_count"),
            F.round(F.try_divide(missing * 100.0, rows), 2).alias("missing_pct"),
            distinct.cast("long").alias("distinct_count"),
        )

    if exact:
        return union_all(
            df.groupBy(F.col(f"`{c}`").alias("_v")).agg(rows.alias("_n")).agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
                F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_n"))), F.lit(0)).alias("_m"), F.count("_v").alias("_d"),
            ).select(F.inline(F.array(entry(c, F.col("_rows"), F.col("_m"), F.col("_d")))))
            for c in columns)
    aggs = [rows.alias("_rows")]
    for i, c in enumerate(columns):
        aggs += [missing(c).alias(f"_m{i}"), F.approx_count_distinct(F.col(f"`{c}`")).alias(f"_d{i}")]
    return _long(df.agg(*aggs), [entry(c, F.col("_rows"), F.col(f"_m{i}"), F.col(f"_d{i}")) for i, c in enumerate(columns)])


# Q11 ---------------------------------------------------------------------------------------------
def describe_tables(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``(table_name, column_name, count, mean, std, min, p25, p50, p75, max)`` of the given numeric columns of
    each table, rounded to 2 places; null and NaN are missing. Percentiles are exact and interpolate linearly
    between order statistics (as pandas does), found by :mod:`order_stats`: no state grows with a column."""
    keys = ["table_name", "column_name"]
    long = union_all(
        df.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias(keys[0]), F.lit(c).alias(keys[1]), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])))
        for name, (df, columns) in tables.items() if columns)
    present = F.when(~F.isnan("value"), F.col("value"))
    stats = long.groupBy(*keys).agg(
        F.count(present).alias("count"), F.round(F.avg(present), 2).alias("mean"), F.round(F.stddev_samp(present), 2).alias("std"),
        F.round(F.min(present), 2).alias("min"), F.round(F.max(present), 2).alias("max"))
    at = order_stats.percentiles(long, keys, "value", [0.25, 0.5, 0.75])
    cuts = at.groupBy(*keys).agg(*[F.round(F.max(F.when(F.col("prob") == p, F.col("value"))), 2).alias(name)
                                   for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return stats.join(cuts, keys, "left").select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def numeric_describe(df: DataFrame, columns: Sequence[str], exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % and max per column, rounded to 2 places; a column without
    values has count 0. ``exact=False`` uses ``percentile_approx`` in one pass without a shuffle of values
    (bounded sketch, relative rank error 1/accuracy)."""
    if exact:
        out = describe_tables({"": (df, columns)}).drop("table_name")
        names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
        return names.join(out, "column_name", "left").fillna(0, ["count"])
    probs = [0.25, 0.5, 0.75]
    aggs = []
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`").cast("double")
        aggs += [
            F.count(col).alias(f"_c{i}"), F.avg(col).alias(f"_a{i}"), F.stddev_samp(col).alias(f"_s{i}"),
            F.min(col).alias(f"_lo{i}"), F.max(col).alias(f"_hi{i}"), F.percentile_approx(col, probs, accuracy).alias(f"_p{i}"),
        ]
    row = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_c{i}").alias("count"),
            F.round(f"_a{i}", 2).alias("mean"),
            F.round(f"_s{i}", 2).alias("std"),
            F.round(f"_lo{i}", 2).alias("min"),
            F.round(F.col(f"_p{i}")[0].cast("double"), 2).alias("p25"),
            F.round(F.col(f"_p{i}")[1].cast("double"), 2).alias("p50"),
            F.round(F.col(f"_p{i}")[2].cast("double"), 2).alias("p75"),
            F.round(f"_hi{i}", 2).alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return _long(row, entries)


# Q12 ---------------------------------------------------------------------------------------------
def top_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column with its frequency, plus the distinct count:
    ``(column_name, top_value, top_count, distinct_count)``. Null counts as a value; ties go to the
    smallest value (nulls first). Values are counted with a partial aggregate on
    ``(column, value)``, then ``min_by`` picks the top per column — no window over a whole column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    counts = df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column_name").agg(
        F.min_by(F.struct("value", "n"), F.struct((-F.col("n")).alias("k"), F.col("value"))).alias("_top"),
        F.count("value").alias("distinct_count"),
    ).select("column_name", F.col("_top.value").alias("top_value"), F.col("_top.n").alias("top_count"), "distinct_count")

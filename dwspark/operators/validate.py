"""Column validation (Q13–Q18) and the per-table roll-up (Q20).

All checks of one table are counted in one aggregation. Example values are bounded: the
``max_examples`` smallest per check are kept with ``row_number() <= k``, which Spark plans with a
group limit in each task before the shuffle, so that only ``k`` rows per check and task move,
however many rows are invalid. The reference shows the first five in row order, repeats included;
"the smallest five" is the deterministic equivalent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.functions.clean import clean_number, numeric_text, parse_number
from dwspark.operators.aggregate import union_all

MAX_EXAMPLES = 5

# strftime-style tokens accepted in date formats, with their Spark pattern letters.
STRFTIME_TOKENS = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%y": "yy", "%f": "SSSSSS"}


def spark_pattern(fmt: str) -> str:
    """Accept either a Spark datetime pattern or a strftime format (``%Y-%m-%d``)."""
    if "%" not in fmt:
        return fmt
    out = fmt
    for k, v in STRFTIME_TOKENS.items():
        out = out.replace(k, v)
    return out


def _examples(
    df: DataFrame, specs: Sequence[tuple[str, Column, Column]], k: int, value_type: str = "string", prefilter: bool = True
) -> DataFrame:
    """``(check, examples)`` with the ``k`` smallest values per check (repeats included) among rows where
    the condition holds. ``prefilter`` drops clean rows before any per-row array is built; turn it
    off when the conditions read projected columns (the filter would be pushed below the projection
    and inline every expression a second time)."""
    items = F.array(*[F.when(cond, F.struct(F.lit(name).alias("check"), val.cast(value_type).alias("value"))) for name, val, cond in specs])
    if prefilter:
        any_failed = F.coalesce(specs[0][2], F.lit(False))
        for _, _, cond in specs[1:]:
            any_failed = any_failed | F.coalesce(cond, F.lit(False))
        df = df.where(any_failed)
    pairs = df.select(F.inline(F.filter(items, lambda x: x.isNotNull())))
    ranked = pairs.withColumn("_r", F.row_number().over(Window.partitionBy("check").orderBy("value"))).where(F.col("_r") <= k)
    return ranked.groupBy("check").agg(F.array_sort(F.collect_list("value")).alias("examples"))


def _attach(counts: DataFrame, examples: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    out = counts
    for name, ex in examples:
        out = out.join(ex.withColumnRenamed("examples", name), "check", "left").withColumn(
            name, F.coalesce(F.col(name), F.array().cast(ex.schema["examples"].dataType))
        )
    return out


# Q13 ---------------------------------------------------------------------------------------------
def validate_dates(df: DataFrame | None, table_name: str, columns: Mapping[str, str], max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """Per configured column: ``status, total_checked, invalid_count, invalid_examples,
    expected_format, validation_mode``.

    * date/timestamp columns are already parsed: ``dtype_based``, nothing invalid;
    * text columns are trimmed and parsed with the pattern: ``format_based``;
    * no non-null value: ``empty``; missing table or column: ``invalid`` with mode ``warning``.
    """
    out_schema = (
        "table_name string, column_name string, status string, total_checked long, invalid_count long, "
        "invalid_examples array<string>, expected_format string, validation_mode string"
    )
    spark = _spark(df)
    warn = []
    present = {}
    for c, fmt in columns.items():
        if df is None or c not in df.columns:
            msg = f"Table '{table_name}' not found." if df is None else f"Column '{c}' not found."
            warn.append((table_name, "_warning" if df is None else c, "invalid", 0, 0, [msg], "n/a" if df is None else fmt, "warning"))
            if df is None:
                break
        else:
            present[c] = fmt
    parts = []
    if warn:
        parts.append(spark.createDataFrame(warn, out_schema))
    if present:
        specs, aggs, meta = [], [], []
        for i, (c, fmt) in enumerate(present.items()):
            col = F.col(f"`{c}`")
            typed = isinstance(df.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
            if typed:
                checked, invalid, shown = col.isNotNull(), F.lit(False), col.cast("string")
            else:
                text = F.trim(col.cast("string"))
                checked = col.isNotNull()
                invalid = checked & F.try_to_timestamp(text, F.lit(spark_pattern(fmt))).isNull()
                shown = text
            aggs += [F.count_if(checked).alias(f"_t{i}"), F.count_if(invalid).alias(f"_i{i}")]
            specs.append((c, shown, invalid))
            meta.append((c, fmt, "dtype_based" if typed else "format_based"))
        row = df.agg(*aggs)
        counts = row.select(F.inline(F.array(*[
            F.struct(
                F.lit(c).alias("check"), F.col(f"_t{i}").alias("total_checked"), F.col(f"_i{i}").alias("invalid_count"),
                F.lit(fmt).alias("expected_format"), F.lit(mode).alias("mode"),
            )
            for i, (c, fmt, mode) in enumerate(meta)
        ])))
        res = _attach(counts, [("invalid_examples", _examples(df, specs, max_examples))])
        parts.append(res.select(
            F.lit(table_name).alias("table_name"),
            F.col("check").alias("column_name"),
            F.when(F.col("invalid_count") == 0, "valid").otherwise("invalid").alias("status"),
            "total_checked", "invalid_count", "invalid_examples", "expected_format",
            F.when(F.col("total_checked") == 0, "empty").otherwise(F.col("mode")).alias("validation_mode"),
        ))
    return union_all(parts)


# Q14 ---------------------------------------------------------------------------------------------
def validate_numeric(df: DataFrame | None, table_name: str, columns: Sequence[str], max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """Strict numeric validation of raw text, per column: ``total_checked`` (non-null, non-blank
    after trimming), ``invalid_count`` (not a plain number), ``recoverable_after_cleaning_count``
    (a number once ``$``/``,``/parentheses are cleaned), ``unrecoverable_count``, and up to
    ``max_examples`` examples of each. Tokens such as ``NA`` count as unrecoverable."""
    schema = (
        "table_name string, column_name string, status string, total_checked long, invalid_count long, "
        "invalid_examples array<string>, recoverable_after_cleaning_count long, recoverable_examples array<string>, "
        "unrecoverable_count long, unrecoverable_examples array<string>"
    )
    spark = _spark(df)
    warn, present = [], []
    for c in columns:
        if df is None or c not in df.columns:
            msg = f"Table '{table_name}' not found." if df is None else f"Column '{c}' not found."
            warn.append((table_name, "_warning" if df is None else c, "invalid", 0, 0, [msg], 0, [], 0, []))
            if df is None:
                break
        else:
            present.append(c)
    parts = [spark.createDataFrame(warn, schema)] if warn else []
    if present:
        # One status code per column (0 not checked, 1 number, 2 recoverable, 3 unrecoverable) is
        # projected once; counts and examples only compare codes, so the cleaning expressions are
        # generated once per column instead of once per check (which overflows codegen limits).
        coded = df.select(*[
            F.struct(text.alias("v"), F.when(text.isNull() | (text == ""), 0).when(parse_number(text).isNotNull(), 1)
                     .when(clean_number(text).isNotNull(), 2).otherwise(3).alias("k")).alias(f"_c{i}")
            for i, text in enumerate(F.trim(F.col(f"`{c}`").cast("string")) for c in present)
        ])
        aggs = []
        for i, _ in enumerate(present):
            k = F.col(f"_c{i}.k")
            aggs += [F.count_if(k >= 1).alias(f"_t{i}"), F.count_if(k >= 2).alias(f"_i{i}"),
                     F.count_if(k == 2).alias(f"_r{i}"), F.count_if(k == 3).alias(f"_u{i}")]
        row = coded.agg(*aggs)
        counts = row.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("check"), F.col(f"_t{i}").alias("total_checked"), F.col(f"_i{i}").alias("invalid_count"),
                     F.col(f"_r{i}").alias("recoverable_after_cleaning_count"), F.col(f"_u{i}").alias("unrecoverable_count"))
            for i, c in enumerate(present)
        ])))
        # One pass collects all three example lists (labelled by kind); the three views below share
        # that plan, so Spark reuses its exchange instead of scanning the table three more times.
        kinds = [("invalid", lambda k: k >= 2), ("recoverable", lambda k: k == 2), ("unrecoverable", lambda k: k == 3)]
        every = _examples(coded, [(f"{kind}\t{c}", F.col(f"_c{i}.v"), test(F.col(f"_c{i}.k")))
                                  for kind, test in kinds for i, c in enumerate(present)], max_examples, prefilter=False)
        split = every.select(F.split("check", "\t").alias("_k"), "examples")

        def of_kind(kind):
            return split.where(F.col("_k")[0] == kind).select(F.col("_k")[1].alias("check"), "examples")

        res = _attach(counts, [(f"{kind}_examples", of_kind(kind)) for kind, _ in kinds])
        parts.append(res.select(
            F.lit(table_name).alias("table_name"), F.col("check").alias("column_name"),
            F.when(F.col("invalid_count") == 0, "valid").otherwise("invalid").alias("status"),
            "total_checked", "invalid_count", "invalid_examples", "recoverable_after_cleaning_count",
            "recoverable_examples", "unrecoverable_count", "unrecoverable_examples",
        ))
    return union_all(parts)


# Q15 ---------------------------------------------------------------------------------------------
def validate_negative(
    df: DataFrame | None, table_name: str, columns: Sequence[str], allow_negative: bool = False, max_examples: int = MAX_EXAMPLES
) -> DataFrame:
    """Negative values after numeric cleanup: ``total_checked`` (parsable values),
    ``negative_count``, the most negative examples, and ``unparsed_count`` (non-null cleaned text
    that is still not a number). ``allow_negative`` reports the counts but marks the column valid."""
    schema = (
        "table_name string, column_name string, status string, total_checked long, negative_count long, "
        "negative_examples array<double>, unparsed_count long"
    )
    spark = _spark(df)
    warn, present = [], []
    for c in columns:
        if df is None or c not in df.columns:
            msg = f"Table '{table_name}' not found." if df is None else f"Column '{c}' not found."
            warn.append((table_name, "_warning" if df is None else c, "invalid", 0, 0, [], 0))
            if df is None:
                break
        else:
            present.append(c)
    parts = [spark.createDataFrame(warn, schema)] if warn else []
    if present:
        aggs, specs = [], []
        for i, c in enumerate(present):
            prepared = numeric_text(F.col(f"`{c}`"))
            num = parse_number(prepared)
            aggs += [F.count(num).alias(f"_t{i}"), F.count_if(num < 0).alias(f"_n{i}"),
                     (F.count(prepared) - F.count(num)).alias(f"_p{i}")]
            specs.append((c, num, num < 0))
        row = df.agg(*aggs)
        counts = row.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("check"), F.col(f"_t{i}").alias("total_checked"), F.col(f"_n{i}").alias("negative_count"),
                     F.col(f"_p{i}").alias("unparsed_count"))
            for i, c in enumerate(present)
        ])))
        res = _attach(counts, [("negative_examples", _examples(df, specs, max_examples, "double"))])
        ok = (F.col("negative_count") == 0) | F.lit(allow_negative)
        parts.append(res.select(
            F.lit(table_name).alias("table_name"), F.col("check").alias("column_name"),
            F.when(ok, "valid").otherwise("invalid").alias("status"),
            "total_checked", "negative_count", "negative_examples", "unparsed_count",
        ))
    return union_all(parts)


def _spark(df):
    from pyspark.sql import SparkSession

    return df.sparkSession if df is not None else SparkSession.getActiveSession()


# Q16 ---------------------------------------------------------------------------------------------
def unexpected_values(df: DataFrame, table_name: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """``(table_name, column_name, unexpected_value, occurrences)`` for trimmed non-null values
    outside the approved set, most frequent first. The approved set is a literal ``IN`` list
    (config-sized), so no join is needed."""
    v = F.trim(F.col(f"`{column}`").cast("string"))
    bad = df.select(v.alias("unexpected_value")).where(F.col("unexpected_value").isNotNull() & ~F.col("unexpected_value").isin(*allowed))
    return bad.groupBy("unexpected_value").agg(F.count(F.lit(1)).alias("occurrences")).select(
        F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"), "unexpected_value", "occurrences"
    )


def unexpected_categorical(tables: Mapping[str, DataFrame], expected: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Q16 over a ``{table: {column: allowed}}`` config; missing tables/columns are skipped."""
    parts = [
        unexpected_values(tables[t], t, c, allowed)
        for t, cols in expected.items() if t in tables
        for c, allowed in cols.items() if c in tables[t].columns
    ]
    return union_all(parts).orderBy("table_name", "column_name", F.desc("occurrences"), "unexpected_value")


# Q17 ---------------------------------------------------------------------------------------------
def price_rules(df: DataFrame, unit_price: str, cost_price: str, total: str | None = None) -> DataFrame:
    """One row: negative unit prices, negative costs, and rows with cost above the unit price, all
    on cleaned numbers; ``total`` names a further column for the number of rows."""
    u, c = clean_number(F.col(unit_price)), clean_number(F.col(cost_price))
    return df.agg(
        F.count_if(u < 0).alias("negative_unit_price_count"),
        F.count_if(c < 0).alias("negative_cost_price_count"),
        F.count_if(c > u).alias("cost_greater_than_unit_count"), *([F.count(F.lit(1)).alias(total)] if total else []),
    )


# Q18 ---------------------------------------------------------------------------------------------
def direction_rules(
    df: DataFrame, reason: str, quantity: str,
    decrease_reasons: Sequence[str] = ("Damaged", "Expired"), increase_reasons: Sequence[str] = ("Restock",),
    total: str | None = None,
) -> DataFrame:
    """One row: movements whose reason should lower stock but whose quantity is positive, and
    movements whose reason should raise stock but whose quantity is negative; ``total`` names a further column for the number of rows."""
    r, q = F.trim(F.col(reason).cast("string")), clean_number(F.col(quantity))
    return df.agg(
        F.count_if(r.isin(*decrease_reasons) & (q > 0)).alias("damaged_or_expired_positive_count"),
        F.count_if(r.isin(*increase_reasons) & (q < 0)).alias("restock_negative_count"), *([F.count(F.lit(1)).alias(total)] if total else []),
    )


# Q20 ---------------------------------------------------------------------------------------------
def quality_rollup(missing: DataFrame, dates: DataFrame | None, numerics: DataFrame | None, negatives: DataFrame | None) -> DataFrame:
    """Per table: total missing values, columns with missing values, total blank-like values and,
    per check kind, the sorted comma-separated invalid columns (``-`` when none)."""
    base = missing.groupBy("table_name").agg(
        F.sum("missing_count").alias("total_missing_values"),
        F.count_if(F.col("missing_count") > 0).alias("columns_with_missing_values"),
        F.sum("blank_like_count").alias("total_blank_like_values"),
    )
    for name, frame in (("invalid_date_columns", dates), ("invalid_numeric_columns", numerics), ("invalid_negative_columns", negatives)):
        if frame is None:
            base = base.withColumn(name, F.lit("-"))
            continue
        bad = frame.where(F.col("status") == "invalid").groupBy("table_name").agg(
            F.array_join(F.array_sort(F.collect_set("column_name")), ", ").alias(name)
        )
        base = base.join(bad, "table_name", "left").withColumn(name, F.coalesce(F.col(name), F.lit("-")))
    return base.orderBy("table_name")

"""Cross-table checks and reports (Q4, Q19, Q22–Q24).

Reports are nested, one row per table, built from the long-form check results with bounded
``collect_list``s (one entry per column or per configured value) and written by
:func:`dwspark.sinks.reports.write_json_report`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwspark.operators.aggregate import union_all
from dwspark.operators.joins import missing_from
from dwspark.operators.profile import duplicate_keys


# Q23 ---------------------------------------------------------------------------------------------
def reconcile(
    header: DataFrame, detail: DataFrame, header_key: str, detail_key: str, total_col: str, amount_col: str,
    scale: int = 2,
) -> DataFrame:
    """Headers whose total differs from the sum of their detail amounts (both as exact decimals with
    ``scale`` places): ``(key, header_total, detail_total, difference)``. The detail side is
    aggregated per key first (partial aggregation), so the join sees one row per header."""
    money = f"decimal(18,{scale})"
    sums = detail.groupBy(F.col(detail_key).alias("_k")).agg(F.sum(F.col(amount_col).cast(money)).alias("detail_total"))
    joined = header.select(F.col(header_key).alias("_k"), F.col(total_col).cast(money).alias("header_total")).join(sums, "_k", "inner")
    return joined.where(F.col("header_total") != F.col("detail_total")).select(
        F.col("_k").alias(header_key), "header_total",
        F.col("detail_total").cast(money).alias("detail_total"),
        (F.col("header_total") - F.col("detail_total")).cast(money).alias("difference"),
    )


# Q24 ---------------------------------------------------------------------------------------------
def warehouse_checks(
    facts: Mapping[str, tuple[DataFrame, str]],
    dim_date: DataFrame,
    dims: Mapping[str, tuple[DataFrame, Sequence[str]]],
    date_key: str = "date_id",
) -> DataFrame:
    """One row per check, ``(check_name, failing_count)``:

    * ``<fact>_date_not_in_dim_date`` — fact rows whose non-null date key is missing from
      ``dim_date`` (an anti join, so a null in ``dim_date`` cannot hide every failure the way
      ``NOT IN`` does);
    * ``<dim>_duplicate_natural_keys`` — natural-key groups with more than one row.
    """
    parts = []
    for name, (fact, col) in facts.items():
        bad = missing_from(fact, dim_date, col, date_key)
        parts.append(bad.agg(F.count(F.lit(1)).alias("failing_count")).select(
            F.lit(f"{name}_date_not_in_dim_date").alias("check_name"), "failing_count"))
    for name, (dim, keys) in dims.items():
        parts.append(duplicate_keys(dim, keys).select(
            F.lit(f"{name}_duplicate_natural_keys").alias("check_name"), F.col("duplicate_groups").alias("failing_count")))
    return union_all(parts)


# Q22 ---------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """Fires for each metric row with ``metric`` (and, when set, table/column) whose value exceeds
    ``threshold``. ``finding`` may use ``{table}``, ``{column}``, ``{value}``."""

    metric: str
    priority: str
    finding: str
    recommendation: str
    table: str | None = None
    column: str | None = None
    threshold: float = 0


DEFAULT_RULES = (
    Rule("missing_count", "High", "`{table}.{column}` has {value} missing values.",
         "Decide whether missing values are legitimate (for example guest orders) and record that as a flag "
         "column instead of filling placeholder values."),
    Rule("numeric_invalid_count", "High", "`{table}.{column}` fails strict numeric parsing in {value} rows.",
         "Clean currency symbols and separators at ingestion and store the column as a decimal."),
    Rule("negative_count", "Medium", "`{table}.{column}` has {value} negative values.",
         "Review negative values: reject them or model them as explicit adjustments."),
    Rule("unexpected_value_count", "Medium", "`{table}.{column}` has {value} rows outside the approved values.",
         "Standardise the values against a lookup table and map unknown ones to a controlled fallback."),
    Rule("date_invalid_count", "Medium", "`{table}.{column}` has {value} values that do not match the expected date format.",
         "Parse dates with one agreed format at ingestion and reject the rest with a reason."),
)
# Findings of the price and movement rules (Q17, Q18), which say out of how many rows.
BUSINESS_RULES = (
    Rule("negative_unit_price_count", "High", "`{table}.{column}` is negative in {value} of {total} rows.",
         "Correct or reject negative selling prices before they reach reports."),
    Rule("negative_cost_price_count", "High", "`{table}.{column}` is negative in {value} of {total} rows.",
         "Correct or reject negative costs before margins are computed."),
    Rule("cost_greater_than_unit_count", "High", "`{table}.{column}` is above the selling price in {value} of {total} rows.",
         "Check these products: either the price or the cost is wrong, or they sell at a loss on purpose and should say so."),
    Rule("damaged_or_expired_positive_count", "Medium", "`{table}.{column}` raises stock for damaged or expired goods in {value} of {total} rows.",
         "Fix the sign rule of stock movements by reason and enforce it at ingestion."),
    Rule("restock_negative_count", "Medium", "`{table}.{column}` lowers stock for restocked goods in {value} of {total} rows.",
         "Fix the sign rule of stock movements by reason and enforce it at ingestion."),
)
ALWAYS = Rule("always", "Medium", "Quality rules are not enforced by the schema.",
              "Add ingestion checks for allowed categories, numeric typing, non-negative amounts and date formats.")


def findings_from_checks(
    missing: DataFrame | None = None,
    dates: DataFrame | None = None,
    numerics: DataFrame | None = None,
    negatives: DataFrame | None = None,
    unexpected: DataFrame | None = None,
) -> DataFrame:
    """Long-form metrics ``(table_name, column_name, metric, value)`` from the check outputs."""
    parts = []

    def add(df, col, metric):
        parts.append(df.select("table_name", "column_name", F.lit(metric).alias("metric"), F.col(col).cast("long").alias("value")))

    if missing is not None:
        add(missing, "missing_count", "missing_count")
    if dates is not None:
        add(dates, "invalid_count", "date_invalid_count")
    if numerics is not None:
        add(numerics, "invalid_count", "numeric_invalid_count")
    if negatives is not None:
        add(negatives.where(F.col("status") == "invalid"), "negative_count", "negative_count")
    if unexpected is not None:
        add(unexpected.groupBy("table_name", "column_name").agg(F.sum("occurrences").alias("n")), "n", "unexpected_value_count")
    return union_all(parts)


def business_findings(counts: DataFrame, table: str, columns: Mapping[str, str], total: str = "total") -> DataFrame:
    """``(table_name, column_name, metric, value, total)`` from a one-row result of Q17 or Q18 that has its number of rows
    in ``total``; ``columns`` says which column each count is about."""
    entries = [F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(m).alias("metric"), F.col(m).alias("value"),
                        F.col(total).alias("total")) for m, c in columns.items()]
    return counts.select(F.inline(F.array(*entries)))


def recommendations(spark: SparkSession, findings: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, always: Rule | None = ALWAYS) -> DataFrame:
    """Apply the rule table to the metrics: ``(priority, table_name, column_name, finding,
    recommendation)``, High before Medium/Low, then by table and column. The rule table is
    config-sized and broadcast. A finding may also use ``{total}`` where the metrics have it."""
    schema = "metric string, priority string, finding string, recommendation string, r_table string, r_column string, threshold double"
    rule_df = spark.createDataFrame([(r.metric, r.priority, r.finding, r.recommendation, r.table, r.column, float(r.threshold)) for r in rules], schema)
    j = findings.join(F.broadcast(rule_df), "metric").where(
        (F.col("value") > F.col("threshold"))
        & (F.col("r_table").isNull() | (F.col("r_table") == F.col("table_name")))
        & (F.col("r_column").isNull() | (F.col("r_column") == F.col("column_name")))
    )
    text = F.replace(F.replace(F.replace(F.col("finding"), F.lit("{table}"), F.col("table_name")),
                               F.lit("{column}"), F.col("column_name")), F.lit("{value}"), F.col("value").cast("string"))
    if "total" in findings.columns:
        text = F.replace(text, F.lit("{total}"), F.col("total").cast("string"))
    out = j.select("priority", "table_name", "column_name", text.alias("finding"), "recommendation")
    if always is not None:
        out = out.unionByName(spark.createDataFrame(
            [(always.priority, None, None, always.finding, always.recommendation)],
            "priority string, table_name string, column_name string, finding string, recommendation string"))
    rank = F.when(F.col("priority") == "High", 0).when(F.col("priority") == "Medium", 1).otherwise(2)
    return out.orderBy(rank, F.col("table_name").asc_nulls_last(), F.col("column_name").asc_nulls_last())


# Q4 ----------------------------------------------------------------------------------------------
def profiling_report(shapes: DataFrame, types: DataFrame, uniques: DataFrame | None = None) -> DataFrame:
    """One row per table: ``shape`` (rows, columns), ``data_types`` (column -> type) and
    ``unique_values`` (column -> sorted distinct values) from Q1, Q2 and Q3.

    The report embeds the distinct values of the *configured* categorical columns, so its lists are
    as long as those columns have categories; a high-cardinality column belongs in Q3's long form
    (one row per value, fully distributed), not in this document."""
    t = types.groupBy("table_name").agg(F.map_from_entries(F.collect_list(F.struct("column_name", "data_type"))).alias("data_types"))
    out = shapes.select("table_name", F.struct(F.col("row_count").alias("rows"), F.col("column_count").alias("columns")).alias("shape")).join(t, "table_name", "left")
    if uniques is not None:
        u = uniques.where(F.col("status") == "ok").groupBy("table_name", "column_name").agg(F.array_sort(F.collect_list("value")).alias("v"))
        u = u.groupBy("table_name").agg(F.map_from_entries(F.collect_list(F.struct("column_name", "v"))).alias("unique_values"))
        out = out.join(u, "table_name", "left")
    return out.orderBy("table_name")


# Q19 ---------------------------------------------------------------------------------------------
def quality_report(missing: DataFrame, dates: DataFrame | None = None, numerics: DataFrame | None = None, negatives: DataFrame | None = None) -> DataFrame:
    """One row per table: missing and blank-like counts per column, a status per validated column
    and the full details of each validation, as nested columns ready for a JSON report."""
    out = missing.groupBy("table_name").agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "missing_count"))).alias("missing_values"),
        F.map_from_entries(F.collect_list(F.struct("column_name", "blank_like_count"))).alias("blank_like_values"),
    )
    for name, frame in (("date", dates), ("numeric", numerics), ("negative", negatives)):
        if frame is None:
            continue
        details = [c for c in frame.columns if c not in ("table_name", "column_name")]
        agg = frame.groupBy("table_name").agg(
            F.map_from_entries(F.collect_list(F.struct("column_name", "status"))).alias(f"{name}_validity"),
            F.map_from_entries(F.collect_list(F.struct("column_name", F.struct(*details)))).alias(f"{name}_validity_details"),
        )
        out = out.join(agg, "table_name", "left")
    return out.orderBy("table_name")

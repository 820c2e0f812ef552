"""Dirty source text derived from the driver tables.

The reference cleans hand-typed source data (``$47.00``, ``Yes``/``No``, ``21/6/65``, ``923``).
The driver tables are clean and typed, so these functions re-render their values as the messy text
forms the cleaners must handle. Every row is rendered (the variant is picked from the row's key),
and each rendering has the same formula in the DuckDB oracle SQL, so both sides start from
identical text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def money_text(value: Column) -> Column:
    """``value`` rounded to cents as plain text, e.g. ``900.10``."""
    return value.cast(DecimalType(18, 2)).cast("string")


def price_text(value: Column, key: Column) -> Column:
    """Price text in one of four spellings that all strip back to the same number (P10)."""
    base = money_text(value)
    v = key % 4
    return (
        F.when(v == 0, base)
        .when(v == 1, F.concat(F.lit("$"), base))
        .when(v == 2, F.concat(base, F.lit(" USD")))
        .otherwise(F.concat(F.lit("IDR "), base))
    )


def stock_word(key: Column) -> Column:
    """Stock words for the tri-state parser (P11), including words it must leave null."""
    v = key % 8
    return (
        F.when(v == 0, "Yes").when(v == 1, "No").when(v == 2, "available").when(v == 3, "Out of Stock")
        .when(v == 4, "1").when(v == 5, "0").when(v == 6, "maybe").otherwise("")
    )


def amount_text(value: Column, key: Column) -> Column:
    """Numeric-like text for P9/Q14/Q15: plain, ``$``-prefixed, thousands commas, accounting
    parentheses for negatives, and unparseable tokens."""
    cents = value.cast(DecimalType(18, 2))
    base = cents.cast("string")
    whole = F.abs(cents).cast("long")
    frac = F.substring_index(base, ".", -1)
    thousands = F.concat(
        (whole / 1000).cast("long").cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0"),
        F.lit("."), frac,
    )
    signed_thousands = F.when(cents < 0, F.concat(F.lit("-"), thousands)).otherwise(thousands)
    v = key % 10
    return (
        F.when(v == 0, F.concat(F.lit("$"), base))
        .when((v == 1) & (whole >= 1000), signed_thousands)
        .when(v == 2, F.when(cents < 0, F.concat(F.lit("("), F.abs(cents).cast("string"), F.lit(")"))).otherwise(base))
        .when(v == 3, F.lit("N/A"))
        .when(v == 4, F.lit(" "))
        .when(v == 5, F.concat(base, F.lit("abc")))
        .when(v == 6, F.concat(F.lit(" "), base, F.lit(" ")))
        .otherwise(base)
    )


def legacy_date_text(ts: Column, key: Column) -> Column:
    """``d/M/yy`` text of a timestamp, with some four-digit years and some invalid values."""
    d = ts.cast("date")
    day, month, year = F.dayofmonth(d).cast("string"), F.month(d).cast("string"), F.year(d)
    yy = F.lpad((year % 100).cast("string"), 2, "0")
    v = key % 9
    return (
        F.when(v == 0, F.concat_ws("/", day, month, year.cast("string")))
        .when(v == 1, F.lit("31/2/90"))
        .when(v == 2, F.lit("nan"))
        .when(v == 3, F.concat(F.lit(" "), F.concat_ws("/", day, month, yy), F.lit(" ")))
        .otherwise(F.concat_ws("/", day, month, yy))
    )


def digit_time_text(ts: Column, key: Column) -> Column:
    """Time of day as digits without separators or leading zeros (``92305``), sometimes with
    punctuation or too many digits (P8)."""
    secs = F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)
    plain = secs.cast("string")
    v = key % 7
    return (
        F.when(v == 0, F.date_format(ts, "HH:mm:ss"))
        .when(v == 1, F.concat(plain, F.lit("0")))
        .when(v == 2, F.concat(F.lit("12345"), plain))
        .otherwise(plain)
    )


def gender_code(key: Column) -> Column:
    v = key % 5
    return F.when(v == 0, "M").when(v == 1, " f ").when(v == 2, "F").when(v == 3, "x").otherwise(F.lit(None))


def iso_date_text(ts: Column, key: Column) -> Column:
    """``yyyy-MM-dd`` text with some invalid dates for the date validator (Q13)."""
    base = F.date_format(ts, "yyyy-MM-dd")
    v = key % 17
    return (
        F.when(v == 0, F.concat(F.year(ts).cast("string"), F.lit("-02-30")))
        .when(v == 1, F.date_format(ts, "dd/MM/yyyy"))
        .when(v == 2, F.lit("unknown"))
        .when(v == 3, F.lit(None))
        .otherwise(base)
    )


def messy_label(label: Column, key: Column) -> Column:
    """Text label with case/space noise and null tokens."""
    v = key % 11
    return (
        F.when(v == 0, F.upper(label))
        .when(v == 1, F.concat(F.lit("  "), F.lower(label), F.lit(" ")))
        .when(v == 2, F.lit("-"))
        .when(v == 3, F.lit("N/A"))
        .when(v == 4, F.lit("<NA>"))
        .when(v == 5, F.lit("unknown-ref"))
        .otherwise(label)
    )


# ---- the same renderings as DuckDB SQL expressions (for the oracle queries) ----------------------
def sql_money_text(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,2)) AS VARCHAR)"


def sql_price_text(value: str, key: str) -> str:
    base = sql_money_text(value)
    return (f"CASE ({key}) % 4 WHEN 0 THEN {base} WHEN 1 THEN '$' || {base} "
            f"WHEN 2 THEN {base} || ' USD' ELSE 'IDR ' || {base} END")


def sql_amount_text(value: str, key: str) -> str:
    cents = f"CAST({value} AS DECIMAL(18,2))"
    base = f"CAST({cents} AS VARCHAR)"
    whole = f"CAST(trunc(abs({cents})) AS BIGINT)"
    frac = f"split_part({base}, '.', 2)"
    thousands = f"(CAST({whole} // 1000 AS VARCHAR) || ',' || lpad(CAST({whole} % 1000 AS VARCHAR), 3, '0') || '.' || {frac})"
    signed = f"(CASE WHEN {cents} < 0 THEN '-' || {thousands} ELSE {thousands} END)"
    v = f"(({key}) % 10)"
    return (
        f"CASE WHEN {v} = 0 THEN '$' || {base} "
        f"WHEN {v} = 1 AND {whole} >= 1000 THEN {signed} "
        f"WHEN {v} = 2 THEN (CASE WHEN {cents} < 0 THEN '(' || CAST(abs({cents}) AS VARCHAR) || ')' ELSE {base} END) "
        f"WHEN {v} = 3 THEN 'N/A' WHEN {v} = 4 THEN ' ' WHEN {v} = 5 THEN {base} || 'abc' "
        f"WHEN {v} = 6 THEN ' ' || {base} || ' ' ELSE {base} END"
    )


def sql_legacy_date_text(ts: str, key: str) -> str:
    d = f"CAST({ts} AS DATE)"
    dmy = f"CAST(day({d}) AS VARCHAR) || '/' || CAST(month({d}) AS VARCHAR) || '/'"
    yy = f"lpad(CAST(year({d}) % 100 AS VARCHAR), 2, '0')"
    v = f"(({key}) % 9)"
    return (
        f"CASE WHEN {v} = 0 THEN {dmy} || CAST(year({d}) AS VARCHAR) WHEN {v} = 1 THEN '31/2/90' "
        f"WHEN {v} = 2 THEN 'nan' WHEN {v} = 3 THEN ' ' || {dmy} || {yy} || ' ' ELSE {dmy} || {yy} END"
    )


def sql_legacy_date(text: str, max_valid_year: int = 2025) -> str:
    p = f"CAST(coalesce(try_strptime(trim({text}), '%d/%m/%y'), try_strptime(trim({text}), '%d/%m/%Y')) AS DATE)"
    return f"(CASE WHEN year({p}) > {max_valid_year} THEN CAST({p} - INTERVAL 100 YEAR AS DATE) ELSE {p} END)"


def sql_to_int(text: str) -> str:
    """Plain decimals only, truncated toward zero."""
    t = f"trim({text})"
    return (f"(CASE WHEN regexp_full_match({t}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)') "
            f"THEN TRY_CAST(trunc(TRY_CAST({t} AS DECIMAL(38,10))) AS INTEGER) END)")


def sql_digit_time_text(ts: str, key: str) -> str:
    plain = f"CAST(hour({ts}) * 10000 + minute({ts}) * 100 + second({ts}) AS VARCHAR)"
    v = f"(({key}) % 7)"
    return (f"CASE WHEN {v} = 0 THEN strftime({ts}, '%H:%M:%S') WHEN {v} = 1 THEN {plain} || '0' "
            f"WHEN {v} = 2 THEN '12345' || {plain} ELSE {plain} END")


def sql_normalize_time(text: str) -> str:
    digits = f"regexp_replace(trim({text}), '\\D', '', 'g')"
    padded = f"lpad({digits}, 6, '0')"
    return (f"(CASE WHEN length({digits}) BETWEEN 1 AND 6 THEN substr({padded}, 1, 2) || ':' || "
            f"substr({padded}, 3, 2) || ':' || substr({padded}, 5, 2) END)")


def sql_gender_code(key: str) -> str:
    v = f"(({key}) % 5)"
    return f"CASE WHEN {v} = 0 THEN 'M' WHEN {v} = 1 THEN ' f ' WHEN {v} = 2 THEN 'F' WHEN {v} = 3 THEN 'x' END"


def sql_gender_label(text: str) -> str:
    return f"(CASE upper(trim({text})) WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE 'Other' END)"


def sql_iso_date_text(ts: str, key: str) -> str:
    v = f"(({key}) % 17)"
    return (f"CASE WHEN {v} = 0 THEN CAST(year({ts}) AS VARCHAR) || '-02-30' WHEN {v} = 1 THEN strftime({ts}, '%d/%m/%Y') "
            f"WHEN {v} = 2 THEN 'unknown' WHEN {v} = 3 THEN NULL ELSE strftime({ts}, '%Y-%m-%d') END")


def sql_messy_label(label: str, key: str) -> str:
    v = f"(({key}) % 11)"
    return (f"CASE WHEN {v} = 0 THEN upper({label}) WHEN {v} = 1 THEN '  ' || lower({label}) || ' ' "
            f"WHEN {v} = 2 THEN '-' WHEN {v} = 3 THEN 'N/A' WHEN {v} = 4 THEN '<NA>' WHEN {v} = 5 THEN 'unknown-ref' "
            f"ELSE {label} END")


SQL_NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def sql_parse_number(text: str) -> str:
    t = f"trim({text})"
    return f"(CASE WHEN regexp_full_match({t}, '{SQL_NUMBER_PATTERN}') THEN TRY_CAST({t} AS DOUBLE) END)"


def sql_numeric_text(text: str) -> str:
    t = f"trim(CAST({text} AS VARCHAR))"
    kept = f"(CASE WHEN {t} IN ('', 'NA', 'N/A', 'NULL', 'None', 'nan') THEN NULL ELSE {t} END)"
    return f"regexp_replace(regexp_replace({kept}, '[,$]', '', 'g'), '^\\((.*)\\)$', '-\\1')"


def sql_clean_number(text: str) -> str:
    return sql_parse_number(sql_numeric_text(text))


def sql_clean_text(text: str) -> str:
    t = f"trim(CAST({text} AS VARCHAR))"
    return f"(CASE WHEN lower({t}) IN ('', '-', '—', 'nan', 'none', 'null', '<na>') THEN NULL ELSE {t} END)"

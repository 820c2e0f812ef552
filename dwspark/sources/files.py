"""File sources.

Readers never infer schemas (inference is an extra full pass and guesses differently per file):
either the caller gives a schema or every column is read as text and typed later by the cleaning
functions. Nothing is cached or counted here; a reader returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType


def require_columns(df: DataFrame, required: Sequence[str], what: str = "source") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df


# S1 ----------------------------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ",",
             mode: str = "FAILFAST", header: bool = True) -> DataFrame:
    """CSV file or folder with a header; every column text unless ``schema`` is given; malformed
    rows fail the read (``FAILFAST``) instead of silently turning into nulls."""
    r = spark.read.option("header", header).option("sep", sep).option("mode", mode).option("inferSchema", False)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


CORRUPT = "_corrupt_record"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows that fit ``schema``, and those that don't: ``file`` (its path), ``block_start`` (the first byte of the read split, to
    find the row again) and ``record``, the row's text. Wrong types, missing and surplus fields make a bad row; a
    load can keep the second frame as its reject table. Each frame reads the file on its own."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("enforceSchema", False).schema(wide).csv(path)).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"))
    # All columns are parsed in both frames: Spark does not look at fields that nothing refers to.
    parsed = F.length(F.concat_ws(",", *[F.col(f"`{f.name}`").cast("string") for f in fields])) >= 0
    fits = F.col(CORRUPT).isNull() & parsed
    good = rows.where(fits).select(*[F.col(f"`{f.name}`") for f in fields])
    bad = rows.where(F.col(CORRUPT).isNotNull() & parsed).select(F.col("_file").alias("file"), F.col("_at").alias("block_start"), F.col(CORRUPT).alias("record"))
    return good, bad


# S4 ----------------------------------------------------------------------------------------------
def read_tsv(spark: SparkSession, path: str, required: Sequence[str] = (), schema: StructType | str | None = None) -> DataFrame:
    """Tab-separated reference file; fails when a required column is missing."""
    return require_columns(read_csv(spark, path, schema, sep="\t"), required, path)


# S5 ----------------------------------------------------------------------------------------------
def read_json_records(spark: SparkSession, path: str, array_field: str = "regions", required: Sequence[str] = (),
                      schema: StructType | str | None = None) -> DataFrame:
    """JSON reference file holding either ``{"<array_field>": [{...}, ...]}`` or a bare array of
    records; returns one row per record. With a ``schema`` of the records nothing is inferred, and a file that is
    no such document is an error when it is read; without one Spark infers it from the whole file."""
    if schema is not None:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("value"), F.col("_metadata.file_path").alias("file"))
        bare = F.col("value").startswith("[")
        strict = {"mode": "FAILFAST"}
        listed = F.from_json(F.when(bare, F.col("value")), T.ArrayType(fields), strict)
        inside = F.from_json(F.when(~bare, F.col("value")), T.StructType([T.StructField(array_field, T.ArrayType(fields))]), strict)[array_field]
        missing = F.raise_error(F.concat(F.lit(f"no list of records in field {array_field}: "), "file")).cast(T.ArrayType(fields))
        raw = text.select(F.inline(F.coalesce(listed, inside, missing)))
    else:
        raw = spark.read.option("multiLine", True).json(path)
        if array_field in raw.columns:
            raw = raw.select(F.inline(F.col(array_field)))
    return require_columns(raw, required, path)


# S6 ----------------------------------------------------------------------------------------------
def read_csv_with_timestamps(spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "M/d/yyyy HH:mm:ss", strict: bool = False) -> DataFrame:
    """CSV read as text, with the given columns parsed from ``fmt`` to timestamps. A text that is no timestamp becomes
    null, or with ``strict`` fails the read with an error that names the column and the text."""
    df = read_csv(spark, path)

    def parsed(c: str):
        at = F.try_to_timestamp(F.trim(F.col(c)), F.lit(fmt))
        if strict:
            bad = F.raise_error(F.concat(F.lit(f"{c}: no timestamp of the form {fmt}: "), F.col(c))).cast("timestamp")
            at = F.when(F.col(c).isNotNull() & at.isNull(), bad).otherwise(at)
        return at.alias(c)

    return df.select(*[parsed(c) if c in columns else F.col(c) for c in df.columns])

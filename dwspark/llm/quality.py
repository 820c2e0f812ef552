"""Quality rules (native): a threshold table compiled into one Spark projection.

No user function runs: words, lines and three-word windows are arrays, repeated windows are found by
sorting (hash, position) pairs inside the row, and each rule of the table becomes one boolean
expression. The documents are never shuffled, so a hot source or a hot group of copies costs nothing.

Defined results: a null or empty text has no words, all counts 0, ``base_failed`` true; repeated rows
and repeated ids are judged row by row; an empty table gives an empty result; other columns of the
input are ignored by :func:`measure` and kept by :func:`keep_good`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwspark.llm.tables import words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 3

# Frequent function words of English, French, German and Spanish, lower case.
STOP_WORDS = tuple(
    "the of and to in a is that it for was with on as by be this are from at or an not have "
    "de la le les et des un une du en que est dans pour qui par sur au pas avec "
    "der die und den von zu das mit sich auf ist ein eine dem nicht auch es im für "
    "el los se las con una su del lo como más o pero sus y al".split()
)


@dataclass(frozen=True)
class Rule:
    """``lower <= 100 * count / of <= upper``, a ratio in per cent; a null bound is open. With ``of``
    null the count itself is bounded. Ratios are compared as integers, so ties fall the same way
    everywhere; where ``of`` is 0 the ratio counts as 0."""

    name: str
    count: str
    of: str | None = None
    lower: int | None = None
    upper: int | None = None

    def spark(self) -> Column:
        count, of = F.col(self.count), F.lit(1) if self.of is None else F.greatest(F.col(self.of), F.lit(1))
        scale = 1 if self.of is None else 100
        passed = F.lit(True)
        if self.lower is not None:
            passed = passed & (count * scale >= of * self.lower)
        if self.upper is not None:
            passed = passed & (count * scale <= of * self.upper)
        return passed

    def sql(self) -> str:
        of, scale = ("1", 1) if self.of is None else (f"greatest({self.of}, 1)", 100)
        bounds = [] if self.lower is None else [f"{self.count} * {scale} >= {of} * {self.lower}"]
        bounds += [] if self.upper is None else [f"{self.count} * {scale} <= {of} * {self.upper}"]
        return "(" + " AND ".join(bounds) + ")"


RULES = (
    Rule("length", "n_words", lower=50),
    Rule("mean_word_length", "word_chars", "n_words", lower=200, upper=1500),
    Rule("symbols", "n_symbols", "n_words", upper=10),
    Rule("letters", "n_letters", "word_chars", lower=60),
    Rule("stop_words", "n_stop_words", "n_words", lower=3),
    Rule("repeated_lines", "n_dup_lines", "n_lines", upper=30),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", upper=90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", upper=30),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_letters",
          "n_stop_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines")


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The counts, ``base_failed``, ``failed_rules`` (names in table order) and ``kept`` of each row,
    after the columns of ``keep``."""
    held = [F.col(c).alias(f"_held{i}") for i, c in enumerate(keep)]
    held_names = [f"_held{i}" for i in range(len(keep))]
    text = F.coalesce(F.col("text"), F.lit(""))
    step = docs.select(
        *held, text.alias("_text"), words(F.col("text")).alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    joined = F.array_join("_words", "")
    counts = step.select(
        *held_names, "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(joined).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS + "+", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace(joined, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.size(F.filter("_words", lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long").alias("n_ellipsis_lines"),
        # One 64-bit hash for each window of three words; the last two words start none.
        F.when(F.size("_words") >= WINDOW, F.slice(
            F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
            F.lit(1), F.size("_words") - (WINDOW - 1),
        )).alias("_windows"),
    )
    # Equal windows stand side by side after the sort. A text without equal windows skips it.
    counts = counts.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    repeated = F.filter("_sorted", lambda x, i: (
        F.coalesce(x["h"] == F.when(i > 0, F.get("_sorted", i - 1))["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get("_sorted", i + 1)["h"], F.lit(False))
    ))
    covered = F.array_distinct(F.flatten(F.transform(
        repeated, lambda x: F.array(*[x["i"] + k for k in range(WINDOW)]))))
    counts = counts.withColumn("n_repeat_words", F.coalesce(F.size(covered).cast("long"), F.lit(0).cast("long")))
    counts = counts.withColumn("n_repeat_words", F.greatest("n_repeat_words", F.lit(0).cast("long")))
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    failed = F.array_compact(F.array(*[F.when(~r.spark(), F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    judged = counts.select(*held_names, *COUNTS, base.alias("base_failed"), failed.alias("failed_rules"))
    # A filter on the verdict must not be pushed below the steps above: inside their lambdas it would
    # split the whole text again for every word. A row number, which is never negative, pins it here.
    pinned = F.monotonically_increasing_id() >= 0
    return judged.select(
        *[F.col(h).alias(c) for h, c in zip(held_names, keep)], *COUNTS, "base_failed", "failed_rules",
        (~F.col("base_failed") & (F.size("failed_rules") == 0) & pinned).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with the input's columns."""
    # The whole row rides along as one struct, so no input name can clash with a count's name.
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text"))
    return measure(row, rules, keep=("_row",)).where("kept").select("_row.*")


def query(docs: DataFrame) -> DataFrame:
    return measure(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_letters", "n_stop_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines")


def sql(docs: str = "documents", columns: str | None = None) -> str:
    """The same judgement in DuckDB SQL."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    rules = " AND ".join(r.sql() for r in RULES)
    space, dots = r"[\x20\x09-\x0D]", r"(\.\.\.|\x{2026})"
    return rf"""
WITH w AS (
  SELECT d.*, row_number() OVER () AS rid,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{space}+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM {docs} d
), g AS (
  SELECT rid, unnest(range(0, len(words) - 2)) AS i,
    unnest(list_transform(range(1, len(words) - 1), lambda k: words[k] || ' ' || words[k + 1] || ' ' || words[k + 2])) AS gram
  FROM w WHERE len(words) >= 3
), t AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g
), r AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM t WHERE n > 1) GROUP BY rid
), m AS (
  SELECT w.* EXCLUDE (words, lines), CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(length(regexp_replace(array_to_string(words, ''), '[^\p{{L}}]', '', 'g')) AS BIGINT) AS n_letters,
    CAST(len(list_filter(words, lambda x: x IN ({stop}))) AS BIGINT) AS n_stop_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '^{space}*[-*\x{{2022}}]'))) AS BIGINT) AS n_bullet_lines,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '{dots}{space}*$'))) AS BIGINT) AS n_ellipsis_lines
  FROM w LEFT JOIN r USING (rid)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT {columns or '''doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND ''' + rules + ''' AS kept,
  n_letters, n_stop_words, n_lines, n_bullet_lines, n_ellipsis_lines'''}
FROM b"""

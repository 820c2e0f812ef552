"""Licence scan (native): Dice coefficient over word bigrams against licence templates.

A text's segments are its lines and, if it has several, the whole text. A segment is normalised (lower
case, every run of characters other than letters and digits becomes one space), its distinct word
bigrams are compared with each template's, and ``2 * common / (size + size)`` is the coefficient. Since
``common <= min(size, size)``, a coefficient of at least ``t`` needs sizes within a factor of
``(2 - t) / t`` of each other: segments outside every template's bounds are dropped before bigrams are
made, and each template is only compared within its own bounds. Nothing is shuffled.

Defined results: a null or empty text, and one without a match, has a null licence, a null coefficient
and 0 matching segments; ties go to the earlier segment (lines first, then the whole text), then to the
smaller licence name; repeated rows are judged row by row; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short licence notices as they are written in files and on pages.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}
THRESHOLD_PERCENT = 80


def _bigrams(text: str) -> list[str]:
    w = re.sub(r"[^\w]+|_", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def bounds(size: int, percent: int) -> tuple[int, int]:
    """Sizes that can reach a coefficient of ``percent`` with a set of ``size`` bigrams."""
    return -(-size * percent // (200 - percent)), size * (200 - percent) // percent


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """doc_id, ``license``, ``dice``, ``segment`` (0-based line; -1: the whole text) and ``n_segments``
    (segments that match any template)."""
    sets = {name: _bigrams(t) for name, t in sorted(templates.items())}
    least = min(bounds(len(s), percent)[0] for s in sets.values())
    most = max(bounds(len(s), percent)[1] for s in sets.values())
    clean = lambda x: F.array_remove(F.split(F.lower(x), r"[^\p{L}\p{Nd}]+"), "")
    step = docs.select("doc_id", F.transform(
        F.split(F.coalesce(F.col("text"), F.lit("")), "\n"),
        lambda x, i: F.struct(i.alias("n"), clean(x).alias("w"))).alias("lines"))
    whole = F.struct(F.lit(-1).alias("n"), F.flatten(F.transform("lines", lambda s: s["w"])).alias("w"))
    step = step.select("doc_id", F.when(F.size("lines") > 1, F.concat("lines", F.array(whole))).otherwise(F.col("lines")).alias("segments"))
    pairs = lambda s: F.array_distinct(F.zip_with(
        F.slice(s["w"], 1, F.greatest(F.size(s["w"]) - 1, F.lit(0))), F.slice(s["w"], 2, F.greatest(F.size(s["w"]) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b)))
    # Words less one bound the distinct bigrams from above, distinct words less one from below: both
    # prune before a bigram is made.
    step = step.select("doc_id", F.transform(
        F.filter("segments", lambda s: (F.size(s["w"]) > least)
                 & ((F.size(s["w"]) <= most + 1) | (F.size(F.array_distinct(s["w"])) <= most + 1))),
        lambda s: F.struct(s["n"].alias("n"), pairs(s).alias("b"))).alias("segments"))
    step = step.select("doc_id", F.filter("segments", lambda s: F.size(s["b"]).between(least, most)).alias("segments"))

    def best(s: Column) -> Column:
        found = []
        for rank, (name, grams) in enumerate(sets.items()):
            low, high = bounds(len(grams), percent)
            common = F.size(F.array_intersect(s["b"], F.array(*[F.lit(g) for g in grams])))
            total = F.size(s["b"]) + len(grams)
            found.append(F.when(F.size(s["b"]).between(low, high) & (common * 200 >= total * percent), F.struct(
                (common * 2.0 / total).alias("dice"),
                F.when(s["n"] >= 0, -s["n"]).otherwise(F.lit(-(2**31) + 1)).alias("order"),
                F.lit(-rank).alias("rank"), F.lit(name).alias("license"), s["n"].alias("n"))))
        return F.array_max(F.array(*found))

    step = step.select("doc_id", F.filter(F.transform("segments", best), lambda x: x.isNotNull()).alias("found"))
    top = F.array_max("found")
    return step.select(
        "doc_id", top["license"].alias("license"), F.round(top["dice"], 6).alias("dice"),
        top["n"].alias("segment"), F.size("found").alias("n_segments"))


def sql(templates: dict[str, str] = TEMPLATES, percent: int = THRESHOLD_PERCENT) -> str:
    """The same scan in DuckDB SQL."""
    rows = ", ".join(
        f"({rank}, '{name}', [{', '.join(repr(g) for g in _bigrams(t))}])" for rank, (name, t) in enumerate(sorted(templates.items())))
    return rf"""
WITH t(rank, license, grams) AS (VALUES {rows}),
d AS (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS lines, coalesce(text, '') AS whole FROM documents),
s AS (
  SELECT rid, unnest(range(0, len(lines))) AS n, unnest(lines) AS x FROM d
  UNION ALL SELECT rid, -1, whole FROM d WHERE len(lines) > 1
), w AS (
  SELECT rid, n, list_filter(regexp_split_to_array(lower(x), '[^\p{{L}}\p{{Nd}}]+'), lambda v: v <> '') AS w FROM s
), b AS (
  SELECT rid, n, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM w
), m AS (
  SELECT rid, n, license, rank, 2.0 * len(list_intersect(b, grams)) / (len(b) + len(grams)) AS dice
  FROM b JOIN t ON 200 * len(list_intersect(b, grams)) >= (len(b) + len(grams)) * {percent}
), k AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY dice DESC, CASE WHEN n >= 0 THEN n ELSE 2147483647 END, rank) AS place,
    count(DISTINCT n) OVER (PARTITION BY rid) AS n_segments FROM m
)
SELECT doc_id, license, round(dice, 6) AS dice, CAST(n AS INTEGER) AS segment, CAST(coalesce(n_segments, 0) AS INTEGER) AS n_segments
FROM d LEFT JOIN (SELECT * FROM k WHERE place = 1) USING (rid)"""

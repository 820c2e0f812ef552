"""Row rules as named boolean Columns.

A rule set is an ordered list of ``(name, passes: Column)``;
:mod:`dwspark.operators.rejects` turns the same list into per-row reasons and per-rule counts, so a
rule is written once and drives the filter, the reject table and the counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def is_present(col: str | Column) -> Column:
    """not null and not the empty string."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (c != F.lit(""))


def required_rules(columns: Iterable[str]) -> list[Rule]:
    """one rule per required column, ``<col>_missing`` when null."""
    return [(f"{c}_missing", F.col(c).isNotNull()) for c in columns]


def range_rules(bounds: Sequence[tuple[str, str, float]]) -> list[Rule]:
    """``[(column, op, bound)]`` with op in ``>=, >, <=, <`` -> ``<col>_out_of_range`` rules.

    A null value is not judged here (the required rule owns it), so the rule passes on null."""
    ops = {">=": lambda c, b: c >= b, ">": lambda c, b: c > b, "<=": lambda c, b: c <= b, "<": lambda c, b: c < b}
    return [(f"{c}_out_of_range", F.coalesce(ops[op](F.col(c), F.lit(b)), F.lit(True))) for c, op, b in bounds]


# F5 offending-row predicates on cleaned values -------------------------------------------------
def bad_price(unit_price: str | Column, cost_price: str | Column) -> Column:
    """Negative unit or cost price, or cost above unit price."""
    u = F.col(unit_price) if isinstance(unit_price, str) else unit_price
    c = F.col(cost_price) if isinstance(cost_price, str) else cost_price
    return F.coalesce((u < 0) | (c < 0) | (c > u), F.lit(False))


def negative(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c < 0, F.lit(False))

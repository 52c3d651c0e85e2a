"""Measures: plain aggregates, slab (tiered) measures and per-unit measures.

All of them are ordinary Catalyst aggregate expressions, so a grouped
measure runs as partial aggregate -> shuffle on the group keys -> final
aggregate, and a global measure as partial -> single final row.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions.scalars import case_tier

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def col_or_expr(text: str) -> Column:
    """A column name (``c`` or ``t.c``) or, failing that, an SQL expression."""
    text = text.strip()
    return F.col(text) if _IDENT.match(text) else F.expr(text)


@dataclass
class Measure:
    kind: str = "agg"                 # agg | slab | flat
    alias: str = "metric"
    func: str = "COUNT"               # agg: COUNT SUM AVG MIN MAX COUNT_DISTINCT APPROX_COUNT_DISTINCT
    column: str = "*"
    slabs: list = field(default_factory=list)   # slab: [(min, max, value)] or dicts
    else_value: float = 0
    outer_func: str = "SUM"           # slab: SUM AVG MIN MAX
    per_unit: float = 0               # flat


_AGG = {
    "COUNT": F.count, "SUM": F.sum, "AVG": F.avg, "MEAN": F.avg, "MIN": F.min, "MAX": F.max,
    "COUNT_DISTINCT": F.count_distinct, "COUNT DISTINCT": F.count_distinct,
    "APPROX_COUNT_DISTINCT": F.approx_count_distinct,
}


def measure_column(m: Measure, column: Callable[[str], Column] = col_or_expr, only: Column | None = None) -> Column | None:
    """The aggregate Column for a measure, or None when the measure is unusable
    (a slab measure with no bounded slab).  ``column`` finds a column by the measure's text;
    with ``only`` the measure is of the rows for which that holds."""
    def of(value: Column) -> Column:
        return value if only is None else F.when(only, value)

    if m.kind == "agg":
        func = m.func.strip().upper()
        if func not in _AGG:
            raise ValueError(f"unknown aggregate {m.func!r}")
        if m.column.strip() == "*":
            if func != "COUNT":
                raise ValueError(f"{func}(*) is not defined; name a column")
            return F.count(of(F.lit(1))).alias(m.alias)
        return _AGG[func](of(column(m.column))).alias(m.alias)
    if m.kind == "slab":
        tier = case_tier(column(m.column), m.slabs, m.else_value)
        if tier is None:
            return None
        outer = m.outer_func.strip().upper()
        if outer not in ("SUM", "AVG", "MIN", "MAX"):
            raise ValueError(f"unknown slab aggregate {m.outer_func!r}")
        return _AGG[outer](of(tier)).alias(m.alias)
    if m.kind == "flat":
        counted = F.count(of(F.lit(1) if m.column.strip() == "*" else column(m.column)))
        return (counted * F.lit(m.per_unit)).alias(m.alias)
    raise ValueError(f"unknown measure kind {m.kind!r}")


def flat_rate(predicate: Column, rate, alias: str) -> Column:
    """``count_if(predicate) * rate`` -- a per-unit payout."""
    return (F.count_if(predicate) * F.lit(rate)).alias(alias)


def case_sum(predicate: Column, then_value, else_value, alias: str) -> Column:
    """``SUM(CASE WHEN predicate THEN a ELSE b END)``."""
    return F.sum(F.when(predicate, F.lit(then_value)).otherwise(F.lit(else_value))).alias(alias)

"""Spec -> DataFrame: base table, star joins, filter, group-by and measures.

No SQL text is generated; the spec is turned straight into DataFrame
operations, so names never need quoting and Catalyst sees one plan (the
filter is pushed below the joins and into the Parquet scans, unused columns
are pruned).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kpiloom.operators.joins import JoinSpec, join_type, star_join
from kpiloom.operators.measures import Measure, col_or_expr, measure_column


@dataclass
class BuildSpec:
    base: str | None
    joins: list[JoinSpec] = field(default_factory=list)
    group_by: list[str] = field(default_factory=list)
    measures: list[Measure] = field(default_factory=list)
    where: str = ""


def _joined(spec: BuildSpec, tables: dict[str, DataFrame]) -> tuple[DataFrame, dict[tuple[str, str], str], dict[str, str]]:
    """The star join under unique column names, with the name of each (table, column) and of each merged ``USING`` key.

    A ``USING`` key is the base's value or, where only the joined table has the row, that one's."""
    def own(df: DataFrame, name: str, no: int) -> DataFrame:
        at.update({(name, c): f"_{no}_{i}" for i, c in enumerate(df.columns)})
        return df.toDF(*[f"_{no}_{i}" for i in range(len(df.columns))])

    at: dict[tuple[str, str], str] = {}
    merged: dict[str, str] = {}
    out = own(tables[spec.base], spec.base, 0)
    for no, s in enumerate((s for s in spec.joins if s.complete), 1):
        before = dict(at)
        right, how = own(tables[s.right_table], s.right_table, no), join_type(s.how)
        using = s.left_key == s.right_key
        left_key = merged.get(s.left_key) if using else None
        left_key, right_key = left_key or before[spec.base, s.left_key], at[s.right_table, s.right_key]
        out = out.join(right, F.col(left_key) == F.col(right_key), how)
        if using:
            merged[s.left_key] = f"_k{no}"
            out = out.withColumn(f"_k{no}", F.coalesce(left_key, right_key))
    return out, at, merged


def _named(df: DataFrame, at: dict[tuple[str, str], str], merged: dict[str, str]) -> DataFrame:
    """Bare names (a merged key, else the base's column, else the first table's that has it), and each table as a struct, so
    that ``t.c`` in any expression is its column.  The optimizer takes the structs apart: only columns in use are read.
    A table named like one of the columns has no struct; its columns go by their bare names."""
    bare = {k.lower(): (k, v) for k, v in merged.items()}
    for (_, c), name in at.items():
        bare.setdefault(c.lower(), (c, name))
    fields: dict[str, list] = {}
    for (t, c), name in at.items():
        fields.setdefault(t, []).append(F.col(name).alias(c))
    return df.select(*[F.col(name).alias(c) for c, name in bare.values()],
                     *[F.struct(*cols).alias(t) for t, cols in fields.items() if t.lower() not in bare])


def _column(name: str, df: DataFrame) -> Column:
    """A column by its exact name, whatever characters it holds, else ``t.c`` or an expression."""
    if name.strip().lower() in {c.lower() for c in df.columns}:
        return F.col(f"`{name.strip()}`")
    table, _, column = name.strip().partition(".")
    kept = {c.lower(): df.schema[c].dataType for c in df.columns}.get(table.lower())
    if isinstance(kept, StructType) and column.lower() in {f.lower() for f in kept.names}:
        return F.col(f"`{table}`.`{column}`")
    return col_or_expr(name)


def build(spec: BuildSpec, tables: dict[str, DataFrame]) -> DataFrame:
    if not spec.base:
        raise ValueError("the spec has no base table")
    if not spec.group_by and not spec.measures:
        df = star_join(tables[spec.base], spec.base, spec.joins, tables)
        return (df.where(F.expr(spec.where.strip())) if spec.where and spec.where.strip() else df).select("*")
    df = _named(*_joined(spec, tables))
    if spec.where and spec.where.strip():
        df = df.where(F.expr(spec.where.strip()))
    keys = [_column(g, df).alias(g if g in df.columns else g.partition(".")[2] or g) for g in spec.group_by]
    aggs = [c for c in (measure_column(m, lambda name: _column(name, df)) for m in spec.measures) if c is not None]
    if keys and aggs:
        return df.groupBy(*keys).agg(*aggs)
    if aggs:
        return df.agg(*aggs)
    if keys:
        return df.select(*keys).distinct()
    return df.select("*")

"""Row search: keep rows whose text matches a pattern (case-insensitive)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.scalars import any_of, contains_ci


def search_any(df: DataFrame, pattern: str | None, literal: bool = False) -> DataFrame:
    """Rows where any column's text matches ``pattern``; blank pattern = all rows.

    A single filter with an OR of ``rlike`` tests; it runs in the scan stage,
    so it is a narrow transformation (no shuffle) at any size.
    """
    if pattern is None or not pattern.strip():
        return df
    return df.where(any_of(contains_ci(F.col(f"`{c}`"), pattern, literal) for c in df.columns))


def search_col(df: DataFrame, column: str, pattern: str | None, literal: bool = False) -> DataFrame:
    """Rows whose ``column`` matches ``pattern``; blank pattern = all rows."""
    if pattern is None or not pattern.strip():
        return df
    return df.where(contains_ci(F.col(f"`{column}`"), pattern, literal))


def search_summary(df: DataFrame, column: str, pattern: str | None, total_col: str,
                   literal: bool = False) -> DataFrame:
    """Count and total of the rows matched by :func:`search_col` (one row)."""
    hits = search_col(df, column, pattern, literal)
    return hits.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.coalesce(F.sum(total_col), F.lit(0.0)).cast("double").alias("total"))

"""Row filters and projections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def where_equal(df: DataFrame, **equals) -> DataFrame:
    """Conjunction of equality predicates (pushed into the Parquet scan)."""
    cond = None
    for k, v in equals.items():
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def between_days(df: DataFrame, ts_col: str, first: str | dt.date, last: str | dt.date) -> DataFrame:
    """``date(ts) BETWEEN first AND last`` (inclusive days).

    Written as a half-open timestamp range so the comparison is on the raw
    column and reaches the Parquet scan as a pushed filter (row groups
    outside the range are skipped).
    """
    lo = F.to_timestamp(F.lit(str(first)))
    hi = F.to_timestamp(F.date_add(F.lit(str(last)).cast("date"), 1))
    c = F.col(ts_col)
    if dict(df.dtypes).get(ts_col) == "timestamp_ntz":
        lo, hi = lo.cast("timestamp_ntz"), hi.cast("timestamp_ntz")
    return df.where((c >= lo) & (c < hi))


def rolling_days(df: DataFrame, ts_col: str, days: int = 30, anchor: str | dt.date | None = None) -> DataFrame:
    """Rows whose day is within ``days`` days before the anchor day (inclusive).

    The anchor defaults to the latest day in the data (one aggregate job, one
    value) so reruns give the same rows -- unlike ``CURRENT_DATE``.  It enters
    the filter as a value compared with the raw column, so the bound reaches
    the Parquet scan.
    """
    c = F.col(f"`{ts_col}`")
    if anchor is None:
        anchor = df.agg(F.max(F.to_date(c))).first()[0]
        if anchor is None:                 # no time at all: nothing is within the window
            return df.where(F.lit(False))
    first = dt.date.fromisoformat(str(anchor)) - dt.timedelta(days=days)
    return df.where(c >= F.lit(str(first)).cast(df.schema[ts_col].dataType))


def where_text(df: DataFrame, predicate: str | None) -> DataFrame:
    """User predicate text as a filter; blank = no filter."""
    if predicate is None or not predicate.strip():
        return df
    return df.where(F.expr(predicate.strip()))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; blank names and resulting duplicates are refused, unchanged names ignored."""
    changes = {k: v.strip() for k, v in mapping.items() if v is not None and v.strip() != k}
    if any(not v for v in changes.values()):
        raise ValueError("column names cannot be blank")
    missing = [k for k in changes if k not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    final = [changes.get(c, c) for c in df.columns]
    dupes = sorted({c for c in final if final.count(c) > 1})
    if dupes:
        raise ValueError(f"duplicate column names after rename: {dupes}")
    return df.withColumnsRenamed(changes) if changes else df


def pick_two(df: DataFrame, key_col: str, val_col: str, key_name: str, val_name: str) -> DataFrame:
    """Keep two columns and name them by position."""
    return df.select(F.col(f"`{key_col}`").alias(key_name), F.col(f"`{val_col}`").alias(val_name))


def union_positional(df: DataFrame, other: DataFrame) -> DataFrame:
    """``UNION ALL`` by position (column names of ``df`` win)."""
    if len(df.columns) != len(other.columns):
        raise ValueError("positional union needs the same number of columns")
    return df.union(other)

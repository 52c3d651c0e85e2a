"""Sheets as SQL tables: name variants, KPI SQL evaluation with error capture."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession


def view_names(sheet: str) -> list[str]:
    """The names a statement can use: the sheet's own, in back-ticks if it is not a plain word, and its word form
    (every other character as ``_``).  Spark compares names without case, so no lower-case form is needed."""
    word = re.sub(r"\W", "_", sheet, flags=re.ASCII)
    return [sheet] if word == sheet else [sheet, word]


def register_sheets(sheets: dict[str, DataFrame | None]) -> list[str]:
    """Register every sheet that holds data as temp views (lazy: nothing is read); returns the names.

    Two sheets that would share a view name are refused."""
    owner: dict[str, str] = {}
    for name, df in sheets.items():
        if df is None:
            continue
        for v in view_names(name):
            if owner.setdefault(v.lower(), name) != name:
                raise ValueError(f"sheets {owner[v.lower()]!r} and {name!r} share the name {v!r}")
    if not owner:
        raise ValueError("no sheet holds data; nothing to query")
    names = []
    for name, df in sheets.items():
        for v in view_names(name) if df is not None else []:
            df.createOrReplaceTempView("`" + v.replace("`", "``") + "`")
            names.append(v)
    return names


def drop_sheets(spark: SparkSession, sheets: list[str]) -> None:
    for name in sheets:
        for v in view_names(name):
            spark.catalog.dropTempView(v)


def run_sql(spark: SparkSession, sql: str, args: dict | None = None):
    """``(df, error)``: analysis/parse errors are returned, never raised.

    ``spark.sql`` analyses eagerly, so an unknown table or column is caught
    here without running a job; ``args`` are bound as named parameters.
    """
    try:
        return (spark.sql(sql, args=args) if args else spark.sql(sql)), None
    except (AnalysisException, ParseException) as e:
        msg = str(e).strip().splitlines()[0]
        if isinstance(e, ParseException) and re.search(r"(?i)\bqualify\b", sql):
            msg += " | Spark SQL has no QUALIFY: rank in a sub-select and filter it outside"
        return None, msg


def run_kpi(spark: SparkSession, sql: str, sheets: dict[str, DataFrame | None]):
    """KPI = SQL over the sheets.  On a missing table the error lists the available ones."""
    available = register_sheets(sheets)
    df, err = run_sql(spark, sql)
    if err and ("TABLE_OR_VIEW_NOT_FOUND" in err or "not found" in err.lower()):
        err = f"{err} | available tables: {', '.join(sorted(set(available)))}"
    return df, err

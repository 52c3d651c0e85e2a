"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


STRICT = os.environ.get("KPILOOM_STRICT_FLOATS") == "1"


def same(a, b) -> bool:
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        try:
            if STRICT:
                return float(a) == float(b)
            return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)
        except TypeError:
            return False
    return a == b


def sort_key(row):
    return tuple((0, "") if v is None else (1, repr(round(v, 6)) if isinstance(v, float) else repr(v)) for v in row)


def compare(spark_cols, spark_rows, duck_cols, duck_rows) -> list[str]:
    """Problems found (empty list = equal): column names, row count, values."""
    srows = [tuple(norm(v) for v in r) for r in spark_rows]
    drows = [tuple(norm(v) for v in r) for r in duck_rows]
    if sorted(spark_cols) != sorted(duck_cols):
        return [f"columns spark={list(spark_cols)} duck={list(duck_cols)}"]
    order = [list(duck_cols).index(c) for c in spark_cols]
    drows = [tuple(r[i] for i in order) for r in drows]
    if len(srows) != len(drows):
        return [f"rows spark={len(srows)} duck={len(drows)}"]
    a, b = sorted(srows, key=sort_key), sorted(drows, key=sort_key)
    diffs = [(x, y) for x, y in zip(a, b) if not all(same(p, q) for p, q in zip(x, y))]
    if diffs:
        return [f"{len(diffs)} differing rows, e.g. spark={diffs[0][0]} duck={diffs[0][1]}"]
    return []


def duck_views(con, sf_dir: str) -> None:
    from kpiloom.sources.tables import TABLES, table_path
    for t in TABLES:
        if os.path.exists(table_path(sf_dir, t)):      # scaled copies may hold a subset of the tables
            con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_problems(spark_dtypes, duck_cols, duck_types) -> list[str]:
    """Column type mismatches (Spark dtype name vs DuckDB type)."""
    duck = {c: str(t) for c, t in zip(duck_cols, duck_types)}
    out = []
    for c, t in spark_dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        if c in duck and duck[c] != want:
            out.append(f"{c}: spark {t} vs duck {duck[c]}")
    return out

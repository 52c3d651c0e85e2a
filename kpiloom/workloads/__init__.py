"""Registered report queries over the test tables.

Each entry is ``name -> (fn(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
The SQL is an independent statement of the same result in ANSI SQL (DuckDB
dialect) over views named after the tables; it is the correctness oracle.
"""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Callable, str | None]]:
    # Import for side effects: each module registers its queries.
    from kpiloom.workloads import (  # noqa: F401
        core, io, jobs, measures, relational, rules, scalars,
    )
    return REGISTRY


# Output hygiene shared by the registered queries: results leave as plain
# double / bigint / string columns so both engines hand back the same types.
def to_doubles(df):
    from pyspark.sql import functions as F
    from pyspark.sql.types import DecimalType
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def as_double(df, *cols):
    """Integer columns that can hold nulls leave as doubles: pandas turns a
    nullable integer column into float64 on one side and Int64 on the other."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def day_text(c):
    """Date -> 'yyyy-MM-dd' text (SQL side: strftime(c, '%Y-%m-%d'))."""
    from pyspark.sql import functions as F
    return F.date_format(c, "yyyy-MM-dd")


def ts_text(c):
    """Timestamp -> 'yyyy-MM-dd HH:mm:ss.SSSSSS' text (SQL: strftime(c, '%Y-%m-%d %H:%M:%S.%f'))."""
    from pyspark.sql import functions as F
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")

"""Latest row(s) per key -- ``DENSE_RANK() OVER (PARTITION BY k ORDER BY t DESC) = 1``.

Spark plans the rank filter as a partial group limit before the shuffle: every
map task keeps only the rows tied on its latest time of a key, so a key with a
third of the table sends a few rows per task, in one scan and one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | list[str], order_col: str, keep_ties: bool = True,
                   where=None) -> DataFrame:
    """Rows holding the maximum ``order_col`` of their key (ties kept).

    ``where`` filters before ranking (e.g. ``rating IS NOT NULL``).  Null keys
    are one key; a null ``order_col`` comes last, so it is kept only for keys
    that have no other.  With ``keep_ties=False`` exactly one
    row per key is returned -- among tied rows the largest by the remaining
    columns -- in a single pass: ``max(struct(order_col, *others))`` is an
    ordinary partial aggregate, so the input is read once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    src = df if where is None else df.where(where)
    if not keep_ties:
        others = [c for c in src.columns if c not in keys and c != order_col]
        picked = src.groupBy(*keys).agg(F.max(F.struct(order_col, *others)).alias("_r"))
        return picked.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in src.columns])
    latest = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_last()))
    return src.withColumn("_rank", latest).where("_rank = 1").drop("_rank")

"""Sorting, top-k, positions and pages.

* ``top_n`` / shallow ``page``: ``orderBy(...).limit`` plans as
  TakeOrderedAndProject -- every task keeps only its best ``offset + n`` rows,
  so the driver merges at most ``tasks * (offset + n)`` rows.
* ``with_position`` numbers a whole sorted table without the single-partition
  window that ``row_number() OVER (ORDER BY ...)`` would need: the table is
  range-partitioned by the sort, each partition's row count gives a prefix
  offset (one row per partition, so that table is bounded by the partition
  count), and each row adds its index inside its partition.
* ``page(by_position=True)`` uses ``with_position`` instead of a huge ``offset``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.session import checkpoint_dir

PAGE_SIZE = 500


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Add a 1-based position in ``order`` (which must be a total order)."""
    ranked = (df.orderBy(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    # Fix partition contents (and thus ids) before they are counted and used
    # twice; a reliable checkpoint (shared folder, survives executor loss)
    # also cuts the lineage.
    checkpoint_dir(df.sparkSession)
    ranked = ranked.checkpoint(eager=True)
    counts = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = (ranked.join(F.broadcast(offsets), "_pid")
                 .withColumn(name, F.col("_off") + local + F.lit(1))
                 .drop("_pid", "_mid", "_off"))
    return out


def page(df: DataFrame, order: list[Column], page_no: int, size: int = PAGE_SIZE, by_position: bool = False) -> DataFrame:
    """Rows of page ``page_no`` (1-based) in ``order``.

    By offset and limit every task keeps its first ``page_no * size`` rows: right for the first pages.  With
    ``by_position`` the sorted table is numbered and the page cut out, at a cost that does not grow with its depth."""
    if page_no < 1:
        raise ValueError("page numbers start at 1")
    skip = (page_no - 1) * size
    if not by_position:
        return df.orderBy(*order).offset(skip).limit(size)
    pos = with_position(df, order, "_pos")
    return pos.where((F.col("_pos") > skip) & (F.col("_pos") <= skip + size)).orderBy("_pos").drop("_pos")


def page_count(n_rows: int, size: int = PAGE_SIZE) -> int:
    """Number of pages for ``n_rows`` rows (at least one)."""
    return max(1, (n_rows - 1) // size + 1)


def page_after(df: DataFrame, order_cols: list[str], last: tuple | None, size: int = PAGE_SIZE,
               descending: list[bool] | None = None) -> DataFrame:
    """Keyset ("seek") page: the ``size`` rows that follow ``last`` in the order.

    Cost is independent of the depth of the page.
    """
    descending = descending or [False] * len(order_cols)
    order = [F.col(c).desc() if d else F.col(c).asc() for c, d in zip(order_cols, descending)]
    if last is None:
        return df.orderBy(*order).limit(size)
    cond = None
    # (a, b, c) after (x, y, z)  <=>  a>x or (a=x and (b>y or (b=y and c>z)))
    for i in range(len(order_cols) - 1, -1, -1):
        c, d, v = F.col(order_cols[i]), descending[i], F.lit(last[i])
        beyond = (c < v) if d else (c > v)
        cond = beyond if cond is None else (beyond | ((c == v) & cond))
    return df.where(cond).orderBy(*order).limit(size)


def domain_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a column."""
    return df.select(column).distinct().orderBy(column)

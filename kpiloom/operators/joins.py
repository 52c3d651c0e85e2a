"""Equi-joins driven by small specs, star joins, and the slab range join.

Broadcast policy: nothing is hinted.  Joins are left to the planner: a side
measured below ``spark.sql.autoBroadcastJoinThreshold`` (at run time, with AQE)
is broadcast, otherwise it stays a shuffled sort-merge join, and skewed
partitions are split (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

JOIN_TYPES = {
    "left": "left", "left join": "left", "left outer join": "left",
    "inner": "inner", "inner join": "inner", "join": "inner",
    "right": "right", "right join": "right", "right outer join": "right",
    "full": "full", "full join": "full", "full outer join": "full", "outer": "full",
}


def join_type(text: str | None) -> str:
    """``LEFT JOIN`` / ``left`` / ... -> Spark join type (default left)."""
    key = (text or "left").strip().lower()
    if key not in JOIN_TYPES:
        raise ValueError(f"unsupported join type {text!r}")
    return JOIN_TYPES[key]


@dataclass(frozen=True)
class JoinSpec:
    right_table: str | None
    left_key: str | None
    right_key: str | None
    how: str = "left"

    @property
    def complete(self) -> bool:
        return bool(self.right_table and self.left_key and self.right_key)


def join_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left") -> DataFrame:
    """Same key name -> ``USING`` (one merged key column, coalesced for full
    joins); different names -> ``ON l = r`` with both columns kept."""
    how = join_type(how)
    if left_key == right_key:
        return left.join(right, on=left_key, how=how)
    # aliases, so that a table can be joined with itself
    return left.alias("_l").join(right.alias("_r"), F.col(f"_l.`{left_key}`") == F.col(f"_r.`{right_key}`"), how)


def star_join(base: DataFrame, base_name: str, specs: list[JoinSpec], tables: dict[str, DataFrame]) -> DataFrame:
    """Each spec joins one table to the *base* table's key (no chaining);
    incomplete specs are skipped.  Columns stay addressable as ``table.col``."""
    out = base.alias(base_name)
    for s in specs:
        if not s.complete:
            continue
        right = tables[s.right_table].alias(s.right_table)
        how = join_type(s.how)
        if s.left_key == s.right_key:
            out = out.join(right, on=s.left_key, how=how)
        else:
            out = out.join(right, on=F.col(f"{base_name}.{s.left_key}") == F.col(f"{s.right_table}.{s.right_key}"),
                           how=how)
    return out


def slab_segments(slabs: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Overlapping slabs (keys, _lo, _hi, _amt) -> disjoint segments (keys, _lo, _lo_open, _hi, _hi_open, _amt).

    A sweep over the slabs' ends: the ends of a group, in order, and the gaps between them are its cells; a slab lies on the
    cells from its lower to its upper end, each cell goes to the first slab by ``order`` that lies on it, and neighbouring
    cells of one slab make one segment.  Slabs that do not overlap come out as they are.  Rows: one per slab and cell on the
    way, so what grows is how deep slabs lie on each other.
    """
    ends = F.array_sort(F.filter(F.array_distinct(F.flatten(F.collect_list(F.array("_lo", "_hi")).over(Window.partitionBy(*keys, F.lit(0))))), lambda x: x.isNotNull()))
    whole = slabs.select(*keys, "_lo", "_hi", F.struct(order, "_lo", "_hi", "_amt").alias("_own")).withColumn("_ends", ends)
    # cells: 2i is the i-th end itself (from 1), odd ones the gaps around it
    first = F.when(F.col("_lo").isNull(), 1).otherwise(2 * F.array_position("_ends", F.col("_lo")))
    last = F.when(F.col("_hi").isNull(), 2 * F.size("_ends") + 1).otherwise(2 * F.array_position("_ends", F.col("_hi")))
    cells = whole.select(*keys, "_own", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("_cell"))
    owned = cells.groupBy(*keys, "_cell").agg(F.min("_own").alias("_own"))
    run = Window.partitionBy(*keys, "_own").orderBy("_cell")
    runs = owned.withColumn("_run", F.col("_cell") - F.row_number().over(run))
    merged = runs.groupBy(*keys, "_own", "_run").agg(F.min("_cell").alias("_from"), F.max("_cell").alias("_to"))
    lists = whole.groupBy(*keys).agg(F.first("_ends").alias("_ends"))
    merged = merged.join(lists, keys) if keys else merged.withColumn("_ends", lists.select("_ends").scalar())
    # the end a segment starts at or after, and the one it stops at or before; beyond the outer ends there is none
    lo, hi = F.expr("get(_ends, _from div 2 - 1)"), F.expr("get(_ends, (_to + 1) div 2 - 1)")
    return merged.select(*keys, F.when(F.col("_from") > 1, lo).alias("_lo"), (F.col("_from") % 2 == 1).alias("_lo_open"),
                         hi.alias("_hi"), (F.col("_to") % 2 == 1).alias("_hi_open"), F.col("_own._amt").alias("_amt"))


def slab_join(values: DataFrame, value_col: str, slabs: DataFrame, lo: str = "lo", hi: str = "hi",
              amount: str = "amount", else_value=0, on: list[tuple[str, str]] | None = None,
              out_col: str | None = None, order: str | None = None) -> DataFrame:
    """Attach to each row the amount of the first slab whose ``[lo, hi]`` holds
    ``value_col`` (null bound = open); no slab -> ``else_value``.  Slabs may
    overlap or nest: the first by the column ``order`` (the sheet's order) wins,
    without one that which begins lower, then ends lower.  ``on`` adds equality
    conditions (e.g. the region class).  One row per value.

    A short list of slabs that the driver holds needs no join:
    :func:`kpiloom.functions.scalars.case_tier` gives the same amounts.  Here
    slabs are a table of any size.  They are cut into disjoint segments
    (:func:`slab_segments`); the span between a group's lowest and highest bound
    is cut into four buckets per segment, segments are repeated for the buckets
    they touch (at most six rows each on average), and values meet them by an
    equality join on (``on`` keys, bucket) with the range check on top.  Values
    beyond the outer bounds fall into the outer buckets, so an open slab needs
    no more rows and the values are not scanned beforehand.  A small slab table
    is broadcast by the planner itself.
    """
    out_col = out_col or amount
    on = on or []
    keys = [f"_on{i}" for i in range(len(on))]
    low, high = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    place = F.col(f"`{order}`") if order else F.lit(0)
    bound = slabs.select(F.coalesce(F.col(f"`{lo}`"), F.col(f"`{hi}`")).alias("b")).schema["b"].dataType  # both ends in one type
    s = slabs.select(*[F.col(f"`{r}`").alias(k) for k, (_, r) in zip(keys, on)], F.col(f"`{lo}`").cast(bound).alias("_lo"),
                     F.col(f"`{hi}`").cast(bound).alias("_hi"), F.col(f"`{amount}`").alias("_amt"), place.alias("_place"))
    s = s.where("_lo is null or _hi is null or _lo <= _hi")
    for k in keys:  # a null key meets no value
        s = s.where(F.col(k).isNotNull())
    s = slab_segments(s, keys, F.col("_place"))
    zero = F.lit(0.0)
    group = Window.partitionBy(*keys, F.lit(0))
    first, last, n = (F.coalesce(F.min(F.least(low, high)).over(group), zero), F.coalesce(F.max(F.greatest(low, high)).over(group), zero),
                      F.count(F.lit(1)).over(group))
    s = s.withColumns({"_first": first, "_last": last}).withColumn(
        "_width", F.coalesce(F.when(F.col("_last") > F.col("_first"), (F.col("_last") - F.col("_first")) / (4 * n)), F.lit(1.0)))
    span = s.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("_first", "_last", "_width")])

    def measured(df: DataFrame) -> DataFrame:
        if keys:
            return df.join(span, keys, "left")
        return df.withColumn("_span", span.select(F.struct("*")).scalar()).select(*df.columns, "_span.*")

    def bucket(x: Column) -> Column:
        inside = F.least(F.greatest(x, F.col("_first")), F.col("_last"))
        return F.when(x.isNotNull(), F.floor((inside - F.col("_first")) / F.col("_width")))

    ends = F.sequence(bucket(F.coalesce(low, F.col("_first"))), bucket(F.coalesce(high, F.col("_last"))))
    pieces = s.select(*keys, "_lo", "_lo_open", "_hi", "_hi_open", "_amt", F.explode(ends).alias("_b"))
    held = values.withColumns({k: F.col(f"`{v}`") for k, (v, _) in zip(keys, on)}) if keys else values
    held = measured(held).withColumn("_b", bucket(F.col(f"`{value_col}`").cast("double"))).alias("_v")
    x = F.col(f"_v.`{value_col}`")
    cond = F.col("_v._b") == F.col("_s._b")
    for k in keys:
        cond = cond & (F.col(f"_v.{k}") == F.col(f"_s.{k}"))
    above, below = F.col("_s._lo"), F.col("_s._hi")
    cond = cond & (above.isNull() | (x > above) | ((x == above) & ~F.col("_lo_open")))
    cond = cond & (below.isNull() | (x < below) | ((x == below) & ~F.col("_hi_open")))
    joined = held.join(pieces.alias("_s"), cond, "left")
    return joined.select(*[F.col(f"_v.`{c}`") for c in values.columns],
                         F.coalesce(F.col("_amt"), F.lit(else_value)).alias(out_col))


def full_merge(tables: list[DataFrame], key: str) -> DataFrame:
    """N-way FULL OUTER merge on a key of which each table has one row at most: every key of any table, nulls where a table lacks it.

    One union and one grouping instead of a chain of joins, each of which would shuffle again because the merged key is a
    new column.  Value columns need different names; a null key is a key like any other here, and meets the other tables' null
    keys.  A key that a table repeats is an error when the merge runs, because joins would multiply its rows.
    """
    values = [[c for c in t.columns if c != key] for t in tables]
    names = [c for own in values for c in own]
    if len({n.lower() for n in [key, *names]}) != len(names) + 1:
        raise ValueError(f"value columns need names of their own: {names}")
    kinds = {f.name: f.dataType for t in tables for f in t.schema.fields}

    def lifted(i: int, t: DataFrame) -> DataFrame:
        own = set(values[i])
        return t.select(F.col(f"`{key}`"), F.lit(i).alias("__from"), *[(F.col(f"`{c}`") if c in own else F.lit(None).cast(kinds[c])).alias(c) for c in names])

    rows = reduce(DataFrame.unionByName, [lifted(i, t) for i, t in enumerate(tables)])
    counts = [F.count_if(F.col("__from") == i).alias(f"__n{i}") for i in range(len(tables))]
    merged = rows.groupBy(f"`{key}`").agg(*[F.any_value(F.col(f"`{c}`"), True).alias(c) for c in names], *counts)
    once = F.assert_true(F.greatest(*[F.col(f"__n{i}") for i in range(len(tables))], F.lit(0)) <= 1, F.lit("full_merge: a table repeats a key"))
    return merged.where(once.isNull()).select(F.col(f"`{key}`"), *[F.col(f"`{c}`") for c in names])

"""Facet cube: every choice of a dashboard's facets from one pass over its facts.

``build_cube`` groups the facts by all subsets of the dimensions in one aggregate (``CUBE``) and writes the cells by level, so
a choice reads the cells of one level.  A level is the sorted names of the dimensions that are not ``All``.  The states are
sums, so cubes of parts of the facts merge by adding cells (``merge_cubes``): rows that arrive later need no second
scan of the earlier ones.

Empty or missing values of a dimension are its ``Unknown`` cell.  A choice that no fact holds gives what the direct query over
no rows gives.  Cells number at most the product of the dimensions' sizes plus their margins, and never more than facts times
levels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.scalars import unknown
from kpiloom.operators.dashboard import ALL, ratio_text

LEVEL = "level"


def cells(facts: DataFrame, dims: list[str], sums: list[str]) -> DataFrame:
    """(level, dims, sums): one row for every combination of values, of any subset of the dimensions, that a fact holds."""
    if LEVEL in [*dims, *sums]:
        raise ValueError(f"a column of the facts is named {LEVEL}")
    src = facts.select(*[unknown(F.col(f"`{d}`").cast("string")).alias(d) for d in dims], *[F.col(f"`{s}`").alias(s) for s in sums])
    keys = [F.col(f"`{d}`") for d in dims]
    # grouping() is 1 where the dimension is summed over; asked for before the keys of other levels become null
    level = F.concat_ws(",", *[F.when(F.grouping(F.col(f"`{d}`")) == 0, F.lit(d)) for d in sorted(dims)])
    out = src.cube(*keys).agg(level.alias(LEVEL), *[F.coalesce(F.sum(f"`{s}`"), F.lit(0)).cast("bigint").alias(s) for s in sums])
    return out.select(LEVEL, *keys, *[f"`{s}`" for s in sums])


def build_cube(facts: DataFrame, path: str, dims: list[str] = ("month", "channel"), sums: list[str] = ("si", "insp")) -> "FacetCube":
    dims, sums = list(dims), list(sums)
    cells(facts, dims, sums).write.partitionBy(LEVEL).parquet(path)
    return FacetCube(facts.sparkSession, path, dims, sums)


def merge_cubes(path: str, *cubes: "FacetCube") -> "FacetCube":
    """The cube of all facts of the given cubes (of the same dimensions and sums), written below ``path``."""
    first = cubes[0]
    if any((sorted(c.dims), sorted(c.sums)) != (sorted(first.dims), sorted(first.sums)) for c in cubes):
        raise ValueError("the cubes differ in their dimensions or sums")
    rows = first.cells()
    for c in cubes[1:]:
        rows = rows.unionByName(c.cells())
    keys = [LEVEL, *first.dims]
    merged = rows.groupBy(*[f"`{k}`" for k in keys]).agg(*[F.sum(f"`{s}`").cast("bigint").alias(s) for s in first.sums])
    merged.write.partitionBy(LEVEL).parquet(path)
    return FacetCube(first.spark, path, first.dims, first.sums)


@dataclass
class FacetCube:
    spark: SparkSession
    path: str
    dims: list[str]
    sums: list[str]

    def cells(self) -> DataFrame:
        # the schema is known, so no job looks for it and an empty cube still has its columns
        fields = [*[f"`{d}` string" for d in self.dims], *[f"`{s}` bigint" for s in self.sums], f"{LEVEL} string"]
        # the level of all facts is the empty text, which a folder name holds as null
        return self.spark.read.schema(", ".join(fields)).parquet(self.path).withColumn(LEVEL, F.coalesce(LEVEL, F.lit("")))

    def level(self, *dims: str) -> DataFrame:
        """The cells grouped by these dimensions; only their folder is read."""
        name = ",".join(sorted(dims))
        stored = self.spark.read.schema(", ".join([*[f"`{d}` string" for d in self.dims], *[f"`{s}` bigint" for s in self.sums],
                                                   f"{LEVEL} string"])).parquet(self.path)
        own = stored.where(F.col(LEVEL) == name) if name else stored.where(F.col(LEVEL).isNull())
        return own.select(*[f"`{d}`" for d in dims], *[f"`{s}`" for s in self.sums])

    def _choice(self, choice: dict[str, str], *free: str) -> DataFrame:
        """Cells by the free dimensions (and those chosen), with the chosen values."""
        unheard = set(choice) - set(self.dims)
        if unheard:
            raise ValueError(f"no dimension {sorted(unheard)}; there are {self.dims}")
        fixed = {d: v for d, v in choice.items() if v != ALL}
        out = self.level(*dict.fromkeys([*free, *fixed]))
        for d, v in fixed.items():
            out = out.where(F.col(f"`{d}`") == v)
        return out

    def totals(self, count: str = "channel", **choice: str) -> DataFrame:
        """One row for a choice: the sums, the ratio text of the first two, and how many values of ``count`` there are."""
        by = self._choice(choice, count)
        agg = by.agg(*[F.coalesce(F.sum(f"`{s}`"), F.lit(0)).cast("bigint").alias(f"total_{s}") for s in self.sums],
                     F.count(F.lit(1)).alias(f"{count}_count"))
        a, b = self.sums[:2]
        return agg.select(*[f"`total_{s}`" for s in self.sums], ratio_text(F.col(f"`total_{a}`"), F.col(f"`total_{b}`")).alias(f"{a}_ratio"),
                          f"`{count}_count`")

    def by(self, dim: str, **choice: str) -> DataFrame:
        """The sums by the values of a dimension, the first sum descending, the value as tie-break."""
        return self._choice(choice, dim).select(f"`{dim}`", *[f"`{s}`" for s in self.sums]).orderBy(F.col(f"`{self.sums[0]}`").desc(), F.col(f"`{dim}`"))

    def values(self) -> DataFrame:
        """(domain, value): the choices of every dimension."""
        out = None
        for d in self.dims:
            one = self.level(d).select(F.lit(d).alias("domain"), F.col(f"`{d}`").alias("value"))
            out = one if out is None else out.unionByName(one)
        return out.orderBy("domain", "value")

    def every_choice(self, count: str = "channel") -> DataFrame:
        """``totals`` of all choices that a fact holds, ``All`` included: a row for each, with the chosen values first."""
        out = None
        for bits in range(1 << len(self.dims)):
            fixed = [d for i, d in enumerate(self.dims) if bits >> i & 1]
            by = self.level(*dict.fromkeys([*fixed, count])).groupBy(*[f"`{d}`" for d in fixed]).agg(
                *[F.sum(f"`{s}`").cast("bigint").alias(f"total_{s}") for s in self.sums], F.count(F.lit(1)).alias(f"{count}_count"))
            one = by.select(*[(F.col(f"`{d}`") if d in fixed else F.lit(ALL)).alias(d) for d in self.dims],
                            *[f"`total_{s}`" for s in self.sums], f"`{count}_count`")
            out = one if out is None else out.unionByName(one)
        a, b = self.sums[:2]
        return out.withColumn(f"{a}_ratio", ratio_text(F.col(f"`total_{a}`"), F.col(f"`total_{b}`")))

"""Stored order of a sheet: pages by position from the rows of one range.

``build_order`` sorts a sheet once, by range partitioning (Spark's own quantile splitters), writes each range to a folder of
its own and beside them a table of ranges with their exact counts, first positions and first rows.  A page looks up the ranges that
hold its positions and sorts only their rows.  The cost of a page depends neither on its depth nor on the size of the sheet.

Rows that tie in the order are told apart by a hash of all their columns and, where whole rows repeat, by a number given
when they are stored: one value (or one row) that fills a third of the sheet is cut into ranges like any other, and pages
neither repeat nor lose rows.  Nulls come first in ascending and last in descending columns, as in Spark's ``orderBy``.

``add`` puts further rows into the ranges that exist, by the first rows of the ranges, without touching what is stored; ranges
grow by it, and ``rebuild`` evens them out in a new folder.  A generation counts once its table of ranges is written, so a job that fails
half way changes no page.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

RANGE_ROWS = 1 << 20
#: Ranges are at most this many: of larger sheets they hold more rows each.  It bounds the splitters that ``add`` sends to tasks.
MOST_RANGES = 4096
STEP = 64
_RANGE, _GEN, _HASH, _NO = "_range", "_gen", "_hash", "_no"
OWN = (_RANGE, _GEN, _HASH, _NO)


def _keys(by: list[tuple[str, bool]]) -> list[tuple[str, bool]]:
    return [*by, (_HASH, False), (_GEN, False), (_NO, False)]


def _sorting(by: list[tuple[str, bool]]) -> list[Column]:
    return [F.col(f"`{c}`").desc() if down else F.col(f"`{c}`").asc() for c, down in _keys(by)]


def _not_before(by: list[tuple[str, bool]], row: Column) -> Column:
    """Whether the current row is not before ``row`` (a struct of the keys) in the stored order."""
    out = F.lit(True)  # equal in all keys
    for c, down in reversed(_keys(by)):
        mine, other = F.col(f"`{c}`"), row[c]
        # a null comes first where the order ascends, last where it descends
        beyond = F.when(mine.isNull(), F.lit(down) & other.isNotNull()).when(other.isNull(), F.lit(not down)).otherwise(
            mine < other if down else mine > other)
        out = beyond | (mine.eqNullSafe(other) & out)
    return out


def _marked(df: DataFrame, generation: int) -> DataFrame:
    clash = [c for c in df.columns if c.lower() in OWN]
    if clash:
        raise ValueError(f"columns {clash} clash with the index's own")
    return df.withColumn(_HASH, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).withColumns({_GEN: F.lit(generation), _NO: F.monotonically_increasing_id()})


def build_order(df: DataFrame, by: list[tuple[str, bool]], path: str, range_rows: int = RANGE_ROWS) -> "OrderIndex":
    """Store ``df`` sorted by ``by``: (column, descending) pairs."""
    index = OrderIndex(df.sparkSession, path, df.schema, list(by), range_rows)
    index._write_first(df)
    return index


@dataclass
class OrderIndex:
    spark: SparkSession
    path: str
    schema: StructType
    by: list[tuple[str, bool]]
    range_rows: int = RANGE_ROWS

    def _write_first(self, df: DataFrame) -> None:
        n = max(1, min(MOST_RANGES, -(-df.count() // self.range_rows)))
        # a given number of partitions is not merged by AQE; their numbers follow the order
        ranged = _marked(df, 0).repartitionByRange(n, *_sorting(self.by)).withColumn(_RANGE, F.spark_partition_id())
        ranged.sortWithinPartitions(_RANGE, *_sorting(self.by)).write.partitionBy(_GEN, _RANGE).parquet(f"{self.path}/rows")
        self._commit(0)

    def _stored(self, generation: int) -> DataFrame:
        whole = StructType([*self.schema.fields, StructField(_HASH, LongType()), StructField(_NO, LongType()),
                            StructField(_GEN, IntegerType()), StructField(_RANGE, IntegerType())])
        return self.spark.read.schema(whole).parquet(f"{self.path}/rows").where(F.col(_GEN) <= generation)

    def _commit(self, generation: int) -> None:
        """Write the ranges of a generation: number, rows, rows before it, first row."""
        rows = self._stored(generation)
        names = [c for c, _ in _keys(self.by)]
        counts = rows.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"))
        if generation:  # the ranges stay where the first generation cut them
            firsts = self._table().where(F.col(_GEN) == 0).select(_RANGE, "first")
        else:
            # ranges were sorted before they were written: the first in order is a top-1 by range
            ranked = Window.partitionBy(_RANGE).orderBy(*_sorting(self.by))
            firsts = rows.withColumn("_r", F.row_number().over(ranked)).where("_r = 1").select(
                _RANGE, F.struct(*[F.col(f"`{c}`") for c in names]).alias("first"))
        # one row per range, MOST_RANGES at most
        before = F.coalesce(F.sum("n").over(Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts.join(firsts, _RANGE, "left").select(_RANGE, "n", before.alias("before"), "first").coalesce(1).write.parquet(
            f"{self.path}/ranges/{_GEN}={generation}")

    def _table(self) -> DataFrame:
        own = [StructField(_HASH, LongType()), StructField(_GEN, IntegerType()), StructField(_NO, LongType())]
        first = StructType([*[self.schema[c] for c, _ in self.by], *own])
        return self.spark.read.schema(StructType([StructField(_RANGE, IntegerType()), StructField("n", LongType()), StructField("before", LongType()),
                                                  StructField("first", first), StructField(_GEN, IntegerType())])).parquet(f"{self.path}/ranges")

    def generation(self) -> int:
        """The last generation whose ranges are written."""
        return self._table().agg(F.max(_GEN)).first()[0] or 0

    def ranges(self) -> DataFrame:
        """(_range, n, before, first) of the ranges that hold rows."""
        return self._table().where(F.col(_GEN) == self.generation()).drop(_GEN)

    def count(self) -> int:
        return self.ranges().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def rows(self) -> DataFrame:
        return self._stored(self.generation()).drop(*OWN)

    def _holding(self, start: int, stop: int) -> list:
        """The ranges that hold positions from start (0-based) up to stop; at most MOST_RANGES rows."""
        held = self.ranges().where((F.col("before") < stop) & (F.col("before") + F.col("n") > start))
        return held.select(_RANGE, "before", "n").orderBy(_RANGE).collect()

    def slice(self, start: int, stop: int) -> DataFrame:
        """The rows at positions start (0-based) up to, not including, stop."""
        if start < 0:
            raise ValueError("positions start at 0")
        generation = self.generation()
        held = self._holding(start, stop) if stop > start else []
        rows = self._stored(generation)
        if not held:
            return rows.where(F.lit(False)).drop(*OWN)
        cut = rows.where(F.col(_RANGE).isin([r[_RANGE] for r in held])).orderBy(*_sorting(self.by))
        skip = start - held[0].before
        return cut.offset(skip).limit(stop - start).drop(*OWN)

    def page(self, page_no: int, size: int = 500) -> DataFrame:
        """Rows of page ``page_no`` (1-based)."""
        if page_no < 1:
            raise ValueError("page numbers start at 1")
        return self.slice((page_no - 1) * size, page_no * size)

    def ranges_read(self, page_no: int, size: int = 500) -> tuple[int, int]:
        """How many ranges a page reads, and how many there are."""
        return len(self._holding((page_no - 1) * size, page_no * size)), self.ranges().count()

    def add(self, df: DataFrame) -> int:
        """Put further rows (same columns) into the ranges; gives the new generation."""
        if sorted(df.columns) != sorted(self.schema.names):
            raise ValueError(f"the rows have the columns {df.columns}, the index {self.schema.names}")
        rows = df.select(*[f"`{c}`" for c in self.schema.names])
        if rows.schema.simpleString() != self.schema.simpleString():
            raise ValueError(f"the rows are {rows.schema.simpleString()}, the index holds {self.schema.simpleString()}")
        generation = self.generation() + 1
        marked = _marked(rows, generation)
        # two levels: a row is held against every STEP-th splitter, then against the STEP behind the last one not after it
        firsts = self._table().where(F.col(_GEN) == 0).agg(F.sort_array(F.collect_list(F.struct(_RANGE, "first"))).alias("s"))
        steps = firsts.select(F.filter("s", lambda _s, i: i % STEP == 0))
        marked = marked.withColumn("_all", firsts.scalar()).withColumn("_steps", steps.scalar())
        block = F.greatest(F.size(F.filter("_steps", lambda s: _not_before(self.by, s["first"]))) - 1, F.lit(0))
        marked = marked.withColumn("_block", F.slice("_all", block * STEP + 1, F.lit(STEP)))
        place = F.greatest(F.size(F.filter("_block", lambda s: _not_before(self.by, s["first"]))) - 1, F.lit(0))
        routed = marked.withColumn(_RANGE, F.coalesce(F.get("_block", place)[_RANGE], F.lit(0))).drop("_all", "_steps", "_block", _GEN)
        routed = routed.repartitionByRange(_RANGE, *[F.col(f"`{c}`") for c, _ in self.by], _HASH, _NO).sortWithinPartitions(_RANGE)
        routed.write.partitionBy(_RANGE).mode("overwrite").parquet(f"{self.path}/rows/{_GEN}={generation}")
        self._commit(generation)
        return generation

    def rebuild(self, path: str) -> "OrderIndex":
        """The same rows in ranges of equal size in another folder."""
        return build_order(self.rows(), self.by, path, self.range_rows)


def open_order(spark: SparkSession, path: str, schema: StructType, by: list[tuple[str, bool]], range_rows: int = RANGE_ROWS) -> OrderIndex:
    return OrderIndex(spark, path, schema, list(by), range_rows)


__all__ = ["MOST_RANGES", "OrderIndex", "RANGE_ROWS", "build_order", "open_order"]

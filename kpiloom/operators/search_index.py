"""Search over stored sheets by a trigram posting index.

A sheet is stored in blocks of about ``block_rows`` rows, one folder each, beside a table of postings: (column, trigram,
block) for every three neighbouring characters of a column's text in a block, in lower case.  From a pattern the trigrams
that every match must hold are derived (per branch of an alternation); the blocks whose one column holds all of them are
read, and the pattern itself decides on their rows.  A pattern that needs no trigram reads all blocks, so the rows are always
those of :func:`kpiloom.functions.search.search_any` and :func:`~kpiloom.functions.search.search_col`.

The postings grow with the different trigrams of a block, not with its rows, and are made map-side distinct before their
shuffle.  At most ``LISTED`` block numbers reach the driver, to prune folders; beyond that the blocks are met by a join.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kpiloom.functions.scalars import any_of
from kpiloom.functions.search import search_any, search_col

BLOCK_ROWS = 1 << 17
LISTED = 10_000
SIZE = 3
_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase


def required(pattern: str, literal: bool = False) -> list[set[str]] | None:
    """Per branch the trigrams that a match must hold; None if some branch needs none.

    Of a regular expression only what is certain counts: runs of plain characters at its top level.  A character class, a
    group, a dot, an anchor or an escape other than of a punctuation mark ends a run; a quantified character ends it as well,
    and does not count if it may be missing."""
    if literal:
        grams = _grams(pattern.lower())
        return [grams] if grams else None
    branches = _runs(pattern)
    if branches is None:
        return None
    out = [set().union(*[_grams(run.translate(str.maketrans(_UPPER, _LOWER))) for run in runs]) for runs in branches]
    return out if all(out) else None


def _grams(text: str) -> set[str]:
    return {text[i:i + SIZE] for i in range(len(text) - SIZE + 1)}


def _runs(pattern: str) -> list[list[str]] | None:
    if "(?" in pattern or "\\Q" in pattern:
        return None  # flags, look-around or quoting: not read here
    branches, runs, run, depth, i = [], [], "", 0, 0

    def end() -> None:
        nonlocal run
        runs.append(run)
        run = ""

    while i < len(pattern):
        c, width, plain = pattern[i], 1, False
        if c == "\\":
            nxt = pattern[i + 1:i + 2]
            plain, c, width = bool(nxt) and not nxt.isalnum(), nxt, 2
            if nxt and nxt.isalnum() and nxt not in "dDsSwWbBAzZG":
                return None  # code points, classes by name, back-references
        elif c == "[":
            j = i + 1 + (pattern[i + 1:i + 2] == "^")
            level, first = 1, j
            while j < len(pattern) and level:
                if pattern[j] == "\\":
                    j += 1
                elif pattern[j] == "[":
                    level += 1
                elif pattern[j] == "]" and j > first:
                    level -= 1
                j += 1
            width = j - i
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "|" and not depth:
            end()
            branches.append(runs)
            runs = []
            i += 1
            continue
        else:
            plain = c not in ".^$*+?{}|"
        i += width
        quantified = i < len(pattern) and pattern[i] in "*+?{"
        if plain and not depth and not quantified:
            run += c
            continue
        if plain and not depth and pattern[i] == "+":
            run += c  # once at least, and maybe more: a run ends with it
        end()
        while i < len(pattern) and pattern[i] in "*+?{":
            i = pattern.find("}", i) + 1 or len(pattern) if pattern[i] == "{" else i + 1
    end()
    return [*branches, runs]


def _trigrams(text: Column) -> Column:
    """The text's different trigrams, in the lower case of regular expressions (A-Z) and in that of plain text."""
    def of(t: Column) -> Column:
        return F.when(F.length(t) >= SIZE, F.transform(F.sequence(F.lit(1), F.length(t) - (SIZE - 1)), lambda i: F.substr(t, i, F.lit(SIZE))))
    empty = F.array().cast("array<string>")
    return F.array_union(F.coalesce(of(F.translate(text, _UPPER, _LOWER)), empty), F.coalesce(of(F.lower(text)), empty))


def build_index(df: DataFrame, path: str, block_rows: int = BLOCK_ROWS) -> "SearchIndex":
    """Store the sheet in blocks below ``path`` with its postings."""
    shift = max(0, block_rows.bit_length() - 1)
    name = "_block"
    while name in df.columns:
        name += "_"
    # the id counts through each partition: its upper bits name a block, and no block spans two partitions
    df.withColumn(name, F.shiftright(F.monotonically_increasing_id(), shift)).write.partitionBy(name).parquet(f"{path}/rows")
    index = SearchIndex(df.sparkSession, path, df.schema, name)
    rows = index._rows()
    cells = F.array(*[F.struct(F.lit(c).alias("col"), _trigrams(F.col(f"`{c}`").cast("string")).alias("grams")) for c in df.columns])
    each = rows.select(F.col(name).alias("block"), F.explode(cells).alias("x")).select("block", "x.col", F.explode("x.grams").alias("gram"))
    each.distinct().repartitionByRange("gram").sortWithinPartitions("gram", "col").write.parquet(f"{path}/postings")
    return index


@dataclass
class SearchIndex:
    spark: SparkSession
    path: str
    schema: StructType
    block: str

    def _rows(self) -> DataFrame:
        whole = StructType([*self.schema.fields, StructField(self.block, LongType())])
        return self.spark.read.schema(whole).parquet(f"{self.path}/rows")

    def blocks(self, pattern: str, column: str | None = None, literal: bool = False) -> DataFrame | None:
        """(block) of the blocks that can hold a match; None for all."""
        needs = required(pattern, literal) if pattern and pattern.strip() else None
        if needs is None:
            return None
        postings = self.spark.read.parquet(f"{self.path}/postings")
        if column is not None:
            postings = postings.where(F.col("col") == column)
        wanted = postings.where(F.col("gram").isin(sorted(set().union(*needs))))
        # all trigrams of one branch in one column of the block
        held = wanted.groupBy("block", "col").agg(F.collect_set("gram").alias("grams"))
        return held.where(any_of(F.size(F.array_intersect("grams", F.array(*map(F.lit, sorted(n))))) == len(n) for n in needs)).select("block").distinct()

    def search(self, pattern: str | None, column: str | None = None, literal: bool = False) -> DataFrame:
        """The sheet's rows that match, as a search over the whole sheet gives them."""
        rows, found = self._rows(), self.blocks(pattern, column, literal)
        if found is not None:
            numbers = [r.block for r in found.limit(LISTED + 1).collect()]
            if len(numbers) <= LISTED:
                rows = rows.where(F.col(self.block).isin(numbers)) if numbers else rows.limit(0)
            else:
                rows = rows.join(found, rows[self.block] == found.block, "left_semi")
        rows = rows.drop(self.block)
        return search_any(rows, pattern, literal) if column is None else search_col(rows, column, pattern, literal)

    def blocks_read(self, pattern: str, column: str | None = None, literal: bool = False) -> tuple[int, int]:
        """How many blocks a search reads, and how many there are."""
        total = self._rows().select(self.block).distinct().count()
        found = self.blocks(pattern, column, literal)
        return (total if found is None else found.count()), total

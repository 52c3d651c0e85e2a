"""Batches whose entries over one table share one scan of it.

An entry is a filter, group-by columns and measures over a source.  Sources are compared by what Spark analyses them to
(``DataFrame.sameSemantics``), not by name, so two views of one table are one source.  All entries over a source are one aggregate:
a grouping set for each different group-by, each measure counting only the rows of its entry's filter, and the entries' filters joined
by OR in front of the scan.  Its result is written by grouping set, and each entry's sheet is cut out of its own set.

Failures stay with their entries: one that Spark cannot analyse is left out of the shared pass, and when the shared pass
itself fails (a cast or an overflow on some row), its entries run one by one, so only the one at fault is marked.  Sheets and
the run log are those of :func:`kpiloom.plans.batch.run_batch`.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.scalars import any_of
from kpiloom.operators.measures import Measure, measure_column
from kpiloom.plans.batch import QueryResult
from kpiloom.session import scratch_path
from kpiloom.sources.sinks import RUNLOG_SCHEMA, refuse_shared_sheets, sheet_name_for, write_sheet


@dataclass
class Entry:
    name: str
    source: str
    group_by: list[str] = field(default_factory=list)
    measures: list[Measure] = field(default_factory=list)
    where: str | None = None
    sheet: str | None = None


def _columns(e: Entry, only: Column | None = None) -> list[Column]:
    found = [measure_column(m, only=only) for m in e.measures]
    if not found or any(c is None for c in found):
        raise ValueError("an entry needs measures, and slab measures a bounded slab")
    return found


def alone(df: DataFrame, e: Entry) -> DataFrame:
    """The entry by itself."""
    rows = df.where(F.expr(e.where)) if e.where else df
    return rows.groupBy(*[F.col(f"`{c}`") for c in e.group_by]).agg(*_columns(e))


def same_sources(sources: dict[str, DataFrame]) -> dict[str, str]:
    """Each source's name -> the first name whose plan means the same."""
    out: dict[str, str] = {}
    by_hash: dict[int, list[str]] = {}
    for name, df in sources.items():
        alike = by_hash.setdefault(df.semanticHash(), [])
        out[name] = next((n for n in alike if sources[n].sameSemantics(df)), name)
        if out[name] == name:
            alike.append(name)
    return out


def shared(df: DataFrame, entries: list[Entry]) -> DataFrame:
    """One aggregate for all entries: ``_set`` (the group-by's number), ``_k*`` (keys), and by entry ``_n*`` and ``_m*_*``."""
    keys = sorted({c for e in entries for c in e.group_by})
    sets = _sets(entries)
    holds = [F.expr(e.where) if e.where else F.lit(True) for e in entries]
    rows = df.where(any_of(holds)) if all(e.where for e in entries) else df
    # keys are copies: a measure or a filter of a grouped column reads the column itself, whatever the grouping set
    rows = rows.withColumns({f"_k{i}": F.col(f"`{c}`") for i, c in enumerate(keys)})
    aggs = []
    for i, (e, own) in enumerate(zip(entries, holds)):
        aggs.append(F.count(F.when(own, F.lit(1))).alias(f"_n{i}"))
        aggs += [c.alias(f"_m{i}_{j}") for j, c in enumerate(_columns(e, own))]
    cols = [F.col(f"_k{i}") for i in range(len(keys))]
    if not cols:
        return rows.groupBy().agg(*aggs).withColumn("_set", F.lit(0))
    grouped = rows.groupingSets([[cols[keys.index(c)] for c in s] for s in sets], *cols)
    number = F.coalesce(*[F.when(_summed_over(keys, s), F.lit(i)) for i, s in enumerate(sets)])
    return grouped.agg(number.alias("_set"), *aggs)


def _sets(entries: list[Entry]) -> list[tuple[str, ...]]:
    return list(dict.fromkeys(tuple(sorted(set(e.group_by))) for e in entries))


def _summed_over(keys: list[str], of: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for i, c in enumerate(keys):
        out = out & (F.grouping(f"_k{i}") == (0 if c in of else 1))
    return out


def _cut(stored: DataFrame, entries: list[Entry], at: int) -> DataFrame:
    """An entry's rows and columns of the shared result."""
    e, keys = entries[at], sorted({c for x in entries for c in x.group_by})
    own = stored.where(F.col("_set") == _sets(entries).index(tuple(sorted(set(e.group_by)))))
    if e.group_by:
        own = own.where(F.col(f"_n{at}") > 0)
    return own.select(*[F.col(f"_k{keys.index(c)}").alias(c) for c in e.group_by],
                      *[F.col(f"_m{at}_{j}").alias(m.alias) for j, m in enumerate(e.measures)])


def _reason(e: Exception) -> str:
    return str(e).strip().splitlines()[0] if str(e).strip() else type(e).__name__


def run_shared(spark: SparkSession, sources: dict[str, DataFrame], entries: list[Entry], out_root: str) -> DataFrame:
    """Run the entries, a scan for each different source; returns the run log (a row per entry, in their order).

    The seconds of an entry are those of its shared pass and its own sheet."""
    sheets = [sheet_name_for(e.name, {e.name: e.sheet}, limit=None) for e in entries]
    refuse_shared_sheets(sheets)
    log: dict[int, QueryResult] = {}

    def note(i: int, start: dt.datetime, t0: float, rows: int = 0, err: str | None = None) -> None:
        log[i] = QueryResult(entries[i].name, sheets[i], "failed" if err else "success", start, dt.datetime.now(), time.perf_counter() - t0, rows, err)

    first, passes = same_sources(sources), {}
    for i, e in enumerate(entries):
        start, t0 = dt.datetime.now(), time.perf_counter()
        try:
            alone(sources[e.source], e)
            passes.setdefault(first[e.source], []).append(i)
        except KeyError:
            note(i, start, t0, err=f"no source {e.source!r}; there are {sorted(sources)}")
        except Exception as x:  # analysis of this entry
            note(i, start, t0, err=_reason(x))
    for name, numbers in passes.items():
        df, own = sources[name], [entries[i] for i in numbers]
        start, t0 = dt.datetime.now(), time.perf_counter()
        stored = None
        if len(own) > 1:
            try:
                plan, path = shared(df, own), scratch_path(spark, "shared-batch")
                plan.write.partitionBy("_set").parquet(path)
                stored = spark.read.schema(plan.schema).parquet(path)
            except Exception:  # some entry's fault: each runs by itself and shows whose
                stored = None
        for at, i in enumerate(numbers):
            if stored is None:
                start, t0 = dt.datetime.now(), time.perf_counter()
            try:
                out = alone(df, own[at]) if stored is None else _cut(stored, own, at)
                if stored is not None and not own[at].group_by and out.isEmpty():
                    out = alone(df, own[at])  # a total over no rows is a row all the same
                note(i, start, t0, write_sheet(out, out_root, sheets[i]))
            except Exception as x:
                note(i, start, t0, err=_reason(x))
    return spark.createDataFrame([tuple(vars(log[i]).values()) for i in range(len(entries))], RUNLOG_SCHEMA)

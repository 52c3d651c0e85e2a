"""Change-driven KPI refresh: only what reads a changed sheet runs again.

A sheet's digest is free of order and of how it is partitioned: the number of rows and the sums of two hashes over all
columns, with the columns' names and types; one narrow scan with a one-row aggregate.  A KPI's fingerprint is made of its
statement and the digests of what it reads.  Its result is written below ``<root>/<kpi>/<fingerprint>``; if that folder is
there with its commit mark, the KPI is not run.  KPIs that read another one go by the digest of its *result*, so a change
that does not reach the result stops there.

A statement that gives another answer each time (the current date, random values) is run at every refresh.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, MapType, VariantType

from kpiloom.plans.batch import kpi_order
from kpiloom.sources.catalog import drop_sheets, register_sheets, run_sql
from kpiloom.streaming.arrival import _fs

VOLATILE = re.compile(r"(?i)\b(current_date|current_timestamp|current_time|localtimestamp|curdate|now|unix_timestamp|rand|randn|random|uuid|shuffle|monotonically_increasing_id)\b")


def sheet_digest(df: DataFrame) -> str:
    """Equal for equal columns and equal rows, each as often, in any order."""
    cells = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, (MapType, VariantType)) else F.col(f"`{f.name}`") for f in df.schema.fields]
    # a null cell leaves a hash as it is, so the pattern of nulls is hashed with the cells
    nulls = F.concat(F.lit("."), *[F.when(c.isNull(), "n").otherwise("v") for c in cells])
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), nulls, *cells).cast(DecimalType(38, 0)))
    got = df.agg(F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b")).first()
    return hashlib.sha256(f"{df.schema.simpleString()}|{got.n}|{got.a}|{got.b}".encode()).hexdigest()


@dataclass
class KpiRun:
    df: DataFrame | None
    error: str | None
    computed: bool
    digest: str | None


def refresh_changed(spark: SparkSession, sheets: dict[str, DataFrame], kpis: dict[str, tuple[str, list[str]]], root: str, keep: int = 2) -> dict[str, KpiRun]:
    """Bring every KPI up to date, dependencies first; ``kpis``: name -> (SQL, the sheets and KPIs it reads).

    Returns per KPI its stored result, the error if it failed, and whether it was run.  A KPI that reads a failed one fails as well.
    The ``keep`` newest results of each KPI stay in the store."""
    register_sheets(sheets)
    for name, (_, reads) in kpis.items():
        unknown = [r for r in reads if r not in sheets and r not in kpis]
        if unknown:
            raise ValueError(f"KPI {name!r} reads {unknown}, which are neither sheets nor KPIs")
    used = {r for _, reads in kpis.values() for r in reads if r in sheets}
    digests = {name: sheet_digest(sheets[name]) for name in sorted(used)}
    out: dict[str, KpiRun] = {}
    for name in kpi_order({k: reads for k, (_, reads) in kpis.items()}):
        sql, reads = kpis[name]
        failed = [r for r in reads if r in out and out[r].error]
        if failed:
            out[name] = KpiRun(None, f"reads {', '.join(failed)}, which failed", False, None)
            drop_sheets(spark, [name])
            continue
        print_ = hashlib.sha256("\n".join([sql, *[f"{r}={digests[r]}" for r in sorted(reads)]]).encode()).hexdigest()
        folder = f"{root.rstrip('/')}/{name}/{print_}"
        path, fs = _fs(spark, folder)
        computed = bool(VOLATILE.search(sql)) or not fs.exists(path(f"{folder}/_SUCCESS"))
        error = None
        if computed:
            df, error = run_sql(spark, sql)
            if error is None:
                try:
                    df.write.mode("overwrite").parquet(folder)
                except Exception as e:  # what fails when it runs, this KPI only
                    error = (str(e).strip() or type(e).__name__).splitlines()[0]
        if error:
            out[name] = KpiRun(None, error, True, None)
            drop_sheets(spark, [name])
            continue
        df = spark.read.parquet(folder)
        digests[name] = sheet_digest(df)
        out[name] = KpiRun(df, None, computed, digests[name])
        register_sheets({name: df})
        if computed:
            _forget(spark, f"{root.rstrip('/')}/{name}", folder, keep)
    return out


def _forget(spark: SparkSession, at: str, newest: str, keep: int) -> None:
    """Remove all but the newest results of a KPI; the one just written always stays."""
    path, fs = _fs(spark, at)
    held = sorted(((f.getModificationTime(), f.getPath().toString()) for f in fs.listStatus(path(at)) if f.isDirectory()), reverse=True)
    last = path(newest).getName()
    others = [p for _, p in held if path(p).getName() != last]
    for p in others[max(0, keep - 1):]:
        fs.delete(path(p), True)

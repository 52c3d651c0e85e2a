"""Batch runs of named queries, the run log and its summaries, KPI refresh.

A batch is a handful of named SQL statements (the registry is configuration,
tens of rows).  Each query is its own Spark job, submitted from a driver
thread pool so several run at once (FAIR scheduling pool per thread); each
writes its own sheet and yields one run-log row.  Failures are isolated: a
query that fails to parse, analyse or run only marks its own row.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from kpiloom.sources.catalog import run_sql
from kpiloom.sources.sinks import RUNLOG_SCHEMA, refuse_shared_sheets, sheet_name_for, write_sheet

REGISTRY_SCHEMA = StructType([
    StructField("name", StringType()), StructField("sql", StringType()), StructField("sheet_name", StringType()),
    StructField("refresh_frequency", StringType()), StructField("enabled", BooleanType()),
])

MAX_PARALLEL = 5


def select_queries(registry: DataFrame, frequency: str | None = None) -> DataFrame:
    """Enabled entries (missing flag = enabled), optionally of one frequency (case-insensitive)."""
    out = registry.where(F.coalesce(F.col("enabled"), F.lit(True)))
    if frequency:
        out = out.where(F.lower(F.col("refresh_frequency")) == frequency.lower())
    return out


@dataclass
class QueryResult:
    query_name: str
    sheet_name: str
    status: str
    start_time: dt.datetime
    end_time: dt.datetime
    execution_time: float
    row_count: int
    error: str | None


def run_one(spark: SparkSession, name: str, sql: str, sheet: str, out_root: str, pool: str | None = None,
            timeout: float | None = None) -> QueryResult:
    """Run one named query into its sheet; never raises.

    With ``timeout`` (seconds) the query's jobs run under their own job group
    and a timer cancels the group when time is up: the running tasks are
    interrupted and the query is recorded as failed.
    """
    sc = spark.sparkContext
    if pool:
        sc.setLocalProperty("spark.scheduler.pool", pool)
    group = f"kpiloom-{uuid.uuid4().hex}"
    sc.setJobGroup(group, name, interruptOnCancel=True)
    timer = threading.Timer(timeout, sc.cancelJobGroup, [group]) if timeout else None
    start, t0 = dt.datetime.now(), time.perf_counter()
    rows, err = 0, None
    try:
        if timer:
            timer.start()
        df, err = run_sql(spark, sql) if sql and sql.strip() else (None, "the entry has no SQL")
        if df is not None:
            rows = write_sheet(df, out_root, sheet)
    except Exception as e:  # any failure of this entry marks its own row only
        err = str(e).strip().splitlines()[0] if str(e).strip() else type(e).__name__
        if timer and not timer.is_alive():
            err = f"timed out after {timeout:g}s"
    finally:
        if timer:
            timer.cancel()
    sc.setLocalProperty("spark.jobGroup.id", None)
    secs = time.perf_counter() - t0
    return QueryResult(name, sheet, "failed" if err else "success", start, dt.datetime.now(), secs,
                       0 if err else rows, err)


def run_batch(spark: SparkSession, registry: DataFrame, out_root: str, frequency: str | None = None,
              parallel: bool = True, max_workers: int = MAX_PARALLEL, timeout: float | None = None) -> DataFrame:
    """Run the selected registry entries; returns the run log (one row per query).

    Collecting the registry is fine: it is configuration, not data.
    """
    entries = select_queries(registry, frequency).select("name", "sql", "sheet_name").collect()
    jobs = [(e["name"], e["sql"], sheet_name_for(e["name"], {e["name"]: e["sheet_name"]}, limit=None))
            for e in entries]
    refuse_shared_sheets([sheet for _, _, sheet in jobs])
    if parallel and len(jobs) > 1:
        target = inheritable_thread_target(spark)(
            lambda j: run_one(spark, j[0], j[1], j[2], out_root, pool=f"batch_{j[0]}", timeout=timeout))
        with ThreadPoolExecutor(max_workers=max_workers) as ex:
            results = list(ex.map(target, jobs))
    else:
        results = [run_one(spark, n, s, sh, out_root, timeout=timeout) for n, s, sh in jobs]
    return spark.createDataFrame([tuple(vars(r).values()) for r in results], RUNLOG_SCHEMA)


def run_summary(log: DataFrame) -> DataFrame:
    """total / successful / failed / success rate / total seconds / total rows.

    An empty log gives no row (the summary of nothing is nothing).
    """
    agg = log.agg(F.count(F.lit(1)).alias("total_queries"),
                  F.count_if(F.col("status") == "success").alias("successful"),
                  F.sum(F.coalesce(F.col("execution_time"), F.lit(0.0))).alias("_secs"),
                  F.sum(F.col("row_count")).alias("total_rows"))
    rate = F.col("successful") * F.lit(100.0) / F.col("total_queries")
    return agg.where(F.col("total_queries") > 0).select(
        "total_queries", "successful", (F.col("total_queries") - F.col("successful")).alias("failed"),
        F.concat(F.format_number(F.round(rate.cast("decimal(38,10)"), 1), 1), F.lit("%")).alias("success_rate"),
        F.concat(F.regexp_replace(F.format_number(F.round(F.col("_secs").cast("decimal(38,10)"), 2), 2), ",", ""),
                 F.lit("s")).alias("total_execution_time"),
        F.col("total_rows").cast("bigint").alias("total_rows"))


def status_rollup(sheets: DataFrame) -> DataFrame:
    """Counts of total / success / failed / running per sheet type plus an
    overall row (type null), scheme sheets excluded -- one ``rollup``."""
    s = sheets.where(F.col("type") != "scheme")
    return s.rollup("type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "running").alias("running"))


def kpi_order(kpis: dict[str, list[str]]) -> list[str]:
    """Topological order of KPIs by declared dependencies; a cycle is an error."""
    order, state = [], {}

    def visit(k, path):
        if state.get(k) == "done":
            return
        if state.get(k) == "busy":
            raise ValueError(f"KPI dependency cycle: {' -> '.join(path + [k])}")
        state[k] = "busy"
        for d in kpis.get(k, []):
            if d in kpis:
                visit(d, path + [k])
        state[k] = "done"
        order.append(k)

    for k in kpis:
        visit(k, [])
    return order


def refresh_kpis(spark: SparkSession, sheets: dict[str, DataFrame], kpis: dict[str, tuple[str, list[str]]],
                 materialize: bool = False):
    """Evaluate every KPI once, dependencies first; each result is registered
    as a view for the KPIs after it.  Returns ``{name: (df, error)}``.  The
    view of a KPI that fails is dropped, so those that read it fail as well
    and none is computed from an earlier result.

    Views are lazy: a KPI read by several later KPIs would be recomputed by
    each.  With ``materialize=True`` every KPI is computed once into a
    reliable checkpoint (the shared checkpoint folder, survives executor loss)
    and later KPIs read that stored result.
    """
    from kpiloom.session import checkpoint_dir
    from kpiloom.sources.catalog import drop_sheets, register_sheets
    register_sheets(sheets)
    if materialize:
        checkpoint_dir(spark)
    out = {}
    for name in kpi_order({k: deps for k, (_sql, deps) in kpis.items()}):
        df, err = run_sql(spark, kpis[name][0])
        if df is not None and materialize:
            try:
                df = df.checkpoint(eager=True)
            except Exception as e:  # runtime failure of this KPI only
                df, err = None, str(e).strip().splitlines()[0]
        out[name] = (df, err)
        if df is not None:
            register_sheets({name: df})
        else:
            drop_sheets(spark, [name])
    return out

"""Job-level queries: batch runs, KPI evaluation / refresh, refresh on
arrival (streaming), run summary and status roll-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kpiloom.operators.measures import Measure
from kpiloom.plans.batch import REGISTRY_SCHEMA, refresh_kpis, run_batch, run_summary, status_rollup
from kpiloom.plans.refresh import refresh_changed
from kpiloom.plans.shared_batch import Entry, run_shared
from kpiloom.session import scratch_path
from kpiloom.sources.catalog import run_kpi
from kpiloom.sources.tables import register_tables, table
from kpiloom.streaming.arrival import current_totals, start_refresh
from kpiloom.streaming.maintained import MaintainedKpi, apply_batch, current_kpi, start_kpi
from kpiloom.workloads import register
from kpiloom.workloads.io import RUNLOG_FROM_EVENTS, runlog_from_events


def T(spark, sf_dir, name):
    return table(spark, sf_dir, name)


REGISTRY = [
    ("Urgent Orders", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'",
     "Urgent", "Daily", True),
    ("Events per user", "SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id", "Events", "daily", None),
    ("Late lines", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'", "Late", "daily", True),
    ("Broken", "SELECT missing_column FROM orders", "Broken", "DAILY", True),
    ("Weekly only", "SELECT * FROM region", "Weekly", "weekly", True),
    ("Switched off", "SELECT * FROM nation", "Off", "daily", False),
]


@register("batch_run", """
SELECT 'Urgent Orders' AS query_name, 'Urgent' AS sheet_name, 'success' AS status,
       CAST(COUNT(*) AS BIGINT) AS row_count FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT 'Events per user', 'Events', 'success', CAST(COUNT(DISTINCT user_id) AS BIGINT) FROM events
UNION ALL SELECT 'Late lines', 'Late', 'success', CAST(COUNT(*) AS BIGINT) FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'Broken', 'Broken', 'failed', CAST(0 AS BIGINT)""")
def q_batch_run(spark, sf_dir):
    register_tables(spark, sf_dir, ["orders", "events", "lineitem", "region", "nation"])
    registry = spark.createDataFrame(REGISTRY, REGISTRY_SCHEMA)
    log = run_batch(spark, registry, scratch_path(spark, "batch"), frequency="daily", parallel=True)
    return log.select("query_name", "sheet_name", "status", "row_count")


SHARED = [
    Entry("orders by status", "orders", ["o_orderstatus"], [Measure(func="COUNT", alias="n"), Measure(func="MAX", column="o_totalprice", alias="top")]),
    Entry("urgent by customer", "sales", ["o_custkey"], [Measure(func="COUNT", alias="n"), Measure(func="MAX", column="o_totalprice", alias="top")],
          "o_orderpriority = '1-URGENT'"),
    Entry("finished", "orders", [], [Measure(func="COUNT", alias="n"), Measure(func="MAX", column="o_totalprice", alias="top")], "o_orderstatus = 'F'"),
]


@register("batch_shared", """
SELECT 'orders by status' AS entry, CAST(o_orderstatus AS VARCHAR) AS grp, CAST(COUNT(*) AS BIGINT) AS n, MAX(o_totalprice) AS top
FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'urgent by customer', CAST(o_custkey AS VARCHAR), COUNT(*), MAX(o_totalprice) FROM orders
WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey
UNION ALL SELECT 'finished', 'all', COUNT(*), MAX(o_totalprice) FROM orders WHERE o_orderstatus = 'F'""")
def q_batch_shared(spark, sf_dir):
    # three entries over two views of one table: one scan of it; then the sheets written are read
    root = scratch_path(spark, "batch-shared")
    log = run_shared(spark, {"orders": T(spark, sf_dir, "orders"), "sales": T(spark, sf_dir, "orders")}, SHARED, root).collect()
    failed = [r.error for r in log if r.status != "success"]
    if failed:
        raise RuntimeError(failed[0])
    sheets = [spark.read.parquet(f"{root}/{r.sheet_name}").select(
        F.lit(e.name).alias("entry"), (F.col(e.group_by[0]).cast("string") if e.group_by else F.lit("all")).alias("grp"), "n", "top") for r, e in zip(log, SHARED)]
    return reduce(lambda a, b: a.unionByName(b), sheets)


KPI_SQL = """
SELECT e.user_id, CAST(COUNT(*) AS BIGINT) AS inspections,
       CAST(SUM(CASE WHEN e.event_type = 'purchase' THEN 10 ELSE 0 END) AS BIGINT) AS five_star_pay
FROM events_sheet e JOIN customer_list c ON e.user_id = c.c_custkey
GROUP BY e.user_id"""


@register("kpi_eval", KPI_SQL.replace("events_sheet", "events").replace("customer_list", "customer"))
def q_kpi_eval(spark, sf_dir):
    sheets = {"Events Sheet": T(spark, sf_dir, "events"), "Customer-List": T(spark, sf_dir, "customer"),
              "pending sheet": None}
    df, err = run_kpi(spark, KPI_SQL, sheets)
    if err:
        raise RuntimeError(err)
    return df


@register("kpi_refresh", """
WITH a AS (SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'view' GROUP BY user_id),
b AS (SELECT user_id, n * 150 AS pay FROM a WHERE n >= 10)
SELECT CAST(COUNT(*) AS BIGINT) AS paid_people, CAST(SUM(pay) AS BIGINT) AS total_pay FROM b""")
def q_kpi_refresh(spark, sf_dir):
    kpis = {  # declared out of order on purpose: dependencies decide the order
        "kpi_total": ("SELECT COUNT(*) AS paid_people, CAST(SUM(pay) AS BIGINT) AS total_pay FROM kpi_pay", ["kpi_pay"]),
        "kpi_pay": ("SELECT user_id, n * 150 AS pay FROM kpi_views WHERE n >= 10", ["kpi_views"]),
        "kpi_views": ("SELECT user_id, COUNT(*) AS n FROM events_data WHERE event_type = 'view' GROUP BY user_id", []),
    }
    out = refresh_kpis(spark, {"events_data": T(spark, sf_dir, "events")}, kpis, materialize=True)
    df, err = out["kpi_total"]
    if err:
        raise RuntimeError(err)
    return df


EVENT_SCHEMA = StructType.fromJson({"type": "struct", "fields": [
    {"name": "event_id", "type": "long", "nullable": True, "metadata": {}},
    {"name": "ts", "type": "timestamp_ntz", "nullable": True, "metadata": {}},
    {"name": "user_id", "type": "long", "nullable": True, "metadata": {}},
    {"name": "event_type", "type": "string", "nullable": True, "metadata": {}},
    {"name": "value", "type": "double", "nullable": True, "metadata": {}},
    {"name": "props", "type": "string", "nullable": True, "metadata": {}},
]})


@register("kpi_on_arrival", r"""
SELECT lower(regexp_replace(CAST(user_id AS VARCHAR), '^\s+|\s+$', '', 'g')) AS cj_id,
       CAST(SUM(CAST(value AS DECIMAL(38,4))) AS DOUBLE) AS total, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM events GROUP BY 1""")
def q_kpi_on_arrival(spark, sf_dir):
    # Replay the events table as six arriving files (by time), consume them
    # two per micro-batch, then read the merged totals.
    landing = scratch_path(spark, "landing")
    T(spark, sf_dir, "events").repartitionByRange(6, "ts").write.parquet(landing)
    state, ckpt = scratch_path(spark, "state"), scratch_path(spark, "stream_ckpt")
    q = start_refresh(spark, landing, EVENT_SCHEMA, state, ckpt, key="user_id", value="value",
                      max_files_per_batch=2)
    q.awaitTermination(600)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return current_totals(spark, state)


MAINTAINED = MaintainedKpi("event_id", ["user_id"], [
    Measure(func="COUNT", alias="n_rows"), Measure(func="SUM", column="value", alias="total"), Measure(func="AVG", column="value", alias="mean"),
    Measure(func="MIN", column="value", alias="least"), Measure(func="MAX", column="value", alias="most")], where="event_type <> 'signup'", version="rev")


@register("kpi_maintained", """
WITH now AS (SELECT event_id, CASE WHEN event_id % 100 = 0 THEN 'signup' ELSE event_type END AS event_type, user_id,
                    CASE WHEN event_id % 20 = 0 THEN value + 1 ELSE value END AS value FROM events)
SELECT user_id, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(SUM(CAST(value AS DECIMAL(38,4))) AS DOUBLE) AS total,
       CAST(SUM(CAST(value AS DECIMAL(38,4))) AS DOUBLE) / COUNT(value) AS mean, MIN(value) AS least, MAX(value) AS most
FROM now WHERE event_type <> 'signup' GROUP BY user_id""")
def q_kpi_maintained(spark, sf_dir):
    # The events arrive in six files; a seventh corrects every twentieth row (and takes every hundredth out of the filter).
    # The KPI's state takes two files a batch; the last batch is applied twice, as after a failure.
    events = T(spark, sf_dir, "events").withColumn("rev", F.lit(0))
    landing = scratch_path(spark, "landing")
    events.repartitionByRange(6, "ts").write.parquet(landing)
    state = scratch_path(spark, "kpi_state")
    q = start_kpi(spark, landing, events.schema, MAINTAINED, state, scratch_path(spark, "stream_ckpt"), max_files_per_batch=2, compact_every=2)
    q.awaitTermination(600)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    corrected = events.where("event_id % 20 = 0").withColumns({
        "rev": F.lit(1), "value": F.col("value") + 1, "event_type": F.when(F.col("event_id") % 100 == 0, "signup").otherwise(F.col("event_type"))})
    for _ in range(2):
        apply_batch(MAINTAINED, corrected, q.lastProgress["batchId"] + 1, state)
    return current_kpi(spark, MAINTAINED, state)


CHANGED_KPIS = {
    "kpi_total": ("SELECT COUNT(*) AS people, CAST(SUM(pay) AS BIGINT) AS pay FROM kpi_pay", ["kpi_pay"]),
    "kpi_pay": ("SELECT user_id, COUNT(*) * 150 AS pay FROM events_data WHERE event_type = 'view' GROUP BY user_id", ["events_data"]),
    "kpi_orders": ("SELECT COUNT(*) AS people, CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS pay FROM orders_data", ["orders_data"])}


@register("kpi_refresh_changed", """
WITH v AS (SELECT COUNT(DISTINCT user_id) AS people, COUNT(*) * 150 AS pay FROM events WHERE event_type = 'view'),
o AS (SELECT COUNT(*) AS people, COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS pay FROM orders),
l AS (SELECT COUNT(*) AS people, COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS pay FROM orders WHERE o_orderkey % 3 <> 0),
r AS (SELECT 'first' AS step, 'kpi_total' AS kpi, TRUE AS computed, people, pay FROM v UNION ALL SELECT 'first', 'kpi_orders', TRUE, people, pay FROM o
      UNION ALL SELECT 'same rows', 'kpi_total', FALSE, people, pay FROM v UNION ALL SELECT 'same rows', 'kpi_orders', FALSE, people, pay FROM o
      UNION ALL SELECT 'other orders', 'kpi_total', FALSE, people, pay FROM v UNION ALL SELECT 'other orders', 'kpi_orders', TRUE, people, pay FROM l)
SELECT step, kpi, computed, CAST(people AS BIGINT) AS people, CAST(pay AS BIGINT) AS pay FROM r""")
def q_kpi_refresh_changed(spark, sf_dir):
    # three refreshes of one store: all new; the same rows in another order; other orders, so only the KPI on orders is run
    e, o, store = T(spark, sf_dir, "events"), T(spark, sf_dir, "orders"), scratch_path(spark, "kpi_store")
    steps = [("first", e, o), ("same rows", e.repartition(3), o.repartition(5)), ("other orders", e, o.where("o_orderkey % 3 <> 0"))]
    rows = []
    for step, events, orders in steps:
        out = refresh_changed(spark, {"events_data": events, "orders_data": orders}, CHANGED_KPIS, store, keep=3)
        rows += [out[k].df.select(F.lit(step).alias("step"), F.lit(k).alias("kpi"), F.lit(out[k].computed).alias("computed"), "people", "pay") for k in ("kpi_total", "kpi_orders")]
    return reduce(lambda a, b: a.unionByName(b), rows)


@register("run_summary", f"""
WITH log AS ({RUNLOG_FROM_EVENTS})
SELECT CAST(COUNT(*) AS BIGINT) AS total_queries,
       CAST(COUNT(*) FILTER (WHERE status = 'success') AS BIGINT) AS successful,
       CAST(COUNT(*) FILTER (WHERE status <> 'success') AS BIGINT) AS failed,
       format('{{:,.1f}}', ROUND(CAST(COUNT(*) FILTER (WHERE status = 'success') * 100.0 / COUNT(*) AS DECIMAL(38,10)), 1))
         || '%' AS success_rate,
       replace(format('{{:,.2f}}', ROUND(CAST(SUM(COALESCE(execution_time, 0)) AS DECIMAL(38,10)), 2)), ',', '')
         || 's' AS total_execution_time,
       CAST(SUM(row_count) AS BIGINT) AS total_rows
FROM log""")
def q_run_summary(spark, sf_dir):
    return run_summary(runlog_from_events(spark, sf_dir))


SHEETS_FROM_EVENTS = """
SELECT CASE event_type WHEN 'view' THEN 'sql' WHEN 'click' THEN 'csv' WHEN 'purchase' THEN 'kpi'
                       WHEN 'signup' THEN 'scheme' ELSE 'sql' END AS type,
       CASE WHEN event_type = 'error' THEN 'failed' WHEN value > 300 THEN 'running' ELSE 'success' END AS status
FROM events"""


@register("status_rollup", f"""
WITH s AS ({SHEETS_FROM_EVENTS})
SELECT type, CAST(COUNT(*) AS BIGINT) AS total, CAST(COUNT(*) FILTER (WHERE status = 'success') AS BIGINT) AS success,
       CAST(COUNT(*) FILTER (WHERE status = 'failed') AS BIGINT) AS failed,
       CAST(COUNT(*) FILTER (WHERE status = 'running') AS BIGINT) AS running
FROM s WHERE type <> 'scheme' GROUP BY ROLLUP (type)""")
def q_status_rollup(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    et = F.col("event_type")
    typ = (F.when(et == "view", "sql").when(et == "click", "csv").when(et == "purchase", "kpi")
            .when(et == "signup", "scheme").otherwise("sql"))
    status = F.when(et == "error", "failed").when(F.col("value") > 300, "running").otherwise("success")
    return status_rollup(e.select(typ.alias("type"), status.alias("status")))


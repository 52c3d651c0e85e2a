"""Projection, filter, search, join, latest-row, sort/limit and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.functions.search import search_any
from kpiloom.operators import dashboard as D
from kpiloom.operators.facet_cube import build_cube
from kpiloom.operators.filters import (
    between_days, pick_two, rename, rolling_days, union_positional, where_equal, where_text,
)
from kpiloom.operators.joins import JoinSpec, join_on, star_join
from kpiloom.operators.latest import latest_per_key
from kpiloom.operators.paging import top_n
from kpiloom.plans.report import inspection_feedback_report, report_inputs_from_tables
from kpiloom.operators.search_index import build_index
from kpiloom.session import scratch_path
from kpiloom.sources.layout import write_colocated
from kpiloom.sources.tables import table
from kpiloom.workloads import as_double, day_text, register, ts_text


def T(spark, sf_dir, name):
    return table(spark, sf_dir, name)


# ---------------------------------------------------------------- projections

@register("proj_star", """
SELECT c.*, n.n_name AS "Nation Name" FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_proj_star(spark, sf_dir):
    c = T(spark, sf_dir, "customer").alias("c")
    n = T(spark, sf_dir, "nation").alias("n")
    # nation is a fixed 25-row dimension: broadcasting it never grows with the data
    return (c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"), "left")
             .select("c.*", F.col("n.n_name").alias("Nation Name")))


@register("proj_distinct", """
SELECT DISTINCT user_id, event_type, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day FROM events""")
def q_proj_distinct(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    return e.select("user_id", "event_type", day_text(F.to_date("ts")).alias("day")).distinct()


@register("proj_derived_tbl", """
SELECT t.user_id, t.n_events, c.c_name
FROM (SELECT user_id, CAST(COUNT(*) AS BIGINT) AS n_events FROM events GROUP BY user_id) t
JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = t.user_id""")
def q_proj_derived_tbl(spark, sf_dir):
    t = T(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    c = T(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0).select("c_custkey", "c_name")
    return t.join(c, c.c_custkey == t.user_id).select("user_id", "n_events", "c_name")


@register("proj_rename", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal AS balance, c_mktsegment
FROM customer""")
def q_proj_rename(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    return rename(c, {"c_custkey": "customer_id", "c_name": "customer_name", "c_acctbal": "balance",
                      "c_nationkey": "c_nationkey"})


@register("proj_subset_rename", """
SELECT user_id AS cj_id, value AS event_kpi FROM events""")
def q_proj_subset_rename(spark, sf_dir):
    return pick_two(T(spark, sf_dir, "events"), "user_id", "value", "cj_id", "event_kpi")


# -------------------------------------------------------------------- filters

@register("filt_eq", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'""")
def q_filt_eq(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    return where_equal(li, l_returnflag="R", l_linestatus="F").select("l_orderkey", "l_linenumber", "l_quantity")


@register("filt_between_date", """
SELECT o_orderkey, o_custkey, o_totalprice, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-04-01' AND DATE '1996-04-30'""")
def q_filt_between_date(spark, sf_dir):
    o = between_days(T(spark, sf_dir, "orders"), "o_orderdate", "1996-04-01", "1996-04-30")
    return o.select("o_orderkey", "o_custkey", "o_totalprice", day_text(F.to_date("o_orderdate")).alias("day"))


@register("filt_rolling", """
SELECT o_orderkey, o_custkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day FROM orders
WHERE CAST(o_orderdate AS DATE) >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - 30""")
def q_filt_rolling(spark, sf_dir):
    o = rolling_days(T(spark, sf_dir, "orders"), "o_orderdate", 30)
    return o.select("o_orderkey", "o_custkey", day_text(F.to_date("o_orderdate")).alias("day"))


@register("filt_not_null", """
SELECT c.c_custkey, CAST(t.n_events AS BIGINT) AS n_events
FROM customer c LEFT JOIN (SELECT user_id, COUNT(*) AS n_events FROM events GROUP BY user_id) t
  ON c.c_custkey = t.user_id
WHERE t.n_events IS NOT NULL""")
def q_filt_not_null(spark, sf_dir):
    t = T(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    c = T(spark, sf_dir, "customer").select("c_custkey")
    j = c.join(t, c.c_custkey == t.user_id, "left")
    return j.where(F.col("n_events").isNotNull()).select("c_custkey", "n_events")


RAW_PREDICATE = "o_totalprice > 100000 AND o_orderpriority LIKE '1-%'"


@register("filt_raw", f"""
SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n_orders FROM orders WHERE {RAW_PREDICATE}
GROUP BY o_orderstatus""")
def q_filt_raw(spark, sf_dir):
    o = where_text(T(spark, sf_dir, "orders"), RAW_PREDICATE)
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))


SEARCH = "building|customer#0000000[1-3]"


@register("search_any", f"""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE regexp_matches(CAST(c_custkey AS VARCHAR), '{SEARCH}', 'i')
   OR regexp_matches(c_name, '{SEARCH}', 'i')
   OR regexp_matches(CAST(c_nationkey AS VARCHAR), '{SEARCH}', 'i')
   OR regexp_matches(CAST(c_acctbal AS VARCHAR), '{SEARCH}', 'i')
   OR regexp_matches(c_mktsegment, '{SEARCH}', 'i')""")
def q_search_any(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return search_any(c, SEARCH).select("c_custkey", "c_name", "c_mktsegment")


INDEXED = "building|#0000000[1-3]"


@register("search_indexed", f"""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE regexp_matches(CAST(c_custkey AS VARCHAR), '{INDEXED}', 'i') OR regexp_matches(c_name, '{INDEXED}', 'i')
   OR regexp_matches(CAST(c_nationkey AS VARCHAR), '{INDEXED}', 'i') OR regexp_matches(c_mktsegment, '{INDEXED}', 'i')""")
def q_search_indexed(spark, sf_dir):
    # the sheet is stored with its trigram postings, then searched through them
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    index = build_index(c, scratch_path(spark, "search-index"), block_rows=1 << 12)
    return index.search(INDEXED).select("c_custkey", "c_name", "c_mktsegment")


# ---------------------------------------------------------- dashboard (facts from orders)

FACTS_SQL = """facts AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS channel,
         CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS si, CAST(COUNT(*) AS BIGINT) AS insp
  FROM orders GROUP BY 1, 2)"""

RATIO_SQL = ("CASE WHEN {insp} > 0 THEN printf('%.1f%%', ROUND(CAST({si} * 100.0 / {insp} AS DECIMAL(38,10)), 1)) "
             "ELSE '0%' END")


def facts(spark, sf_dir):
    return D.facts_from_orders(T(spark, sf_dir, "orders"))


@register("filt_facet", f"""
WITH {FACTS_SQL}
SELECT month, channel, si, insp FROM facts WHERE month = '1996-04' AND COALESCE(NULLIF(channel, ''), 'Unknown') = 'Unknown'""")
def q_filt_facet(spark, sf_dir):
    return D.filter_facets(D.facts_from_orders(T(spark, sf_dir, "orders"), "1996-04"), month="1996-04", channel="Unknown")


@register("proj_ratio", f"""
WITH {FACTS_SQL}
SELECT month, channel, CASE WHEN insp > 0 THEN si * 100.0 / insp ELSE 0.0 END AS si_ratio,
       {RATIO_SQL.format(si='si', insp='insp')} AS si_pct
FROM facts""")
def q_proj_ratio(spark, sf_dir):
    from kpiloom.functions.scalars import safe_ratio_pct
    f = facts(spark, sf_dir)
    return f.select("month", "channel", safe_ratio_pct("si", "insp").alias("si_ratio"),
                    D.ratio_text(F.col("si"), F.col("insp")).alias("si_pct"))


@register("dash_totals", f"""
WITH {FACTS_SQL}
SELECT CAST(SUM(si) AS BIGINT) AS total_si, CAST(SUM(insp) AS BIGINT) AS total_insp,
       {RATIO_SQL.format(si='SUM(si)', insp='SUM(insp)')} AS si_ratio,
       CAST(COUNT(DISTINCT COALESCE(NULLIF(channel, ''), 'Unknown')) AS BIGINT) AS channel_count
FROM facts""")
def q_dash_totals(spark, sf_dir):
    return D.totals(facts(spark, sf_dir))


@register("dash_by_channel", f"""
WITH {FACTS_SQL}
SELECT COALESCE(NULLIF(channel, ''), 'Unknown') AS channel, CAST(SUM(si) AS BIGINT) AS si,
       CAST(SUM(insp) AS BIGINT) AS insp
FROM facts GROUP BY 1""")
def q_dash_by_channel(spark, sf_dir):
    return D.by_channel(facts(spark, sf_dir))


@register("dash_detail", f"""
WITH {FACTS_SQL}
SELECT month, COALESCE(NULLIF(channel, ''), 'Unknown') AS channel, si, insp,
       {RATIO_SQL.format(si='si', insp='insp')} AS si_pct
FROM facts""")
def q_dash_detail(spark, sf_dir):
    return D.detail(facts(spark, sf_dir))


@register("dash_facets", f"""
WITH {FACTS_SQL},
named AS (SELECT month, COALESCE(NULLIF(channel, ''), 'Unknown') AS channel, si, insp FROM facts)
SELECT COALESCE(month, 'All') AS month, 'All' AS channel, CAST(SUM(si) AS BIGINT) AS total_si, CAST(SUM(insp) AS BIGINT) AS total_insp,
       {RATIO_SQL.format(si='SUM(si)', insp='SUM(insp)')} AS si_ratio, CAST(COUNT(DISTINCT channel) AS BIGINT) AS channel_count
FROM named GROUP BY GROUPING SETS ((named.month), ())
UNION ALL
SELECT COALESCE(month, 'All'), named.channel, CAST(SUM(si) AS BIGINT), CAST(SUM(insp) AS BIGINT),
       {RATIO_SQL.format(si='SUM(si)', insp='SUM(insp)')}, 1
FROM named GROUP BY GROUPING SETS ((named.month, named.channel), (named.channel))""")
def q_dash_facets(spark, sf_dir):
    # the totals of every choice of month and channel, from one cube
    return build_cube(facts(spark, sf_dir), scratch_path(spark, "facet-cube")).every_choice()


@register("domain_values", f"""
WITH {FACTS_SQL}
SELECT DISTINCT 'month' AS domain, month AS value FROM facts
UNION SELECT DISTINCT 'channel', COALESCE(NULLIF(channel, ''), 'Unknown') FROM facts""")
def q_domain_values(spark, sf_dir):
    return D.facet_values(facts(spark, sf_dir))


# ---------------------------------------------------------------------- joins

def events_per_user(spark, sf_dir):
    return T(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))


def debtors(spark, sf_dir):
    """Customers keyed like the event users."""
    c = T(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("user_id"), "c_name")


@register("join_left", """
SELECT c.c_custkey, CAST(e.event_id AS DOUBLE) AS event_id, e.value
FROM customer c LEFT JOIN events e ON c.c_custkey = e.user_id""")
def q_join_left(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select("c_custkey")
    e = T(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return as_double(join_on(c, e, "c_custkey", "user_id", "LEFT JOIN").select("c_custkey", "event_id", "value"),
                     "event_id")


@register("join_inner", """
SELECT c.c_custkey, e.event_id, e.value FROM customer c JOIN events e ON c.c_custkey = e.user_id""")
def q_join_inner(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select("c_custkey")
    e = T(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return join_on(c, e, "c_custkey", "user_id", "INNER JOIN").select("c_custkey", "event_id", "value")


@register("join_right", """
SELECT CAST(e.event_id AS DOUBLE) AS event_id, c.c_custkey, c.c_name FROM events e RIGHT JOIN customer c ON e.user_id = c.c_custkey""")
def q_join_right(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_name")
    e = T(spark, sf_dir, "events").select("event_id", "user_id")
    return as_double(join_on(e, c, "user_id", "c_custkey", "RIGHT JOIN").select("event_id", "c_custkey", "c_name"),
                     "event_id")


@register("join_full", """
SELECT CAST(t.user_id AS DOUBLE) AS event_user, CAST(d.c_custkey AS DOUBLE) AS debtor,
       CAST(t.n_events AS DOUBLE) AS n_events, d.c_name
FROM (SELECT user_id, COUNT(*) AS n_events FROM events GROUP BY user_id) t
FULL OUTER JOIN customer d ON t.user_id = d.c_custkey""")
def q_join_full(spark, sf_dir):
    t = events_per_user(spark, sf_dir)
    d = T(spark, sf_dir, "customer").select("c_custkey", "c_name")
    out = join_on(t, d, "user_id", "c_custkey", "FULL OUTER JOIN").select(
        F.col("user_id").alias("event_user"), F.col("c_custkey").alias("debtor"), "n_events", "c_name")
    return as_double(out, "event_user", "debtor", "n_events")


@register("join_using", """
SELECT user_id, CAST(t.n_events AS DOUBLE) AS n_events, d.c_name
FROM (SELECT user_id, COUNT(*) AS n_events FROM events GROUP BY user_id) t
FULL OUTER JOIN (SELECT c_custkey AS user_id, c_name FROM customer) d USING (user_id)""")
def q_join_using(spark, sf_dir):
    return as_double(join_on(events_per_user(spark, sf_dir), debtors(spark, sf_dir), "user_id", "user_id", "full"),
                     "n_events")


@register("join_on_diff", """
SELECT e.event_id, e.user_id, c.c_custkey, c.c_mktsegment FROM events e
LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def q_join_on_diff(spark, sf_dir):
    e = T(spark, sf_dir, "events").select("event_id", "user_id")
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return join_on(e, c, "user_id", "c_custkey", "left").select("event_id", "user_id", "c_custkey", "c_mktsegment")


@register("join_star", """
SELECT o.o_orderkey, c.c_name, CAST(li.n_lines AS DOUBLE) AS n_lines, CAST(li.qty AS DOUBLE) AS qty
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT l_orderkey AS o_orderkey, CAST(COUNT(*) AS BIGINT) AS n_lines, SUM(l_quantity) AS qty
           FROM lineitem GROUP BY l_orderkey) li USING (o_orderkey)""")
def q_join_star(spark, sf_dir):
    orders = T(spark, sf_dir, "orders")
    tables = {
        "customer": T(spark, sf_dir, "customer"),
        "li": T(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
                                          .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty")),
    }
    specs = [JoinSpec("customer", "o_custkey", "c_custkey", "LEFT JOIN"),
             JoinSpec("li", "o_orderkey", "o_orderkey", "LEFT JOIN"),
             JoinSpec("supplier", None, "s_suppkey")]          # incomplete: skipped
    j = star_join(orders, "o", specs, tables)
    return as_double(j.select("o_orderkey", F.col("customer.c_name"), F.col("li.n_lines"), F.col("li.qty")),
                     "n_lines")


REPORT_SQL = """
WITH il AS (
  SELECT o_orderkey AS appointment_id, o_custkey AS inspection_by, 0 AS version,
         CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE lower(o_orderstatus) END AS inspection_status,
         o_orderdate AS inspection_end_time, o_custkey AS store_id FROM orders),
cl AS (
  SELECT c.c_custkey AS centre_id, r.r_name AS region, n.n_name AS city, c.c_name AS centre
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
fbsrc AS (
  SELECT l_orderkey AS appointment_id, CAST(l_quantity AS INTEGER) AS feedback_rating, l_shipdate AS created_at,
         l_returnflag AS feedbacks, l_linestatus AS additional_comment FROM lineitem),
fo AS (
  SELECT o_orderkey AS pub_appt_id, o_orderpriority AS "Store Type", o_totalprice > 100000 AS verified,
         'store_' || CAST(o_custkey AS VARCHAR) AS store_name FROM orders),
t4 AS (
  SELECT DISTINCT il.appointment_id, il.inspection_by, il.version, il.inspection_status, cl.region, cl.city, cl.centre,
         CAST(il.inspection_end_time AS DATE) AS dat
  FROM il LEFT JOIN cl ON cl.centre_id = il.store_id
  WHERE il.version = 0 AND il.inspection_status = 'done'
    AND CAST(il.inspection_end_time AS DATE) BETWEEN DATE '1994-01-01' AND DATE '1994-12-31'
),
fb AS (
  SELECT * FROM (
    SELECT appointment_id, feedback_rating, created_at, feedbacks, additional_comment,
           DENSE_RANK() OVER (PARTITION BY appointment_id ORDER BY created_at DESC) AS rnk
    FROM fbsrc WHERE feedback_rating IS NOT NULL) WHERE rnk = 1)
SELECT t4.appointment_id, t4.inspection_by, t4.version, t4.inspection_status, t4.region, t4.city, t4.centre,
       strftime(t4.dat, '%Y-%m-%d') AS dat, CAST(fb.feedback_rating AS DOUBLE) AS feedback_rating,
       strftime(fb.created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, fb.feedbacks, fb.additional_comment,
       fo."Store Type", fo.verified, fo.store_name
FROM t4 LEFT JOIN fb ON fb.appointment_id = t4.appointment_id
LEFT JOIN fo ON fo.pub_appt_id = t4.appointment_id"""


def report(spark, sf_dir, first, last):
    ins = report_inputs_from_tables(T(spark, sf_dir, "orders"), T(spark, sf_dir, "customer"),
                                    T(spark, sf_dir, "nation"), T(spark, sf_dir, "region"),
                                    T(spark, sf_dir, "lineitem"))
    out = inspection_feedback_report(ins["inspection_log"], ins["centre_list"], ins["feedback"],
                                     ins["store_info"], first, last)
    out = out.withColumn("dat", day_text("dat")).withColumn("created_at", ts_text("created_at"))
    return as_double(out, "feedback_rating")


@register("join_colocated", """
SELECT o.o_orderkey, o.o_custkey, CAST(COUNT(*) AS BIGINT) AS n_lines, CAST(MAX(l.l_extendedprice) AS DOUBLE) AS top_price
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey, o.o_custkey""")
def q_join_colocated(spark, sf_dir):
    # both tables are stored in equal buckets of the order key; the pre-sum of the lines and the join need no further exchange
    t = write_colocated({"orders": (T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey"),
                         "lineitem": (T(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice"), "l_orderkey")}, 8)
    lines = t["lineitem"].groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_extendedprice").cast("double").alias("top_price"))
    return t["orders"].hint("merge").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_custkey", "n_lines", "top_price")


@register("join_enrich", REPORT_SQL.replace("1994-01-01", "1996-01-01").replace("1994-12-31", "1996-12-31"))
def q_join_enrich(spark, sf_dir):
    return report(spark, sf_dir, "1996-01-01", "1996-12-31")


@register("proj_derived_tbl_report", REPORT_SQL.replace("1994-01-01", "1998-04-01").replace("1994-12-31", "1998-04-30"))
def q_report_month(spark, sf_dir):
    # The shipped report over one month (derived tables feeding three left joins).
    return report(spark, sf_dir, "1998-04-01", "1998-04-30")


@register("win_latest", """
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (
  SELECT *, DENSE_RANK() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rnk FROM events WHERE value IS NOT NULL)
WHERE rnk = 1""")
def q_win_latest(spark, sf_dir):
    e = T(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    out = latest_per_key(e, "user_id", "ts", where=F.col("value").isNotNull())
    return out.select("event_id", "user_id", "event_type", ts_text("ts").alias("ts"))


@register("win_latest_ties", """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS shipped FROM (
  SELECT *, DENSE_RANK() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) AS rnk FROM lineitem)
WHERE rnk = 1""")
def q_win_latest_ties(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    out = latest_per_key(li, "l_orderkey", "l_shipdate")
    return out.select("l_orderkey", "l_linenumber", ts_text("l_shipdate").alias("shipped"))


# ------------------------------------------------------------ sort, limit, set

@register("limit", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def q_limit(spark, sf_dir):
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_n(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 25)


@register("union_pos", """
SELECT o_orderkey AS k, o_totalprice AS v FROM orders
UNION ALL
SELECT l_orderkey, l_extendedprice FROM lineitem""")
def q_union_pos(spark, sf_dir):
    a = T(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    b = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    return union_positional(a, b)


"""Measure queries, all expressed through the spec builder."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.operators.joins import JoinSpec
from kpiloom.operators.measures import Measure, case_sum
from kpiloom.plans.builder import BuildSpec, build
from kpiloom.sources.tables import table
from kpiloom.workloads import register, to_doubles


def tables(spark, sf_dir, *names):
    return {n: table(spark, sf_dir, n) for n in names}


def run(spark, sf_dir, spec: BuildSpec, *names):
    return to_doubles(build(spec, tables(spark, sf_dir, *names)))


GROUP = "GROUP BY l_returnflag, l_linestatus"


@register("agg_count", f"""
SELECT l_returnflag, l_linestatus, CAST(COUNT(*) AS BIGINT) AS n_lines, CAST(COUNT(l_tax) AS BIGINT) AS n_taxed
FROM lineitem {GROUP}""")
def q_agg_count(spark, sf_dir):
    spec = BuildSpec("lineitem", group_by=["l_returnflag", "l_linestatus"],
                     measures=[Measure(alias="n_lines"), Measure(alias="n_taxed", column="l_tax")])
    return run(spark, sf_dir, spec, "lineitem")


@register("agg_sum", f"""
SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS sum_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price
FROM lineitem {GROUP}""")
def q_agg_sum(spark, sf_dir):
    spec = BuildSpec("lineitem", group_by=["l_returnflag", "l_linestatus"],
                     measures=[Measure(alias="sum_qty", func="SUM", column="l_quantity"),
                               Measure(alias="sum_price", func="SUM",
                                       column="CAST(l_extendedprice AS DECIMAL(18,2))")])
    return run(spark, sf_dir, spec, "lineitem")


@register("agg_avg", f"""
SELECT l_returnflag, l_linestatus, AVG(l_quantity) AS avg_qty FROM lineitem {GROUP}""")
def q_agg_avg(spark, sf_dir):
    spec = BuildSpec("lineitem", group_by=["l_returnflag", "l_linestatus"],
                     measures=[Measure(alias="avg_qty", func="AVG", column="l_quantity")])
    return run(spark, sf_dir, spec, "lineitem")


@register("agg_min", f"""
SELECT l_returnflag, l_linestatus, MIN(l_extendedprice) AS min_price, MIN(l_shipdate)::DATE::VARCHAR AS first_ship
FROM lineitem {GROUP}""")
def q_agg_min(spark, sf_dir):
    spec = BuildSpec("lineitem", group_by=["l_returnflag", "l_linestatus"],
                     measures=[Measure(alias="min_price", func="MIN", column="l_extendedprice"),
                               Measure(alias="first_ship", func="MIN",
                                       column="date_format(l_shipdate, 'yyyy-MM-dd')")])
    return run(spark, sf_dir, spec, "lineitem")


@register("agg_max", f"""
SELECT l_returnflag, l_linestatus, MAX(l_extendedprice) AS max_price, MAX(l_discount) AS max_discount
FROM lineitem {GROUP}""")
def q_agg_max(spark, sf_dir):
    spec = BuildSpec("lineitem", group_by=["l_returnflag", "l_linestatus"],
                     measures=[Measure(alias="max_price", func="MAX", column="l_extendedprice"),
                               Measure(alias="max_discount", func="MAX", column="l_discount")])
    return run(spark, sf_dir, spec, "lineitem")


@register("agg_count_distinct", """
SELECT event_type, CAST(COUNT(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(COUNT(DISTINCT CAST(ts AS DATE)) AS BIGINT) AS n_days
FROM events GROUP BY event_type""")
def q_agg_count_distinct(spark, sf_dir):
    spec = BuildSpec("events", group_by=["event_type"],
                     measures=[Measure(alias="n_users", func="COUNT DISTINCT", column="user_id"),
                               Measure(alias="n_days", func="COUNT_DISTINCT", column="to_date(ts)")])
    return run(spark, sf_dir, spec, "events")


SLAB_SQL = """CASE WHEN l_quantity >= 1 AND l_quantity <= 10 THEN 5 WHEN l_quantity >= 11 AND l_quantity <= 25 THEN 15
     WHEN l_quantity >= 26.5 AND l_quantity <= 40 THEN 30 WHEN l_quantity >= 45 THEN 50 ELSE 0 END"""

SLABS = [{"min": 1, "max": 10, "value": 5}, {"min": 11, "max": 25, "value": 15},
         {"min": 26.5, "max": 40, "value": 30}, {"min": 45, "max": None, "value": 50},
         {"min": None, "max": "", "value": 99}]     # no bound: dropped


@register("meas_slab", f"""
SELECT l_returnflag, l_linestatus, CAST(SUM({SLAB_SQL}) AS BIGINT) AS slab_sum,
       CAST(MAX({SLAB_SQL}) AS BIGINT) AS slab_max, AVG({SLAB_SQL}) AS slab_avg
FROM lineitem {GROUP}""")
def q_meas_slab(spark, sf_dir):
    spec = BuildSpec("lineitem", group_by=["l_returnflag", "l_linestatus"], measures=[
        Measure(kind="slab", alias="slab_sum", column="l_quantity", slabs=SLABS, outer_func="SUM"),
        Measure(kind="slab", alias="slab_max", column="l_quantity", slabs=SLABS, outer_func="MAX"),
        Measure(kind="slab", alias="slab_avg", column="l_quantity", slabs=SLABS, outer_func="AVG"),
        Measure(kind="slab", alias="unused", column="l_quantity", slabs=[{"value": 1}]),   # dropped
    ])
    out = build(spec, tables(spark, sf_dir, "lineitem"))
    return out.select("l_returnflag", "l_linestatus", F.col("slab_sum").cast("bigint"),
                      F.col("slab_max").cast("bigint"), F.col("slab_avg").cast("double"))


@register("meas_flat", """
SELECT user_id, CAST(COUNT(event_id) * 150 AS BIGINT) AS per_unit_pay FROM events
GROUP BY user_id""")
def q_meas_flat(spark, sf_dir):
    spec = BuildSpec("events", group_by=["user_id"],
                     measures=[Measure(kind="flat", alias="per_unit_pay", column="event_id", per_unit=150)])
    return build(spec, tables(spark, sf_dir, "events")).withColumn("per_unit_pay", F.col("per_unit_pay").cast("bigint"))


@register("agg_case_sum", """
SELECT user_id, CAST(SUM(CASE WHEN value >= 200 THEN 100 ELSE 50 END) AS BIGINT) AS rating_pay
FROM events GROUP BY user_id""")
def q_agg_case_sum(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(case_sum(F.col("value") >= 200, 100, 50, "rating_pay").cast("bigint")
                                    .alias("rating_pay"))


@register("agg_global", """
SELECT CAST(COUNT(*) AS BIGINT) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS n_customers
FROM orders""")
def q_agg_global(spark, sf_dir):
    spec = BuildSpec("orders", measures=[
        Measure(alias="n_orders"),
        Measure(alias="revenue", func="SUM", column="CAST(o_totalprice AS DECIMAL(18,2))"),
        Measure(alias="n_customers", func="COUNT_DISTINCT", column="o_custkey")])
    return run(spark, sf_dir, spec, "orders")


@register("agg_group_only", """
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders""")
def q_agg_group_only(spark, sf_dir):
    spec = BuildSpec("orders", group_by=["o_orderstatus", "o_orderpriority"])
    return run(spark, sf_dir, spec, "orders")


@register("builder", """
SELECT c.c_mktsegment, orders.o_orderpriority, CAST(COUNT(*) AS BIGINT) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       CAST(SUM(CASE WHEN o_totalprice >= 0 AND o_totalprice <= 100000 THEN 10
                     WHEN o_totalprice >= 100001 THEN 25 ELSE 0 END) AS BIGINT) AS slab_pay,
       CAST(COUNT(o_orderkey) * 2 AS BIGINT) AS flat_pay,
       CAST(SUM(ol.n_lines) AS BIGINT) AS n_lines
FROM orders
LEFT JOIN customer c ON orders.o_custkey = c.c_custkey
LEFT JOIN (SELECT l_orderkey AS o_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY 1) ol USING (o_orderkey)
WHERE o_orderstatus = 'F'
GROUP BY c.c_mktsegment, orders.o_orderpriority""")
def q_builder(spark, sf_dir):
    sheets = tables(spark, sf_dir, "orders", "customer", "region")
    sheets["order_lines"] = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")) \
                                                           .agg(F.count(F.lit(1)).alias("n_lines"))
    spec = BuildSpec(
        base="orders",
        joins=[JoinSpec("customer", "o_custkey", "c_custkey", "LEFT JOIN"),       # ON base.k = right.k
               JoinSpec("order_lines", "o_orderkey", "o_orderkey", "LEFT JOIN"),  # same name: USING
               JoinSpec("region", "", "r_regionkey")],                            # incomplete: skipped
        group_by=["customer.c_mktsegment", "o_orderpriority"],
        measures=[Measure(alias="n_orders"),
                  Measure(alias="revenue", func="SUM", column="CAST(o_totalprice AS DECIMAL(18,2))"),
                  Measure(kind="slab", alias="slab_pay", column="o_totalprice",
                          slabs=[(0, 100000, 10), (100001, None, 25)]),
                  Measure(kind="flat", alias="flat_pay", column="o_orderkey", per_unit=2),
                  Measure(alias="n_lines", func="SUM", column="order_lines.n_lines")],
        where="o_orderstatus = 'F'")
    out = to_doubles(build(spec, sheets))
    return out.select("c_mktsegment", "o_orderpriority", "n_orders", "revenue", F.col("slab_pay").cast("bigint"),
                      F.col("flat_pay").cast("bigint"), F.col("n_lines").cast("bigint"))

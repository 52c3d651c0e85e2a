"""Flagship: consolidated payout per person, and the operators around it
(pre-sum, row total, cards, sort, top earner, paging, search)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.scalars import NULL_KEY, from_parts, from_units, key_norm, money_parts
from kpiloom.functions.search import search_summary
from kpiloom.operators.consolidate import Mapping, consolidate, mappings_for, payout_cards, presum, q, row_total
from kpiloom.operators.order_index import build_order
from kpiloom.operators.joins import full_merge
from kpiloom.operators.paging import page, page_count, top_n
from kpiloom.session import scratch_path
from kpiloom.sources.tables import table
from kpiloom.workloads import register


def kpi_sheets(spark, sf_dir) -> dict[str, DataFrame]:
    """Three KPI tables keyed by person (customer / user id).

    * order_kpi: every order's total price, keyed by ``o_custkey``
    * event_kpi: every event's value, keyed by ``user_id``
    * line_kpi:  net line revenue per customer -- lineitem is first summed per
      order (map-side partial aggregate), then joined to orders, so the join
      sees one row per order instead of one per line.
    """
    orders = table(spark, sf_dir, "orders")
    events = table(spark, sf_dir, "events")
    lines = table(spark, sf_dir, "lineitem")
    # net = price * (1 - discount), exactly, in 1e-4 units: cents x (100 - discount points)
    net_units = (F.rint(F.col("l_extendedprice") * 100).cast("long")
                 * (F.lit(100) - F.rint(F.col("l_discount") * 100).cast("long")))
    per_order = lines.groupBy("l_orderkey").agg(from_units(F.sum(net_units)).alias("line_payout"))
    line_kpi = (per_order.join(orders.select("o_orderkey", "o_custkey"),
                               per_order.l_orderkey == orders.o_orderkey)
                .select(F.col("o_custkey").alias("inspector"), "line_payout"))
    return {
        "order_kpi": orders.select("o_custkey", "o_totalprice"),
        "event_kpi": events.select("user_id", "value"),
        "line_kpi": line_kpi,
    }


def flagship_mappings(spark, sf_dir) -> list[Mapping]:
    s = kpi_sheets(spark, sf_dir)
    return (mappings_for(s["order_kpi"], "order_kpi", key_col="o_custkey", val_cols=["o_totalprice"])
            + mappings_for(s["event_kpi"], "event_kpi", key_col="user_id", val_cols=["value"])
            # default detection: key `inspector`, value `line_payout` (contains "payout")
            + mappings_for(s["line_kpi"], "line_kpi"))


def flagship(spark, sf_dir, sort: bool = True) -> DataFrame:
    return consolidate(flagship_mappings(spark, sf_dir), sort=sort)


KEY = r"lower(regexp_replace(CAST({c} AS VARCHAR), '^\s+|\s+$', '', 'g'))"

PRESUMS = f"""
t0 AS (SELECT {KEY.format(c='o_custkey')} AS cj_id, SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS order_kpi
       FROM orders GROUP BY 1),
t1 AS (SELECT {KEY.format(c='user_id')} AS cj_id, SUM(CAST(value AS DECIMAL(38,4))) AS event_kpi
       FROM events GROUP BY 1),
t2 AS (SELECT {KEY.format(c='o.o_custkey')} AS cj_id,
              SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2)))) AS line_kpi
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1)"""

MERGED = f"""
WITH {PRESUMS},
m AS (SELECT cj_id, COALESCE(order_kpi, 0) AS a, COALESCE(event_kpi, 0) AS b, COALESCE(line_kpi, 0) AS c
      FROM t0 FULL OUTER JOIN t1 USING (cj_id) FULL OUTER JOIN t2 USING (cj_id))
SELECT cj_id, CAST(a AS DOUBLE) AS order_kpi, CAST(b AS DOUBLE) AS event_kpi, CAST(c AS DOUBLE) AS line_kpi,
       CAST(a + b + c AS DOUBLE) AS total_incentive
FROM m"""


@register("consolidate", MERGED)
def q_consolidate(spark, sf_dir):
    return flagship(spark, sf_dir)


@register("join_nway_full", MERGED)
def q_join_nway_full(spark, sf_dir):
    # Each table summed per person first, then one full merge of all persons of the three; the sums stay whole part and rest
    # until the end, so that totals are exact.
    mappings = flagship_mappings(spark, sf_dir)
    sums = []
    for m in mappings:
        whole, rest = money_parts(q(m.val_col), m.df.schema[m.val_col].dataType)
        key = key_norm(q(m.key_col), NULL_KEY, m.df.schema[m.key_col].dataType).alias("cj_id")
        rows = m.df.select(key, whole.alias("_w"), rest.alias("_r"))
        sums.append(rows.groupBy("cj_id").agg(F.sum("_w").alias(f"{m.label}_w"), F.sum("_r").alias(f"{m.label}_r")))
    merged = full_merge(sums, "cj_id").na.fill(0)
    parts = [(F.col(f"{m.label}_w"), F.col(f"{m.label}_r")) for m in mappings]
    total = from_parts(*[reduce(Column.__add__, own) for own in zip(*parts)]).alias("total_incentive")
    out = merged.select("cj_id", *[from_parts(*p).alias(m.label) for p, m in zip(parts, mappings)], total)
    return out.orderBy(F.col("total_incentive").desc(), "cj_id")


@register("agg_key_presum", f"""
SELECT {KEY.format(c='user_id')} AS cj_id, CAST(SUM(CAST(value AS DECIMAL(38,4))) AS DOUBLE) AS event_kpi
FROM events GROUP BY 1""")
def q_agg_key_presum(spark, sf_dir):
    return presum(table(spark, sf_dir, "events"), "user_id", "value", label="event_kpi")


@register("row_total", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS tax_amount,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2))
            + CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS gross
FROM lineitem""")
def q_row_total(spark, sf_dir):
    # gross per line = price + tax amount, summed across the two columns of each row
    li = table(spark, sf_dir, "lineitem")
    tax = (F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(18,2)")).cast("double")
    rows = li.select("l_orderkey", "l_linenumber", "l_extendedprice", tax.alias("tax_amount"))
    return row_total(rows, ["l_extendedprice", "tax_amount"], "gross")


CARDS = f"""
WITH {PRESUMS},
m AS (SELECT cj_id, COALESCE(order_kpi, 0) + COALESCE(event_kpi, 0) + COALESCE(line_kpi, 0) AS t
      FROM t0 FULL OUTER JOIN t1 USING (cj_id) FULL OUTER JOIN t2 USING (cj_id))
SELECT CAST(COUNT(*) AS BIGINT) AS total_people,
       CAST(TRUNC(SUM(t)) AS BIGINT) AS total_payout,
       CAST(TRUNC(AVG(t)) AS BIGINT) AS avg_payout,
       arg_min(cj_id, (-t, cj_id)) AS top_earner
FROM m"""


@register("payout_cards", CARDS)
def q_payout_cards(spark, sf_dir):
    return payout_cards(flagship(spark, sf_dir, sort=False))


TOP = f"""
WITH {PRESUMS},
m AS (SELECT cj_id, COALESCE(order_kpi, 0) + COALESCE(event_kpi, 0) + COALESCE(line_kpi, 0) AS t
      FROM t0 FULL OUTER JOIN t1 USING (cj_id) FULL OUTER JOIN t2 USING (cj_id))
SELECT cj_id, CAST(t AS DOUBLE) AS total_incentive FROM m
ORDER BY t DESC, cj_id LIMIT {{n}} OFFSET {{off}}"""


@register("top1", TOP.format(n=1, off=0))
def q_top1(spark, sf_dir):
    return top_n(flagship(spark, sf_dir, sort=False).select("cj_id", "total_incentive"),
                 [F.col("total_incentive").desc(), F.col("cj_id").asc()], 1)


@register("sort_total", f"""
WITH {PRESUMS},
m AS (SELECT cj_id, COALESCE(order_kpi, 0) + COALESCE(event_kpi, 0) + COALESCE(line_kpi, 0) AS t
      FROM t0 FULL OUTER JOIN t1 USING (cj_id) FULL OUTER JOIN t2 USING (cj_id))
SELECT cj_id, CAST(t AS DOUBLE) AS total_incentive,
       CAST(ROW_NUMBER() OVER (ORDER BY t DESC, cj_id) AS BIGINT) AS position FROM m""")
def q_sort_total(spark, sf_dir):
    # The global sort is a range-partitioned shuffle; the position is derived
    # without a single-partition window (see operators.paging.with_position).
    from kpiloom.operators.paging import with_position
    merged = flagship(spark, sf_dir, sort=False).select("cj_id", "total_incentive")
    return with_position(merged, [F.col("total_incentive").desc(), F.col("cj_id").asc()], "position")


@register("page", TOP.format(n=500, off=500))
def q_page(spark, sf_dir):
    # Page 2 of the payout table, 500 rows per page.
    return page(flagship(spark, sf_dir, sort=False).select("cj_id", "total_incentive"),
                [F.col("total_incentive").desc(), F.col("cj_id").asc()], 2, 500)


@register("page_indexed", f"""
WITH {PRESUMS},
m AS (SELECT cj_id, COALESCE(order_kpi, 0) + COALESCE(event_kpi, 0) + COALESCE(line_kpi, 0) AS t
      FROM t0 FULL OUTER JOIN t1 USING (cj_id) FULL OUTER JOIN t2 USING (cj_id)),
p AS (SELECT cj_id, CAST(t AS DOUBLE) AS total_incentive, (ROW_NUMBER() OVER (ORDER BY t DESC, cj_id) - 1) // 40 + 1 AS page_no FROM m)
SELECT CAST(page_no AS INT) AS page_no, cj_id, total_incentive FROM p WHERE page_no IN (1, 2, (SELECT MAX(page_no) FROM p))""")
def q_page_indexed(spark, sf_dir):
    # the payout table is stored in its order; the first two pages and the last one are read from their ranges
    merged = flagship(spark, sf_dir, sort=False).select("cj_id", "total_incentive")
    index = build_order(merged, [("total_incentive", True), ("cj_id", False)], scratch_path(spark, "order-index"), range_rows=1 << 12)
    out = None
    for no in sorted({1, 2, page_count(index.count(), 40)}):
        one = index.page(no, 40).select(F.lit(no).alias("page_no"), "cj_id", F.col("total_incentive").cast("double").alias("total_incentive"))
        out = one if out is None else out.unionByName(one)
    return out


@register("search_col", f"""
WITH {PRESUMS},
m AS (SELECT cj_id, COALESCE(order_kpi, 0) + COALESCE(event_kpi, 0) + COALESCE(line_kpi, 0) AS t
      FROM t0 FULL OUTER JOIN t1 USING (cj_id) FULL OUTER JOIN t2 USING (cj_id))
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COALESCE(SUM(t), 0) AS DOUBLE) AS total
FROM m WHERE regexp_matches(cj_id, '1[0-4]$', 'i')""")
def q_search_col(spark, sf_dir):
    merged = flagship(spark, sf_dir, sort=False)
    return search_summary(merged.withColumn("total_incentive", F.col("total_incentive").cast("decimal(38,4)")),
                          "cj_id", "1[0-4]$", "total_incentive")


__all__ = ["flagship", "kpi_sheets"]

"""Scheme rules applied to the test tables.

Mapping (SURVEY 7.3): an inspection is an ``events`` row (inspector =
``user_id``); done / five-star / one-star = ``view`` / ``purchase`` /
``error``; region class T7 = the user's customer nation in region 0 or 1;
SP orders = ``orders`` per customer per day; a quality case is an order
costing ``o_totalprice / 20``; km = ``value`` of done inspections; booking
time = inspection time minus 30 minutes; joining day = first order day.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.functions.scalars import from_units, money_units
from kpiloom.operators import rules as R
from kpiloom.operators.consolidate import Mapping, net_payout
from kpiloom.operators.joins import slab_join
from kpiloom.sources.scheme import load_scheme, scheme_amount
from kpiloom.sources.tables import table
from kpiloom.workloads import as_double, register


def T(spark, sf_dir, name):
    return table(spark, sf_dir, name)


# The test people have few inspections a month: the sheet's bonus row is put at a level that some of them reach.
EXCELLENCE_ROW = ">50 Inspections/Month + 20% Conversion"


def sheet_with(spark, changes: dict[str, str], column: str = "Slab_or_Range"):
    """The built-in sheet with other texts for the named sub-categories."""
    text = F.col(column)
    for name, value in changes.items():
        text = F.when(F.col("Sub_Category") == name, F.lit(value)).otherwise(text)
    return load_scheme(spark).withColumn(column, text)


def parsed_scheme(spark):
    return R.scheme_parse(load_scheme(spark))


def person_class(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = T(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    cls = F.when(F.col("n_regionkey").isin(0, 1), F.lit("T7 Regions")).otherwise(F.lit("Non T7"))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("person"), cls.alias("condition"))


def productivity(spark, sf_dir):
    daily = R.daily_counts(T(spark, sf_dir, "events"), "user_id", "ts")
    return R.daily_slab_incentive(daily, R.builtin(spark).slabs["Productivity"],
                                  person_class(spark, sf_dir), alias="productivity_incentive")


def sp_orders(spark, sf_dir):
    daily = R.daily_counts(T(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")
    return R.daily_slab_incentive(daily, R.builtin(spark).slabs["SP / SP Lite"], alias="sp_incentive")


def flat(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    et = F.col("event_type")
    return R.flat_incentives(e, "user_id", [
        ("sp_pro", et == "view", scheme_amount("SP Pro")),
        ("pdi", et == "click", scheme_amount("PDI")),
        ("five_star", et == "purchase", scheme_amount("CJ 5 Star Rating")),
        ("referral", et == "signup", scheme_amount("Referral")),
    ])


def night(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    booked = F.col("ts") - F.expr("INTERVAL 30 MINUTES")
    return R.night_incentive(e, "user_id", booked, F.col("ts"), scheme_amount("Night Inspection"))


def cases(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    return o.select("o_custkey", "o_orderdate", (F.col("o_totalprice").cast("decimal(18,2)") / 20).alias("cost"))


def im_penalty(spark, sf_dir):
    return R.im_slab_penalty(cases(spark, sf_dir), "o_custkey", "cost", R.builtin(spark).slabs["IM"])


def one_star(spark, sf_dir):
    return R.per_unit_penalty(T(spark, sf_dir, "events"), "user_id", F.col("event_type") == "error",
                              scheme_amount("1 Star Rating"), "one_star_penalty")


def reimbursement(spark, sf_dir):
    return R.km_reimbursement(T(spark, sf_dir, "events"), "user_id", F.col("value"),
                              F.col("event_type") == "view", scheme_amount("Conveyance"))


# -------------------------------------------------------------- oracle pieces

CLS_SQL = """cls AS (SELECT c_custkey, CASE WHEN n_regionkey IN (0, 1) THEN 'T7' ELSE 'NT7' END AS cls
             FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
PROD_CASE = """CASE WHEN cls = 'T7' THEN CASE WHEN n >= 9 THEN 1000 WHEN n = 8 THEN 800 WHEN n = 7 THEN 500
                                         WHEN n = 6 THEN 300 WHEN n = 5 THEN 100 ELSE 0 END
          WHEN cls = 'NT7' THEN CASE WHEN n >= 9 THEN 1000 WHEN n = 8 THEN 700 WHEN n = 7 THEN 500
                                          WHEN n = 6 THEN 300 WHEN n = 5 THEN 150 WHEN n = 4 THEN 50 ELSE 0 END
          ELSE 0 END"""
PROD_SQL = f"""
WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events GROUP BY 1, 2), {CLS_SQL}
SELECT user_id AS person, CAST(SUM({PROD_CASE}) AS DOUBLE) AS productivity_incentive,
       CAST(COUNT(*) AS BIGINT) AS active_days
FROM daily LEFT JOIN cls ON user_id = c_custkey GROUP BY user_id"""

SP_CASE = """CASE WHEN n >= 9 THEN 800 WHEN n = 8 THEN 700 WHEN n = 7 THEN 600 WHEN n = 6 THEN 500 WHEN n = 5 THEN 400
          WHEN n = 4 THEN 300 WHEN n = 3 THEN 200 WHEN n = 2 THEN 130 WHEN n = 1 THEN 40 ELSE 0 END"""
SP_SQL = f"""
WITH daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey AS person, CAST(SUM({SP_CASE}) AS DOUBLE) AS sp_incentive, CAST(COUNT(*) AS BIGINT) AS active_days
FROM daily GROUP BY o_custkey"""

FLAT_SQL = """
SELECT user_id AS person,
       CAST(COUNT(*) FILTER (WHERE event_type = 'view') * 150 AS DOUBLE) AS sp_pro,
       CAST(COUNT(*) FILTER (WHERE event_type = 'click') * 50 AS DOUBLE) AS pdi,
       CAST(COUNT(*) FILTER (WHERE event_type = 'purchase') * 10 AS DOUBLE) AS five_star,
       CAST(COUNT(*) FILTER (WHERE event_type = 'signup') * 4000 AS DOUBLE) AS referral
FROM events GROUP BY user_id"""

NIGHT_SQL = """
SELECT user_id AS person,
       CAST(COUNT(*) FILTER (WHERE hour(ts - INTERVAL 30 MINUTE) >= 18 AND hour(ts - INTERVAL 30 MINUTE) < 22
                                AND hour(ts) >= 18 AND hour(ts) < 22) * 150 AS DOUBLE) AS night_incentive
FROM events GROUP BY user_id"""

IM_CASE = """CASE WHEN cost >= 1 AND cost <= 2000 THEN 500 WHEN cost >= 2001 AND cost <= 5000 THEN 1000
          WHEN cost >= 5001 AND cost <= 7500 THEN 1500 WHEN cost >= 7501 AND cost <= 10000 THEN 2500 ELSE 0 END"""
CASES_SQL = "cases AS (SELECT o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) * 0.05 AS cost FROM orders)"
IM_SQL = f"""
WITH {CASES_SQL}
SELECT o_custkey AS person, CAST(SUM({IM_CASE}) AS DOUBLE) AS im_penalty, CAST(COUNT(*) AS BIGINT) AS im_cases
FROM cases WHERE cost < 10000 GROUP BY o_custkey"""

ONE_STAR_SQL = """
SELECT user_id AS person, CAST(COUNT(*) FILTER (WHERE event_type = 'error') * 200 AS DOUBLE) AS one_star_penalty
FROM events GROUP BY user_id"""

REIMB_SQL = """
SELECT user_id AS person,
       CAST(COALESCE(SUM(CASE WHEN event_type = 'view' THEN CAST(value AS DECIMAL(18,2)) * 6 END), 0) AS DOUBLE)
         AS reimbursement
FROM events GROUP BY user_id"""


# Cost slabs by order priority in the order of a sheet: with overlaps, a nested one, gaps, shared ends, single values and open ends.
COST_SLABS = [
    ("1-URGENT", 7501, 10000, 2500.0), ("1-URGENT", 10000, 13500, 4000.0), ("1-URGENT", None, 2000, 500.0), ("1-URGENT", 2001, 5000, 1000.0),
    ("2-HIGH", 0, 30000, 10.0), ("2-HIGH", 4000, 6000, 99.0), ("2-HIGH", 20000, None, 77.0),
    ("3-MEDIUM", 4000, 6000, 99.0), ("3-MEDIUM", 0, 30000, 10.0), ("3-MEDIUM", 5000, 8000, 55.0), ("3-MEDIUM", 5500, 5500, 1.0),
    ("4-NOT SPECIFIED", 6000, None, 3.0), ("4-NOT SPECIFIED", None, 7000, 2.0)]
COST_CASE = "CASE " + " ".join(
    f"WHEN o_orderpriority = '{p}'" + (f" AND cost >= {lo}" if lo is not None else "") + (f" AND cost <= {hi}" if hi is not None else "") + f" THEN {v}"
    for p, lo, hi, v in COST_SLABS) + " ELSE 0.0 END"


@register("join_slab_range", f"""
WITH c AS (SELECT o_orderkey, o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.05 AS DOUBLE) AS cost FROM orders
           UNION ALL SELECT o_orderkey, o_orderpriority, CAST(round(o_totalprice / 20 / 500) * 500 AS DOUBLE) FROM orders)
SELECT o_orderkey, o_orderpriority, cost, CAST({COST_CASE} AS DOUBLE) AS amount FROM c""")
def q_join_slab_range(spark, sf_dir):
    # each order's cost, as it is and rounded to the slabs' ends, against overlapping slabs of its priority: one row per value
    o = T(spark, sf_dir, "orders")
    exact = o.select("o_orderkey", "o_orderpriority", (F.col("o_totalprice").cast("decimal(18,2)") / 20).cast("double").alias("cost"))
    rounded = o.select("o_orderkey", "o_orderpriority", (F.round(F.col("o_totalprice") / 20 / 500) * 500).cast("double").alias("cost"))
    sheet = spark.createDataFrame([(i, *r) for i, r in enumerate(COST_SLABS)], "place int, priority string, lo long, hi long, amount double")
    return slab_join(exact.unionAll(rounded), "cost", sheet, on=[("o_orderpriority", "priority")], else_value=0.0, order="place")


@register("inc_productivity", PROD_SQL)
def q_inc_productivity(spark, sf_dir):
    return productivity(spark, sf_dir)


@register("inc_sp_orders", SP_SQL)
def q_inc_sp_orders(spark, sf_dir):
    return sp_orders(spark, sf_dir)


@register("inc_flat", FLAT_SQL)
def q_inc_flat(spark, sf_dir):
    return flat(spark, sf_dir)


EXCELLENCE_SQL = """
SELECT user_id AS person, strftime(ts, '%Y-%m') AS month, CAST(COUNT(*) AS BIGINT) AS n,
       COUNT(*) FILTER (WHERE event_type = 'view') / COUNT(*) AS share,
       CASE WHEN COUNT(*) > 50 AND COUNT(*) FILTER (WHERE event_type = 'view') / COUNT(*) >= 0.2
            THEN 3000.0 ELSE 0.0 END::DOUBLE AS excellence_bonus
FROM events GROUP BY 1, 2"""


@register("inc_excellence", EXCELLENCE_SQL)
def q_inc_excellence(spark, sf_dir):
    # conversion = done share
    least, share, bonus = R.read_scheme(sheet_with(spark, {"Excellence Bonus": EXCELLENCE_ROW})).excellence
    return R.excellence_bonus(T(spark, sf_dir, "events"), "user_id", "ts", F.col("event_type") == "view",
                              min_count=least - 1, min_share=share, bonus=bonus)


@register("inc_night", NIGHT_SQL)
def q_inc_night(spark, sf_dir):
    return night(spark, sf_dir)


@register("pen_im_slab", IM_SQL)
def q_pen_im_slab(spark, sf_dir):
    return im_penalty(spark, sf_dir)


@register("pen_critical", f"""
WITH {CASES_SQL},
agg AS (SELECT o_custkey AS person, CAST(COUNT(*) AS BIGINT) AS n_critical, MAX(cost) AS max_cost
        FROM cases WHERE cost >= 10000 GROUP BY o_custkey),
s AS (SELECT *, CASE WHEN n_critical >= 2 OR max_cost >= 20000 THEN 'EXIT' WHEN max_cost > 13500 THEN 'ZERO'
                     WHEN max_cost >= 10000 THEN 'HALF' END AS action FROM agg)
SELECT person, n_critical, CAST(max_cost AS DOUBLE) AS max_cost, action,
       CASE WHEN action = 'HALF' THEN 0.5 ELSE 0.0 END::DOUBLE AS multiplier, action = 'EXIT' AS exit
FROM s""")
def q_pen_critical(spark, sf_dir):
    out = R.critical_penalty(cases(spark, sf_dir), "o_custkey", "cost")
    return out.withColumn("max_cost", F.col("max_cost").cast("double"))


def joined_days(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("person")).agg(F.min(F.to_date("o_orderdate")).alias("join_day"))


@register("pen_critical_new", f"""
WITH {CASES_SQL},
j AS (SELECT o_custkey AS person, MIN(CAST(o_orderdate AS DATE)) AS join_day FROM orders GROUP BY 1),
c AS (SELECT cases.o_custkey AS person, cost FROM cases JOIN j ON cases.o_custkey = j.person
      WHERE cost >= 10000 AND CAST(o_orderdate AS DATE) - join_day <= 60),
agg AS (SELECT person, CAST(COUNT(*) AS BIGINT) AS n_critical, MAX(cost) AS max_cost,
               COUNT(*) FILTER (WHERE cost <= 13500) AS n_half FROM c GROUP BY person)
SELECT person, n_critical, CAST(max_cost AS DOUBLE) AS max_cost,
       CASE WHEN n_critical >= 2 OR max_cost > 13500 THEN 'ZERO' ELSE 'FLAT' END AS action,
       CAST(CASE WHEN n_critical >= 2 OR max_cost > 13500 THEN 0 ELSE n_half * 2500 END AS DOUBLE) AS flat_penalty
FROM agg""")
def q_pen_critical_new(spark, sf_dir):
    out = R.critical_penalty_new(cases(spark, sf_dir), "o_custkey", "cost", "o_orderdate", joined_days(spark, sf_dir))
    return out.withColumn("max_cost", F.col("max_cost").cast("double"))


@register("pen_one_star", ONE_STAR_SQL)
def q_pen_one_star(spark, sf_dir):
    return one_star(spark, sf_dir)


@register("reimb_km", REIMB_SQL)
def q_reimb_km(spark, sf_dir):
    return reimbursement(spark, sf_dir)


CRITICAL_SQL = f"""
SELECT person, CASE WHEN n_old >= 2 OR max_old > 13500 THEN 0.0 WHEN n_old = 1 THEN 0.5 ELSE 1.0 END
               * CASE WHEN n_new >= 2 OR max_new > 13500 THEN 0.0 ELSE 1.0 END AS share,
       CASE WHEN n_new >= 2 OR max_new > 13500 THEN 0 ELSE n_new * 2500 END AS flat
FROM (SELECT o_custkey AS person, COUNT(*) FILTER (WHERE late) AS n_old, MAX(cost) FILTER (WHERE late) AS max_old,
             COUNT(*) FILTER (WHERE NOT late) AS n_new, MAX(cost) FILTER (WHERE NOT late) AS max_new
      FROM (SELECT c.o_custkey, cost, CAST(o_orderdate AS DATE) - join_day > 60 AS late
            FROM (SELECT o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) * 0.05 AS cost FROM orders) c
            JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS join_day FROM orders GROUP BY 1) j
              ON c.o_custkey = j.o_custkey
            WHERE cost >= 10000) GROUP BY 1)"""

NET_PARTS = {  # label -> (SQL of the person's amount, taken from)
    "productivity": ("productivity_incentive", PROD_SQL), "sp_orders": ("sp_incentive", SP_SQL),
    "per_unit": ("sp_pro + pdi + five_star + referral", FLAT_SQL), "night": ("night_incentive", NIGHT_SQL),
    "excellence": ("excellence_bonus", EXCELLENCE_SQL), "conveyance": ("reimbursement", REIMB_SQL),
    "tips": ("tips", """SELECT user_id AS person, CAST(value AS DECIMAL(18,2)) AS tips FROM events WHERE event_type = 'purchase'"""),
    "one_star": ("-one_star_penalty", ONE_STAR_SQL), "im": ("-im_penalty", IM_SQL), "critical_flat": ("-flat", CRITICAL_SQL)}
NET_ROWS = " UNION ALL ".join(f"SELECT person, '{label}' AS label, CAST({what} AS DECIMAL(38,4)) AS v FROM ({sql})"
                              for label, (what, sql) in NET_PARTS.items())
NET_SUMS = ", ".join(f"COALESCE(SUM(v) FILTER (WHERE label = '{label}'), 0) AS {label}" for label in NET_PARTS)
NET_EARNED = "(productivity + sp_orders + per_unit + night + excellence)"
NET_SQL = f"""
WITH g AS (SELECT person, {NET_SUMS} FROM ({NET_ROWS}) GROUP BY person),
s AS (SELECT g.*, CAST(COALESCE(c.share, 1.0) AS DECIMAL(2,1)) AS share FROM g LEFT JOIN ({CRITICAL_SQL}) c USING (person))
SELECT CAST(person AS VARCHAR) AS cj_id, {", ".join(f"CAST({label} AS DOUBLE) AS {label}" for label in NET_PARTS)},
       CAST(share AS DOUBLE) AS incentive_share,
       CAST(CASE share WHEN 0.0 THEN 0 WHEN 0.5 THEN CAST({NET_EARNED} / 2 AS DECIMAL(38,5)) ELSE {NET_EARNED} END
            + conveyance + tips + one_star + im + critical_flat AS DOUBLE) AS net_payout
FROM s"""


def payout(spark, sf_dir, sheet):
    """Every rule of the sheet in one payout row per person.

    All event-based rules share one scan and one (person, day) aggregate, all rules on cases and SP orders another; one
    merge brings them together."""
    scheme = R.read_scheme(sheet)
    rate = scheme.rates
    et, ts = F.col("event_type"), F.col("ts")
    booked = ts - F.expr("INTERVAL 30 MINUTES")
    counters = {
        "views": (et == "view").cast("long"), "clicks": (et == "click").cast("long"),
        "purchases": (et == "purchase").cast("long"), "signups": (et == "signup").cast("long"),
        "errors": (et == "error").cast("long"),
        "nights": (R.in_window(booked, *scheme.night) & R.in_window(ts, *scheme.night)).cast("long"),
        "km_units": F.when(et == "view", money_units(F.col("value"))),
        "tip_units": F.when(et == "purchase", money_units(F.col("value"))),
    }
    daily = R.person_day_rollup(T(spark, sf_dir, "events"), "user_id", "ts", counters)
    priced = R.price_days(daily, scheme.slabs["Productivity"], person_class(spark, sf_dir))
    monthly = priced.groupBy("person", F.trunc("day", "month").alias("month")).agg(
        *[F.sum(c).alias(c) for c in ("day_amount", "n", *counters)])
    least, share, bonus = scheme.excellence
    people = monthly.groupBy("person").agg(
        F.sum("day_amount").alias("productivity"),
        (F.sum("views") * rate["SP Pro"] + F.sum("clicks") * rate["PDI"] + F.sum("purchases") * rate["CJ 5 Star Rating"]
         + F.sum("signups") * rate["Referral"]).alias("per_unit"),
        (F.sum("nights") * rate["Night Inspection"]).alias("night"),
        F.sum(F.when((F.col("n") >= least) & (F.col("views") / F.col("n") >= share), bonus).otherwise(0.0)).alias("excellence"),
        from_units(F.coalesce(F.sum("km_units"), F.lit(0)) * int(rate["Conveyance"] * 10 ** 4), 8).alias("conveyance"),
        from_units(F.coalesce(F.sum("tip_units"), F.lit(0))).alias("tips"),
        (F.sum("errors") * rate["1 Star Rating"]).alias("one_star"))
    by_case = R.case_rollup(cases(spark, sf_dir), "o_custkey", "cost", "o_orderdate", scheme, scheme.slabs["SP / SP Lite"], scheme.slabs["IM"])

    def m(df, col, label=None):
        return Mapping(df, "person", col, label or col)
    return net_payout(
        incentives=[m(people, "productivity"), m(by_case, "day_incentive", "sp_orders"), m(people, "per_unit"), m(people, "night"), m(people, "excellence")],
        reimbursements=[m(people, "conveyance")], tips=[m(people, "tips")],
        penalties=[m(people, "one_star"), m(by_case, "case_penalty", "im"), m(by_case, "flat_penalty", "critical_flat")],
        severity=[m(by_case, "severity")])


@register("net_payout", NET_SQL)
def q_net_payout(spark, sf_dir):
    return payout(spark, sf_dir, sheet_with(spark, {"Excellence Bonus": EXCELLENCE_ROW}))


# Expected typed rule table, stated independently for the oracle (rule_no,
# category, sub_category, condition, lo, hi, unit, amount, action, min_share).
TYPED_RULES_SQL = """
rules(rule_no, category, sub_category, condition, lo, hi, unit, amount, action, min_share) AS (VALUES
 (1, 'Incentive', 'Productivity', 'T7 Regions', 3, 3, 'day', 0.0, NULL, NULL),
 (2, 'Incentive', 'Productivity', 'T7 Regions', 4, 4, 'day', 0.0, NULL, NULL),
 (3, 'Incentive', 'Productivity', 'T7 Regions', 5, 5, 'day', 100.0, NULL, NULL),
 (4, 'Incentive', 'Productivity', 'T7 Regions', 6, 6, 'day', 300.0, NULL, NULL),
 (5, 'Incentive', 'Productivity', 'T7 Regions', 7, 7, 'day', 500.0, NULL, NULL),
 (6, 'Incentive', 'Productivity', 'T7 Regions', 8, 8, 'day', 800.0, NULL, NULL),
 (7, 'Incentive', 'Productivity', 'T7 Regions', 9, NULL, 'day', 1000.0, NULL, NULL),
 (8, 'Incentive', 'Productivity', 'Non T7', 3, 3, 'day', 0.0, NULL, NULL),
 (9, 'Incentive', 'Productivity', 'Non T7', 4, 4, 'day', 50.0, NULL, NULL),
 (10, 'Incentive', 'Productivity', 'Non T7', 5, 5, 'day', 150.0, NULL, NULL),
 (11, 'Incentive', 'Productivity', 'Non T7', 6, 6, 'day', 300.0, NULL, NULL),
 (12, 'Incentive', 'Productivity', 'Non T7', 7, 7, 'day', 500.0, NULL, NULL),
 (13, 'Incentive', 'Productivity', 'Non T7', 8, 8, 'day', 700.0, NULL, NULL),
 (14, 'Incentive', 'Productivity', 'Non T7', 9, NULL, 'day', 1000.0, NULL, NULL),
 (15, 'Incentive', 'SP / SP Lite', 'All', 1, 1, 'day', 40.0, NULL, NULL),
 (16, 'Incentive', 'SP / SP Lite', 'All', 2, 2, 'day', 130.0, NULL, NULL),
 (17, 'Incentive', 'SP / SP Lite', 'All', 3, 3, 'day', 200.0, NULL, NULL),
 (18, 'Incentive', 'SP / SP Lite', 'All', 4, 4, 'day', 300.0, NULL, NULL),
 (19, 'Incentive', 'SP / SP Lite', 'All', 5, 5, 'day', 400.0, NULL, NULL),
 (20, 'Incentive', 'SP / SP Lite', 'All', 6, 6, 'day', 500.0, NULL, NULL),
 (21, 'Incentive', 'SP / SP Lite', 'All', 7, 7, 'day', 600.0, NULL, NULL),
 (22, 'Incentive', 'SP / SP Lite', 'All', 8, 8, 'day', 700.0, NULL, NULL),
 (23, 'Incentive', 'SP / SP Lite', 'All', 9, NULL, 'day', 800.0, NULL, NULL),
 (24, 'Incentive', 'SP Pro', 'All', NULL, NULL, 'inspection', 150.0, NULL, NULL),
 (25, 'Incentive', 'Excellence Bonus', 'All', 121, NULL, 'month', 3000.0, NULL, 0.7),
 (26, 'Incentive', 'PDI', 'All', NULL, NULL, 'inspection', 50.0, NULL, NULL),
 (27, 'Incentive', 'CJ 5 Star Rating', 'All', NULL, NULL, 'inspection', 10.0, NULL, NULL),
 (28, 'Incentive', 'Night Inspection', 'All', NULL, NULL, 'inspection', 150.0, NULL, NULL),
 (29, 'Penalty', 'IM', 'All', 1, 2000, 'case', 500.0, NULL, NULL),
 (30, 'Penalty', 'IM', 'All', 2001, 5000, 'case', 1000.0, NULL, NULL),
 (31, 'Penalty', 'IM', 'All', 5001, 7500, 'case', 1500.0, NULL, NULL),
 (32, 'Penalty', 'IM', 'All', 7501, 10000, 'case', 2500.0, NULL, NULL),
 (33, 'Penalty', 'Critical IM (Regular CJ)', 'All', 10000, 13500, 'case', NULL, 'HALF', NULL),
 (34, 'Penalty', 'Critical IM (Regular CJ)', 'All', 13501, 19999, 'case', NULL, 'ZERO', NULL),
 (35, 'Penalty', 'Critical IM (Regular CJ)', 'All', 20000, NULL, 'case', NULL, 'EXIT', NULL),
 (36, 'Penalty', 'Critical IM (Regular CJ)', 'All', 2, NULL, 'case_count', NULL, 'EXIT', NULL),
 (37, 'Penalty', 'Critical IM (0-60 Days from DOJ)', 'All', 10000, 13500, 'case', 2500.0, NULL, NULL),
 (38, 'Penalty', 'Critical IM (0-60 Days from DOJ)', 'All', 13501, 19999, 'case', NULL, 'ZERO', NULL),
 (39, 'Penalty', 'Critical IM (0-60 Days from DOJ)', 'All', 20000, NULL, 'case', NULL, 'ZERO', NULL),
 (40, 'Penalty', 'Critical IM (0-60 Days from DOJ)', 'All', 2, NULL, 'case_count', NULL, 'ZERO', NULL),
 (41, 'Penalty', '1 Star Rating', 'All', NULL, NULL, 'inspection', 200.0, NULL, NULL),
 (42, 'Reimbursement', 'Conveyance', 'All', NULL, NULL, 'km', 6.0, NULL, NULL),
 (43, 'Note', 'Tipping', 'All', NULL, NULL, NULL, NULL, NULL, NULL),
 (44, 'Note', 'Referral', 'All', NULL, NULL, 'referral', 4000.0, NULL, NULL))"""

COVERAGE_SQL = f"""
WITH {TYPED_RULES_SQL},
pd AS (SELECT user_id, CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events GROUP BY 1, 2),
cls AS (SELECT c_custkey, CASE WHEN n_regionkey IN (0, 1) THEN 'T7 Regions' ELSE 'Non T7' END AS condition
        FROM customer JOIN nation ON c_nationkey = n_nationkey),
cost AS (SELECT o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.05 AS DOUBLE) AS value FROM orders),
facts AS (
  SELECT 'Productivity' AS family, cls.condition, 'day' AS unit, CAST(n AS DOUBLE) AS value
  FROM pd JOIN cls ON pd.user_id = cls.c_custkey
  UNION ALL SELECT 'SP / SP Lite', 'All', 'day', CAST(COUNT(*) AS DOUBLE) FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)
  UNION ALL SELECT NULL, 'All', 'case', value FROM cost
  UNION ALL SELECT NULL, 'All', 'case_count', CAST(COUNT(*) AS DOUBLE) FROM cost WHERE value >= 10000 GROUP BY o_custkey
  UNION ALL SELECT NULL, 'All', 'month', CAST(COUNT(*) AS DOUBLE) FROM events GROUP BY user_id, strftime(ts, '%Y-%m'))
SELECT rule_no, category, sub_category, condition, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, unit,
       CAST(amount AS DOUBLE) AS amount, action, CAST(min_share AS DOUBLE) AS min_share,
       CASE WHEN lo IS NULL THEN NULL ELSE CAST((
         SELECT COUNT(*) FROM facts f WHERE f.unit = r.unit AND (f.family IS NULL OR f.family = r.sub_category)
            AND (r.condition = 'All' OR r.condition = f.condition) AND f.value >= r.lo
            AND (r.hi IS NULL OR f.value <= r.hi)) AS DOUBLE) END AS n_hits
FROM rules r"""


@register("scheme_parse", COVERAGE_SQL)
def q_scheme_parse(spark, sf_dir):
    # The typed scheme with, per bounded rule, how many facts of the test
    # tables fall inside it (person-days, orders by cost, critical-case
    # counts, person-months).
    ev, o = T(spark, sf_dir, "events"), T(spark, sf_dir, "orders")
    lit_s = lambda v: F.lit(v).cast("string")
    pd = R.daily_counts(ev, "user_id", "ts").join(person_class(spark, sf_dir), "person")
    cost = (F.col("o_totalprice").cast("decimal(18,2)") / 20).cast("double")
    cases_df = o.select("o_custkey", cost.alias("value"))
    facts = (pd.select(lit_s("Productivity").alias("family"), "condition", lit_s("day").alias("unit"),
                       F.col("n").cast("double").alias("value"))
             .unionAll(R.daily_counts(o, "o_custkey", "o_orderdate").select(
                 lit_s("SP / SP Lite"), lit_s("All"), lit_s("day"), F.col("n").cast("double")))
             .unionAll(cases_df.select(lit_s(None), lit_s("All"), lit_s("case"), "value"))
             .unionAll(cases_df.where(F.col("value") >= 10000).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("c"))
                       .select(lit_s(None), lit_s("All"), lit_s("case_count"), F.col("c").cast("double")))
             .unionAll(ev.groupBy("user_id", F.date_format("ts", "yyyy-MM")).agg(F.count(F.lit(1)).alias("c"))
                       .select(lit_s(None), lit_s("All"), lit_s("month"), F.col("c").cast("double"))))
    return as_double(R.rule_coverage(parsed_scheme(spark), facts), "lo", "hi", "n_hits")

"""Scheme parsing and the incentive / penalty rules on boundary rows."""

import datetime as dt

from pyspark.sql import functions as F

from kpiloom.operators import rules as R
from kpiloom.sources.scheme import load_scheme, scheme_amount, scheme_rows


def parsed(spark):
    return {(r.sub_category, r.condition, r.lo, r.hi): r for r in R.scheme_parse(load_scheme(spark)).collect()}


def test_scheme_has_44_rows_and_types(spark):
    assert len(scheme_rows()) == 44
    rows = R.scheme_parse(load_scheme(spark)).collect()
    assert len(rows) == 44
    by = {(r.sub_category, r.lo, r.hi, r.condition): r for r in rows}
    assert by[("Productivity", 9, None, "T7 Regions")].amount == 1000.0
    assert by[("Productivity", 4, 4, "Non T7")].amount == 50.0
    assert by[("Productivity", 4, 4, "Non T7")].unit == "day"
    assert by[("SP / SP Lite", 1, 1, "All")].amount == 40.0
    assert by[("IM", 2001, 5000, "All")].unit == "case"
    assert by[("Critical IM (Regular CJ)", 10000, 13500, "All")].action == "HALF"
    assert by[("Critical IM (Regular CJ)", 20000, None, "All")].action == "EXIT"
    assert by[("Critical IM (Regular CJ)", 2, None, "All")].action == "EXIT"
    assert by[("Critical IM (0-60 Days from DOJ)", 10000, 13500, "All")].amount == 2500.0
    excel = by[("Excellence Bonus", 121, None, "All")]
    assert (excel.unit, excel.amount, excel.min_share) == ("month", 3000.0, 0.7)
    night = [r for r in rows if r.sub_category == "Night Inspection"][0]
    assert (night.lo, night.hi, night.unit, night.amount) == (None, None, "inspection", 150.0)
    tip = [r for r in rows if r.sub_category == "Tipping"][0]
    assert (tip.lo, tip.amount, tip.action) == (None, None, None)
    km = [r for r in rows if r.sub_category == "Conveyance"][0]
    assert (km.unit, km.amount) == ("km", 6.0)
    assert scheme_amount("Referral") == 4000.0


def test_daily_slabs_by_region_class(spark):
    ts = [dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11),
          dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2, 9)]
    rows = [(1, t) for t in ts] + [(2, t) for t in ts] + [(3, ts[0])]
    ev = spark.createDataFrame(rows, "user_id long, ts timestamp")
    cls = spark.createDataFrame([(1, "T7 Regions"), (2, "Non T7")], "person long, condition string")
    slabs = R.slabs(R.scheme_parse(load_scheme(spark)), "Productivity")
    out = {r.person: r.incentive for r in R.daily_slab_incentive(R.daily_counts(ev, "user_id", "ts"), slabs, cls)
           .collect()}
    assert out == {1: 0.0, 2: 50.0, 3: 0.0}      # 4 a day: T7 pays 0, Non T7 pays 50; no class -> 0


def test_critical_severity_boundaries(spark):
    cases = spark.createDataFrame([
        ("half", 10000.0), ("half_top", 13500.0), ("zero", 13500.5), ("zero2", 19999.0), ("exit", 20000.0),
        ("two", 10000.0), ("two", 10001.0), ("im_only", 9999.0)], "p string, cost double")
    got = {r.person: (r.action, r.multiplier, r.exit) for r in R.critical_penalty(cases, "p", "cost").collect()}
    assert got == {"half": ("HALF", 0.5, False), "half_top": ("HALF", 0.5, False), "zero": ("ZERO", 0.0, False),
                   "zero2": ("ZERO", 0.0, False), "exit": ("EXIT", 0.0, True), "two": ("EXIT", 0.0, True)}
    slabs = R.slabs(R.scheme_parse(load_scheme(spark)), "IM")
    im = {r.person: r.im_penalty for r in R.im_slab_penalty(cases, "p", "cost", slabs).collect()}
    assert im == {"im_only": 2500.0}              # 10000 itself is critical, not IM


def test_critical_new_joiner(spark):
    cases = spark.createDataFrame([
        ("a", 11000.0, "2024-01-10"), ("a", 12000.0, "2024-06-01"),      # second case after tenure window
        ("b", 15000.0, "2024-01-05"), ("c", 11000.0, "2024-03-05")],
        "p string, cost double, d string").withColumn("d", F.to_date("d"))
    joined = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-01")],
                                   "person string, join_day string").withColumn("join_day", F.to_date("join_day"))
    got = {r.person: (r.action, r.flat_penalty)
           for r in R.critical_penalty_new(cases, "p", "cost", "d", joined).collect()}
    assert got == {"a": ("FLAT", 2500.0), "b": ("ZERO", 0.0)}     # c: 64 days after joining


def test_excellence_threshold_120_vs_121(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("u120", base, "view")] * 120 + [("u121", base, "view")] * 121 + \
           [("low", base, "view")] * 84 + [("low", base, "click")] * 37
    ev = spark.createDataFrame(rows, "p string, ts timestamp, t string")
    got = {r.person: r.excellence_bonus for r in R.excellence_bonus(ev, "p", "ts", F.col("t") == "view").collect()}
    assert got == {"u120": 0.0, "u121": 3000.0, "low": 0.0}      # low: 121 but 69.4% conversion


def test_night_window_edges(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 18, 29)), ("a", dt.datetime(2024, 1, 1, 18, 30)),
            ("a", dt.datetime(2024, 1, 1, 21, 59)), ("a", dt.datetime(2024, 1, 1, 22, 0))]
    ev = spark.createDataFrame(rows, "p string, ts timestamp")
    out = R.night_incentive(ev, "p", F.col("ts") - F.expr("INTERVAL 30 MINUTES"), F.col("ts")).first()
    assert out.night_incentive == 300.0


def test_km_reimbursement_exact(spark):
    ev = spark.createDataFrame([("a", 0.1, True), ("a", 0.2, True), ("a", 5.0, False)], "p string, km double, d boolean")
    assert R.km_reimbursement(ev, "p", F.col("km"), F.col("d")).first().reimbursement == 1.8


def test_limits_come_from_the_sheet(spark):
    built_in = R.read_scheme(load_scheme(spark))
    assert built_in.regular == R.Critical(10000, 13500, 20000, 2)
    assert built_in.new == R.Critical(10000, 13500, 20000, 2, 2500.0, 60)
    assert built_in.excellence == (121, 0.7, 3000.0) and built_in.night == (18, 22) and built_in.rates["SP Pro"] == 150.0
    sheet = load_scheme(spark).withColumn("Slab_or_Range", F.regexp_replace("Slab_or_Range", "10000 - 13500", "8000 - 9000"))
    cases = spark.createDataFrame([("a", 8500.0), ("b", 9500.0)], "p string, cost double")
    got = {r.person: r.action for r in R.critical_penalty(cases, "p", "cost", R.read_scheme(sheet).regular).collect()}
    assert got == {"a": "HALF", "b": "ZERO"} and R.critical_penalty(cases, "p", "cost").isEmpty()


def test_critical_cases_cut_the_incentives_only(spark):
    from kpiloom.operators.consolidate import mappings_for, net_payout
    cases = spark.createDataFrame([
        ("half", 11000.0, "2024-06-01"), ("exit", 25000.0, "2024-06-01"), ("fresh", 12000.0, "2024-01-20"),
        ("fresh_zero", 15000.0, "2024-01-20"), ("unknown", 11000.0, "2024-01-02"), ("fine", 9000.0, "2024-06-01")],
        "p string, cost double, d string")
    joined = spark.createDataFrame([(p, dt.date(2024, 1, 1)) for p in ("half", "exit", "fresh", "fresh_zero", "fine")], "person string, join_day date")
    out = R.critical_outcome(cases, "p", "cost", "d", joined, R.read_scheme(load_scheme(spark)))
    assert {r.person: (r.severity, r.flat_penalty) for r in out.collect()} == {
        "half": (1, 0.0), "exit": (2, 0.0), "fresh": (0, 2500.0), "fresh_zero": (2, 0.0), "unknown": (1, 0.0)}
    paid = spark.createDataFrame([(p, 100.25, 7.0) for p in ("half", "exit", "fresh", "fine")], "k string, v double, t double")
    net = net_payout(mappings_for(paid, "inc", "k", ["v"]), tips=mappings_for(paid, "tips", "k", ["t"]),
                     penalties=mappings_for(out, "flat", "person", ["flat_penalty"]), severity=mappings_for(out, "sev", "person", ["severity"]))
    got = {r.cj_id: r.net_payout for r in net.collect()}
    assert {k: got[k] for k in ("half", "exit", "fresh", "fine")} == {"half": 57.125, "exit": 7.0, "fresh": -2392.75, "fine": 107.25}


def test_an_edited_sheet_changes_the_payout(spark):
    from fixture_paths import SF_SMALL
    from kpiloom.workloads.rules import payout, sheet_with
    before = {r.cj_id: r for r in payout(spark, SF_SMALL, load_scheme(spark)).collect()}
    after = {r.cj_id: r for r in payout(spark, SF_SMALL, sheet_with(spark, {"1 Star Rating": "400"}, "Amount_or_Payout")).collect()}
    assert before.keys() == after.keys() and any(r.one_star for r in before.values())
    assert all(after[k].one_star == 2 * r.one_star and abs(after[k].net_payout - r.net_payout - r.one_star) < 1e-6 for k, r in before.items())

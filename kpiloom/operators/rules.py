"""Incentive, penalty and reimbursement rules of the scheme, as Spark jobs.

Common shape: count or sum per person (and per day / month) with a grouped
aggregate -- map-side partial aggregation keeps a hot person cheap -- then
look the count up in the slabs (of a rule sheet that the driver has read: a CASE
over its rows; of a table of slabs: :func:`slab_join`), then sum per person.

Decisions where the rule text is silent:
* slab bounds are inclusive; a value in a gap between slabs pays nothing;
* a case costing exactly 10000 is *critical* (not the 7501-10000 IM slab);
* critical levels: 10000-13500 half, above 13500 and below 20000 zero,
  20000 or more exit; two or more critical cases exit; exit > zero > half;
* "70% conversion" means a share of at least 0.70;
* the night window is 18:00 <= t < 22:00 for both booking and inspection.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.functions.scalars import from_units, money_units
from kpiloom.operators.joins import slab_join
from kpiloom.sources.scheme import SCHEME_CSV, load_scheme

# ------------------------------------------------------------- scheme parsing

_INT = r"(\d+)"


def scheme_parse(scheme: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed rule table: category, sub_category, condition, lo, hi, unit,
    amount, action, min_share.

    ``9+ X/Day`` -> (9, open); ``3 X/Day`` -> (3, 3); ``>120 X/Month`` ->
    (121, open); ``RFC 1 - 2000`` / ``INR 10000 - 13500`` -> (lo, hi);
    ``Single IM >= INR 20000`` -> (20000, open); ``Two Critical IMs`` ->
    (2, open) with unit ``case_count``; ``Per ...`` -> no bounds.  Payout ``800`` /
    ``INR 2500`` -> amount; ``Half ...`` / ``Zero ...`` / ``... Exit`` -> action.
    """
    s = F.trim(F.col("Slab_or_Range"))
    p = F.trim(F.col("Amount_or_Payout"))

    def ext(pattern: str, group: int = 1) -> Column:
        v = F.regexp_extract(s, pattern, group)
        return F.when(v != "", v.cast("long"))

    rng_lo, rng_hi = ext(rf"^(?:RFC|INR)\s*{_INT}\s*-\s*{_INT}$", 1), ext(rf"^(?:RFC|INR)\s*{_INT}\s*-\s*{_INT}$", 2)
    at_least = ext(rf">=\s*(?:INR\s*)?{_INT}")
    more_than = ext(rf"^>\s*{_INT}")
    plus = ext(rf"^{_INT}\+")
    exact = ext(rf"^{_INT}\s")
    two = F.when(s.rlike(r"(?i)^two\b"), F.lit(2).cast("long"))

    lo = F.coalesce(rng_lo, at_least, more_than + 1, plus, exact, two)
    hi = F.coalesce(rng_hi, exact)

    unit = (F.when(s.rlike(r"(?i)^two\b"), "case_count")
             .when(s.rlike(r"(?i)/day"), "day")
             .when(s.rlike(r"(?i)/month"), "month")
             .when(s.rlike(r"(?i)per\s+km"), "km")
             .when(s.rlike(r"(?i)^(RFC|INR)|INR\s*\d|critical"), "case")
             .when(s.rlike(r"(?i)referral"), "referral")
             .when(s.rlike(r"(?i)inspection"), "inspection"))

    amount_text = F.regexp_extract(p, r"^(?:INR\s*)?(\d+(?:\.\d+)?)$", 1)
    amount = F.when(amount_text != "", amount_text.cast("double"))
    action = (F.when(p.rlike(r"(?i)exit"), "EXIT")
               .when(p.rlike(r"(?i)^zero"), "ZERO")
               .when(p.rlike(r"(?i)^half"), "HALF"))
    share_text = F.regexp_extract(s, r"(\d+(?:\.\d+)?)%", 1)
    min_share = F.when(share_text != "", share_text.cast("double") / 100)

    ident = [F.col("rule_no")] if "rule_no" in scheme.columns else []
    return scheme.select(
        *ident, F.col("Category").alias("category"), F.col("Sub_Category").alias("sub_category"),
        F.col("Region_or_Condition").alias("condition"),
        lo.alias("lo"), hi.alias("hi"), unit.alias("unit"), amount.alias("amount"), action.alias("action"),
        min_share.alias("min_share"), *(keep or []))


def rule_coverage(parsed: DataFrame, facts: DataFrame) -> DataFrame:
    """How many facts fall inside each bounded rule of the typed scheme.

    ``facts``: (family, condition, unit, value) -- ``family`` null matches any
    sub-category.  A fact hits a rule with the same unit, a matching
    condition (rule ``All`` matches every condition) and ``lo <= value <=
    hi``.  Facts are counted by value before they meet the rules.  Rules
    without bounds get a null count.
    """
    facts = facts.groupBy("family", "condition", "unit", "value").agg(F.count(F.lit(1)).alias("n"))
    r = parsed.where(F.col("lo").isNotNull()).select("rule_no", "sub_category", "condition", "unit", "lo", "hi")
    cond = ((F.col("f.unit") == F.col("r.unit"))
            & (F.col("f.family").isNull() | (F.col("f.family") == F.col("r.sub_category")))
            & ((F.col("r.condition") == "All") | (F.col("r.condition") == F.col("f.condition")))
            & (F.col("f.value") >= F.col("r.lo"))
            & (F.col("r.hi").isNull() | (F.col("f.value") <= F.col("r.hi"))))
    hits = (facts.alias("f").join(r.alias("r"), cond)
                 .groupBy(F.col("r.rule_no").alias("rule_no")).agg(F.sum("f.n").alias("n_hits")))
    counted = parsed.join(hits, "rule_no", "left")
    return counted.select(*parsed.columns,
                          F.when(F.col("lo").isNotNull(), F.coalesce("n_hits", F.lit(0))).alias("n_hits"))


def slabs(parsed: DataFrame, sub_category: str) -> DataFrame:
    """Slab rows (condition, lo, hi, amount, and rule_no where the sheet has it) of one rule."""
    return (parsed.where((F.col("sub_category") == sub_category) & F.col("lo").isNotNull())
                  .select("condition", "lo", "hi", "amount", *[c for c in ("rule_no",) if c in parsed.columns]))


def slab_amount(column: str, slab_rows: list[Slab], condition: str | None = None) -> Column:
    """Amount of the first slab of the sheet that holds the column's value, 0 where none does; with ``condition`` (a column) of
    that condition's slabs only.  One CASE, whatever the number of slabs."""
    x = f"`{column}`"
    whens = []
    for s in slab_rows:
        tests = [f"{x} >= {s.lo!r}"] * (s.lo is not None) + [f"{x} <= {s.hi!r}"] * (s.hi is not None)
        if condition is not None:
            tests.append(f"`{condition}` = '{s.condition.replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39))}'")
        whens.append(f"WHEN {' AND '.join(tests) or 'TRUE'} THEN {float(s.amount)!r}D")
    return F.expr(f"CASE {' '.join(whens)} ELSE 0.0D END") if whens else F.lit(0.0)


@dataclass(frozen=True)
class Slab:
    condition: str
    lo: float | None
    hi: float | None
    amount: float


@dataclass(frozen=True)
class Critical:
    """Limits of the critical cases: cost from which a case is critical, upper end of the first level, cost from which one
    case means the worst action, number of cases that do, flat penalty of the first level, days after joining."""
    floor: float
    first_upto: float
    worst_from: float
    count: int
    flat: float = 0.0
    tenure_days: int = 0


@dataclass(frozen=True)
class Scheme:
    """The limits and rates of a rule sheet, for rules that are not slab tables."""
    rates: dict[str, float]
    regular: Critical
    new: Critical
    excellence: tuple[int, float, float]      # least inspections a month, least converted share, bonus
    night: tuple[int, int]                    # first hour, hour after the last
    slabs: dict[str, list[Slab]] = field(default_factory=dict)  # by sub-category, in the sheet's order


#: A rule sheet is configuration that the driver reads; a longer one is refused.
MAX_RULES = 10_000


def read_scheme(sheet: DataFrame) -> Scheme:
    """The limits and slabs of a rule sheet as loaded by :func:`kpiloom.sources.scheme.load_scheme`, from a file or built in:
    one read of the sheet."""
    rules = scheme_parse(sheet, keep=["Slab_or_Range"]).limit(MAX_RULES + 1).collect()
    if len(rules) > MAX_RULES:
        raise ValueError(f"a rule sheet of more than {MAX_RULES} rows")

    def family(pattern: str) -> tuple[str, list]:
        names = {r.sub_category for r in rules if re.search(pattern, r.sub_category or "", re.I)}
        if len(names) != 1:
            raise ValueError(f"the rule sheet needs one family {pattern!r}, it has {sorted(names)}")
        return (name := names.pop()), [r for r in rules if r.sub_category == name]

    def critical(pattern: str) -> Critical:
        name, rows = family(pattern)
        levels = sorted((r for r in rows if r.unit == "case"), key=lambda r: r.lo)
        days = re.search(r"(\d+)\s*Days", name, re.I)
        return Critical(levels[0].lo, levels[0].hi, levels[-1].lo, next(r.lo for r in rows if r.unit == "case_count"),
                        levels[0].amount or 0.0, int(days.group(1)) if days else 0)

    bonus = family("^Excellence")[1][0]
    text = family("^Night")[1][0].Slab_or_Range
    hours = [int(h) % 12 + (12 if half.upper() == "PM" else 0) for h, half in re.findall(r"(\d+)\s*([AP]M)", text, re.I)]
    slab_rows: dict[str, list[Slab]] = {}
    ordered = sorted(rules, key=lambda r: r.rule_no) if rules and "rule_no" in rules[0] else rules
    for r in ordered:
        if r.lo is not None and r.amount is not None:
            slab_rows.setdefault(r.sub_category, []).append(Slab(r.condition, r.lo, r.hi, r.amount))
    return Scheme({r.sub_category: r.amount for r in rules if r.lo is None and r.amount is not None},
                  critical(r"^Critical.*Regular"), critical(r"^Critical.*Days"), (bonus.lo, bonus.min_share, bonus.amount),
                  (hours[0], hours[1]), slab_rows)


_BUILTIN: dict[str, Scheme] = {}


def builtin(spark: SparkSession) -> Scheme:
    """The limits and slabs of the built-in sheet, which is a constant: read once."""
    if SCHEME_CSV not in _BUILTIN:
        _BUILTIN[SCHEME_CSV] = read_scheme(load_scheme(spark))
    return _BUILTIN[SCHEME_CSV]


# ------------------------------------------------------------------ incentives

def daily_counts(events: DataFrame, person: str, ts: str, where: Column | None = None) -> DataFrame:
    """Rows per person per day (``n``)."""
    src = events if where is None else events.where(where)
    return src.groupBy(F.col(person).alias("person"), F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def person_day_rollup(df: DataFrame, person: str, ts: str, counters: dict[str, Column]) -> DataFrame:
    """One grouped pass over a fact table: per person and day the row count
    ``n`` plus one sum per counter column.  Several rules that read the same
    facts then share this single scan and shuffle."""
    return df.groupBy(F.col(person).alias("person"), F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(name) for name, c in counters.items()])


def price_days(daily: DataFrame, slab_table: DataFrame | list[Slab], person_class: DataFrame | None = None,
               out_col: str = "day_amount") -> DataFrame:
    """Attach each person-day's slab amount for its count ``n`` (keeps all columns).

    Slabs: the list of a sheet that the driver has read (no join), or a table."""
    if isinstance(slab_table, list):
        if person_class is None:
            return daily.withColumn(out_col, slab_amount("n", slab_table))
        return daily.join(person_class, "person", "left").withColumn(out_col, slab_amount("n", slab_table, "condition"))
    order = "rule_no" if "rule_no" in slab_table.columns else None
    if person_class is not None:
        return slab_join(daily.join(person_class, "person", "left"), "n", slab_table,
                         on=[("condition", "condition")], out_col=out_col, order=order)
    return slab_join(daily, "n", slab_table.drop("condition"), out_col=out_col, order=order)


def daily_slab_incentive(daily: DataFrame, slab_table: DataFrame | list[Slab], person_class: DataFrame | None = None,
                         alias: str = "incentive") -> DataFrame:
    """Sum over days of the slab amount for each day's count.

    ``person_class`` (person, condition) selects the slab family per person
    (e.g. T7 / Non T7); without it the slab rows must carry one condition.
    """
    priced = price_days(daily, slab_table, person_class, out_col="amount")
    return priced.groupBy("person").agg(F.sum("amount").cast("double").alias(alias),
                                        F.count(F.lit(1)).alias("active_days"))


def flat_incentives(df: DataFrame, person: str, rules: list[tuple[str, Column, float]]) -> DataFrame:
    """Per-unit payouts: for each (alias, predicate, rate) ``count_if(predicate) * rate``, one pass."""
    return df.groupBy(F.col(person).alias("person")).agg(
        *[(F.count_if(pred) * F.lit(float(rate))).alias(alias) for alias, pred, rate in rules])


def excellence_bonus(events: DataFrame, person: str, ts: str, converted: Column, min_count: int = 120,
                     min_share: float = 0.70, bonus: float = 3000.0) -> DataFrame:
    """Per person and month: bonus when inspections > ``min_count`` and the
    converted share >= ``min_share``."""
    m = events.groupBy(F.col(person).alias("person"), F.trunc(F.to_date(ts), "month").alias("_m")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(converted).alias("converted"))
    share = F.col("converted") / F.col("n")
    return m.select("person", F.date_format("_m", "yyyy-MM").alias("month"), "n", share.alias("share"),
                    F.when((F.col("n") > min_count) & (share >= min_share), F.lit(bonus)).otherwise(F.lit(0.0))
                    .alias("excellence_bonus"))


def in_window(t: Column, start_hour: int = 18, end_hour: int = 22) -> Column:
    """``start_hour:00 <= time of day < end_hour:00``."""
    return (F.hour(t) >= start_hour) & (F.hour(t) < end_hour)


def night_incentive(df: DataFrame, person: str, booked: Column, inspected: Column, rate: float = 150.0,
                    hours: tuple[int, int] = (18, 22)) -> DataFrame:
    """``rate`` per inspection booked and inspected inside the night window."""
    return df.groupBy(F.col(person).alias("person")).agg(
        (F.count_if(in_window(booked, *hours) & in_window(inspected, *hours)) * F.lit(rate)).cast("double").alias("night_incentive"))


# ------------------------------------------------------------------- penalties

def im_slab_penalty(cases: DataFrame, person: str, cost: str, slab_table: DataFrame | list[Slab], limits: Critical | None = None) -> DataFrame:
    """Sum of IM slab penalties per person over the cases below the critical ones."""
    limits = limits or builtin(cases.sparkSession).regular
    c = cases.where(F.col(cost) < limits.floor).select(F.col(person).alias("person"), F.col(cost).alias("cost"))
    if isinstance(slab_table, list):
        priced = c.withColumn("amount", slab_amount("cost", slab_table))
    else:
        priced = slab_join(c, "cost", slab_table.drop("condition"), out_col="amount", order="rule_no" if "rule_no" in slab_table.columns else None)
    return priced.groupBy("person").agg(F.sum("amount").cast("double").alias("im_penalty"),
                                        F.count(F.lit(1)).alias("im_cases"))


def _severity(n_critical: Column, max_cost: Column, limits: Critical) -> Column:
    return (F.when((n_critical >= limits.count) | (max_cost >= limits.worst_from), "EXIT")
             .when(max_cost > limits.first_upto, "ZERO")
             .when(max_cost >= limits.floor, "HALF"))


def _worse(n_critical: Column, max_cost: Column, limits: Critical) -> Column:
    return (n_critical >= limits.count) | (max_cost > limits.first_upto)


def critical_penalty(cases: DataFrame, person: str, cost: str, limits: Critical | None = None) -> DataFrame:
    """Regular staff: per person with critical cases, the action and the
    incentive multiplier (HALF 0.5, ZERO / EXIT 0)."""
    limits = limits or builtin(cases.sparkSession).regular
    c = cases.where(F.col(cost) >= limits.floor)
    agg = c.groupBy(F.col(person).alias("person")).agg(F.count(F.lit(1)).alias("n_critical"),
                                                        F.max(cost).alias("max_cost"))
    action = _severity(F.col("n_critical"), F.col("max_cost"), limits)
    return agg.select("person", "n_critical", "max_cost", action.alias("action"),
                      F.when(action == "HALF", F.lit(0.5)).otherwise(F.lit(0.0)).alias("multiplier"),
                      (action == "EXIT").alias("exit"))


def critical_penalty_new(cases: DataFrame, person: str, cost: str, case_day: str, joined: DataFrame,
                         limits: Critical | None = None) -> DataFrame:
    """New joiners (case within the tenure days of joining): cases of the first level
    cost a flat penalty each; anything worse zeroes the incentive.

    ``joined`` is (person, join_day); only cases inside the tenure window count.
    """
    limits = limits or builtin(cases.sparkSession).new
    c = (cases.where(F.col(cost) >= limits.floor)
              .select(F.col(person).alias("person"), F.col(cost).alias("cost"), F.to_date(case_day).alias("day"))
              .join(joined, "person")
              .where(F.datediff("day", "join_day") <= limits.tenure_days))
    agg = c.groupBy("person").agg(F.count(F.lit(1)).alias("n_critical"), F.max("cost").alias("max_cost"),
                                  F.count_if(F.col("cost") <= limits.first_upto).alias("n_half"))
    worse = _worse(F.col("n_critical"), F.col("max_cost"), limits)
    return agg.select("person", "n_critical", "max_cost",
                      F.when(worse, F.lit("ZERO")).otherwise(F.lit("FLAT")).alias("action"),
                      F.when(worse, F.lit(0.0)).otherwise(F.col("n_half") * F.lit(limits.flat)).alias("flat_penalty"))


def _outcome(scheme: Scheme) -> tuple[Column, Column]:
    """(severity, flat penalty) from a person's n_old, max_old, n_new, max_new and n_flat."""
    action = _severity(F.col("n_old"), F.col("max_old"), scheme.regular)
    worse = F.coalesce(_worse(F.col("n_new"), F.col("max_new"), scheme.new), F.lit(False))
    points = F.when(action == "HALF", 1).when(action.isNotNull(), 2).otherwise(0) + F.when(worse, 2).otherwise(0)
    return points.cast("long"), F.when(worse, 0.0).otherwise(F.col("n_flat") * F.lit(scheme.new.flat))


def critical_outcome(cases: DataFrame, person: str, cost: str, case_day: str, joined: DataFrame, scheme: Scheme) -> DataFrame:
    """What critical cases do to a payout: (person, severity, flat_penalty).

    A case within the tenure days of joining goes by the new joiners' rule, any other (or one
    of a person without a joining day) by the regular one.  ``severity``: 1 for HALF, 2 for ZERO
    or EXIT of either rule; both add up.  One join and one aggregate over the critical cases only.
    """
    regular, new = scheme.regular, scheme.new
    c = (cases.where(F.col(cost) >= min(regular.floor, new.floor))
              .select(F.col(person).alias("person"), F.col(cost).alias("cost"), F.to_date(case_day).alias("day"))
              .join(joined, "person", "left")
              .withColumn("fresh", F.coalesce(F.datediff("day", "join_day") <= new.tenure_days, F.lit(False))))
    old_cost, new_cost = (F.when(which & (F.col("cost") >= limits.floor), F.col("cost"))
                          for which, limits in ((~F.col("fresh"), regular), (F.col("fresh"), new)))
    agg = c.groupBy("person").agg(F.count(old_cost).alias("n_old"), F.max(old_cost).alias("max_old"),
                                  F.count(new_cost).alias("n_new"), F.max(new_cost).alias("max_new"),
                                  F.count_if(new_cost <= new.first_upto).alias("n_flat"))
    severity, flat = _outcome(scheme)
    return agg.select("person", severity.alias("severity"), flat.alias("flat_penalty"))


def case_rollup(cases: DataFrame, person: str, cost: str, case_day: str, scheme: Scheme, day_slabs: list[Slab], case_slabs: list[Slab],
                joined: DataFrame | None = None) -> DataFrame:
    """All rules that read the cases, in one pass: (person, day_incentive, case_penalty, severity, flat_penalty).

    ``day_slabs`` price the number of cases a day, ``case_slabs`` each case below the critical ones, and critical cases
    go by :func:`critical_outcome`.  One aggregate per (person, day), one per person; ``joined`` (person, join_day) is the
    first day with a case unless given."""
    regular, new = scheme.regular, scheme.new
    c = F.col(cost)
    below = F.when(c < regular.floor, slab_amount(cost, case_slabs)).otherwise(0.0)
    days = cases.groupBy(F.col(person).alias("person"), F.to_date(case_day).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(below).alias("below"),
        F.count_if(c >= regular.floor).alias("n_old"), F.max(F.when(c >= regular.floor, c)).alias("max_old"),
        F.count_if(c >= new.floor).alias("n_new"), F.max(F.when(c >= new.floor, c)).alias("max_new"),
        F.count_if((c >= new.floor) & (c <= new.first_upto)).alias("n_flat"))
    if joined is None:
        days = days.withColumn("join_day", F.min("day").over(Window.partitionBy("person")))
    else:
        days = days.join(joined, "person", "left")
    fresh = F.coalesce(F.datediff("day", "join_day") <= new.tenure_days, F.lit(False))
    agg = days.withColumn("fresh", fresh).groupBy("person").agg(
        F.sum(slab_amount("n", day_slabs)).alias("day_incentive"), F.sum("below").alias("case_penalty"),
        F.sum(F.when(~F.col("fresh"), F.col("n_old")).otherwise(0)).alias("n_old"), F.max(F.when(~F.col("fresh"), F.col("max_old"))).alias("max_old"),
        F.sum(F.when(F.col("fresh"), F.col("n_new")).otherwise(0)).alias("n_new"), F.max(F.when(F.col("fresh"), F.col("max_new"))).alias("max_new"),
        F.sum(F.when(F.col("fresh"), F.col("n_flat")).otherwise(0)).alias("n_flat"))
    severity, flat = _outcome(scheme)
    return agg.select("person", "day_incentive", "case_penalty", severity.alias("severity"), flat.alias("flat_penalty"))


def per_unit_penalty(df: DataFrame, person: str, predicate: Column, rate: float, alias: str) -> DataFrame:
    return df.groupBy(F.col(person).alias("person")).agg((F.count_if(predicate) * F.lit(float(rate))).alias(alias))


def km_reimbursement(df: DataFrame, person: str, km: Column, done: Column, rate: float = 6.0) -> DataFrame:
    """``rate`` per km over completed inspections only (exact sum in 1e-4 units;
    the rate is taken to 1e-4 as well)."""
    rate_units = int(round(float(rate) * 10 ** 4))
    amt = F.when(done, money_units(km) * F.lit(rate_units))
    return df.groupBy(F.col(person).alias("person")).agg(
        from_units(F.coalesce(F.sum(amt), F.lit(0).cast("long")), 8).alias("reimbursement"))

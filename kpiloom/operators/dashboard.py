"""Channel dashboard: facet filter, totals, per-channel bars, detail rows.

Input facts: ``month string, channel string, si long, insp long`` (channel may
be empty).  Every output is one aggregate or projection over the facts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.scalars import fmt_pct, safe_ratio_pct, unknown
from kpiloom.operators.filters import between_days

ALL = "All"
UNKNOWN = "Unknown"


def facts_from_orders(orders: DataFrame, month: str = ALL) -> DataFrame:
    """Month x channel facts from an orders table: month = order month,
    channel = order priority ('' when not specified), si = finished orders,
    insp = all orders.  One grouped aggregate (partial + final).  ``month`` (yyyy-MM)
    is a half-open range on the raw date, so only its row groups are read."""
    if month != ALL:
        first = dt.date.fromisoformat(f"{month}-01")
        orders = between_days(orders, "o_orderdate", first, (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1))
    channel = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("")).otherwise(F.col("o_orderpriority"))
    # group on the month's first day (a date), format the text once per group
    facts = (orders.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("_m"), channel.alias("channel"))
                   .agg(F.count_if(F.col("o_orderstatus") == "F").alias("si"), F.count(F.lit(1)).alias("insp")))
    return facts.select(F.date_format("_m", "yyyy-MM").alias("month"), "channel", "si", "insp")


def ratio_text(si: Column, insp: Column) -> Column:
    """``12.3%``; ``0%`` when there is nothing to divide by."""
    return F.when(insp > 0, fmt_pct(safe_ratio_pct(si, insp), 1)).otherwise(F.lit("0%"))


def filter_facets(facts: DataFrame, month: str = ALL, channel: str = ALL) -> DataFrame:
    """``All`` = no filter; ``Unknown`` selects empty/missing channels."""
    out = facts
    if month != ALL:
        out = out.where(F.col("month") == month)
    if channel != ALL:
        out = out.where(unknown(F.col("channel")) == F.lit(UNKNOWN)) if channel == UNKNOWN \
            else out.where(F.col("channel") == channel)
    return out


def totals(facts: DataFrame) -> DataFrame:
    """One row: total si, total insp, si ratio text, distinct channels (empty = Unknown)."""
    agg = facts.agg(F.coalesce(F.sum("si"), F.lit(0)).cast("bigint").alias("total_si"),
                    F.coalesce(F.sum("insp"), F.lit(0)).cast("bigint").alias("total_insp"),
                    F.count_distinct(unknown(F.col("channel"))).alias("channel_count"))
    return agg.select("total_si", "total_insp", ratio_text(F.col("total_si"), F.col("total_insp")).alias("si_ratio"),
                      "channel_count")


def by_channel(facts: DataFrame) -> DataFrame:
    """si and insp per channel (Unknown bucket), si descending, channel as tie-break."""
    return (facts.groupBy(unknown(F.col("channel")).alias("channel"))
                 .agg(F.sum("si").cast("bigint").alias("si"), F.sum("insp").cast("bigint").alias("insp"))
                 .orderBy(F.col("si").desc(), F.col("channel")))


def detail(facts: DataFrame) -> DataFrame:
    """Detail rows with the Unknown fallback and the row's si ratio."""
    return facts.select("month", unknown(F.col("channel")).alias("channel"), "si", "insp",
                        ratio_text(F.col("si"), F.col("insp")).alias("si_pct"))


def facet_values(facts: DataFrame) -> DataFrame:
    """Filter choices: ``(domain, value)`` rows for the sorted distinct months and
    channels (empty channel shown as ``Unknown``)."""
    months = facts.select(F.lit("month").alias("domain"), F.col("month").alias("value"))
    channels = facts.select(F.lit("channel").alias("domain"), unknown(F.col("channel")).alias("value"))
    return months.unionByName(channels).distinct().orderBy("domain", "value")

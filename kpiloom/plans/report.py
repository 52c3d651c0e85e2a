"""The shipped report: inspections of a period enriched with their centre,
their latest feedback (ties kept) and the store record.

    t4 = DISTINCT(inspection_log[version=0, done, day in period] LEFT JOIN centre_list)
    fb = latest feedback per appointment (rating not null, DENSE_RANK = 1)
    fo = store info per appointment
    result = t4 LEFT JOIN fb LEFT JOIN fo     (t4.* + feedback + store columns)

Scale notes: the period filter is pushed into the inspection scan; feedback
and the store records are first reduced to the appointments of the period
(left-semi joins against the filtered log's keys, which AQE broadcasts when
small), so a one-month report never ranks the whole feedback history nor
shuffles the whole store table.  Latest-per-key is
a grouped max + semi-join, not a window (see operators.latest).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.filters import between_days
from kpiloom.operators.latest import latest_per_key

T4_COLS = ["appointment_id", "inspection_by", "version", "inspection_status", "region", "city", "centre"]
FEEDBACK_COLS = ["feedback_rating", "created_at", "feedbacks", "additional_comment"]
STORE_COLS = ["Store Type", "verified", "store_name"]


def inspection_feedback_report(inspection_log: DataFrame, centre_list: DataFrame, feedback: DataFrame,
                               store_info: DataFrame, first_day: str, last_day: str,
                               version: int = 0, status: str = "done") -> DataFrame:
    il = between_days(inspection_log, "inspection_end_time", first_day, last_day)
    il = il.where((F.col("version") == version) & (F.col("inspection_status") == status))
    t4 = (il.join(centre_list, il.store_id == centre_list.centre_id, "left")
            .select(*[F.col(c) for c in T4_COLS], F.to_date("inspection_end_time").alias("dat"))
            .distinct())

    # appointments of the period, straight from the filtered log (no centre join / distinct needed)
    period_keys = il.select("appointment_id")
    fb_in = feedback.join(period_keys, "appointment_id", "left_semi")
    fb = latest_per_key(fb_in, "appointment_id", "created_at", where=F.col("feedback_rating").isNotNull())
    fb = fb.select("appointment_id", *FEEDBACK_COLS)

    # store records, also restricted to the period's appointments before the join
    fo = (store_info.select(F.col("pub_appt_id"), *[F.col(f"`{c}`") for c in STORE_COLS])
                    .join(period_keys.withColumnRenamed("appointment_id", "pub_appt_id"), "pub_appt_id", "left_semi"))
    out = (t4.join(fb, "appointment_id", "left")
             .join(fo, F.col("appointment_id") == F.col("pub_appt_id"), "left"))
    return out.select(*T4_COLS, "dat", *FEEDBACK_COLS, *[F.col(f"`{c}`") for c in STORE_COLS])


def report_inputs_from_tables(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame,
                              lineitem: DataFrame) -> dict[str, DataFrame]:
    """Map the test tables onto the report's four inputs.

    inspection_log <- orders (appointment = order, inspector = customer key,
    done = status 'F', store = customer key); centre_list <- customer + nation
    + region; feedback <- lineitem (rating = quantity, created = ship date);
    store info <- orders (store type = priority).
    """
    inspection_log = orders.select(
        F.col("o_orderkey").alias("appointment_id"),
        F.col("o_custkey").alias("inspection_by"),
        F.lit(0).alias("version"),
        F.when(F.col("o_orderstatus") == "F", F.lit("done")).otherwise(F.lower("o_orderstatus")).alias("inspection_status"),
        F.col("o_orderdate").alias("inspection_end_time"),
        F.col("o_custkey").alias("store_id"))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    centre_list = customer.join(geo, customer.c_nationkey == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("centre_id"), F.col("r_name").alias("region"),
        F.col("n_name").alias("city"), F.col("c_name").alias("centre"))
    feedback = lineitem.select(
        F.col("l_orderkey").alias("appointment_id"), F.col("l_quantity").cast("int").alias("feedback_rating"),
        F.col("l_shipdate").alias("created_at"), F.col("l_returnflag").alias("feedbacks"),
        F.col("l_linestatus").alias("additional_comment"))
    store_info = orders.select(
        F.col("o_orderkey").alias("pub_appt_id"), F.col("o_orderpriority").alias("Store Type"),
        (F.col("o_totalprice") > 100000).alias("verified"),
        F.concat(F.lit("store_"), F.col("o_custkey").cast("string")).alias("store_name"))
    return {"inspection_log": inspection_log, "centre_list": centre_list, "feedback": feedback,
            "store_info": store_info}

"""Scalar function queries: one helper projected over a test table next to its key."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.functions import scalars as S
from kpiloom.sources.tables import table
from kpiloom.workloads import day_text, register

NUM_RE_SQL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _coerce_sql(expr: str) -> str:
    return (f"COALESCE(CASE WHEN regexp_matches({expr}, '{NUM_RE_SQL}') "
            f"THEN CASE WHEN isinf(TRY_CAST(trim({expr}) AS DOUBLE)) OR isnan(TRY_CAST(trim({expr}) AS DOUBLE)) "
            f"THEN 0.0 ELSE TRY_CAST(trim({expr}) AS DOUBLE) END END, 0.0)")


@register("fn_key_norm", r"""
SELECT c_custkey,
       COALESCE(lower(regexp_replace(CAST(c_name AS VARCHAR), '^\s+|\s+$', '', 'g')), 'nan') AS name_key,
       COALESCE(lower(regexp_replace(CAST(c_custkey AS VARCHAR), '^\s+|\s+$', '', 'g')), 'nan') AS id_key
FROM customer""")
def q_fn_key_norm(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", S.key_norm("c_name").alias("name_key"), S.key_norm("c_custkey").alias("id_key"))


@register("fn_num_coerce", f"""
SELECT event_id,
       {_coerce_sql("regexp_extract(props, '([0-9]+)', 1)")} AS k_value,
       {_coerce_sql("props")} AS props_value,
       {_coerce_sql("concat(' ', CAST(value AS VARCHAR), ' ')")} AS padded_value
FROM events""")
def q_fn_num_coerce(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        S.num_coerce(F.regexp_extract("props", r"([0-9]+)", 1)).alias("k_value"),
        S.num_coerce("props").alias("props_value"),
        S.num_coerce(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))).alias("padded_value"),
    )


@register("fn_case_tier", """
SELECT event_id,
       CASE WHEN value >= 0 AND value <= 100 THEN 1
            WHEN value >= 101 AND value <= 200 THEN 2
            WHEN value >= 300 THEN 3 ELSE 0 END AS tier
FROM events""")
def q_fn_case_tier(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    tiers = [(0, 100, 1), (101, 200, 2), (300, None, 3), (None, None, 9)]  # the unbounded tier is dropped
    return e.select("event_id", S.case_tier("value", tiers, 0).alias("tier"))


@register("fn_to_date", """
SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day FROM events""")
def q_fn_to_date(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", day_text(S.to_day("ts")).alias("day"))


@register("fn_contains_ci", """
SELECT c_custkey,
       COALESCE(regexp_matches(c_name, 'CUSTOMER#00000001', 'i'), false) AS name_hit,
       COALESCE(contains(lower(c_mktsegment), lower('Build')), false) AS segment_hit
FROM customer""")
def q_fn_contains_ci(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", S.contains_ci("c_name", "CUSTOMER#00000001").alias("name_hit"),
                    S.contains_ci("c_mktsegment", "Build", literal=True).alias("segment_hit"))


@register("fn_unknown", """
SELECT c_custkey, COALESCE(NULLIF(regexp_extract(c_mktsegment, '^(AUTO.*)', 1), ''), 'Unknown') AS segment
FROM customer""")
def q_fn_unknown(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", S.unknown(F.regexp_extract("c_mktsegment", r"^(AUTO.*)", 1)).alias("segment"))


@register("fn_fmt_pct", """
SELECT user_id,
       printf('%.1f%%', ROUND(CAST(CASE WHEN COUNT(*) > 0 THEN COUNT(*) FILTER (WHERE event_type = 'purchase') * 100.0 / COUNT(*)
                                     ELSE 0.0 END AS DECIMAL(38,10)), 1)) AS purchase_share
FROM events GROUP BY user_id""")
def q_fn_fmt_pct(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    per_user = e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("si"),
                                        F.count(F.lit(1)).alias("insp"))
    return per_user.select("user_id", S.fmt_pct(S.safe_ratio_pct("si", "insp")).alias("purchase_share"))


@register("fn_fmt_thousands", """
SELECT c_nationkey, format('{:,.2f}', SUM(CAST(c_acctbal AS DECIMAL(18,2)))) AS balance_text
FROM customer GROUP BY c_nationkey""")
def q_fn_fmt_thousands(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    s = c.groupBy("c_nationkey").agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("b"))
    return s.select("c_nationkey", S.fmt_thousands("b", 2).alias("balance_text"))


@register("fn_trunc_int", """
SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS whole_balance FROM customer""")
def q_fn_trunc_int(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", S.trunc_int("c_acctbal").alias("whole_balance"))


@register("fn_safe_name", r"""
SELECT c_custkey, regexp_replace(c_name || ' ' || c_mktsegment, '[^\p{L}\p{N}_-]', '_', 'g') AS safe
FROM customer""")
def q_fn_safe_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", S.safe_name(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("safe"))


@register("fn_word_name", """
SELECT p_partkey, regexp_replace(p_name || '-' || p_type, '[^A-Za-z0-9_]', '_', 'g') AS word
FROM part""")
def q_fn_word_name(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", S.word_name(F.concat_ws("-", "p_name", "p_type")).alias("word"))


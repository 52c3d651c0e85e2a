"""Column helpers on hand-made edge rows."""

import math

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from kpiloom.functions import scalars as S
from kpiloom.functions.search import search_any, search_col, search_summary


def one_col(spark, values, dtype=StringType()):
    return spark.createDataFrame([(v,) for v in values], StructType([StructField("x", dtype)]))


def test_key_norm_strips_blanks_lowers_and_buckets_nulls(spark):
    df = one_col(spark, ["  Alice@X.com ", "\tBOB\n", None, "carol"])
    got = [r[0] for r in df.select(S.key_norm("x")).collect()]
    assert got == ["alice@x.com", "bob", "nan", "carol"]
    kept = [r[0] for r in df.select(S.key_norm("x", null_label=None)).collect()]
    assert kept[2] is None


def test_num_coerce_like_to_numeric(spark):
    df = one_col(spark, ["1,000", "", "12d", " 12 ", "1e3", None, "-3.5", ".5", "inf", "NaN", "abc"])
    got = [r[0] for r in df.select(S.num_coerce("x")).collect()]
    assert got == [0.0, 0.0, 0.0, 12.0, 1000.0, 0.0, -3.5, 0.5, 0.0, 0.0, 0.0]


def test_num_coerce_numeric_column(spark):
    df = one_col(spark, [1.5, float("nan"), None, float("inf")], DoubleType())
    got = [r[0] for r in df.select(S.num_coerce("x", DoubleType())).collect()]
    assert got == [1.5, 0.0, 0.0, 0.0]


def test_money_units_exact(spark):
    df = one_col(spark, [1013.7, 0.1, 0.2, -2.25], DoubleType())
    total = df.agg(S.from_units(F.sum(S.money_units("x", DoubleType()))).alias("t")).first().t
    assert total == 1011.75


def test_case_tier_first_match_gaps_and_open_ends(spark):
    df = one_col(spark, [5.0, 10.0, 10.5, 11.0, 100.0, -1.0], DoubleType())
    tier = S.case_tier("x", [(None, 10, "a"), (11, 20, "b"), (15, None, "c"), (None, None, "dropped")], "none")
    assert [r[0] for r in df.select(tier).collect()] == ["a", "a", "none", "b", "c", "a"]
    assert S.case_tier("x", [(None, None, 1)]) is None


def test_contains_ci_regex_literal_and_nulls(spark):
    df = one_col(spark, ["Foo.Bar", "fooXbar", None])
    assert [r[0] for r in df.select(S.contains_ci("x", "foo.bar")).collect()] == [True, True, False]
    assert [r[0] for r in df.select(S.contains_ci("x", "foo.bar", literal=True)).collect()] == [True, False, False]


def test_unknown_and_ratio_text(spark):
    df = spark.createDataFrame([("", 1, 8), (None, 0, 0), ("A", 49, 400)], "c string, si long, insp long")
    rows = df.select(S.unknown("c").alias("u"), S.fmt_pct(S.safe_ratio_pct("si", "insp")).alias("p")).collect()
    assert [r.u for r in rows] == ["Unknown", "Unknown", "A"]
    assert [r.p for r in rows] == ["12.5%", "0.0%", "12.3%"]   # 12.25 rounds half up


def test_trunc_and_names(spark):
    df = one_col(spark, [-1.9, 2.9], DoubleType())
    assert [r[0] for r in df.select(S.trunc_int("x")).collect()] == [-1, 2]
    names = one_col(spark, ["Sales Q1/2024 (é)", "a-b_c"])
    assert [r[0] for r in names.select(S.safe_name("x")).collect()] == ["Sales_Q1_2024__é_", "a-b_c"]
    assert [r[0] for r in names.select(S.word_name("x")).collect()] == ["Sales_Q1_2024____", "a_b_c"]


def test_fmt_thousands(spark):
    df = one_col(spark, [1234567.0], DoubleType())
    assert df.select(S.fmt_thousands("x")).first()[0] == "1,234,567"


def test_search_any_and_col(spark):
    df = spark.createDataFrame([("alice", 10.0), ("Bob", None), (None, 7.0)], "name string, pay double")
    assert search_any(df, "  ").count() == 3
    assert search_any(df, "BOB").count() == 1
    assert search_any(df, "^7").count() == 1         # numbers are searched as text
    assert search_col(df, "name", "li").count() == 1
    s = search_summary(df, "name", "a|b", "pay").first()
    assert (s.n_rows, s.total) == (2, 10.0)
    assert not math.isnan(s.total)


def test_small_and_large_amounts_are_summed_whole(spark):
    from kpiloom.operators.consolidate import consolidate, mappings_for, presum
    df = spark.createDataFrame([("a", 0.00004), ("a", 0.00004), ("b", 1e15), ("b\xa0", 0.5)], "k string, v double")
    got = {r.cj_id: r.a for r in consolidate(mappings_for(df, "a", "k", ["v"])).collect()}
    assert got == {"a": 0.00008, "b": 1e15 + 0.5}
    exact = df.selectExpr("k", "cast(9007199254740993 as bigint) as v")
    assert {r.cj_id: r.v for r in presum(exact, "k", "v").collect()}["a"] == 2.0 * 9007199254740993

"""Co-located tables: the same rows, joined and grouped without an exchange."""

import pytest
from pyspark.sql import functions as F

from kpiloom.sources.layout import BUCKET_BYTES, bucket_count, write_colocated
from kpiloom.sources.tables import table

from fixture_paths import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    orders, lines = table(spark, SF_SMALL, "orders"), table(spark, SF_SMALL, "lineitem")
    return orders, lines, write_colocated({"orders": (orders, "o_orderkey"), "lineitem": (lines, "l_orderkey")}, 4)


def test_same_rows(stored):
    orders, lines, t = stored
    for df, own in ((orders, t["orders"]), (lines, t["lineitem"])):
        assert own.columns == df.columns and own.exceptAll(df).isEmpty() and df.exceptAll(own).isEmpty()


def test_join_and_presum_without_an_exchange(stored):
    orders, lines, t = stored
    presum = t["lineitem"].groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    joined = t["orders"].hint("merge").join(presum, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "n")
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    direct = orders.hint("merge").join(lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")), F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "n")
    assert "Exchange" in plan(direct)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, direct.collect()))


def test_keys_of_other_integer_types_nulls_and_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (3, "w")], "k int, a string")
    b = spark.createDataFrame([(1, 5), (3, 6), (None, 7), (4, 8)], "key long, b int")
    t = write_colocated({"a": (a, "k"), "b": (b, "key")}, 3)
    joined = t["a"].hint("merge").join(t["b"], F.col("k") == F.col("key")).select("a", "b")
    assert "Exchange" not in plan(joined)
    assert sorted(map(tuple, joined.collect())) == [("w", 6), ("x", 5), ("y", 5)]
    assert t["a"].count() == 4 and t["b"].count() == 4


def test_refused(spark):
    one, two = spark.range(3), spark.range(3).selectExpr("CAST(id AS STRING) s")
    with pytest.raises(ValueError):
        write_colocated({"a": (one, "id"), "b": (two, "s")}, 2)
    with pytest.raises(ValueError):
        write_colocated({"a": (one, "id")}, 0)
    assert bucket_count(1) == 8 and bucket_count(9 * BUCKET_BYTES) == 16

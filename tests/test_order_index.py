"""The stored order of a sheet against the sorted sheet."""

import random
import uuid

import pytest

from kpiloom.operators.order_index import build_order, open_order
from kpiloom.session import scratch_path

SCHEMA = "a int, b string, c double"


def sheet(n, seed):
    rng = random.Random(seed)
    # a third of the rows tie in the first column, some rows repeat as a whole, nulls in all columns
    return [(7 if rng.random() < 0.34 else rng.choice([None, *range(12)]), rng.choice([None, "x", "y", "zz"]), rng.choice([None, 1.5, -2.0, float(i % 9)]))
            for i in range(n)]


def placed(rows, by):
    """The rows in the order of Spark's orderBy, by the columns of the order alone."""
    at = {"a": 0, "b": 1, "c": 2}
    for c, down in reversed(by):
        rows = sorted(rows, key=lambda r: (r[at[c]] is not None, r[at[c]] if r[at[c]] is not None else 0) if c != "b" else (r[1] is not None, r[1] or ""),
                      reverse=down)
    return [tuple(r[at[c]] for c, _ in by) for r in rows]


BY = [("a", True), ("b", False)]


def keys(rows, by=BY):
    return [tuple(r[c] for c, _ in by) for r in rows]


@pytest.mark.parametrize("by", [BY, [("b", True), ("c", False), ("a", False)]])
def test_pages_are_the_sorted_sheet(spark, by):
    rows = sheet(1003, 1)
    index = build_order(spark.createDataFrame(rows, SCHEMA), by, scratch_path(spark, "order"), range_rows=100)
    got = [r for p in range(1, 7) for r in index.page(p, 180).collect()]
    assert keys(got, by) == placed(rows, by)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, rows))  # ties neither repeat nor go missing between pages
    assert index.page(7, 180).count() == 0 and index.count() == 1003


def test_first_and_last_page_read_one_range(spark):
    rows = [(i % 1000, "x", float(i)) for i in range(4000)]
    index = build_order(spark.createDataFrame(rows, SCHEMA), BY, scratch_path(spark, "order"), range_rows=500)
    first, n = index.ranges_read(1, 20)
    last, _ = index.ranges_read(200, 20)
    assert n >= 6 and first == last == 1
    # the plan names one range's folder
    plan = index.page(200, 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan and "LocalLimit" in plan


def test_a_value_of_all_rows_is_cut_into_ranges(spark):
    index = build_order(spark.range(2000).selectExpr("1 a", "'x' b", "1D c"), BY, scratch_path(spark, "order"), range_rows=250)
    assert index.ranges_read(1, 10)[1] >= 4
    assert max(r.n for r in index.ranges().collect()) < 1000


def test_added_rows_take_their_places(spark):
    first, more, last = sheet(600, 2), sheet(400, 3), sheet(37, 4)
    index = build_order(spark.createDataFrame(first, SCHEMA), BY, scratch_path(spark, "order"), range_rows=100)
    assert index.add(spark.createDataFrame(more, SCHEMA)) == 1
    assert index.add(spark.createDataFrame(last, SCHEMA)) == 2
    again = open_order(spark, index.path, index.schema, BY)
    got = [r for p in range(1, 5) for r in again.page(p, 300).collect()]
    assert keys(got) == placed(first + more + last, BY)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, first + more + last))
    even = again.rebuild(scratch_path(spark, "order"))
    assert keys(even.slice(0, 2000).collect()) == placed(first + more + last, BY)


def test_rows_before_and_behind_all_ranges(spark):
    index = build_order(spark.createDataFrame([(i, "x", 0.0) for i in range(10, 90)], SCHEMA), [("a", False)], scratch_path(spark, "order"), range_rows=10)
    index.add(spark.createDataFrame([(-5, "x", 0.0), (None, "x", 0.0), (500, "x", 0.0)], SCHEMA))
    got = [r.a for r in index.slice(0, 100).collect()]
    assert got == [None, -5, *range(10, 90), 500]


def test_a_failed_addition_changes_no_page(spark):
    index = build_order(spark.createDataFrame([(i, "x", 0.0) for i in range(50)], SCHEMA), [("a", False)], scratch_path(spark, "order"), range_rows=10)
    before = [r.a for r in index.page(1, 20).collect()]
    # rows of a generation without its table of ranges: a job that ended between the two writes
    spark.createDataFrame([(-1, "x", 0.0, 0, 0)], SCHEMA + ", _hash long, _no long").write.parquet(f"{index.path}/rows/_gen=1/_range=0")
    assert [r.a for r in index.page(1, 20).collect()] == before
    index.add(spark.createDataFrame([(-9, "x", 0.0)], SCHEMA))
    assert [r.a for r in index.page(1, 3).collect()] == [-9, 0, 1]


def test_empty_sheet_and_wrong_calls(spark):
    empty = spark.createDataFrame([], SCHEMA)
    index = build_order(empty, BY, scratch_path(spark, f"order-{uuid.uuid4().hex}"))
    assert index.page(1).count() == 0 and index.count() == 0
    index.add(spark.createDataFrame([(1, "x", 0.0), (2, "y", 0.0)], SCHEMA))
    assert [r.a for r in index.page(1).collect()] == [2, 1]
    with pytest.raises(ValueError):
        index.page(0)
    with pytest.raises(ValueError):
        index.add(spark.range(3))
    with pytest.raises(ValueError):
        build_order(spark.range(3).withColumnRenamed("id", "_no"), [("_no", False)], scratch_path(spark, "order"))

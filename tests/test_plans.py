"""Plan-shape tests: the scale properties the design relies on, read from
``explain`` so a regression shows up as a failing test."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from kpiloom.operators.consolidate import consolidate, mappings_for
from kpiloom.operators.joins import slab_join
from kpiloom.operators.latest import latest_per_key
from kpiloom.workloads import load_all

from fixture_paths import SF_SMALL

REGISTRY = load_all()


def plan_of(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_and_no_cartesian(spark, name):
    plan = plan_of(REGISTRY[name][0](spark, SF_SMALL), "extended")
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "FlatMapGroupsInPandas"):
        assert bad not in plan, f"{name}: {bad}"


def test_period_filter_reaches_the_scan(spark):
    for name in ("filt_between_date", "join_enrich"):
        plan = plan_of(REGISTRY[name][0](spark, SF_SMALL))
        assert "GreaterThanOrEqual(o_orderdate," in plan and "LessThan(o_orderdate," in plan, name


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(REGISTRY["consolidate"][0](spark, SF_SMALL))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan


def test_merge_is_one_shuffle(spark):
    a = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("v"))
    b = spark.range(50).select((F.col("id") % 5).alias("k"), F.col("id").cast("double").alias("w"))
    plan = plan_of(consolidate(mappings_for(a, "a", "k", ["v"]) + mappings_for(b, "b", "k", ["w"]), sort=False))
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert tree.count("HashAggregate") == 2          # partial (map side) + final


def test_latest_per_key_prunes_before_its_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), (F.col("id") % 10).alias("t"))
    plan = plan_of(latest_per_key(df, "k", "t"))
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1 and "Join" not in tree


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_slab_join_is_an_equality_join_at_any_size(spark, threshold):
    vals = spark.range(100).select(F.col("id").cast("double").alias("v"), (F.col("id") % 2).alias("g"))
    slabs = spark.sql("SELECT * FROM VALUES (0L, 0L, 50L, 1.0D), (1L, 51L, NULL, 2.0D) AS t(g, lo, hi, amount)")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for on in ([], [("g", "g")]):
            tree = plan_of(slab_join(vals, "v", slabs, on=on)).split("\n\n")[0]
            assert "NestedLoop" not in tree and "Cartesian" not in tree
            assert ("BroadcastHashJoin" in tree) == (threshold != "-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_month_and_rolling_filters_reach_the_scan(spark):
    for name in ("filt_facet", "filt_rolling"):
        plan = plan_of(REGISTRY[name][0](spark, SF_SMALL))
        assert "GreaterThanOrEqual(" in plan, name

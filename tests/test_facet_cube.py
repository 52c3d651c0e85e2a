"""The facet cube against the direct queries of every choice."""

import random

import pytest

from kpiloom.operators import dashboard as D
from kpiloom.operators.facet_cube import build_cube, merge_cubes
from kpiloom.session import scratch_path

SCHEMA = "month string, channel string, si long, insp long"


def some_facts(spark, n, seed):
    rng = random.Random(seed)
    return spark.createDataFrame([(rng.choice(["2024-01", "2024-02", "2024-03"]), rng.choice(["", None, "A", "B", "C"]), rng.randint(0, 5), rng.choice([0, 3, 9]))
                                  for _ in range(n)], SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_every_choice_equals_the_direct_query(spark):
    facts = some_facts(spark, 60, 1)
    cube = build_cube(facts, scratch_path(spark, "cube"))
    for month in ("All", "2024-01", "2024-02", "1999-01"):
        for channel in ("All", "A", "Unknown", "none"):
            picked = D.filter_facets(facts, month, channel)
            assert rows(cube.totals(month=month, channel=channel)) == rows(D.totals(picked)), (month, channel)
            assert rows(cube.by("channel", month=month, channel=channel)) == rows(D.by_channel(picked)), (month, channel)
    assert rows(cube.values()) == rows(D.facet_values(facts))
    for r in cube.every_choice().collect():
        assert tuple(cube.totals(month=r.month, channel=r.channel).first()) == (r.total_si, r.total_insp, r.si_ratio, r.channel_count)
    assert cube.every_choice().count() == cube.cells().count()


def test_cubes_of_parts_merge(spark):
    one, two = some_facts(spark, 30, 2), some_facts(spark, 40, 3)
    merged = merge_cubes(scratch_path(spark, "cube"), build_cube(one, scratch_path(spark, "cube")), build_cube(two, scratch_path(spark, "cube")))
    whole = build_cube(one.unionByName(two), scratch_path(spark, "cube"))
    assert sorted(map(repr, rows(merged.cells()))) == sorted(map(repr, rows(whole.cells())))


def test_one_scan_of_the_facts(spark, tmp_path):
    from kpiloom.operators.facet_cube import cells
    path = str(tmp_path / "facts")
    some_facts(spark, 50, 4).write.parquet(path)
    plan = cells(spark.read.parquet(path), ["month", "channel"], ["si", "insp"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan


def test_a_choice_reads_one_level(spark):
    cube = build_cube(some_facts(spark, 50, 5), scratch_path(spark, "cube"))
    plan = cube.by("channel")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(level" in plan


def test_no_facts_and_wrong_names(spark):
    cube = build_cube(spark.createDataFrame([], SCHEMA), scratch_path(spark, "cube"))
    assert rows(cube.totals()) == [(0, 0, "0%", 0)] and rows(cube.by("channel")) == []
    with pytest.raises(ValueError):
        cube.totals(region="x")
    with pytest.raises(ValueError):
        build_cube(spark.range(3).selectExpr("'x' level", "id si", "id insp"), scratch_path(spark, "cube"), ["level"])

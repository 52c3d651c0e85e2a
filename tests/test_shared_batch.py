"""Entries that share a scan against the same entries by themselves."""

import pytest

from kpiloom.operators.measures import Measure
from kpiloom.plans.shared_batch import Entry, alone, run_shared, same_sources, shared
from kpiloom.session import scratch_path
from kpiloom.sources.sinks import RUNLOG_SCHEMA

ROWS = [(i, None if i % 7 == 0 else f"u{i % 5}", ["view", "buy", None][i % 3], None if i % 11 == 0 else float(i % 13), str(i) if i != 40 else "bad") for i in range(200)]
SCHEMA = "id long, user string, kind string, value double, text string"


def M(func, column="*", alias=None):
    return Measure(func=func, column=column, alias=alias or f"{func}_{column}".lower().replace("*", "all"))


ENTRIES = [
    Entry("by user", "e", ["user"], [M("COUNT"), M("SUM", "value"), M("MIN", "value")], "kind = 'view'"),
    Entry("by kind", "again", ["kind"], [M("AVG", "value"), M("COUNT_DISTINCT", "user")]),
    Entry("both", "e", ["kind", "user"], [M("MAX", "id"), M("COUNT")], "user <> 'u1'"),
    Entry("paid", "e", ["user"], [Measure("slab", "pay", column="value", slabs=[(0, 4, 10), (5, None, 30)], else_value=1), Measure("flat", "units", per_unit=3)], "id < 50"),
    Entry("nobody", "e", ["user"], [M("COUNT")], "id < 0"),
    Entry("all", "e", [], [M("COUNT"), M("SUM", "value")], "kind = 'buy'"),
]


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(path)
    return path


def views(spark, path):
    return {"e": spark.read.parquet(path), "again": spark.read.parquet(path)}


def read_sheet(spark, root, sheet):
    return spark.read.parquet(f"{root}/{sheet}")


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_sheets_equal_the_entries_alone(spark, source):
    src, out = views(spark, source), scratch_path(spark, "out")
    log = run_shared(spark, src, ENTRIES, out)
    assert log.schema == RUNLOG_SCHEMA
    assert [(r.query_name, r.status) for r in log.collect()] == [(e.name, "success") for e in ENTRIES]
    for r, e in zip(log.collect(), ENTRIES):
        own, sheet = alone(src[e.source], e), read_sheet(spark, out, r.sheet_name)
        assert sheet.columns == own.columns and rows(sheet) == rows(own) and r.row_count == own.count(), e.name


def test_views_of_one_table_are_one_source(spark, source):
    src = views(spark, source) | {"other": spark.read.parquet(source).where("id > 3")}
    assert same_sources(src) == {"e": "e", "again": "e", "other": "other"}


def test_one_scan_with_only_the_columns_needed(spark, source):
    plan = shared(spark.read.parquet(source), ENTRIES[:1] + ENTRIES[2:4])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "text" not in plan.split("ReadSchema")[1] and "Or(" in plan.split("PushedFilters")[1]


def test_an_entry_that_fails_leaves_the_others(spark, source):
    src, out = views(spark, source), scratch_path(spark, "out")
    wrong = [Entry("missing", "e", ["nothing"], [M("COUNT")]), Entry("nowhere", "gone", [], [M("COUNT")]),
             Entry("no measure", "e", ["user"], []),
             Entry("cast", "e", ["user"], [M("SUM", "CAST(text AS INT)", "n")])]  # fails on one row when it runs
    log = {r.query_name: r for r in run_shared(spark, src, wrong + ENTRIES[:2], out).collect()}
    assert {n for n, r in log.items() if r.status == "failed"} == {"missing", "nowhere", "no measure", "cast"}
    assert all(log[n].error and log[n].row_count == 0 for n in ("missing", "nowhere", "cast"))
    for e in ENTRIES[:2]:
        assert rows(read_sheet(spark, out, log[e.name].sheet_name)) == rows(alone(src[e.source], e))


def test_no_rows(spark):
    src, out = {"e": spark.createDataFrame([], SCHEMA)}, scratch_path(spark, "out")
    log = run_shared(spark, src, [ENTRIES[0], ENTRIES[5]], out).collect()
    assert [(r.status, r.row_count) for r in log] == [("success", 0), ("success", 1)]
    assert rows(read_sheet(spark, out, log[1].sheet_name)) == ["(0, None)"]

"""Sources, sinks, catalog, batch runs, summaries and the streaming refresh."""

import pytest
from pyspark.sql import functions as F

from kpiloom.plans.batch import REGISTRY_SCHEMA, kpi_order, run_batch, run_summary, select_queries, status_rollup
from kpiloom.session import scratch_path
from kpiloom.sources import files as FS
from kpiloom.sources import sinks as SK
from kpiloom.sources.catalog import register_sheets, run_kpi, view_names, run_sql
from kpiloom.streaming.arrival import current_totals, start_refresh


def test_name_variants_and_kpi_errors(spark):
    assert view_names("My Sheet-1") == ["My Sheet-1", "My_Sheet_1"] and view_names("plain") == ["plain"]
    register_sheets({"My Sheet-1": spark.range(2)})
    assert spark.sql("SELECT * FROM `My Sheet-1` UNION ALL SELECT * FROM my_sheet_1").count() == 4
    with pytest.raises(ValueError, match="share"):
        register_sheets({"pay-a": spark.range(1), "pay a": spark.range(1)})
    df = spark.createDataFrame([(1,)], "x int")
    out, err = run_kpi(spark, "SELECT SUM(x) AS s FROM my_sheet_1", {"My Sheet-1": df, "empty": None})
    assert err is None and out.first().s == 1
    out, err = run_kpi(spark, "SELECT * FROM nowhere", {"My Sheet-1": df})
    assert out is None and "available tables" in err
    assert run_sql(spark, "SELEC 1")[1] is not None
    with pytest.raises(ValueError):
        run_kpi(spark, "SELECT 1", {"empty": None})


def test_norm_headers(spark):
    df = spark.createDataFrame([(1, "a", "b")], "`Query Name` int, `SQL Query` string, Other string")
    assert FS.norm_headers(df).columns == ["query_name", "sql_query", "other"]
    with pytest.raises(ValueError, match="sheet_name"):
        FS.norm_headers(df, ["query_name", "sheet_name"])


def test_json_result_contract(spark):
    ok = scratch_path(spark, "ok")
    spark.createDataFrame([(1, "a")], "id long, v string").write.json(ok)
    df, status, err = FS.read_result_json(spark, ok)
    assert status == "success" and df.count() == 1
    bad = scratch_path(spark, "bad")
    spark.createDataFrame([("boom",)], "__error__ string").write.json(bad)
    assert FS.read_result_json(spark, bad)[1:] == ("failed", "boom")
    empty = scratch_path(spark, "empty")
    spark.createDataFrame([], "id long").write.json(empty)
    assert FS.read_result_json(spark, empty, schema=spark.createDataFrame([], "id long").schema)[1] == "failed"
    rt = FS.rows_from_json(FS.rows_as_json(spark.createDataFrame([(1, "x")], "a long, b string")), "record",
                           spark.createDataFrame([], "a long, b string").schema)
    assert rt.first() == (1, "x")


def test_folder_naming_and_skips(spark):
    folder = scratch_path(spark, "wb")
    for n in ("one", "two"):
        spark.createDataFrame([(1,)], "x int").write.option("header", True).csv(f"{folder}/{n}.csv")
    tables, skipped = FS.read_folder(spark, folder, prefix="book", existing={"BOOK_TWO"})
    assert sorted(tables) == ["book_one"] and skipped == ["book_two"]
    single = scratch_path(spark, "wb1")
    spark.createDataFrame([(1,)], "x int").write.option("header", True).csv(f"{single}/only.csv")
    assert list(FS.read_folder(spark, single, prefix="book")[0]) == ["book"]
    assert list(FS.read_folder(spark, single)[0]) == ["only"]


def test_report_sinks_and_append(spark):
    root = scratch_path(spark, "rep")
    good = spark.range(3)
    SK.write_report(spark, [("first", good, "success"), ("bad", None, "failed")], root)
    SK.write_report(spark, [("second", spark.range(5), "success")], root)
    man = {r.sheet_name: r.row_count for r in spark.read.parquet(f"{root}/_manifest").collect()}
    assert man == {"first": 3, "second": 5}
    assert spark.read.parquet(f"{root}/first").count() == 3            # untouched by the second run
    assert SK.sheet_name_for("x" * 40) == "x" * 40
    with pytest.raises(ValueError, match="one sheet"):
        SK.write_report(spark, [("a/b", good, "success"), ("a:b", good, "success")], root)
    boom = spark.range(4).select(F.expr("assert_true(id < 2)"), "id")
    with pytest.raises(Exception):
        SK.write_report(spark, [("first", boom, "success")], root)
    assert spark.read.parquet(f"{root}/first").count() == 3            # a rerun that fails leaves the earlier rows
    SK.write_report(spark, [("first", spark.range(7), "success")], root)
    assert spark.read.parquet(f"{root}/first").count() == 7
    path = scratch_path(spark, "app")
    SK.append_positional(spark.createDataFrame([(1, "a")], "k long, v string"), path)
    SK.append_positional(spark.createDataFrame([(2, "b")], "other long, names string"), path)
    assert sorted(spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        SK.append_positional(spark.range(1), path)
    assert SK.append_positional(spark.createDataFrame([(3, 4)], "k int, v int"), path) == 1
    assert spark.read.parquet(path).where("v = '4' and k = 3").count() == 1


def test_workspace_round_trip(spark):
    root = scratch_path(spark, "ws")
    df = spark.createDataFrame([(1, 2.5)], "a long, b double")
    SK.save_workspace(spark, root, "w1", {"t": (df, "sql", "q"), "e": (df.where("false"), "sql", "q2"),
                                          "scheme": (df, "scheme", None)})
    meta, tables = SK.load_workspace(spark, root, "w1")
    assert sorted((r.name, r.status) for r in meta.collect()) == [("e", "pending"), ("t", "success")]
    assert tables["t"].schema == df.schema and tables["t"].first() == (1, 2.5)
    SK.save_workspace(spark, root, "w1", {"t": (tables["t"], "sql", "q")})    # back to the folder it is read from
    assert SK.load_workspace(spark, root, "w1")[1]["t"].first() == (1, 2.5)


def test_batch_isolates_failures_and_filters(spark):
    spark.range(4).createOrReplaceTempView("nums")
    reg = spark.createDataFrame([
        ("ok", "SELECT * FROM nums", "Ok", "Daily", None), ("bad", "SELECT nope FROM nums", "Bad", "daily", True),
        ("boom", "SELECT assert_true(id < 2) FROM nums", "Boom", "daily", True), ("none", None, "None", "daily", True),
        ("weekly", "SELECT 1", "W", "weekly", True), ("off", "SELECT 1", "Off", "daily", False)], REGISTRY_SCHEMA)
    assert select_queries(reg).count() == 5 and select_queries(reg, "DAILY").count() == 4
    log = run_batch(spark, reg, scratch_path(spark, "b"), frequency="daily")
    got = {r.query_name: (r.status, r.row_count) for r in log.collect()}
    assert got == {"ok": ("success", 4), "bad": ("failed", 0), "boom": ("failed", 0), "none": ("failed", 0)}
    s = run_summary(log).first()
    assert (s.total_queries, s.successful, s.failed, s.success_rate, s.total_rows) == (4, 1, 3, "25.0%", 4)
    assert run_summary(log.where("false")).count() == 0


def test_status_rollup_and_kpi_order(spark):
    sheets = spark.createDataFrame([("sql", "success"), ("sql", "failed"), ("kpi", "running"), ("scheme", "success")],
                                   "type string, status string")
    got = {r.type: (r.total, r.success, r.failed, r.running) for r in status_rollup(sheets).collect()}
    assert got == {"sql": (2, 1, 1, 0), "kpi": (1, 0, 0, 1), None: (3, 1, 1, 1)}
    assert kpi_order({"c": ["b"], "b": ["a"], "a": []}) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="cycle"):
        kpi_order({"a": ["b"], "b": ["a"]})


def test_streaming_refresh_is_incremental_and_idempotent(spark):
    landing, state, ckpt = (scratch_path(spark, n) for n in ("land", "state", "ckpt"))
    schema = spark.createDataFrame([], "k string, v double").schema
    spark.createDataFrame([(" A", 1.5), ("b", 2.0)], schema).write.mode("append").parquet(landing)
    q = start_refresh(spark, landing, schema, state, ckpt, "k", "v")
    q.awaitTermination(120)
    spark.createDataFrame([("a", 1.0)], schema).write.mode("append").parquet(landing)
    q = start_refresh(spark, landing, schema, state, ckpt, "k", "v")      # restart: only the new file
    q.awaitTermination(120)
    got = {r.cj_id: (r.total, r.n_rows) for r in current_totals(spark, state).collect()}
    assert got == {"a": (2.5, 2), "b": (2.0, 1)}


def test_strip_zone(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.to_timestamp_ntz("t").alias("t"))
    out = FS.strip_zone(df, "Asia/Kolkata").first().t
    assert str(out) == "2024-01-01 05:30:00"


def test_csv_table_naming_and_scheme_first(spark):
    from kpiloom.sources.scheme import with_scheme_first
    p = scratch_path(spark, "people.csv")
    spark.createDataFrame([(1, "a")], "id int, n string").write.option("header", True).csv(p)
    name, df = FS.load_csv_table(spark, p)
    assert name == "people" and df.count() == 1
    with pytest.raises(ValueError):
        FS.load_csv_table(spark, p, existing={"PEOPLE"})
    sheets = with_scheme_first(spark, {"x": df, "scheme": None})
    assert list(sheets) == ["scheme", "x"] and sheets["scheme"].count() == 44


def test_batch_cli_with_yaml_and_html_registries(spark, tmp_path):
    from kpiloom.plans.cli import main
    data = scratch_path(spark, "nums")
    spark.range(10).write.parquet(data)
    yml = tmp_path / "q.yaml"
    yml.write_text("queries:\n"
                   "  - name: Evens\n    sql: SELECT * FROM nums WHERE id % 2 = 0\n    sheet_name: Evens\n"
                   "    refresh_frequency: manual\n    enabled: true\n"
                   "  - name: Broken\n    sql: SELECT nope FROM nums\n    sheet_name: Broken\n"
                   "    refresh_frequency: manual\n")
    out = scratch_path(spark, "out")
    s = main(["--registry", str(yml), "--table", f"nums={data}", "--out", out, "--frequency", "MANUAL"], spark)
    assert (s["total_queries"], s["successful"], s["failed"], s["total_rows"]) == (2, 1, 1, 5)
    assert spark.read.parquet(f"{out}/Evens").count() == 5
    assert spark.read.parquet(f"{out}/_runlog").count() == 2
    html = tmp_path / "q.html"
    html.write_text("<html><table><tr><th>Query Name</th><th>SQL Query</th><th>Sheet Name</th></tr>"
                    "<tr><td>Small</td><td>SELECT * FROM nums WHERE id &lt; 3</td><td>Small</td></tr></table></html>")
    out2 = scratch_path(spark, "out2")
    s = main(["--registry", str(html), "--table", f"nums={data}", "--out", out2, "--sequential"], spark)
    assert (s["total_queries"], s["total_rows"]) == (1, 3)


def test_streaming_compaction(spark):
    from kpiloom.streaming.arrival import compact
    landing, state, ckpt = (scratch_path(spark, n) for n in ("land2", "state2", "ckpt2"))
    schema = spark.createDataFrame([], "k long, v double").schema

    def land_and_run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        q = start_refresh(spark, landing, schema, state, ckpt, "k", "v")
        q.awaitTermination(120)

    land_and_run([(1, 1.0), (2, 2.0)])
    land_and_run([(1, 0.5)])
    assert compact(spark, state) == 1
    land_and_run([(2, 0.25), (3, 3.0)])
    want = {"1": (1.5, 2), "2": (2.25, 2), "3": (3.0, 1)}
    assert {r.cj_id: (r.total, r.n_rows) for r in current_totals(spark, state).collect()} == want
    assert compact(spark, state) == 2
    assert {r.cj_id: (r.total, r.n_rows) for r in current_totals(spark, state).collect()} == want
    assert compact(spark, state) == 2          # nothing new: no second snapshot


def test_report_append_mode_and_qualify_hint(spark):
    root = scratch_path(spark, "rep_app")
    SK.write_report(spark, [("s", spark.range(2), "success")], root)
    SK.write_report(spark, [("s", spark.range(3).withColumnRenamed("id", "other"), "success")], root, overwrite=False)
    assert spark.read.parquet(f"{root}/s").count() == 5
    _, err = run_sql(spark, "SELECT id, RANK() OVER (ORDER BY id) AS r FROM range(3) QUALIFY r = 1")
    assert "QUALIFY" in err


def test_kpi_refresh_materialized(spark):
    from kpiloom.plans.batch import refresh_kpis
    kpis = {"b": ("SELECT SUM(n) AS s FROM a", ["a"]), "a": ("SELECT id % 3 AS k, COUNT(*) AS n FROM base GROUP BY 1", []),
            "bad": ("SELECT nope FROM a", ["a"])}
    out = refresh_kpis(spark, {"base": spark.range(10)}, kpis, materialize=True)
    assert out["b"][0].first().s == 10 and out["bad"][0] is None and out["bad"][1]


def test_batch_timeout_cancels_only_the_slow_query(spark):
    import time as _t
    reg = spark.createDataFrame([
        ("slow", "SELECT SUM(a.id * b.id) AS s FROM range(20000000000) a JOIN range(3) b ON a.id % 3 = b.id",
         "Slow", "daily", True),
        ("fast", "SELECT 1 AS x", "Fast", "daily", True)], REGISTRY_SCHEMA)
    t0 = _t.time()
    log = run_batch(spark, reg, scratch_path(spark, "to"), timeout=3, parallel=False)
    got = {r.query_name: (r.status, r.error) for r in log.collect()}
    assert got["fast"] == ("success", None)
    assert got["slow"][0] == "failed" and "timed out" in got["slow"][1]
    assert _t.time() - t0 < 60


def test_streaming_after_batch_hook(spark):
    landing, state, ckpt, out = (scratch_path(spark, n) for n in ("land3", "state3", "ckpt3", "kpi3"))
    schema = spark.createDataFrame([], "k string, v double").schema
    for rows in ([("a", 1.0)], [("b", 2.0)], [("a", 3.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)   # one file each
    seen = []

    def refresh_kpi(s, batch_id):
        seen.append(batch_id)
        current_totals(s, state).where("total > 1").write.mode("overwrite").parquet(out)

    q = start_refresh(spark, landing, schema, state, ckpt, "k", "v", max_files_per_batch=1, after_batch=refresh_kpi)
    q.awaitTermination(120)
    assert seen == [0, 1, 2]
    assert sorted((r.cj_id, r.total) for r in spark.read.parquet(out).collect()) == [("a", 4.0), ("b", 2.0)]


def test_streaming_scheduled_compaction(spark):
    from kpiloom.streaming.arrival import _snapshots
    landing, state, ckpt = (scratch_path(spark, n) for n in ("land4", "state4", "ckpt4"))
    schema = spark.createDataFrame([], "k string, v double").schema
    for rows in ([("a", 1.0)], [("b", 2.0)], [("a", 3.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    q = start_refresh(spark, landing, schema, state, ckpt, "k", "v", max_files_per_batch=1, compact_every=2)
    q.awaitTermination(120)
    assert _snapshots(spark, state) == [1]                      # after batches 0 and 1
    assert sorted((r.cj_id, r.total) for r in current_totals(spark, state).collect()) == [("a", 4.0), ("b", 2.0)]


def test_a_snapshot_without_its_mark_is_not_trusted(spark):
    import glob
    import os

    from kpiloom.streaming.arrival import _snapshots, compact
    landing, state, ckpt = (scratch_path(spark, n) for n in ("snap_landing", "snap_state", "snap_ckpt"))
    schema = spark.createDataFrame([], "k string, v double").schema
    for i in range(3):
        spark.createDataFrame([("a", float(i)), ("b", 1.0)], schema).coalesce(1).write.mode("append").parquet(landing)
        q = start_refresh(spark, landing, schema, state, ckpt, "k", "v")
        q.awaitTermination(120)
    want = {r.cj_id: (r.total, r.n_rows) for r in current_totals(spark, state).collect()}
    assert want == {"a": (3.0, 3), "b": (3.0, 3)} and compact(spark, state) == 2
    folder = state.removeprefix("file:").replace("//", "/") + "/_snapshots/upto=2"
    os.remove(f"{folder}/_SUCCESS")                                   # an interrupted commit
    os.remove(sorted(glob.glob(f"{folder}/part-*"))[0])
    assert _snapshots(spark, state) == []
    assert {r.cj_id: (r.total, r.n_rows) for r in current_totals(spark, state).collect()} == want
    assert compact(spark, state) == 2 and _snapshots(spark, state) == [2]
    assert {r.cj_id: (r.total, r.n_rows) for r in current_totals(spark, state).collect()} == want

"""Refresh by digest: what is run after no change, a changed sheet, a changed statement."""

from kpiloom.plans.refresh import refresh_changed, sheet_digest

KPIS = {"total": ("SELECT SUM(pay) AS pay FROM pays", ["pays"]), "pays": ("SELECT who, SUM(n) * 10 AS pay FROM visits GROUP BY who", ["visits"]),
        "names": ("SELECT COUNT(*) AS n FROM people", ["people"])}


def sheets(spark, visits, people=((1, "a"),)):
    return {"visits": spark.createDataFrame(visits, "who int, n int"), "people": spark.createDataFrame(list(people), "id int, name string")}


def ran(out):
    return {k for k, r in out.items() if r.computed}


def test_digest_is_free_of_order_and_sees_any_cell(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, 2.5), (None, "2", 2.0)]
    df = lambda r: spark.createDataFrame(r, "a int, b string, c double")
    assert sheet_digest(df(rows)) == sheet_digest(df(rows[::-1]).repartition(3))
    seen = {sheet_digest(df(r)) for r in (rows, rows[1:], rows + rows[:1], [(1, "a", 0.0), *rows[1:]], [(1, None, None), *rows[1:]], [])}
    assert len(seen) == 6
    assert sheet_digest(df(rows)) != sheet_digest(df(rows).withColumnRenamed("a", "z"))
    assert sheet_digest(spark.createDataFrame([(None, 5)], "a int, b int")) != sheet_digest(spark.createDataFrame([(5, None)], "a int, b int"))
    assert sheet_digest(spark.sql("SELECT map('a', 1) AS m"))


def test_only_what_changed_runs(spark, tmp_path):
    root, visits = str(tmp_path), [(1, 2), (1, 3), (2, 1)]
    first = refresh_changed(spark, sheets(spark, visits), KPIS, root)
    assert ran(first) == {"total", "pays", "names"} and first["total"].df.first().pay == 60
    again = refresh_changed(spark, sheets(spark, visits[::-1]), KPIS, root)
    assert ran(again) == set() and again["total"].df.first().pay == 60
    more = refresh_changed(spark, sheets(spark, visits + [(2, 4)]), KPIS, root)
    assert ran(more) == {"total", "pays"} and more["total"].df.first().pay == 100
    # another split of the same sum: pays is run, its result is the same, total is not run
    assert ran(refresh_changed(spark, sheets(spark, [(1, 5), (2, 5)]), KPIS, root)) == {"pays"}
    told = KPIS | {"names": ("SELECT COUNT(*) + 1 AS n FROM people", ["people"])}
    out = refresh_changed(spark, sheets(spark, [(1, 5), (2, 5)]), told, root)
    assert ran(out) == {"names"} and out["names"].df.first().n == 2


def test_failures_and_statements_that_change_by_themselves(spark, tmp_path):
    kpis = {"bad": ("SELECT 1 / n AS x FROM visits", ["visits"]), "after": ("SELECT COUNT(*) AS n FROM bad", ["bad"]), "day": ("SELECT current_date() AS d", []),
            "typo": ("SELECT missing FROM visits", ["visits"])}
    for _ in range(2):
        out = refresh_changed(spark, sheets(spark, [(1, 0)]), kpis, str(tmp_path))
        assert "DIVIDE_BY_ZERO" in out["bad"].error and "bad" in out["after"].error and out["typo"].error and out["day"].computed and not out["day"].error
    fixed = refresh_changed(spark, sheets(spark, [(1, 2)]), kpis, str(tmp_path))
    assert fixed["bad"].error is None and fixed["after"].df.first().n == 1

"""The workbook: sheets, refresh order, errors, views, status, merge, save / load."""

from pyspark.sql import functions as F

from kpiloom.plans.workbook import Workbook
from kpiloom.session import scratch_path


def test_workbook_end_to_end(spark):
    wb = Workbook(spark)
    assert list(wb.sheets) == ["scheme"]
    wb.add_table("inspections", spark.range(30).select(
        F.concat(F.lit("cj"), (F.col("id") % 3).cast("string")).alias("inspection_by"),
        (F.col("id") % 5).alias("rating")))
    wb.add_sql("Good Ratings", "SELECT * FROM inspections WHERE rating >= 4")
    wb.add_kpi("bonus", "SELECT inspection_by, COUNT(*) * 100 AS bonus FROM good_ratings GROUP BY 1")
    wb.add_kpi("payout", "SELECT inspection_by, SUM(bonus) * 2 AS payout FROM bonus GROUP BY 1", deps=["bonus"])
    wb.add_kpi("broken", "SELECT nope FROM inspections")
    try:
        wb.add_sql("good ratings", "SELECT 1")
        raise AssertionError("duplicate name accepted")
    except ValueError:
        pass
    status = {r.name: r.status for r in wb.refresh().collect()}
    assert status == {"scheme": "success", "inspections": "success", "Good Ratings": "success",
                      "bonus": "success", "payout": "success", "broken": "failed"}
    counts = {r.type: (r.total, r.success, r.failed) for r in wb.status_counts().collect()}
    assert counts["kpi"] == (3, 2, 1) and counts[None] == (5, 4, 1)
    assert wb.view("inspections", search="CJ1", size=4, order=["rating", "inspection_by"]).count() == 4
    merged = {r.cj_id: r.total_incentive for r in wb.merge().collect()}
    assert merged == {"cj0": 600.0, "cj1": 600.0, "cj2": 600.0}    # bonus 200 + payout 400 each

    root = scratch_path(spark, "wb")
    wb.add_sql("never run", "SELECT 1 AS x")
    wb.save(root, "w")
    back = Workbook.load(spark, root, "w")
    assert list(back.sheets)[0] == "scheme"
    assert back.sheets["payout"].df.count() == 3 and back.sheets["never run"].status == "pending"
    assert back.sheets["payout"].deps == ["bonus"]
    assert {r.name: r.status for r in back.refresh().collect()}["payout"] == "success"


def test_workbook_infers_kpi_dependencies(spark):
    wb = Workbook(spark)
    wb.add_table("facts", spark.range(10))
    wb.add_kpi("Total Pay", "SELECT SUM(pay) AS total FROM per_row")          # reads a KPI added later
    wb.add_kpi("per row", "SELECT id, id * 10 AS pay FROM facts")
    status = {r.name: r.status for r in wb.refresh().collect()}
    assert status["Total Pay"] == "success" and wb.sheets["Total Pay"].df.first().total == 450

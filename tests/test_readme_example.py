"""The README usage example, run on small frames."""


def test_readme_usage(spark):
    from kpiloom.functions.search import search_col
    from kpiloom.operators.consolidate import consolidate, mappings_for, payout_cards
    from kpiloom.operators.joins import JoinSpec
    from kpiloom.operators.measures import Measure
    from kpiloom.operators.paging import page
    from kpiloom.plans.builder import BuildSpec, build
    from kpiloom.sources.catalog import run_kpi

    sheets = {
        "inspections": spark.createDataFrame(
            [("a1", "Alice", "done"), ("a2", "alice ", "done"), ("a3", "bob", "done"), ("a4", "bob", "open")],
            "appointment_id string, inspection_by string, inspection_status string"),
        "feedback": spark.createDataFrame([("a1", 5), ("a2", 3), ("a3", 4)], "appointment_id string, rating int"),
    }
    kpi, err = run_kpi(spark, "SELECT inspection_by, COUNT(*) * 150 AS incentive FROM inspections GROUP BY 1", sheets)
    assert err is None
    daily = build(BuildSpec("inspections", joins=[JoinSpec("feedback", "appointment_id", "appointment_id")],
                            group_by=["inspection_by"], where="inspection_status = 'done'",
                            measures=[Measure(kind="slab", alias="slab_pay", column="rating",
                                              slabs=[(4, None, 100)], else_value=50)]),
                  sheets)
    merged = consolidate(mappings_for(kpi, "sp_pro") + mappings_for(daily, "rating", "inspection_by", ["slab_pay"]))
    got = {r.cj_id: (r.sp_pro, r.rating, r.total_incentive) for r in merged.collect()}
    assert got == {"alice": (300.0, 150.0, 450.0), "bob": (300.0, 100.0, 400.0)}
    assert payout_cards(merged).first().top_earner == "alice"
    assert page(merged, [merged.total_incentive.desc(), merged.cj_id], 1).count() == 2
    assert search_col(merged, "cj_id", "ali").count() == 1

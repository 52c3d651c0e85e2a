"""Operators on hand-made rows: merge, latest row, joins, paging, dashboard, HTML, filters."""

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import dashboard as D
from kpiloom.operators.consolidate import consolidate, mappings_for, payout_cards, presum, row_total
from kpiloom.operators.filters import between_days, rename, rolling_days, union_positional
from kpiloom.operators.joins import JoinSpec, join_on, slab_join, star_join
from kpiloom.operators.latest import latest_per_key
from kpiloom.operators.measures import Measure, measure_column
from kpiloom.operators.paging import page, page_after, page_count, with_position
from kpiloom.plans.builder import BuildSpec, build
from kpiloom.sources.html import read_html_table


def test_consolidate_edges(spark):
    kpi_a = spark.createDataFrame(
        [(" Alice ", "1,000"), ("alice", "10"), ("BOB", "12d"), (None, "5"), ("carol", " 12 ")],
        "inspection_by string, incentive string")
    kpi_b = spark.createDataFrame([("bob", 2.5), ("dave", 1e3), ("dave", None)],
                                  "email string, bonus double")
    empty = spark.createDataFrame([], "inspector string, payout double")
    maps = mappings_for(kpi_a, "a") + mappings_for(kpi_b, "b") + mappings_for(empty, "c")
    assert [(m.key_col, m.val_col) for m in maps] == [("inspection_by", "incentive"), ("email", "bonus"),
                                                       ("inspector", "payout")]
    rows = consolidate(maps).collect()
    got = {r.cj_id: (r.a, r.b, r.c, r.total_incentive) for r in rows}
    assert got == {"alice": (10.0, 0.0, 0.0, 10.0), "bob": (0.0, 2.5, 0.0, 2.5), "nan": (5.0, 0.0, 0.0, 5.0),
                   "carol": (12.0, 0.0, 0.0, 12.0), "dave": (0.0, 1000.0, 0.0, 1000.0)}
    assert [r.cj_id for r in rows] == ["dave", "carol", "alice", "nan", "bob"]     # total desc


def test_consolidate_labels(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0)], "inspector string, bonus double, payout double")
    maps = mappings_for(df, "kpi")
    assert [m.label for m in maps] == ["kpi__bonus", "kpi__payout"]
    with pytest.raises(ValueError):
        consolidate(mappings_for(df, "same", val_cols=["bonus"]) + mappings_for(df, "same", val_cols=["payout"]))
    assert mappings_for(spark.createDataFrame([("k", "v")], "a string, b string"), "p")[0].val_col == "b"


def test_presum_row_total_and_cards(spark):
    df = spark.createDataFrame([("a", 1.1), ("A ", 2.2), ("b", 3.3)], "k string, v double")
    assert sorted(presum(df, "k", "v").collect()) == [("a", 3.3), ("b", 3.3)]
    t = row_total(spark.createDataFrame([(1.1, "2.2", None)], "x double, y string, z double"), ["x", "y", "z"])
    assert t.first().total == 3.3
    merged = spark.createDataFrame([("b", 10.0), ("a", 10.0), ("c", -3.9)], "cj_id string, total_incentive double")
    c = payout_cards(merged).first()
    assert (c.total_people, c.total_payout, c.avg_payout, c.top_earner) == (3, 16, 5, "a")
    empty = payout_cards(merged.where("false")).first()
    assert (empty.total_people, empty.total_payout, empty.avg_payout, empty.top_earner) == (0, 0, None, "—")


def test_latest_per_key_keeps_ties_and_skips_null_ratings(spark):
    fb = spark.createDataFrame([
        ("a1", 5, "2024-01-02"), ("a1", 4, "2024-01-02"), ("a1", 3, "2024-01-01"),
        ("a2", None, "2024-02-01"), ("a2", 2, "2024-01-15"),
    ], "appointment_id string, rating int, created string").withColumn("created", F.to_timestamp("created"))
    out = latest_per_key(fb, "appointment_id", "created", where=F.col("rating").isNotNull())
    assert sorted((r.appointment_id, r.rating) for r in out.collect()) == [("a1", 4), ("a1", 5), ("a2", 2)]
    one = latest_per_key(fb, "appointment_id", "created", keep_ties=False, where=F.col("rating").isNotNull())
    assert one.columns == fb.columns
    assert sorted((r.appointment_id, r.rating) for r in one.collect()) == [("a1", 5), ("a2", 2)]


def test_joins_using_on_and_star(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "k long, a string")
    right = spark.createDataFrame([(2, "r2"), (3, "r3")], "k long, b string")
    full = join_on(left, right, "k", "k", "FULL OUTER JOIN")
    assert full.columns == ["k", "a", "b"] and full.count() == 3
    other = right.withColumnRenamed("k", "rk")
    on = join_on(left, other, "k", "rk", "inner")
    assert on.columns == ["k", "a", "rk", "b"] and on.count() == 1
    with pytest.raises(ValueError):
        join_on(left, right, "k", "k", "cross")
    star = star_join(left, "base", [JoinSpec("r", "k", "k", "left"), JoinSpec("s", None, "k")], {"r": right})
    assert star.count() == 2


def test_slab_join_open_ends_gaps_and_else(spark):
    vals = spark.createDataFrame([(0.5,), (1.0,), (2000.0,), (2000.5,), (2001.0,), (99999.0,)], "v double")
    slabs = spark.createDataFrame([(1, 2000, 500.0), (2001, 5000, 1000.0), (9000, None, 9.0)],
                                  "lo long, hi long, amount double")
    got = [r.amount for r in slab_join(vals, "v", slabs, else_value=-1.0).orderBy("v").collect()]
    assert got == [-1.0, 500.0, 500.0, -1.0, 1000.0, 9.0]


def test_measures_and_builder(spark):
    with pytest.raises(ValueError):
        measure_column(Measure(func="SUM", column="*"))
    assert measure_column(Measure(kind="slab", column="x", slabs=[{"value": 1}])) is None
    t = {"t": spark.createDataFrame([("a", 1.0), ("a", 5.0), ("b", None)], "g string, x double")}
    out = build(BuildSpec("t", group_by=["g"], measures=[
        Measure(alias="n"), Measure(alias="nx", column="x"), Measure(alias="d", func="count distinct", column="x"),
        Measure(kind="slab", alias="s", column="x", slabs=[(None, 2, 10), (3, None, 20)], else_value=0),
        Measure(kind="flat", alias="f", column="x", per_unit=7)]), t)
    got = {r.g: (r.n, r.nx, r.d, r.s, r.f) for r in out.collect()}
    assert got == {"a": (2, 2, 2, 30, 14.0), "b": (1, 0, 0, 0, 0.0)}
    assert build(BuildSpec("t", group_by=["g"]), t).count() == 2
    assert build(BuildSpec("t", measures=[Measure(alias="n")]), t).first().n == 3
    assert build(BuildSpec("t"), t).count() == 3
    with pytest.raises(ValueError):
        build(BuildSpec(None), t)


def test_paging_positions_match_brute_force(spark):
    df = spark.range(0, 2345).select((F.col("id") * 7919 % 2345).alias("k"), (F.col("id") % 13).alias("g"))
    order = [F.col("g").desc(), F.col("k").asc()]
    pos = {r.k: r.position for r in with_position(df.repartition(7), order).collect()}
    brute = sorted(df.collect(), key=lambda r: (-r.g, r.k))
    assert all(pos[r.k] == i + 1 for i, r in enumerate(brute))
    p3 = [r.k for r in page(df, order, 3, 500).collect()]
    assert p3 == [r.k for r in brute[1000:1500]]
    assert page_count(0) == 1 and page_count(500) == 1 and page_count(501) == 2
    last = brute[499]
    seek = [r.k for r in page_after(df, ["g", "k"], (last.g, last.k), 500, descending=[True, False]).collect()]
    assert seek == [r.k for r in brute[500:1000]]


def test_deep_page_uses_positions(spark):
    import kpiloom.operators.paging as P
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    assert [r.k for r in P.page(df, [F.col("k")], 3, 20, by_position=True).collect()] == list(range(40, 60))


def test_dashboard_fixture(spark):
    facts = spark.createDataFrame([
        ("Jan'26", "GOOGLE", 10, 100), ("Jan'26", "", 1, 8), ("Feb'26", "GOOGLE", 5, 50),
        ("Feb'26", "DSA", 0, 0), ("Feb'26", None, 2, 10)], "month string, channel string, si long, insp long")
    t = D.totals(facts).first()
    assert (t.total_si, t.total_insp, t.si_ratio, t.channel_count) == (18, 168, "10.7%", 3)
    assert D.totals(D.filter_facets(facts, channel="Unknown")).first().total_si == 3
    assert D.totals(D.filter_facets(facts, month="Feb'26", channel="DSA")).first().si_ratio == "0%"
    assert [tuple(r) for r in D.by_channel(facts).collect()] == [("GOOGLE", 15, 150), ("Unknown", 3, 18),
                                                                 ("DSA", 0, 0)]
    detail = {(r.month, r.channel): r.si_pct for r in D.detail(facts).collect()}
    assert detail[("Jan'26", "Unknown")] == "12.5%" and detail[("Feb'26", "DSA")] == "0%"


def test_html_table_reader(spark):
    docs = spark.createDataFrame([
        (1, "<p>x</p><TABLE border=1><tr><th>Query Name</th><th>SQL Query</th></tr>"
            "<tr><td>a &amp; b</td><td><b>SELECT 1</b></td></tr></TABLE><table><tr><td>ignored</td></tr></table>"),
        (2, "<table><tr><th>sql query</th><th>query name</th></tr><tr><td>q2</td><td>n2</td></tr>"
            "<tr><td>q3</td><td>n3</td></tr></table>"),
        (3, "no table here")], "doc long, html string")
    rows = read_html_table(docs, "html", ["query_name", "sql_query", "sheet_name"], keep=["doc"])
    got = sorted((r.doc, r.row_no, r.query_name, r.sql_query, r.sheet_name) for r in rows.collect())
    assert got == [(1, 0, "a & b", "SELECT 1", None), (2, 0, "n2", "q2", None), (2, 1, "n3", "q3", None)]


def test_filters(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-31 23:59:59",), ("2024-02-01 00:00:00",)],
                               "ts string").select(F.to_timestamp_ntz("ts").alias("ts"))
    assert between_days(df, "ts", "2024-01-01", "2024-01-31").count() == 2
    assert rolling_days(df, "ts", 1).count() == 2
    assert rolling_days(df, "ts", 0, anchor="2024-01-31").count() == 2
    with pytest.raises(ValueError):
        rename(df.withColumn("x", F.lit(1)), {"x": "ts"})
    with pytest.raises(ValueError):
        rename(df, {"ts": " "})
    assert rename(df, {"ts": "ts"}).columns == ["ts"]
    with pytest.raises(ValueError):
        union_positional(df, df.withColumn("x", F.lit(1)))


def test_slab_join_by_group_with_open_ends(spark):
    vals = spark.range(0, 3000).select((F.col("id") * 7 % 1001 - 50).cast("double").alias("v"),
                                       (F.col("id") % 2).alias("g"))
    rows = [(g, i * 10 + g, i * 10 + 7 + g, float(i * 100 + g)) for g in (0, 1) for i in range(90)]
    rows += [(0, None, -40, -1.0), (1, 905, None, -2.0)]          # open ends
    slabs = spark.createDataFrame(rows, "g long, lo long, hi long, amount double")
    def amount(v, g):
        hit = [a for h, lo, hi, a in rows if h == g and (lo is None or v >= lo) and (hi is None or v <= hi)]
        return hit[0] if hit else 0.0

    got = slab_join(vals, "v", slabs, on=[("g", "g")], else_value=0.0).collect()
    assert len(got) == 3000 and all(r.amount == amount(r.v, r.g) for r in got)


def test_bucketed_slab_join_drops_out_of_range_slabs(spark):
    vals = spark.createDataFrame([(5.0,), (15.0,), (None,)], "v double")
    slabs = spark.createDataFrame([(0, 10, 1.0), (11, 20, 2.0), (100, 200, 3.0), (-50, -10, 4.0)],
                                  "lo long, hi long, amount double")
    got = sorted(slab_join(vals, "v", slabs).collect(), key=lambda r: (r.v is None, r.v))
    assert [(r.v, r.amount) for r in got] == [(5.0, 1.0), (15.0, 2.0), (None, 0)]


def test_consolidate_integer_keys_fast_path(spark):
    a = spark.createDataFrame([(1, 2.0), (None, 3.0), (10, 1.0)], "k long, v double")
    b = spark.createDataFrame([(1, 5.0), (2, 7.0)], "k int, v double")
    got = {r.cj_id: r.total_incentive for r in consolidate(mappings_for(a, "a", "k", ["v"]) +
                                                           mappings_for(b, "b", "k", ["v"])).collect()}
    assert got == {"1": 7.0, "nan": 3.0, "10": 1.0, "2": 7.0}
    mixed = spark.createDataFrame([(" 1 ", 1.0)], "k string, v double")
    got = {r.cj_id: r.total_incentive for r in consolidate(mappings_for(a, "a", "k", ["v"]) +
                                                           mappings_for(mixed, "m", "k", ["v"])).collect()}
    assert got["1"] == 3.0


def test_net_payout_signs_and_tips(spark):
    from kpiloom.operators.consolidate import net_payout
    inc = spark.createDataFrame([("a", 100.0), ("b", 50.0)], "k string, v double")
    pen = spark.createDataFrame([("a", "30"), ("c", "5")], "k string, v string")
    tip = spark.createDataFrame([("b", 12.5)], "k string, v double")
    out = net_payout(mappings_for(inc, "inc", "k", ["v"]), penalties=mappings_for(pen, "pen", "k", ["v"]),
                     tips=mappings_for(tip, "tips", "k", ["v"]))
    got = {r.cj_id: (r.inc, r.tips, r.pen, r.net_payout) for r in out.collect()}
    assert got == {"a": (100.0, 0.0, -30.0, 70.0), "b": (50.0, 12.5, 0.0, 62.5), "c": (0.0, 0.0, -5.0, -5.0)}


def test_distinct_measures(spark):
    t = {"t": spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") % 100).alias("x"))}
    out = build(BuildSpec("t", group_by=["g"], measures=[
        Measure(alias="exact", func="COUNT DISTINCT", column="x"),
        Measure(alias="approx", func="APPROX_COUNT_DISTINCT", column="x")]), t)
    for r in out.collect():
        assert r.exact == 100 and abs(r.approx - 100) <= 10


def test_slab_rows_stay_few_with_many_groups(spark):
    rows = [(g, i * 10, None if i == 4 else i * 10 + 9, float(i)) for g in range(200) for i in range(5)]
    slabs = spark.createDataFrame(rows, "g long, lo long, hi long, amount double")
    vals = spark.createDataFrame([(g, float(v)) for g in (0, 7, 199, 500) for v in (-1, 0, 9, 10, 10**9)] + [(None, 1.0), (3, None)], "g long, v double")
    got = {(r.g, r.v): r.amount for r in slab_join(vals, "v", slabs, on=[("g", "g")], else_value=-1.0).collect()}
    assert [got[7, v] for v in (-1.0, 0.0, 9.0, 10.0, 1e9)] == [-1.0, 0.0, 0.0, 1.0, 4.0]
    assert got[500, 0.0] == got[None, 1.0] == got[3, None] == -1.0


def test_join_on_of_a_table_with_itself(spark):
    t = spark.createDataFrame([(1, 2), (2, 3)], "a int, b int")
    assert [tuple(r) for r in join_on(t, t, "a", "b", "inner").collect()] == [(2, 3, 1, 2)]


@pytest.mark.parametrize("how,want", [("RIGHT JOIN", {1: 10, 3: 7, 4: 8}), ("FULL JOIN", {1: 10, 2: None, 3: 7, 4: 8})])
def test_builder_groups_by_the_merged_using_key(spark, how, want):
    base = spark.createDataFrame([(1, "x"), (2, "y")], "k int, `Store Type` string")
    right = spark.createDataFrame([(1, 10, "r"), (3, 7, "r"), (4, 8, "r")], "k int, v int, `Store Type` string")
    spec = BuildSpec("base", joins=[JoinSpec("r", "k", "k", how)], group_by=["k"],
                     measures=[Measure(alias="s", func="SUM", column="v"), Measure(alias="n", column="Store Type"),
                               Measure(alias="m", column="r.Store Type")])
    got = {r.k: r for r in build(spec, {"base": base, "r": right}).collect()}
    assert {k: r.s for k, r in got.items()} == want
    assert got[3].n == 0 and got[3].m == 1 and got[1].n == got[1].m == 1       # a bare name is the base's column


def test_full_merge_of_unequal_keys(spark):
    from kpiloom.operators.joins import full_merge
    a = spark.createDataFrame([(1, "x"), (2, None), (None, "n")], "k long, a string")
    b = spark.createDataFrame([(2, 2.5), (3, 3.5), (None, 0.5)], "k long, b double")
    c = spark.createDataFrame([(4, True)], "k long, c boolean")
    got = {r.k: (r.a, r.b, r.c) for r in full_merge([a, b, c], "k").collect()}
    assert got == {1: ("x", None, None), 2: (None, 2.5, None), 3: (None, 3.5, None), 4: (None, None, True), None: ("n", 0.5, None)}
    assert full_merge([a.limit(0), b.limit(0)], "k").count() == 0
    with pytest.raises(ValueError):
        full_merge([a, a], "k")
    with pytest.raises(Exception, match="repeats a key"):
        full_merge([a.unionByName(a), b], "k").collect()


def test_join_nway_full_keeps_every_person(spark, tmp_path):
    """Persons of one table only, of two and of all, whatever their amounts, status or segment; a null person is a bucket."""
    from kpiloom.workloads.core import q_consolidate, q_join_nway_full
    tables = {
        "orders": ([(1, 10, 100.25, "O"), (2, 10, 0.5, "F"), (3, 20, 7.0, "P"), (4, None, 3.0, "F")],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string"),
        "events": ([(10, 0.1), (10, 0.2), (30, 95.0), (None, 1.0)], "user_id long, value double"),
        "lineitem": ([(1, 50.0, 0.1), (1, 10.0, 0.0), (3, 2.0, 0.5), (9, 9.0, 0.0)], "l_orderkey long, l_extendedprice double, l_discount double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = [tuple(r) for r in q_join_nway_full(spark, str(tmp_path)).collect()]
    assert got == [("10", 100.75, 0.3, 55.0, 156.05), ("30", 0.0, 95.0, 0.0, 95.0), ("20", 7.0, 0.0, 1.0, 8.0), ("nan", 3.0, 1.0, 0.0, 4.0)]
    assert got == [tuple(r) for r in q_consolidate(spark, str(tmp_path)).collect()]

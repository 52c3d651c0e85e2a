"""Property tests: Spark operators against small pure-Python statements of the
same rules, on generated inputs (one Spark job per generated batch)."""

import math
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from kpiloom.functions import scalars as S
from kpiloom.operators.consolidate import consolidate, mappings_for
from kpiloom.functions.scalars import case_tier
from kpiloom.operators.joins import slab_join

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

NUM = re.compile(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$", re.ASCII)


def py_coerce(text):
    if text is None or not NUM.match(text):
        return 0.0
    v = float(text.strip())
    return 0.0 if math.isinf(v) or math.isnan(v) else v


def py_key(text):
    return "nan" if text is None else re.sub(r"^[ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+$", "", text).lower()


number_text = st.one_of(
    st.none(), st.just(""), st.sampled_from(["1,000", "12d", " 12 ", "1e3", "-.5", "+7.", "abc", "1e400", "NaN"]),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(repr),
    st.integers(-10**6, 10**6).map(lambda i: f" {i}\t"))


@SETTINGS
@given(st.lists(number_text, min_size=1, max_size=40))
def test_num_coerce_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], StructType([StructField("x", StringType())]))
    got = [r[0] for r in df.select(S.num_coerce("x")).collect()]
    assert got == [py_coerce(v) for v in values]


key_text = st.one_of(st.none(), st.text(alphabet="aAbB \t\n", max_size=6))


@SETTINGS
@given(st.lists(key_text, min_size=1, max_size=40))
def test_key_norm_matches_python(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], StructType([StructField("x", StringType())]))
    assert [r[0] for r in df.select(S.key_norm("x")).collect()] == [py_key(k) for k in keys]


bound = st.one_of(st.none(), st.integers(-50, 50))


@SETTINGS
@given(st.lists(st.tuples(bound, bound, st.integers(0, 9)), max_size=6),
       st.lists(st.floats(-60, 60, allow_nan=False), min_size=1, max_size=30))
def test_case_tier_first_match(spark, tiers, xs):
    df = spark.createDataFrame([(x,) for x in xs], StructType([StructField("x", DoubleType())]))
    expr = S.case_tier("x", tiers, -1)

    def py(x):
        for lo, hi, v in tiers:
            if lo is None and hi is None:
                continue
            if (lo is None or x >= lo) and (hi is None or x <= hi):
                return v
        return -1
    if expr is None:
        assert all(lo is None and hi is None for lo, hi, _ in tiers)
        return
    assert [r[0] for r in df.select(expr).collect()] == [py(x) for x in xs]


money_text = st.one_of(
    st.none(), st.just(""), st.sampled_from(["1,000", "12d", " 12 ", "1e3", "-.5", "+7.", "abc", "NaN"]),
    st.floats(-1e9, 1e9, allow_nan=False).map(repr), st.integers(-10**6, 10**6).map(str))
rows = st.lists(st.tuples(key_text, money_text), max_size=25)


@SETTINGS
@given(rows, rows)
def test_consolidate_matches_python_merge(spark, a_rows, b_rows):
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])
    a, b = spark.createDataFrame(a_rows, schema), spark.createDataFrame(b_rows, schema)
    out = consolidate(mappings_for(a, "a", "k", ["v"]) + mappings_for(b, "b", "k", ["v"]))
    got = {r.cj_id: (r.a, r.b, r.total_incentive) for r in out.collect()}
    want = {}
    for label, data in (("a", a_rows), ("b", b_rows)):
        for k, v in data:
            entry = want.setdefault(py_key(k), {"a": 0, "b": 0})
            entry[label] += round(py_coerce(v) * 10**9)            # exact units, as the merge sums
    assert set(got) == set(want)
    for k, e in want.items():
        assert got[k][0] == pytest.approx(e["a"] / 10**9, rel=1e-12, abs=2e-9) and got[k][1] == pytest.approx(e["b"] / 10**9, rel=1e-12, abs=2e-9)
        assert got[k][2] == pytest.approx((e["a"] + e["b"]) / 10**9, rel=1e-12, abs=2e-9)


@SETTINGS
@given(st.lists(st.integers(-100, 100), min_size=1, max_size=12, unique=True),
       st.lists(st.floats(-120, 120, allow_nan=False), min_size=1, max_size=40))
def test_slab_join_agrees_with_python(spark, cuts, xs):
    cuts = sorted(cuts)
    slabs = [(cuts[i], cuts[i + 1] - 1, float(i)) for i in range(len(cuts) - 1)] + [(cuts[-1], None, 99.0)]
    sdf = spark.createDataFrame(slabs, "lo long, hi long, amount double")
    vdf = spark.createDataFrame([(x,) for x in xs], "v double")

    def py(x):
        for lo, hi, amt in slabs:
            if x >= lo and (hi is None or x <= hi):
                return amt
        return -1.0
    want = sorted((x, py(x)) for x in xs)
    assert sorted((r.v, r.amount) for r in slab_join(vdf, "v", sdf, else_value=-1.0).collect()) == want


def _first_slab(slabs, x):
    for lo, hi, v in slabs:
        if x is not None and (lo is None or x >= lo) and (hi is None or x <= hi):
            return v
    return -1.0


def test_first_of_overlapping_slabs_wins(spark):
    """Overlapping, nested, open, empty and repeated slabs in 120 random sheets: one row a value, the first slab in the sheet's order."""
    rng = random.Random(20)
    end = lambda: rng.choice([None, *range(-6, 7)])
    sheets = {f"g{g}": [(end(), end(), float(rng.randint(1, 4))) for _ in range(rng.randint(1, 9))] for g in range(120)}
    slabs = [(i, g, *s) for g, sheet in sheets.items() for i, s in enumerate(sheet)]
    rng.shuffle(slabs)
    values = [(g, x / 2) for g in sheets for x in range(-15, 16)] + [("g1", None), (None, 1.0), ("none", 1.0)]
    sdf = spark.createDataFrame(slabs + [(0, None, 0, 1, 9.0)], "place int, g string, lo long, hi long, amount double")
    got = slab_join(spark.createDataFrame(values, "g string, v double"), "v", sdf, else_value=-1.0, on=[("g", "g")], order="place").collect()
    assert sorted(map(str, got)) == sorted(f"Row(g={g!r}, v={x!r}, amount={_first_slab(sheets.get(g, []), x)!r})" for g, x in values)


@pytest.mark.parametrize("sheet", [
    [(7501, 10000, 1.0), (10000, 13500, 2.0)], [(10000, 13500, 2.0), (7501, 10000, 1.0)], [(0, None, 1.0), (3, 5, 2.0)],
    [(3, 5, 2.0), (None, None, 1.0)], [(None, None, 1.0)], [(5, 3, 1.0)]])
def test_slabs_without_groups_and_as_a_case(spark, sheet):
    points = [x + d for lo, hi, _ in sheet for x in (lo, hi) if x is not None for d in (-0.5, 0, 0.5)] + [0.0]
    vdf = spark.createDataFrame([(float(x),) for x in points], "v double")
    sdf = spark.createDataFrame([(i, *s) for i, s in enumerate(sheet)], "place int, lo long, hi long, amount double")
    want = sorted((float(x), _first_slab(sheet, x)) for x in points)
    assert sorted((r.v, r.amount) for r in slab_join(vdf, "v", sdf, else_value=-1.0, order="place").collect()) == want
    tier = case_tier("v", sheet, -1.0)
    if tier is not None and (None, None, 1.0) not in sheet:
        assert sorted((r.v, r.amount) for r in vdf.withColumn("amount", tier).collect()) == want


def test_money_outside_long_units_raises(spark):
    import pytest
    df = spark.createDataFrame([("a", "1e300")], "k string, v string")
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        consolidate(mappings_for(df, "a", "k", ["v"])).collect()


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 3)),
                min_size=1, max_size=40))
def test_latest_per_key_matches_dense_rank(spark, rows):
    from kpiloom.operators.latest import latest_per_key
    data = [(i, k, t, r) for i, (k, t, r) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k long, t long, r long")
    got = sorted(r.id for r in latest_per_key(df, "k", "t", where=F.col("r") > 0).collect())
    kept = [d for d in data if d[3] > 0]
    best = {}
    for _, k, t, _ in kept:
        best[k] = max(best.get(k, -1), -1 if t is None else t)
    want = sorted(i for i, k, t, _ in kept if (-1 if t is None else t) == best[k])
    assert got == want
    one = sorted(r.id for r in latest_per_key(df, "k", "t", keep_ties=False, where=F.col("r") > 0).collect())
    top = {}
    for i, k, t, r in kept:
        t = -1 if t is None else t
        top[k] = max(top.get(k, (t, i, r)), (t, i, r))
    assert one == sorted(v[1] for v in top.values())


cell_text = st.text(alphabet="ab <>&\"'#;xyz", min_size=0, max_size=8)


@SETTINGS
@given(st.lists(st.tuples(cell_text, cell_text), min_size=1, max_size=12))
def test_html_round_trip(spark, rows):
    from kpiloom.sources.html import read_html_table, table_html
    data = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "n long, a string, b string").withColumn("doc", F.lit(1))
    docs = table_html(df, ["doc"], ["n", "a", "b"], "n")
    back = read_html_table(docs, "html", ["n", "a", "b"], keep=["doc"]).collect()
    got = sorted((int(r.n), r.a, r.b) for r in back)
    assert got == sorted((n, a.strip(), b.strip()) for n, a, b in data)      # cells are trimmed

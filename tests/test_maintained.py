"""KPIs kept from arriving batches, against a plain computation over the current rows."""

import random

import pytest

from kpiloom.operators.measures import Measure
from kpiloom.streaming.maintained import MaintainedKpi, apply_batch, compact_kpi, current_kpi

MEASURES = [Measure(func="COUNT", alias="n"), Measure(func="COUNT", column="v", alias="values"), Measure(func="SUM", column="v", alias="total"),
            Measure(func="AVG", column="v", alias="mean"), Measure(func="MIN", column="v", alias="least"), Measure(func="MAX", column="v", alias="most")]
SCHEMA = "id long, g string, v double, ver int, kind string"


def plain(batches, versions=True):
    now = {}
    for at, rows in enumerate(batches):
        for r in rows:
            if r[0] is None:
                continue
            rank = (r[3] if versions else 0, at)
            if r[0] not in now or rank > now[r[0]][0] or (rank == now[r[0]][0] and (r[4] != "x", r[1] or "", r[2] or 0) > now[r[0]][2]):
                now[r[0]] = (rank, r, (r[4] != "x", r[1] or "", r[2] or 0))
    groups = {}
    for _, r, _ in now.values():
        if r[4] != "x":
            groups.setdefault(r[1], []).append(r[2])
    out = {}
    for g, vs in groups.items():
        known = [v for v in vs if v is not None]
        out[g] = (len(vs), len(known), *((round(sum(known), 6), round(sum(known) / len(known), 6), min(known), max(known)) if known else (None,) * 4))
    return out


def found(spark, kpi, at):
    return {r.g: (r.n, r["values"], *(None if r[c] is None else round(r[c], 6) for c in ("total", "mean", "least", "most"))) for r in current_kpi(spark, kpi, at).collect()}


@pytest.mark.parametrize("versions", [True, False])
def test_batches_corrections_and_replays(spark, tmp_path, versions):
    rng = random.Random(6 + versions)
    kpi = MaintainedKpi("id", ["g"], MEASURES, where="kind <> 'x'", version="ver" if versions else None)
    batches = []
    for b in range(4):
        ids = rng.sample(range(60), 30)  # an id comes once a batch, and often again in a later one
        batches.append([(i, rng.choice(["a", "b", None, "c"]), rng.choice([None, round(rng.uniform(-9, 9), 2)]), rng.randint(0, 3), rng.choice("xyz")) for i in ids])
    batches[2].append((None, "a", 99.0, 9, "y"))
    at = str(tmp_path / "state")
    for i, rows in enumerate(batches):
        apply_batch(kpi, spark.createDataFrame(rows, SCHEMA), i, at)
        assert found(spark, kpi, at) == plain(batches[:i + 1], versions)
        if i == 1:
            assert compact_kpi(spark, kpi, at) == 1
            assert found(spark, kpi, at) == plain(batches[:2], versions)
    apply_batch(kpi, spark.createDataFrame(batches[3], SCHEMA), 3, at)      # run again after a failure
    assert found(spark, kpi, at) == plain(batches, versions)
    assert compact_kpi(spark, kpi, at) == 3 and compact_kpi(spark, kpi, at) == 3
    assert found(spark, kpi, at) == plain(batches, versions)


def test_a_corrected_extreme_and_an_emptied_group(spark, tmp_path):
    kpi = MaintainedKpi("id", ["g"], MEASURES, version="ver")
    at = str(tmp_path / "state")
    apply_batch(kpi, spark.createDataFrame([(1, "a", 5.0, 0, "y"), (2, "a", 9.0, 0, "y"), (3, "b", 1.0, 0, "y")], SCHEMA), 0, at)
    apply_batch(kpi, spark.createDataFrame([(2, "a", 7.0, 1, "y"), (3, "a", 6.0, 1, "y")], SCHEMA), 1, at)
    apply_batch(kpi, spark.createDataFrame([(2, "a", 100.0, 0, "y")], SCHEMA), 2, at)  # late: an older version
    assert found(spark, kpi, at) == {"a": (3, 3, 18.0, 6.0, 5.0, 7.0)}


def test_only_measures_with_a_state(spark, tmp_path):
    with pytest.raises(ValueError, match="COUNT_DISTINCT"):
        MaintainedKpi("id", ["g"], [Measure(func="COUNT_DISTINCT", column="v")])
    with pytest.raises(ValueError, match="no batch"):
        current_kpi(spark, MaintainedKpi("id", ["g"], MEASURES), str(tmp_path / "nothing"))

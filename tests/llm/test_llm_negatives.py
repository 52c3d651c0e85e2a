"""Hard negatives against a plain loop over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import hard_negatives
from kpiloom.llm.hard_negatives import pack_planes, scores, subset_sums

SF = "/root/testdata/sf0.01"
def plain(rows):
    """rows: (vec_id, embedding, label)."""
    ok = []
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((i, [math.floor(256 * float(x)) for x in v], (y + 1) % 10 if i % 7 == 0 else y))
    out = []
    for i, v, y in ok:
        if i % 50:
            continue
        ranked = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in ok if j != i)
        for s, p, _ in [r for r in ranked if r[2] == y][:5]:
            s = -s
            near = [r for r in ranked if r[2] != y and 50 * s <= -100 * r[0] <= 95 * s][:3]
            out += [(i, p, k + 1, j, s, -t) for k, (t, j, _) in enumerate(near)]
    return sorted(out)


def mined(df, **sizes):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 50 == 0, label, **sizes).collect())


def test_scores_are_inner_products():
    rng = np.random.default_rng(3)
    for width, top in ((8, 1), (16, 127), (64, 160), (24, 9000)):
        a, c = rng.integers(-top - 1, top + 1, (5, width)), rng.integers(-top - 1, top + 1, (40, width))
        planes = int(top).bit_length() + 1
        got = scores(subset_sums(a, np.int64), pack_planes(c, planes))
        assert (got.T == a @ c.T).all()


def test_query_equals_plain_loops(worker_code):
    df = worker_code.read.parquet(f"{SF}/embeddings.parquet")
    want = plain([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert want and mined(df) == want
    assert mined(df, candidate_rows=37, anchor_rows=3) == want


def test_query_equals_its_sql(worker_code, duck):
    from kpiloom.llm.queries import QUERIES
    fn, sql = QUERIES["op11_hard_negatives"]
    from fixture_paths import SF_SMALL
    df = fn(worker_code, SF_SMALL)
    rel = duck.sql(sql)
    assert df.columns == rel.columns
    assert sorted(tuple(r) for r in df.collect()) == sorted(rel.fetchall())


def test_ties_repeats_nulls_and_odd_vectors(worker_code):
    rng = random.Random(11)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(5)], rng.randrange(3)) for i in range(160)]
    rows += [(200, [0.0] * 5, 1), (250, [], 1), (300, [0.5] * 9, 0), (301, [0.5] * 9, 1), (302, [0.25], 1), (-50, [1.0] * 5, 0)]
    bad = [(None, [1.0] * 5, 1), (350, None, 1), (351, [1.0] * 5, None), (400, [1.0, None], 1), (401, [float("nan")], 1), (402, [float("inf")], 0)]
    df = worker_code.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").withColumn("block", F.lit("x")).withColumn("q", F.lit(1))
    want = plain(rows)
    assert want and mined(df, candidate_rows=32, anchor_rows=2) == want
    # a repeated row is one more candidate, at the same id
    again = rows + [rows[7]] * 2
    assert mined(worker_code.createDataFrame(again, "vec_id long, embedding array<float>, label int")) == plain(again)
    assert mined(df.limit(0)) == []


def test_too_large_components_are_refused(worker_code):
    df = worker_code.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="62 bits"):
        mined(df)


def test_pairs_of_blocks_are_not_broadcast(worker_code):
    """The files of a few anchors are small; their copies for all candidate blocks are not."""
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)], rng.randrange(2)) for i in range(300)]
    df = worker_code.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, F.col("label"), candidate_rows=20, anchor_rows=2)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()

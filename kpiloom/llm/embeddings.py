"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are scaled to unit length and rotated into their principal axes, the
axis of largest variance first.  Rotation keeps every product, and puts as much
of it as possible into the leading dimensions.  Sorted along the first axis the
vectors are cut into blocks of ``block_rows``; two vectors with cosine of at
least t are at most sqrt(2 - 2t) apart on every axis, so a block is compared
only with the blocks within that reach.  A pair of blocks is one task: products
over the leading quarter of the dimensions plus the product of the suffix norms
bound the cosine from above; pairs whose bound falls short of the threshold
stop there, the others go on to the half and then to the whole.

Equal vectors collapse before comparing.  A task gives, per vector, the number
of its links and one link to its group's first vector in the task, so a dense
group never becomes a table of all its pairs.

Rows: one per vector.  Vectors that are null, empty, zero, or hold null or
non-finite components link with nothing, not even with each other; vectors of
different lengths never link.  Rows that repeat an id count as vectors of their
own in n_links; rows without an id are left out.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import stored
from kpiloom.llm.components import components

BLOCK_ROWS = 8192
TILE = 1024


def usable(v):
    """Neither null nor empty, every component a finite number, and not all of them zero."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Columns: the axes by falling variance.  Partial products are summed by Spark; width squared numbers reach the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for b in batches:
            x = _matrix(b["v"], width)
            total += x.T @ x
        i, j = np.indices((width, width))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "s": total.ravel()})

    sums = vectors.select("v").mapInPandas(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    cov = np.zeros((width, width))
    cov[sums["i"], sums["j"]] = sums["s"]
    return np.linalg.eigh((cov + cov.T) / 2)[1][:, ::-1]


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Unit vectors; shorter ones are filled up with zeros."""
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of a[i] and b[i]; label[x] is the smallest index of x's group."""
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def compare(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with x[i] . y[j] >= threshold, a tile of rows at a time; with same only i < j."""
    width = x.shape[1]
    steps = sorted({max(1, width // 4), max(1, width // 2), width})
    first = steps[0]
    norm = lambda m, k: np.sqrt((m[:, k:] ** 2).sum(1))
    lead_y = np.hstack([y[:, :first], norm(y, first)[:, None]]).astype(np.float32).T
    for at in range(0, len(x), TILE):
        part = x[at:at + TILE]
        bound = np.hstack([part[:, :first], norm(part, first)[:, None]]).astype(np.float32) @ lead_y
        i, j = np.nonzero(bound >= threshold - 1e-4)  # the slack covers single precision
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for lo in range(0, len(i), 1 << 20):  # bounds the gathered rows
            p, q = i[lo:lo + (1 << 20)], j[lo:lo + (1 << 20)]
            dot = np.einsum("ij,ij->i", x[p, :first], y[q, :first])
            for k, nxt in zip(steps, steps[1:]):
                dot += np.einsum("ij,ij->i", x[p, k:nxt], y[q, k:nxt])
                ok = dot + (norm(x[p], nxt) * norm(y[q], nxt) if nxt < width else 0) >= threshold - (1e-12 if nxt < width else 0)
                p, q, dot = p[ok], q[ok], dot[ok]
            if len(steps) == 1:
                ok = dot >= threshold
                p, q = p[ok], q[ok]
            yield p, q


def near_vectors(vecs: DataFrame, threshold: float = 0.9, key: str = "vec_id", vector: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(key, n_links, component_id, kept)."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vecs.select(F.col(f"`{key}`").alias("id"), v.alias("v")).where("id is not null")
    digest = F.when(usable(F.col("v")), F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), F.col("v")).alias("b")))
    rows = rows.withColumn("h", digest)
    keys = stored(rows.select("id", "h"), "vector-keys")
    good = rows.where("h is not null")
    reps = keys.where("h is not null").groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    # one row per digest, with a number of its own: two vectors can share their smallest id
    distinct = good.join(reps, "h").where("id = rep").dropDuplicates(["h"]).select("h", F.col("rep").alias("least"), "copies", "v")
    distinct = stored(distinct.withColumn("rep", F.monotonically_increasing_id()), "distinct-vectors")
    width = distinct.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return keys.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    axes = vecs.sparkSession.sparkContext.broadcast(principal_axes(distinct, width))

    def rotate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _matrix(b["v"], width) @ axes.value
            yield pd.DataFrame({"rep": b["rep"], "copies": b["copies"], "dim": b["v"].map(len).astype("int32"), "pc": x[:, 0], "x": list(x)})

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, part = 0, TaskContext.get().partitionId()
        for b in batches:
            yield b.assign(part=part, row=np.arange(at, at + len(b)))
            at += len(b)

    schema = "rep long, copies long, dim int, pc double, x array<double>"
    turned = distinct.select("rep", "copies", "v").mapInPandas(rotate, schema).repartitionByRange("dim", "pc", "rep").sortWithinPartitions("dim", "pc", "rep")
    turned = stored(turned.mapInPandas(number, f"{schema}, part int, row long"), "turned-vectors")
    # the position in the whole order, from the row counts of the partitions
    counts = {r.part: r.n for r in turned.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in sorted(counts):
        before.append((p, total))
        total += counts[p]
    spark = vecs.sparkSession
    blocks = turned.join(F.broadcast(spark.createDataFrame(before, "part int, before long")), "part").withColumn(
        "block", F.expr(f"cast((before + row) div {block_rows} as int)")).drop("part", "row", "before")
    ends = sorted(blocks.groupBy("block").agg(F.min("dim"), F.max("dim"), F.min("pc"), F.max("pc")).collect())
    reach, last = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9, []
    for b in ends:
        j = b[0]
        while j + 1 < len(ends) and ends[j + 1][1] <= b[2] and not (
                b[1] == b[2] == ends[j + 1][1] == ends[j + 1][2] and ends[j + 1][3] - b[4] > reach):
            j += 1
        last.append(j)
    span = [(b, next(i for i in range(b + 1) if last[i] >= b), last[b]) for b in range(len(ends))]
    spans = spark.createDataFrame(span, "block int, lo int, hi int")
    sent = blocks.join(spans, "block").withColumn("other", F.explode(F.sequence("lo", "hi")))
    sent = sent.select(F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "rep", "copies", "dim", "x")

    def task(pair: tuple, b: pd.DataFrame) -> pd.DataFrame:
        side = (b["block"] == pair[0]).to_numpy()
        same = pair[0] == pair[1]
        ids, copies, dims = b["rep"].to_numpy(), b["copies"].to_numpy(), b["dim"].to_numpy()
        x = np.stack(b["x"].to_numpy()) if len(b) else np.zeros((0, width))
        left = np.arange(len(b)) if same else np.nonzero(side)[0]
        right = left if same else np.nonzero(~side)[0]
        n, label = np.zeros(len(b), np.int64), np.arange(len(b))
        for i, j in compare(x[left], x[right], threshold, same):
            a, c = left[i], right[j]
            ok = dims[a] == dims[c]
            a, c = a[ok], c[ok]
            np.add.at(n, a, copies[c])
            np.add.at(n, c, copies[a])
            _merge(label, a, c)
        has = n > 0
        return pd.DataFrame({"rep": ids[has], "first": ids[label[has]], "n": n[has]})

    found = stored(sent.groupBy("p", "q").applyInPandas(task, "rep long, first long, n long"), "vector-links")
    groups = stored(components(found, "rep", "first").withColumnRenamed("node", "rep"), "vector-groups")
    own = distinct.select("h", "rep", "least", "copies")
    smallest = own.join(groups, "rep").groupBy("component").agg(F.min("least").alias("component_id"))
    n = found.groupBy("rep").agg(F.sum("n").alias("n"))
    named = own.join(n, "rep", "left").join(groups, "rep", "left").join(smallest, "component", "left").select(
        "h", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    out = keys.join(named, "h", "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(key) == F.col("component_id"))

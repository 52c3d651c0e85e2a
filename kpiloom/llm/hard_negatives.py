"""Hard negatives by Four-Russians scoring.

A row's score for an anchor is the inner product of their components, each
taken as the integer floor(scale * x).  The components of a candidate are held
as bit planes: plane b of eight neighbouring dimensions is one byte.  For each
group of eight dimensions an anchor gets a table of its 256 subset sums, so a
byte of a plane selects the sum of the anchor's components at the byte's set
bits.  Adding the selected sums of all groups gives a plane's share; doubling
the total before each lower plane puts the planes together (the top plane of
two's complement counts negatively).  The scores are whole and exact.

Candidates lie in blocks of about ``candidate_rows`` rows, anchors in blocks of
``anchor_rows``, all in files; a task reads some blocks of both sides and pairs
them, so no side is sent to the driver or copied to a shuffle for its pairs, the
work spreads over the cluster, nothing depends on how often an id, a label or a
vector occurs, and a lost executor costs the pairs it held.
Anchors are a stated query set against all rows, in blocks.  Two passes: the
first finds each anchor's positives (its first rows of the same label), the
second the first different-label rows within each positive's limits.  A task
keeps a few rows per anchor and block; Spark ranks what is left.

Rows with a null id or label, a null vector or any null or non-finite component
take no part.  Shorter vectors are filled up with zeros (an empty one scores 0).
Repeated rows rank as rows of their own, but rows that share the anchor's id are
neither its positives nor its negatives; an anchor row that repeats gives its
results once per row.  Other columns are ignored.  An empty table gives no
rows.  Components so large that a score could pass 62 bits raise ValueError.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import stored

SCALE = 256
CANDIDATE_ROWS, ANCHOR_ROWS = 4096, 1024
TILE = 64  # anchors whose tables are held at once
NONE = np.iinfo(np.int64).min


def usable_rows(vecs: DataFrame, scale: int, key: str, vector: str, label: Column) -> DataFrame:
    """(id, label, q array<double>): rows that take part, components as whole numbers."""
    rows = vecs.select(F.col(f"`{key}`").cast("long").alias("id"), label.cast("long").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & whole)
    # floor() of a double is a long in SQL and would saturate; the product minus its fraction stays a double
    return rows.select("id", "label", F.transform("v", lambda x: F.rint(x * scale) - F.when(F.rint(x * scale) > x * scale, 1.0).otherwise(0.0)).alias("q"))


def pack_planes(c: np.ndarray, planes: int) -> np.ndarray:
    """(planes, groups, rows) bytes; bit j of a byte is dimension 8 * group + j."""
    bits = (c[None] >> np.arange(planes)[:, None, None]) & 1
    return np.ascontiguousarray(np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").transpose(0, 2, 1))


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """(groups, 256, anchors): for each byte the sum of the anchors' components at its set bits."""
    n, width = anchors.shape
    out = np.zeros((width // 8, 256, n), dtype)
    for j in range(8):
        out[:, 1 << j:2 << j] = out[:, :1 << j] + anchors[:, j::8].T[:, None, :]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors) exact inner products from subset-sum tables and packed planes."""
    top = len(planes) - 1
    rows, n = planes.shape[2], tables.shape[2]
    total, found = np.zeros((rows, n), tables.dtype), np.empty((rows, n), tables.dtype)
    for b in range(top, -1, -1):
        if b < top:
            total <<= 1
        for table, bytes_ in zip(tables, planes[b]):
            np.take(table, bytes_, axis=0, out=found, mode="clip")
            if b == top:
                total -= found
            else:
                total += found
    return total


def _blocks(rows: DataFrame, per_block: int, width: int, planes: int | None, name: str) -> DataFrame:
    """Rows dealt evenly to blocks, one per partition, whatever their ids: (block, n, ids, labels, data), sorted by id inside.

    data: bit planes with planes, else the whole numbers."""
    n = max(1, math.ceil(rows.count() / per_block))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches if len(b)]
        if got:
            b = pd.concat(got).sort_values(["id", "label"], kind="stable")
            c = np.zeros((len(b), width), np.int64)
            for i, v in enumerate(b["q"]):
                c[i, :len(v)] = v
            data = pack_planes(c, planes) if planes else c
            yield pd.DataFrame({"block": [TaskContext.get().partitionId()], "n": [len(b)], "ids": [b["id"].to_numpy(np.int64).tobytes()],
                                "labels": [b["label"].to_numpy(np.int64).tobytes()], "data": [data.tobytes()]})

    made = rows.repartition(n).mapInPandas(run, "block int, n int, ids binary, labels binary, data binary")
    return stored(made, name)


def _pairs(anchors: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row per pair of an anchor block and a candidate block: never a broadcast, however small the files of a side are."""
    a = anchors.withColumnsRenamed({c: f"a_{c}" for c in anchors.columns})
    return candidates.crossJoin(a.hint("shuffle_replicate_nl"))


def _ranked_keys(r, width: int, planes: int, dtype, same: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For the anchors of a pair, tile by tile: (anchor's place, its id, its keys in rising order, the candidates' ids).

    A key holds a candidate's score and its place counted from the end of the block, so keys differ, and the larger of two
    has the higher score or, at equal scores, the smaller id.  Rows that do not count have the key NONE."""
    ids, labels = np.frombuffer(r.ids, np.int64), np.frombuffer(r.labels, np.int64)
    data = np.frombuffer(r.data, np.uint8).reshape(planes, width // 8, len(ids))
    a_ids, a_labels = np.frombuffer(r.a_ids, np.int64), np.frombuffer(r.a_labels, np.int64)
    a = np.frombuffer(r.a_data, np.int64).reshape(len(a_ids), width)
    back = np.arange(len(ids) - 1, -1, -1, dtype=np.int64)
    for lo in range(0, len(a_ids), TILE):
        got = scores(subset_sums(a[lo:lo + TILE], dtype), data).T.astype(np.int64)
        keys = got * len(ids) + back
        its, own = a_labels[lo:lo + TILE, None], a_ids[lo:lo + TILE, None]
        keys[((labels == its) if not same else (labels != its)) | (ids == own)] = NONE
        keys.sort(axis=1)
        for i in range(len(keys)):
            yield lo + i, int(a_ids[lo + i]), keys[i], ids


def mine(vecs: DataFrame, anchor: Column, label: Column, key: str = "vec_id", vector: str = "embedding", positives: int = 5, negatives: int = 3,
         least: int = 50, most: int = 95, scale: int = SCALE, candidate_rows: int = CANDIDATE_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    anchor: condition on the columns of vecs that marks anchors; label: the label to use.  For each anchor and each of its first
    ``positives`` rows of its label: the first ``negatives`` rows of another label with least * positive_score <= 100 *
    negative_score <= most * positive_score, in the order of falling score, then rising id."""
    flagged = usable_rows(vecs, scale, key, vector, label)
    rows = stored(flagged, "whole-vectors")
    anchors = usable_rows(vecs.where(F.coalesce(anchor, F.lit(False))), scale, key, vector, label)
    most_dims, largest = rows.agg(F.max(F.size("q")), F.max(F.expr("aggregate(q, 0D, (m, x) -> greatest(m, abs(x)))"))).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if most_dims is None:
        return vecs.sparkSession.createDataFrame([], schema)
    width = max(8, -(-most_dims // 8) * 8)
    # a key is a score times the rows of its block
    if width * (largest + 1) ** 2 * 100 * 4 * candidate_rows >= 2 ** 62:
        raise ValueError(f"components of up to {largest / scale:g} in {most_dims} dimensions: scores could pass 62 bits")
    planes = max(2, int(largest).bit_length() + 1)
    dtype = np.int32 if 2 * width * (largest + 1) ** 2 < 2 ** 31 else np.int64
    c = _blocks(rows, candidate_rows, width, planes, "candidate-blocks")
    a = _blocks(anchors, anchor_rows, width, None, "anchor-blocks")

    def first_positives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                at, ids_, sums = [], [], []
                for i, _, keys, ids in _ranked_keys(r, width, planes, dtype, True):
                    best = keys[-positives:]
                    best = best[best != NONE]
                    at += [i] * len(best)
                    ids_.append(ids[len(ids) - 1 - best % len(ids)])
                    sums.append(best // len(ids))
                if at:
                    yield pd.DataFrame({"a_block": r.a_block, "at": at, "id": np.concatenate(ids_), "score": np.concatenate(sums)})

    near = _pairs(a, c).mapInPandas(first_positives, "a_block int, at int, id long, score long")
    place = F.row_number().over(Window.partitionBy("a_block", "at").orderBy(F.desc("score"), "id"))
    near = near.withColumn("place", place).where(F.col("place") <= positives)
    # at most anchor_rows * positives entries to a block
    lists = near.groupBy("a_block").agg(F.collect_list(F.struct("at", "place", "id", "score")).alias("near"))
    # merged: whole numbers take far less room in a file than in a broadcast
    a = stored(a.join(lists.hint("merge"), a.block == lists.a_block).drop("a_block"), "anchor-positives")

    def first_negatives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                wanted: dict[int, list] = {}
                for p in r.a_near:
                    wanted.setdefault(p["at"], []).append(p)
                out = []
                for i, own, keys, ids in _ranked_keys(r, width, planes, dtype, False):
                    n = len(ids)
                    for p in wanted.get(i, ()):
                        s = int(p["score"])
                        low, high = -(-least * s // 100), most * s // 100
                        lo, hi = np.searchsorted(keys, [low * n, (high + 1) * n]) if low <= high else (0, 0)
                        for k in keys[max(lo, hi - negatives):hi].tolist():
                            if k != NONE:
                                out.append((r.a_block, i, p["place"], own, p["id"], s, k // n, int(ids[n - 1 - k % n])))
                if out:
                    yield pd.DataFrame(out, columns=["a_block", "at", "place", "anchor_id", "positive_id", "positive_score", "negative_score", "negative_id"])

    far = _pairs(a, c).mapInPandas(
        first_negatives, "a_block int, at int, place int, anchor_id long, positive_id long, positive_score long, negative_score long, negative_id long")
    rank = F.row_number().over(Window.partitionBy("a_block", "at", "place").orderBy(F.desc("negative_score"), "negative_id"))
    return far.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms (words, and the first four letters of
longer words).  The machine scores w0 + sum of w + sum over pairs of <v, v>, so
that two terms together can say what neither says alone, such as an insult with
the mention of a group; an additive model cannot.

Fitting uses a bounded, stratified sample of the labelled rows (``SAMPLE`` of
each label, those with the smallest hashes of their ids), never rows that are
held out.  From the sample two kinds of terms are kept: the ``TERMS`` that part the
labels best by themselves (two-sample z value), and those of the ``PAIR_TERMS`` most
telling by frequency that belong to a pair whose joint effect differs from the sum of
its single ones (z value of the interaction over the four cells), however neutral each
is alone.  The others have no weight: a score then does not drift with a document's
length.  Scoring is a narrow map over all texts with a model of fixed size.

Null texts are empty and get the score of no terms; rows of labels that are
null are ignored, repeated ones used once, of texts that share an id the one of the smallest hash; without labelled rows of both
kinds every score is the share of toxic rows (0 without any).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 10_000
BITS = 20
TERMS, FACTORS = 2048, 8
#: Terms whose pairs are tried, and the least |z| of an interaction: of some two million pairs chance gives one in a hundred samples.
PAIR_TERMS, PAIR_Z, PAIR_LEAST = 2048, 6.0, 5
EPOCHS, RATE, L2 = 30, 0.1, 1e-4
MEMO = 400_000
_WORD = re.compile(r"\w+")


def terms_of(token: str) -> tuple[int, ...]:
    out = []
    for w in _WORD.findall(token.lower()):
        out.append(zlib.crc32(w.encode()) & ((1 << BITS) - 1))
        if len(w) > 5:
            out.append(zlib.crc32(b"^" + w[:4].encode()) & ((1 << BITS) - 1))
    return tuple(out)


class _Memo(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, token: str):
        if len(self) >= MEMO:
            self.clear()
        out = self.make(token)
        if len(token) <= 64:
            self[token] = out
        return out


class Model:
    def __init__(self, bias: float, index: dict[int, int], weights: np.ndarray, factors: np.ndarray):
        self.bias, self.index, self.weights, self.factors = bias, index, weights, factors

    def scorer(self):
        known = self.index
        memo = _Memo(lambda token: tuple(i for t in terms_of(token) if (i := known.get(t)) is not None))

        def score(text: str) -> float:
            found = set()
            for x in set(map(memo.__getitem__, text.split())):
                found.update(x)
            z = self.bias
            if found:
                at = np.fromiter(sorted(found), np.int64, len(found))
                v = self.factors[at]
                z += self.weights[at].sum() + 0.5 * float((v.sum(0) ** 2 - (v ** 2).sum(0)).sum())
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def paired(sample: list[tuple[int, list[int]]], seen: Counter) -> list[int]:
    """Terms of pairs with an interaction: toxic share with both, minus with one, minus with the other, plus with neither."""
    n = len(sample)
    tried = sorted((t for t, k in seen.items() if min(k, n - k) >= 2 * PAIR_LEAST), key=lambda t: (-min(seen[t], n - seen[t]), t))[:PAIR_TERMS]
    if len(tried) < 2:
        return []
    at = {t: i for i, t in enumerate(tried)}
    both = {y: np.zeros((len(tried), len(tried)), np.float32) for y in (0, 1)}  # counts below 2**24 are exact
    single = {y: np.zeros(len(tried)) for y in (0, 1)}
    number = {y: sum(1 for z, _ in sample if z == y) for y in (0, 1)}
    for y in (0, 1):
        rows = [ts for z, ts in sample if z == y]
        for i in range(0, len(rows), 512):
            x = np.zeros((min(512, len(rows) - i), len(tried)), np.float32)
            for j, ts in enumerate(rows[i:i + 512]):
                x[j, [at[t] for t in ts if t in at]] = 1
            both[y] += x.T @ x
            single[y] += x.sum(0, dtype=float)
    found = np.zeros(len(tried), bool)
    for i in range(0, len(tried), 128):  # a band of the matrix at a time, which bounds the driver's memory
        band, effect, variance, least = slice(i, i + 128), 0.0, 0.0, np.inf
        for sign, cell in ((1, lambda y: both[y][band]), (-1, lambda y: single[y][band, None] - both[y][band]),
                           (-1, lambda y: single[y][None, :] - both[y][band]),
                           (1, lambda y: number[y] - single[y][band, None] - single[y][None, :] + both[y][band])):
            toxic, clean = cell(1).astype(float), cell(0).astype(float)
            k = toxic + clean
            p = (toxic + 0.5) / (k + 1)  # never 0 or 1, so that an even cell has a variance
            effect, variance, least = effect + sign * p, variance + p * (1 - p) / (k + 1), np.minimum(least, k)
        strong = (least >= PAIR_LEAST) & (np.abs(effect) >= PAIR_Z * np.sqrt(variance))
        strong[np.arange(len(strong)), np.arange(i, i + len(strong))] = False
        found[band] = strong.any(1)
    return [t for t, is_paired in zip(tried, found) if is_paired]


def fit(sample: list[tuple[int, list[int]]]) -> Model:
    """sample: (label, distinct terms) per document."""
    n, toxic = len(sample), sum(y for y, _ in sample)
    none = Model(0.0, {}, np.zeros(0), np.zeros((0, FACTORS)))
    if not toxic or toxic == n:
        none.bias = 30.0 if toxic else -30.0
        return none
    seen, seen_toxic = Counter(), Counter()
    for y, ts in sample:
        seen.update(ts)
        if y:
            seen_toxic.update(ts)
    share = toxic / n
    z = {t: (seen_toxic[t] - k * share) / np.sqrt(k * share * (1 - share)) for t, k in seen.items() if k >= 5}
    chosen = sorted((t for t in z if abs(z[t]) >= 4), key=lambda t: (-abs(z[t]), t))[:TERMS]
    held = set(chosen)
    chosen += [t for t in paired(sample, seen) if t not in held]
    index = {t: i for i, t in enumerate(chosen)}
    rng = np.random.default_rng(7)
    w, v, bias = np.zeros(len(chosen)), rng.normal(0, 0.01, (len(chosen), FACTORS)), float(np.log(share / (1 - share)))
    gw, gv, gb = np.full_like(w, 1e-6), np.full_like(v, 1e-6), 1e-6
    rows = [(y, np.array([index[t] for t in ts if t in index], np.int64)) for y, ts in sample]
    weight = {1: 0.5 / share, 0: 0.5 / (1 - share)}
    for epoch in range(EPOCHS):
        for k in rng.permutation(n):
            y, at = rows[k]
            s = v[at].sum(0)
            p = 1 / (1 + np.exp(-np.clip(bias + w[at].sum() + 0.5 * float((s ** 2 - (v[at] ** 2).sum(0)).sum()), -30, 30)))
            g = (p - y) * weight[y]
            if abs(g) < 1e-3:
                continue
            gb += g * g
            bias -= RATE * g / np.sqrt(gb)
            if len(at):
                dw = g + L2 * w[at]
                dv = g * (s - v[at]) + L2 * v[at]
                gw[at] += dw * dw
                gv[at] += dv * dv
                w[at] -= RATE * dw / np.sqrt(gw[at])
                v[at] -= RATE * dv / np.sqrt(gv[at])
    return Model(bias, index, w, v)


def held_out(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    use = labels.select(F.col(f"`{key}`").alias(key), F.col(f"`{label}`").cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).dropDuplicates([key])
    part = [use.where(F.col("y") == y).orderBy(F.xxhash64(key), key).limit(SAMPLE) for y in (0, 1)]
    chosen = F.broadcast(part[0].unionByName(part[1]))  # 2 * SAMPLE rows at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "terms": [np.array(sorted({i for w in set(t.split()) for i in terms_of(w)}), "<i4").tobytes() for t in b["t"]]})

    rows = docs.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).join(chosen, key)
    # a key that repeats in docs counts once, so that the sample keeps its bound
    once = rows.groupBy(F.xxhash64(key).alias("h"), F.col(key).alias("k")).agg(F.first("y").alias("y"), F.min_by("t", F.struct(F.xxhash64("t"), "t")).alias("t"))
    got = once.orderBy("h", "k").select("y", "t").mapInPandas(run, "y int, terms binary").collect()
    return fit([(r.y, np.frombuffer(r.terms, "<i4").tolist()) for r in got])


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rate = sent.value.scorer()
        for b in batches:
            s = np.array([rate(t) for t in b["t"]], dtype=float)
            yield pd.DataFrame({key: b[key], "held_out": b["held_out"], "score": s, "predicted": (s >= 0.5).astype("int32")})

    src = docs.select(F.col(f"`{key}`").alias(key), F.coalesce(held_out(f"`{key}`"), F.lit(False)).alias("held_out"),
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    return src.mapInPandas(run, f"`{key}` {src.schema[key].dataType.simpleString()}, held_out boolean, score double, predicted int")

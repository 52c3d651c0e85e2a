"""Alignment of two tokenizers' tokens by lockstep merging.

Tokenizer A (byte-level BPE) encodes a blank and the text, tokenizer B
(sentence pieces, which add that blank themselves) encodes the text.  Both
token rows cover the same bytes.  A NumPy vector holds one pair of pointers
(A token, B token) per open stretch of a batch of documents; each step emits
the pairs under the pointers as links, marks a cut where both tokens end at the
same byte, advances the pointer of whichever token ends first (both at a cut),
and drops the stretches that are finished.  A long document is entered at
several places at once: at cuts found near every ``STRETCH``-th token, which no
token spans, so a batch takes about as many steps as one stretch has links.

The count of an id pair is the number of rows that hold it linked.  A first
pass writes each document's groups and its distinct pairs with their numbers of
links; Spark sums the pairs (each task counts its own first).  The counts of
the most frequent pairs, at most ``HEAD``, are broadcast; the documents' rarer
pairs, if there are more, meet theirs in a join, where no pair is frequent.

Texts that are null or empty, or that either tokenizer changes (its tokens'
bytes do not make up the blank and the text), have no tokens: zeros and an
empty digest.  Repeated rows and rows without an id count as rows of their own;
other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import library
from kpiloom.llm.common import stored, text_of
from kpiloom.llm.heads import head_limit

STRETCH, LOOK = 512, 64
CHUNK_CHARS = 1 << 21
HEAD = 1 << 19
HELD = 1 << 20  # distinct pairs a counting task holds before it passes them on
BLANK = "▁"


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(BLANK, " ").encode()


class Pair:
    """Both tokenizers, and tables of their ids' bytes, lengths and decimal forms."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.a = library.load(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        known = self.a.own.piece_bytes
        self.bytes_a = [known.get(i, b"") for i in range(max(known) + 1)]
        self.bytes_b = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        n = max(len(self.bytes_a), len(self.bytes_b))
        # the decimal form of an id with what follows it: , | ; or nothing
        self.text = np.array([f"{i}{end}".encode() for end in (",", "|", ";", "") for i in range(n)], dtype=object)
        self.n = n

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B, or None where a tokenizer does not give back the bytes."""
        if not text:
            return None
        data = b" " + text.encode()
        a, b = self.a.plain_ids(" " + text), self.b.encode(text, num_threads=1)
        if b"".join(map(self.bytes_b.__getitem__, b)) != data or b"".join(map(self.bytes_a.__getitem__, a.tolist())) != data:
            return None
        return a.astype(np.int64), np.array(b, np.int64)


@functools.lru_cache(maxsize=4)
def load(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _entries(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, last_a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pointers start: each document's first tokens, and in long ones the tokens behind a cut near every STRETCH-th."""
    more = (last_a - first_a - 1) // STRETCH
    doc = np.repeat(np.arange(len(first_a)), more)
    at = first_a[doc] + STRETCH * (1 + np.arange(len(doc)) - np.repeat(np.cumsum(more) - more, more))
    i = at[:, None] + np.arange(LOOK)
    end = ends_a[np.minimum(i, len(ends_a) - 1)]
    j = np.searchsorted(ends_b, end)
    cut = (ends_b[np.minimum(j, len(ends_b) - 1)] == end) & (i + 1 < last_a[doc][:, None])
    found, k = cut.any(1), cut.argmax(1)
    rows = np.nonzero(found)[0]
    a = np.unique(np.concatenate([first_a, i[rows, k[rows]] + 1]))
    # a start in B is the token after the one that ends where A's token before it ends
    before = np.where(a > 0, ends_a[np.maximum(a - 1, 0)], 0)
    return a, np.searchsorted(ends_b, before, side="right")


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (index in A, index in B) in order, and whether both tokens of a link end at the same byte.

    The token rows of all documents lie one behind the other, ends counted through; first_a and first_b: the documents' starts."""
    a, b = _entries(ends_a, ends_b, first_a, first_b, np.append(first_a[1:], len(ends_a)))
    stop = np.append(a[1:], len(ends_a))
    # each step moves a + b by one or two, and stretches do not share tokens: the sum names a link's slot
    slots = len(ends_a) + len(ends_b)
    link_a, cuts = np.full(slots, -1, np.int64), np.zeros(slots, bool)
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        slot = a + b
        link_a[slot] = a
        cuts[slot] = end_a == end_b
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    slot = np.nonzero(link_a >= 0)[0]
    link_a = link_a[slot]
    return link_a, slot - link_a, cuts[slot]


def align(pair: Pair, docs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[dict, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """For documents with tokens: their numbers, their groups' digests, and (document, pair code, links) sorted by both."""
    n_a, n_b = (np.array([len(d[k]) for d in docs]) for k in (0, 1))
    ids_a, ids_b = (np.concatenate([d[k] for d in docs]) for k in (0, 1))
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    link_a, link_b, cut = lockstep(np.cumsum(pair.len_a[ids_a]), np.cumsum(pair.len_b[ids_b]), first_a, first_b)
    starts = np.searchsorted(link_a, first_a)
    n_links = np.diff(np.append(starts, len(link_a)))
    n_groups = np.add.reduceat(cut.astype(np.int64), starts)
    group = np.cumsum(cut) - cut
    group_a, group_b = np.empty(len(ids_a), np.int64), np.empty(len(ids_b), np.int64)
    group_a[link_a], group_b[link_b] = group, group
    # a group's A tokens, then its B tokens; what follows an id: 0 a comma, 1 a bar, 2 a semicolon, 3 nothing
    sizes_a, sizes_b = np.bincount(group_a), np.bincount(group_b)
    place_a = np.arange(len(ids_a)) + (np.cumsum(sizes_b) - sizes_b)[group_a]
    place_b = np.arange(len(ids_b)) + np.cumsum(sizes_a)[group_b]
    after_a, after_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    after_a[np.cumsum(sizes_a) - 1] = 1
    after_b[np.cumsum(sizes_b) - 1] = 2
    after_b[first_b + n_b - 1] = 3
    text = np.empty(len(ids_a) + len(ids_b), dtype=object)
    text[place_a], text[place_b] = pair.text[ids_a + pair.n * after_a], pair.text[ids_b + pair.n * after_b]
    text, ends = text.tolist(), np.cumsum(n_a + n_b).tolist()
    shas = [hashlib.sha256(b"".join(text[lo:hi])).hexdigest() for lo, hi in zip([0, *ends], ends)]
    width = len(pair.bytes_a) * len(pair.bytes_b)
    key = np.repeat(np.arange(len(docs)), n_links) * width + ids_a[link_a] * len(pair.bytes_b) + ids_b[link_b]
    key, links = np.unique(key, return_counts=True)
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links}, shas, key // width, key % width, links


def _chunks(texts: pd.Series) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_CHARS:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    yield lo, len(texts)


def links(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, key, n_a, n_b, n_groups, n_links, groups_sha256, codes, times): codes are the distinct linked pairs, a * (ids of B) + b,
    as sorted little-endian 64-bit integers, times their links as 32-bit ones."""
    columns = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair, row = load(path_a, path_b), TaskContext.get().partitionId() << 33
        for b in batches:
            for lo, hi in _chunks(b[text]) if len(b) else ():
                part = b.iloc[lo:hi]
                both = [pair.encode(t) for t in part[text]]
                held = [i for i, x in enumerate(both) if x]
                out = pd.DataFrame({"row": np.arange(row, row + len(part)), key: part[key].to_numpy(), **{c: np.zeros(len(part), np.int64) for c in columns}})
                shas, codes, times = [""] * len(part), [b""] * len(part), [b""] * len(part)
                if held:
                    numbers, found, doc, code, n = align(pair, [both[i] for i in held])
                    for c in columns:
                        out.loc[held, c] = numbers[c]
                    cuts = np.searchsorted(doc, np.arange(len(held) + 1))
                    code, n = code.astype("<i8"), n.astype("<i4")
                    for k, i in enumerate(held):
                        shas[i] = found[k]
                        codes[i], times[i] = code[cuts[k]:cuts[k + 1]].tobytes(), n[cuts[k]:cuts[k + 1]].tobytes()
                row += len(part)
                yield out.assign(groups_sha256=shas, codes=codes, times=times)

    src = text_of(docs, key, text)
    schema = f"row long, `{key}` {src.schema[key].dataType.simpleString()}, " + "".join(f"{c} long, " for c in columns)
    return src.mapInPandas(run, schema + "groups_sha256 string, codes binary, times binary")


def pair_counts(found: DataFrame, n_b: int) -> DataFrame:
    """(code, n, best): in how many rows each pair is linked, and whether no pair of its A id is in more."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            c, k = np.unique(np.frombuffer(b"".join(b["codes"]), "<i8"), return_counts=True)
            codes, at = np.unique(np.concatenate([codes, c]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([n, k]), minlength=len(codes)).astype(np.int64)
            if len(codes) > HELD:
                yield pd.DataFrame({"code": codes, "n": n})
                codes, n = codes[:0], n[:0]
        yield pd.DataFrame({"code": codes, "n": n})

    summed = found.select("codes").mapInPandas(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    a = F.expr(f"code div {n_b}")
    most = summed.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return summed.withColumn("a", a).join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of docs."""
    spark = docs.sparkSession
    found = stored(links(docs, path_a, path_b, key, text), "token-links", "zstd")
    counts = stored(pair_counts(found, len(load(path_a, path_b).bytes_b)), "pair-counts")
    least = head_limit(counts, head)
    common = counts.where(F.col("n") >= least) if least is not None else counts.limit(0)
    common = common.sort("code").toPandas()
    sent = spark.sparkContext.broadcast(tuple(common[c].to_numpy() for c in ("code", "n", "best")))

    def look_up(b: pd.DataFrame):
        """Per row: its codes, times, their places in the head and whether they are there."""
        code, n, best = sent.value
        codes, times = np.frombuffer(b"".join(b["codes"]), "<i8"), np.frombuffer(b"".join(b["times"]), "<i4").astype(np.int64)
        row = np.repeat(np.arange(len(b)), [len(x) // 8 for x in b["codes"]])
        at = np.minimum(np.searchsorted(code, codes), max(0, len(code) - 1))
        return row, codes, times, at, (code[at] == codes) if len(code) else np.zeros(len(codes), bool)

    def total_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, n, best = sent.value
        for b in batches:
            row, _, times, at, there = look_up(b)
            row, times, at = row[there], times[there], at[there]
            sums = [np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)]
            if len(at):
                np.add.at(sums[0], row, times * best[at])
                np.add.at(sums[1], row, times * n[at])
            yield b.drop(columns=["codes", "times"]).assign(n_best=sums[0], count_sum=sums[1])

    def rare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            row, codes, times, _, there = look_up(b)
            yield pd.DataFrame({"row": b["row"].to_numpy()[row[~there]], "code": codes[~there], "times": times[~there]})

    result = [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = found.drop("codes", "times").schema.add("n_best", "long").add("count_sum", "long")
    out = found.mapInPandas(total_up, schema)
    others = counts.where(F.col("n") < least) if least is not None else counts
    if others.isEmpty():
        return out.select(*[f"`{c}`" for c in result])
    extra = found.select("row", "codes", "times").mapInPandas(rare, "row long, code long, times long").join(others, "code").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_count"))
    out = out.join(extra, "row", "left")
    return out.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn(
        "count_sum", F.col("count_sum") + F.coalesce("more_count", F.lit(0))).select(*[f"`{c}`" for c in result])

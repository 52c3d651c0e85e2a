"""Packing documents into sequences, in their order, by dynamic programming.

The token stream of one input partition (its documents in order, each closed by
the end id) may be cut anywhere.  Cuts after a document are free, cuts after a
sentence cost a little, cuts elsewhere cost more; padding costs one per token.
With g(j) = cost up to cut j plus the position of j, the cost of ending a
sequence at i is min g(j) over the cuts within ``size`` tokens before i, plus
size - position of i + penalty of i: a sliding-window minimum, kept by a
monotone queue, so that the work is linear in the number of cuts.

Each partition packs its own documents, so nothing is shuffled and only its
last sequence can be short; a sequence id is the partition's number times 2^33
plus the sequence's number there.  A partition is worked off in blocks of
``BLOCK`` tokens: all sequences of a block but the last are given out, and the
last one's tokens start the next block.  That bounds memory at every size and
costs at most the difference of one cut per block.

Null or empty texts are the end id alone; documents longer than a sequence are
cut as often as needed; repeated rows are packed as often as they occur; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from kpiloom.llm import library
from kpiloom.llm.common import text_of

SIZE = 2048
END = 1
BLOCK = 1 << 19
#: Costs in tokens of padding: of a cut after a sentence, and of one inside a sentence.
AT_SENTENCE, INSIDE = 8, 48


def choose_cuts(at: list[int], penalty: list[float], size: int, final: bool = True) -> list[int]:
    """Ends of the sequences of the cheapest packing.  at: cut positions, increasing, from 0 to the stream's end, no two
    neighbours more than size apart; penalty: the cost of each as an end (that of the last is not counted).  If more
    tokens follow (not final) the last sequence will be filled up by them, so its padding is not counted either."""
    n = len(at)
    best, back = [0.0] * n, [0] * n
    queue, value = deque([0]), [0.0] * n  # value: best cost + position
    last = n - 1
    for i in range(1, n):
        while at[i] - at[queue[0]] > size:
            queue.popleft()
        j = queue[0]
        best[i] = value[j] + size - at[i] + (penalty[i] if i < last else 0)
        back[i] = j
        value[i] = v = best[i] + at[i]
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(i)
    if last and not final:
        back[last] = min((j for j in range(last) if at[last] - at[j] <= size), key=lambda j: best[j])
    ends, i = [], last
    while i:
        ends.append(at[i])
        i = back[i]
    return ends[::-1]


class _Stream:
    """Tokens not yet given out, as documents in order."""

    def __init__(self, size: int, first: int):
        self.size, self.next = size, first
        self.docs: list[list] = []  # [key, ids as bytes, start in the document, its tokens, boundaries relative to the kept ids]
        self.held = 0

    def add(self, key, ids: bytes, sentence_ends: np.ndarray) -> None:
        n = len(ids) // 4
        self.docs.append([key, ids, 0, n, sentence_ends])
        self.held += n

    def give(self, final: bool) -> list[tuple]:
        """Pieces of all sequences but the last, or of all."""
        if not self.held:
            return []
        size, base = self.size, 0
        at, cost = [np.zeros(1, np.int64)], [np.zeros(1)]
        for _, _, start, n, ends in self.docs:
            left = n - start
            own = ends[ends > start] - start
            own = own[own < left]
            at += [base + own, np.array([base + left])]
            cost += [np.full(len(own), float(AT_SENTENCE)), np.zeros(1)]
            base += left
        # cuts inside sentences: a grid from each stretch without a cheaper cut, so that a full sequence is always possible
        marks, costs = np.concatenate(at), np.concatenate(cost)
        grid = np.arange(size // 32, base, size // 32)
        grid = grid[~np.isin(grid, marks)]
        marks, costs = np.concatenate([marks, grid]), np.concatenate([costs, np.full(len(grid), float(INSIDE))])
        order = np.argsort(marks, kind="stable")
        ends = choose_cuts(marks[order].tolist(), costs[order].tolist(), size, final)
        return self._cut(ends if final else ends[:-1])

    def _cut(self, ends: list[int]) -> list[tuple]:
        out, done, k = [], 0, 0  # done: tokens given out of all; k: first document with tokens left
        for end in ends:
            offset = 0
            while done < end:
                key, ids, start, n, _ = doc = self.docs[k]
                take = min(n - start, end - done)
                out.append((key, start, take, zlib.crc32(ids[4 * start:4 * (start + take)]), n, self.next, offset))
                offset += take
                done += take
                doc[2] = start + take
                k += doc[2] == n
            self.next += 1
        del self.docs[:k]
        self.held -= done
        return out


def pack(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, end = library.load(path), int(end_id).to_bytes(4, "little")
        stream = _Stream(size, TaskContext.get().partitionId() << 33)

        def rows(final: bool) -> pd.DataFrame:
            cut = stream.give(final)
            return pd.DataFrame({n: pd.Series(list(c), dtype="object" if n == key else "int64") for n, c in zip(names, zip(*cut))}
                                if cut else {n: pd.Series([], dtype="object" if n == key else "int64") for n in names})

        for b in batches:
            for k, t in zip(b[key].tolist(), b[text]):
                ids = coder.ids(t)
                stream.add(None if pd.isna(k) else k, ids.tobytes() + end, np.nonzero(coder.ends_sentence[ids])[0] + 1)
                if stream.held >= BLOCK:
                    yield rows(False)
        yield rows(True)

    src = text_of(docs, key, text)
    kind = src.schema[key].dataType.simpleString()
    return src.mapInPandas(run, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

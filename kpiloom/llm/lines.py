"""Line deduplication by an exact set-similarity join.

A line is the set of its words (A-Z lower-cased).  Two lines match if the
Jaccard similarity of their sets is at least ``threshold``; a line that matches
an earlier one (by document id, then line number) is removed.

1.  Words are ordered by rarity: corpus counts over 2^``BITS`` hash buckets, a
    table of fixed size that is sent to all executors as the buckets' ranks; the
    word's 64-bit hash orders a bucket.  Any fixed order gives right results, a
    rare-first order few candidates.  A word that occurs once in the whole corpus
    (its bucket counts 1) is shared by no two lines and has no index row.
2.  Lines with equal sets (by a 128-bit digest) collapse to the earliest; all
    others of them go.
3.  Of a set of n words, the rarest n - ceil(t n) + 1 are indexed: two sets
    that match share one of them.  A set so small that one more word is too many
    (n < t (n + 1)) matches none but its equals and is not indexed.  Rows of a word are compared with earlier
    rows of that word by length, position and a 128-bit image of the set
    (whose differing bits bound the overlap from above), and each line gives
    its nearest candidates per word, so a group of thousands of like lines gives
    few candidates per line and word, not all its pairs.
4.  Candidates are verified on the lines themselves, per word the nearest
    first, the others for lines whose nearest ones do not hold.  Lines that are
    still open get their next ones, sixteen times as many each round and only under
    the words that have more, until one holds or none is left, so nothing is
    missed.

Lines of fewer than ``least_words`` words stay as they are, and so do empty
lines.  A null text stays null.  Rows that share an id, or have none, are told
apart by ``row``, a digest of the text, and come in its order; only rows that are
equal in both are one document's, and a line goes from all of them or none.  Null
ids come last.  An empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import counted, free_name, stored

THRESHOLD = 0.8
LEAST_WORDS = 3
#: What op6_line_dedup and the pipeline take instead: every line that has a word.
EVERY_LINE = 1
BITS = 20
SLOT = 4096
#: Bytes of lines that are made sets, and of words that are hashed, at a time.
CHUNK, PIECE = 1 << 20, 1 << 16
LONG_WORD = 4096
BLANKS = b" \t\n\x0b\x0c\r"
BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Candidates per line and word of the first round; later rounds take sixteen times as many each, until none is left.
FIRST_ROUND = 8
#: Index rows that meet at a time, times the candidates that each may give.
GATHERED = 1 << 20
LAST = (1 << 63) - 1
#: What names a line and, of a pair, the earlier one.
LINE, EARLIER = ("doc", "row", "line"), ("e_doc", "e_row", "e_line")


def _weights() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(6)
    values, places = (rng.integers(0, 1 << 64, n, np.uint64) for n in (256, LONG_WORD))
    values[list(BLANKS)] = 0
    return values, places


VALUES, PLACES = _weights()
INSIDE = bytes(int(x not in BLANKS) for x in range(256))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word of the (lower-cased) bytes, and the number of its line.

    A word's hash is the sum over its bytes of (number of the byte) * (number of its place), mixed: whole arrays at a time.
    Words above LONG_WORD bytes take their XXH64."""
    found, lines, lo, before = [], [], 0, 0
    while lo < len(data):
        cut = BLANK.search(data, lo + PIECE) if lo + PIECE < len(data) else None  # pieces end behind a blank
        piece = data[lo:cut.end() if cut else len(data)]
        lo += len(piece)
        a = np.frombuffer(piece, np.uint8)
        inside = np.frombuffer(b"\0" + piece.translate(INSIDE) + b"\0", np.uint8)
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        breaks = np.flatnonzero(a == 10)
        if len(start):
            place = np.arange(len(a)) - np.repeat(np.append(0, start), np.diff(start, prepend=0, append=len(a)))
            total = VALUES.take(a)
            total *= PLACES.take(place, mode="clip")
            np.cumsum(total, out=total)  # sums wrap, and so do their differences
            h = total[end - 1]
            h[1:] -= h[:-1].copy()
            h ^= h >> np.uint64(32)
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            for i in np.flatnonzero(end - start > LONG_WORD):
                h[i] = xxhash.xxh64_intdigest(piece[start[i]:end[i]])
            found.append(h)
            lines.append(before + np.searchsorted(breaks, start))
        before += len(breaks)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(lines)


def _joined(texts: Iterator[str]) -> Iterator[tuple[bytes, int]]:
    """Lower-cased texts (A-Z), joined by line breaks to a bounded size (or one text), and how many they are."""
    own, size = [], 0
    for t in texts:
        own.append(t.encode().lower())
        size += len(own[-1]) + 1
        if size >= CHUNK:
            yield b"\n".join(own), len(own)
            own, size = [], 0
    if own:
        yield b"\n".join(own), len(own)


def _row_key(docs: DataFrame, key: str, text: str) -> tuple[Column, Column]:
    """(doc, row) of each row: doc stands for the id, the largest long for a null; row is the text's digest, or 0 where the ids do without."""
    own, digest = F.col(f"`{key}`").cast("long"), F.xxhash64(F.col(f"`{text}`"))
    repeated = not docs.select(own.alias("doc")).where("doc is not null").groupBy("doc").count().where("count > 1").isEmpty()
    return F.coalesce(own, F.lit(LAST)), digest if repeated else F.when(own.isNull(), digest).otherwise(F.lit(0).cast("long"))


def _keyed(docs: DataFrame, text: str, keys: tuple[Column, Column]) -> DataFrame:
    """(doc, row, text) of the documents that have a text."""
    return docs.select(keys[0].alias("doc"), keys[1].alias("row"), F.col(f"`{text}`").alias("text")).where("text is not null")


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return _keyed(docs, text, _row_key(docs, key, text))


def word_counts(texts: DataFrame) -> np.ndarray:
    """Occurrences by hash bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, words, mask = np.zeros(1 << BITS, np.uint32), 0, np.uint64((1 << BITS) - 1)

        def out() -> pd.DataFrame:
            return pd.DataFrame({"slot": np.arange(len(total) // SLOT), "counts": [x.tobytes() for x in total.reshape(-1, SLOT)]})

        for b in batches:
            for data, _ in _joined(b["text"]):
                at = (word_hashes(data)[0] & mask).astype(np.int64)
                if words + len(at) >= 1 << 32:  # the counts leave before they could overflow
                    yield out()
                    total, words = np.zeros(1 << BITS, np.uint32), 0
                words += len(at)
                np.add.at(total, at, np.uint32(1))
        if words:
            yield out()

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for slot, c in zip(b["slot"], b["counts"]):
                sums[slot] = sums.get(slot, 0) + np.frombuffer(c, np.uint32).astype(np.int64)
        yield pd.DataFrame({"slot": pd.Series(list(sums), dtype="int64"), "counts": [x.tobytes() for x in sums.values()]})

    parts = texts.select("text").mapInPandas(run, "slot long, counts binary").repartition("slot")
    out = np.zeros(1 << BITS, np.int64)
    for r in parts.mapInPandas(summed, "slot long, counts binary").collect():  # 2^BITS numbers of 8 bytes
        out[r.slot * SLOT:(r.slot + 1) * SLOT] = np.frombuffer(r.counts, np.int64)
    return out


def ranks(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The place of each bucket when they are ordered by count, and how many of them hold one word occurrence or none."""
    place = np.empty(len(counts), np.uint32)
    place[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint32)
    return place, int((counts <= 1).sum())


def _rare_first(line: np.ndarray, rank: np.ndarray, h: np.ndarray, sizes: int) -> np.ndarray:
    """The order by line, rank and hash: one sort of a packed number, checked where its cut hashes tie."""
    low = 64 - BITS - max(1, sizes.bit_length())
    packed = (line.astype(np.uint64) << np.uint64(64 - max(1, sizes.bit_length()))) | (rank << np.uint64(low)) | (h >> np.uint64(64 - low))
    order = np.argsort(packed)
    p, o = packed[order], h[order]
    if ((p[1:] == p[:-1]) & (o[1:] != o[:-1])).any():
        return np.lexsort((h, rank, line))
    return order


def _sets(keys: list[np.ndarray], sizes: np.ndarray, h: np.ndarray, place: np.ndarray, lone: int, threshold: float) -> pa.RecordBatch:
    """Rows of ``line_sets`` for lines of the given numbers of words, none of them 0; keys: their docs, rows and numbers; h: the words' hashes."""
    line = np.repeat(np.arange(len(sizes)), sizes)
    rank = place[(h & np.uint64(len(place) - 1)).astype(np.int64)].astype(np.uint64)
    order = _rare_first(line, rank, h, len(sizes))
    h, line, rank = h[order], line[order], rank[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (line[1:] != line[:-1])] if len(h) else np.zeros(0, bool)
    h, line, rank = h[new], line[new], rank[new]
    n = np.bincount(line, minlength=len(sizes))
    start = np.cumsum(n) - n
    prefix = np.where(n >= threshold * (n + 1) - 1e-9, n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1, 0)
    alone = np.bincount(line[rank < lone], minlength=len(sizes))  # the first words of a line; they are in no other
    mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bit, one = h & np.uint64(127), np.uint64(1)
    image = [np.where((bit >> np.uint64(6)) == half, one << (bit & np.uint64(63)), np.uint64(0)) for half in (0, 1)]
    over = (lambda f, x: f.reduceat(x, start)) if len(n) else (lambda f, x: x)
    offsets = np.r_[0, np.cumsum(np.maximum(prefix - alone, 0))].astype(np.int32)
    at = np.arange(len(h)) - start[line]
    chosen = h[(at >= alone[line]) & (at < prefix[line])]
    return pa.RecordBatch.from_arrays([
        *[pa.array(x, kind) for x, kind in zip(keys, (pa.int64(), pa.int64(), pa.int32()))],
        *[pa.array(over(np.add, x).view(np.int64)) for x in (h, mixed ^ (mixed >> np.uint64(32)))], pa.array(n.astype(np.int32)),
        pa.array(alone.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(chosen.view(np.int64))),
        *[pa.array(over(np.bitwise_or, x).view(np.int64)) for x in image],
    ], names=["doc", "row", "line", "d0", "d1", "n", "alone", "prefix", "b0", "b1"])


def line_sets(texts: DataFrame, counts: np.ndarray, threshold: float, least_words: int) -> DataFrame:
    """One row per line: (doc, row, line, d0, d1, n, alone, prefix, b0, b1); d0 and d1 are a 128-bit digest of the set of words,
    alone counts the words at its start that occur nowhere else, prefix holds the indexed words after them."""
    sent = texts.sparkSession.sparkContext.broadcast(ranks(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, row = (b.column(c).to_numpy() for c in ("doc", "row"))
            done = 0
            for data, many in _joined(b.column("text").to_pylist()):
                texts_lines = 1 + np.fromiter((t.count("\n") for t in b.column("text").slice(done, many).to_pylist()), np.int64, many)
                h, line = word_hashes(data)
                sizes = np.bincount(line, minlength=texts_lines.sum())
                use = np.flatnonzero(sizes >= max(1, least_words))
                if len(use):
                    own = np.repeat(np.arange(done, done + many), texts_lines)
                    number = np.arange(len(sizes)) - np.repeat(np.cumsum(texts_lines) - texts_lines, texts_lines)
                    keys = [doc[own[use]], row[own[use]], number[use]]
                    yield _sets(keys, sizes[use], h[sizes[line] >= max(1, least_words)], *sent.value, threshold)
                done += many

    return texts.mapInArrow(run, "doc long, row long, line int, d0 long, d1 long, n int, alone int, prefix array<long>, b0 long, b1 long")


def _index(sets: DataFrame) -> DataFrame:
    rows = sets.select("doc", "row", "line", "n", "alone", "b0", "b1", F.posexplode("prefix").alias("i", "word"))
    return rows.select("doc", "row", "line", "n", "b0", "b1", (F.col("alone") + F.col("i")).alias("at"), "word")


def _least_overlap(n, m, threshold: float):
    return np.ceil(threshold / (1 + threshold) * (n + m) - 1e-9)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64)).astype(np.int64)


def _whole_words(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[dict[str, np.ndarray]]:
    """The columns of rows ordered by word, from batch to batch: ``least`` rows or more at a time (fewer at the end), no word in two of them.

    A word that goes on over many batches is put together once, at its end."""
    def columns(held: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
        rows = pa.Table.from_batches(held)
        return {c: rows.column(c).to_numpy() for c in rows.column_names}

    held, rows = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        word = b.column("word").to_numpy()
        if rows >= least and word[0] != word[-1]:  # the last word may go on in the next batch
            cut = int(np.flatnonzero(word != word[-1])[-1]) + 1
            yield columns([*held[:-1], b.slice(0, cut)])
            held, rows = [b.slice(cut)], b.num_rows - cut
    if held:
        yield columns(held)


def _by_line(a: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The columns of rows ordered by word, with each word's rows ordered by line: one sort of a packed number where the ids leave room for it."""
    if len(a["word"]) < 2:
        return a
    word = np.cumsum(np.r_[False, a["word"][1:] != a["word"][:-1]])
    doc, row, line = (a[c] for c in LINE)
    low, first, last = int(line.max()).bit_length(), int(doc.min()), int(doc.max())
    high = low + (last - first).bit_length()
    if row.min() == row.max() and line.min() >= 0 and high + int(word[-1]).bit_length() <= 63:
        order = np.argsort(word << high | (doc - first) << low | line)
    else:
        order = np.lexsort((line, row, doc, word))
    return {c: x[order] for c, x in a.items()}


def _nearest(index: DataFrame, threshold: float, skip: int = 0, take: int = 1, only: DataFrame | None = None) -> DataFrame:
    """(doc, row, line, e_doc, e_row, e_line, word, place, more): per line and word its nearest earlier lines that the filters let pass,
    without the first ``skip``, ``take`` at most, the first at place 1; more: that line and word have further ones.  only: what to give them for, rows
    of (doc, line), (doc, row, line) or (doc, row, line, word)."""
    columns = ["word", "doc", "row", "line", "n", "at", "b0", "b1"]
    if only is not None:
        rows = only.count()
        if "word" in only.columns:  # first, so that only these words' rows move
            index = index.join(counted(only.select("word").distinct(), rows), "word", "left_semi")
        index = index.join(counted(only.distinct().withColumn("open", F.lit(True)), rows), only.columns, "left").withColumn("open", F.coalesce("open", F.lit(False)))
        columns.append("open")

    def meet(a: dict[str, np.ndarray]) -> pa.RecordBatch:
        total = len(a["word"])
        start = np.r_[True, a["word"][1:] != a["word"][:-1]] if total else np.zeros(0, bool)
        first = np.maximum.accumulate(np.where(start, np.arange(total), 0)) if total else np.zeros(0, np.int64)
        live = np.nonzero((np.arange(total) > first) & a.get("open", np.ones(total, bool)).astype(bool))[0]
        seen, last = np.zeros(total, np.int64), skip + take
        late, early, place, d = [], [], [], 1
        while len(live):
            other = live - d
            n, m = a["n"][live], a["n"][other]
            need = _least_overlap(n, m, threshold)
            ok = (np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9)
            ok &= 1 + np.minimum(n - a["at"][live] - 1, m - a["at"][other] - 1) >= need
            k = np.nonzero(ok)[0]
            differ = _bits(a["b0"][live[k]] ^ a["b0"][other[k]]) + _bits(a["b1"][live[k]] ^ a["b1"][other[k]])
            ok[k] = (n[k] + m[k] - differ) // 2 >= need[k]
            seen[live[ok]] += 1
            ok &= (seen[live] > skip) & (seen[live] <= last)
            late.append(live[ok])
            early.append(other[ok])
            place.append(seen[live[ok]] - skip)
            live = live[seen[live] <= last]  # one more than is given tells whether any is left
            d += 1
            live = live[live - d >= first[live]]
        i = np.concatenate(late) if late else np.zeros(0, np.int64)
        j = np.concatenate(early) if early else np.zeros(0, np.int64)
        return pa.RecordBatch.from_pydict({**{c: a[c][i] for c in LINE}, **{f"e_{c}": a[c][j] for c in LINE}, "word": a["word"][i],
                                           "place": np.concatenate(place) if place else i, "more": seen[i] > last})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(meet, map(_by_line, _whole_words(batches, max(1, GATHERED // take))))

    parts = index.select(*columns).repartition("word").sortWithinPartitions("word")  # by one number, as Spark sorts fastest
    return parts.mapInArrow(run, "doc long, row long, line int, e_doc long, e_row long, e_line int, word long, place long, more boolean")


def candidates(index: DataFrame, threshold: float, skip: int = 0, take: int = 1, only: DataFrame | None = None) -> DataFrame:
    """(doc, row, line, e_doc, e_row, e_line) of ``_nearest``, each pair once."""
    return _nearest(index, threshold, skip, take, only).select(*LINE, *EARLIER).distinct()


def _set_of(line: Column) -> Column:
    other = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    low = F.when(F.octet_length(line) == F.char_length(line), F.lower(line)).otherwise(other)  # in ASCII, lower() changes A-Z only
    return F.array_distinct(F.array_remove(F.split(low, r"[\x20\x09-\x0D]+"), ""))


def line_words(pairs: DataFrame, texts: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc, row, line, s) of the lines of the pairs, s their sets of words, alone and with ``known``: those read before, which are not read again."""
    wanted = pairs.select(*LINE).unionByName(pairs.select(*[F.col(e).alias(c) for c, e in zip(LINE, EARLIER)])).distinct()
    if known is not None:
        wanted = stored(wanted, "round-lines")  # often few: the planner, which knows their size, then moves no others
        held = known.join(counted(wanted, wanted.count()), [*LINE], "left_semi")
        wanted = wanted.join(known.select(*LINE), [*LINE], "left_anti")
    wanted = stored(wanted.groupBy("doc", "row").agg(F.collect_list("line").alias("lines")), "wanted-lines")  # the lines of one document
    if known is not None and wanted.isEmpty():
        return stored(held.hint("rebalance"), "round-words"), known
    # The first round wants lines of nearly all documents; what later ones want is often small, and the planner, which knows its size, decides.
    named = texts.join(wanted.hint("shuffle_hash") if known is None else wanted, ["doc", "row"]).withColumn("all", F.split("text", "\n"))
    named = named.select("doc", "row", F.explode("lines").alias("line"), "all").select(*LINE, _set_of(F.get("all", F.col("line"))).alias("s"))
    named = stored(named.dropDuplicates([*LINE]), "candidate-lines")
    return (named, named) if known is None else (stored(held.unionByName(named).hint("rebalance"), "round-words"), known.unionByName(named))


def verified(pairs: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """(doc, row, line) of the pairs whose lines, given by ``line_words``, have the similarity."""
    e = known.select(*[F.col(c).alias(e) for c, e in zip(LINE, EARLIER)], F.col("s").alias("t"))
    both = pairs.join(known, [*LINE]).join(e, [*EARLIER])
    common = F.size(F.array_intersect("s", "t"))  # named once: a filter computes each mention anew
    return both.where(F.lit(1 + threshold) * common >= F.lit(threshold) * (F.size("s") + F.size("t")) - 1e-9).select(*LINE).distinct()


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc, row, line, exact): the lines to remove, numbered from 0; exact: an earlier line has the same words."""
    return _removed(_texts(docs, key, text), threshold, least_words)


def _removed(texts: DataFrame, threshold: float, least_words: int) -> DataFrame:
    lines = stored(line_sets(texts, word_counts(texts), threshold, least_words), "lines")
    firsts = lines.groupBy("d0", "d1").agg(F.min(F.struct(*LINE, "n", "alone", "b0", "b1", "prefix")).alias("f"), F.count("*").alias("copies"))
    sets = stored(firsts.select("d0", "d1", "f.*", "copies"), "line-sets")
    index = _index(sets)
    near, still, known, skip, take = [], None, None, 0, FIRST_ROUND
    while True:
        found = stored(_nearest(index, threshold, skip, take, still), "line-candidates")
        words, known = line_words(found, texts, known)
        rest = found
        # At first the others only for lines whose nearest ones do not hold; what is open later has no near one that holds.
        for now in ("true",) if skip else ("place = 1", "place > 1"):
            pairs = rest.where(now).select(*LINE, *EARLIER).distinct()
            if not pairs.isEmpty():
                near.append(stored(verified(pairs, words, threshold), "near-lines"))
                rest = rest.join(counted(near[-1], near[-1].count()), [*LINE], "left_anti")
        still = stored(rest.where("more").select(*LINE, "word").distinct(), "open-lines")
        if still.isEmpty():
            break
        if not skip:  # the words of open lines only get fewer: later rounds read no others
            index = stored(index.join(counted(still.select("word").distinct(), still.count()), "word", "left_semi").hint("rebalance"), "open-index")
        skip, take = skip + take, 16 * take
    again = sets.where("copies > 1").select("d0", "d1", *[F.col(c).alias(e) for c, e in zip(LINE, EARLIER)])
    exact = lines.select("d0", "d1", *LINE).join(again, ["d0", "d1"]).where("doc != e_doc or row != e_row or line != e_line").select(*LINE, F.lit(True).alias("exact"))
    return reduce(DataFrame.unionByName, [x.select(*LINE, F.lit(False).alias("exact")) for x in near], exact).dropDuplicates([*LINE])


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines of those numbers; one pass over its lines however many go."""
    @F.pandas_udf("string")
    def cut(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        out = []
        for t, g in zip(texts, numbers):
            own = set() if g is None else set(g.tolist())
            out.append(None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in own))
        return pd.Series(out, dtype=object)

    return cut(text, gone)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, least_words: int = LEAST_WORDS,
                names: tuple[str, str] = ("n_exact", "n_near")) -> DataFrame:
    """docs with the removed lines cut out of the text, and two more columns with the lines removed: equal and near ones.

    All other columns pass through, but those of docs that have one of the two names, which are replaced."""
    keys = _row_key(docs, key, text)
    gone = _removed(_keyed(docs, text, keys), threshold, least_words).groupBy("doc", "row").agg(
        F.collect_set("line").alias("gone"), F.sum(F.col("exact").cast("long")).alias("exact"), F.sum((~F.col("exact")).cast("long")).alias("near"))
    gone = stored(gone, "removed-lines").alias("g")
    doc, row = free_name(docs, "own_doc"), free_name(docs, "own_row")
    own = docs.withColumn(doc, keys[0]).withColumn(row, keys[1]).alias("d")
    both = own.join(gone.hint("shuffle_hash"), (F.col(f"d.{doc}") == F.col("g.doc")) & (F.col(f"d.{row}") == F.col("g.row")), "left")
    mine, numbers = F.col(f"d.`{text}`"), F.col("g.gone")
    cut = F.when(numbers.isNull(), mine).otherwise(_without(F.when(numbers.isNotNull(), mine), numbers)).alias(text)
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    return both.select(*[cut if c == text else F.col(f"d.`{c}`") for c in kept], F.coalesce("g.exact", F.lit(0)).alias(names[0]),
                       F.coalesce("g.near", F.lit(0)).alias(names[1]))

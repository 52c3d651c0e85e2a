"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is the bitwise majority of the XXH64 values (seed 42) of
the text's word shingles.  To find all fingerprints within ``max_bits`` of each
other the 64 bits are cut into so few segments that one segment differs by at
most one bit (for 2 bits: two segments of 32).  Each segment is indexed once as
it is and once per position with that bit deleted (a wildcard); equal keys are
joined, and the whole fingerprints verified by their bit distance.  A deleted
position joins a fingerprint with a 0 there to one with a 1 there, so that a
pair that differs in a segment meets under one key of it, not under all.

Equal fingerprints collapse before the index is built: a group of copies of any
size is one row there.  Rows: one per document, null texts as empty; texts
without a word have fingerprint zero, which links like any other; repeated rows
keep their own row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import stored
from kpiloom.llm.components import components

SEED = 42


def fingerprint(text: str, shingle: int = 3) -> int:
    """The text's fingerprint as an unsigned number.  A-Z are lower-cased, words end at the six ASCII blanks."""
    words = text.encode().lower().split()
    n = len(words)
    if n == 0:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n < shingle:
        return digest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = [0, *ends[:n - shingle].tolist()]
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):  # bounds the unpacked bits of very long texts
        ones += np.unpackbits(hashes[at:at + 65536].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").tobytes(), "little")


def content_mark(text: str) -> Column:
    """Tells apart the texts of rows that share a key."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fp, mark): fp holds the 64 bits as a signed long, mark is the content's.  A narrow map."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "fp": np.array([fingerprint(t, shingle) for t in b["t"]], dtype=np.uint64).view(np.int64), "mark": b["mark"]})

    src = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"), content_mark(f"`{text}`").alias("mark"))
    return src.mapInPandas(run, f"k {src.schema['k'].dataType.simpleString()}, fp long, mark long")


def _variants(fp: Column, segment: int, at: int, width: int) -> Column:
    """Keys of one segment: the segment itself, and for each position the segment without it, with the deleted bit apart."""
    part = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))
    whole = F.struct(F.lit(segment * 65).alias("slot"), part.alias("bits"), F.lit(-1).alias("bit"))
    without = [F.struct(F.lit(segment * 65 + 1 + i).alias("slot"), part.bitwiseAND(F.lit(~(1 << i) if i < 63 else (1 << 63) - 1)).alias("bits"),
                        F.shiftright(part, i).bitwiseAND(F.lit(1)).cast("int").alias("bit")) for i in range(width)]
    return F.array(whole, *without)


def near_pairs(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """prints(fp, rep), distinct in fp -> (a, b): reps of all fingerprints that differ in 1 to max_bits bits."""
    segments = max_bits // 2 + 1  # max_bits differences over so many segments: one holds at most one
    cuts = [64 * i // segments for i in range(segments + 1)]
    keys = F.flatten(F.array(*[_variants(F.col("fp"), s, cuts[s], cuts[s + 1] - cuts[s]) for s in range(segments)]))
    index = prints.select("fp", "rep", F.explode(keys).alias("k")).select("fp", "rep", "k.slot", "k.bits", "k.bit")
    x, y = index.alias("x"), index.alias("y")
    meet = ((F.col("x.slot") == F.col("y.slot")) & (F.col("x.bits") == F.col("y.bits"))
            & (((F.col("x.bit") == 0) & (F.col("y.bit") == 1)) | ((F.col("x.bit") == -1) & (F.col("x.fp") < F.col("y.fp"))))
            & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits))
    # merged: Spark takes the size of the prints for that of their many keys and would broadcast those
    return x.join(y.hint("merge"), meet).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))


def _groups(docs: DataFrame, key: str, text: str, shingle: int, max_bits: int) -> DataFrame:
    """(k, fp, mark, component_id) per row."""
    prints = stored(fingerprints(docs, key, text, shingle), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("k").alias("rep")), "distinct-fingerprints")
    groups = components(near_pairs(distinct, max_bits))
    named = distinct.join(groups, distinct.rep == groups.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named.hint("merge"), "fp")  # else the prints, smaller in their file than as rows, may be broadcast


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(key, fingerprint, component_id): 16 hex digits, and the smallest key reachable by links of at most max_bits bits."""
    return _groups(docs, key, text, shingle, max_bits).select(F.col("k").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """docs with one document of each group: that with the smallest key.  Null keys stay; of rows that repeat a key each goes
    by its own text, and rows that repeat key and text stay or go together."""
    groups = _groups(docs.where(F.col(f"`{key}`").isNotNull()), key, text, shingle, max_bits)
    gone = groups.where(F.col("k") != F.col("component_id")).select(F.col("k").alias("g0"), F.col("mark").alias("g1")).distinct()
    same = (F.col(f"d.`{key}`") == F.col("g.g0")) & (content_mark(f"d.`{text}`") == F.col("g.g1"))
    return docs.alias("d").join(gone.alias("g"), same, "left_anti").select(*[F.col(f"d.`{c}`") for c in docs.columns])

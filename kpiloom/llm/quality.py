"""Quality rules: repetition and length, and divergence from the language's character and word distributions.

The base rules look at one document: too few words, or too large a share of
words inside 8-word windows that occur twice.  The method compares two
histograms of the document with those of its language: of character classes,
and of the language's most common words (with one bin for all others), by
Jensen-Shannon distance (base 2, so 0 to 1).  A distance counts only for
documents with enough characters or words, since short ones stray by chance.

The references are sums over all documents of a language.  Languages are primary
subtags (zh of zh-CN) of two or three letters a-z, so there are at most 18,252 of
them with ``COMMON`` words of at most ``COMMON_CHARS`` code points each: that
bounds what is sent to the executors at any input size.

How much a language's own reference says grows smoothly with its size: with n
words it weighs n / (n + ``PRIOR``).  By that weight char_distance is the distance
to the language's own classes, and by the rest that of ``SHAPE``, the classes with
all letters and blanks as one, to the nearest shape of any language, so no script
is rejected as such; word_distance is the distance to the language's words times the
weight.  Shapes of small languages lean on the pool of all (as if ``PRIOR`` words of
it were added), and the shape's part weighs N / (N + ``PRIOR``) for a table of N words.
Documents with another tag or none have the weight 0.  There is no size at which a
reference starts to count.

Null texts have no words and fail; repeated rows are judged alike; an empty
table gives no rows; columns of docs with other names pass through ``keep``.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import stored

LEAST_WORDS = 20
REPEATED_PERCENT = 30
WINDOW = 8
COMMON, COMMON_CHARS = 48, 24
PRIOR = 2_000
#: Greatest distances, and the characters and words from which they count.
CHAR_LIMIT, CHAR_LEAST = 0.30, 100
WORD_LIMIT, WORD_LEAST = 0.48, 60
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
FLUSH = 300_000

CLASSES = ("blank", "line end", "vowel", "consonant", "capital", "accented", "accented capital", "other letter",
           "digit", "stop", "comma", "quote or bracket", "exclamation or question", "symbol", "other")
#: The classes without what sets scripts apart: letters and blanks are one.
SHAPE = np.array([0, 1, 0, 0, 0, 0, 0, 0, 2, 3, 4, 5, 6, 7, 8])


def _class_of(code: int) -> int:
    c = chr(code)
    if c in BLANKS:
        return int(c == "\n")
    kind = unicodedata.category(c)
    if kind[0] in "LM":  # marks are parts of letters, in some scripts every third code point
        if code < 128:
            return 4 if c.isupper() else 2 if c in "aeiou" else 3
        return 7 if code >= 0x250 or kind not in ("Ll", "Lu") else 6 if kind == "Lu" else 5
    if kind[0] == "N":
        return 8
    for i, own in ((9, ".…。"), (10, ",;:，、"), (11, "\"'()[]{}«»“”‘’„-–—"), (12, "!?¡¿")):
        if c in own:
            return i
    return 13 if kind[0] in "SP" else 14


_TABLE = np.zeros(0, np.int64)


def _classes() -> np.ndarray:
    global _TABLE
    if not len(_TABLE):
        _TABLE = np.array([_class_of(i) for i in range(0x20000)] + [7, 13], np.int64)
    return _TABLE


def characters(text: str) -> np.ndarray:
    """Counts by class; code points from U+20000 count as letters (ideographs), from U+40000 as symbols."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(codes) and codes.max() >= 0x20000:
        codes = np.where(codes < 0x20000, codes, np.where(codes < 0x40000, 0x20000, 0x20001))
    return np.bincount(_classes()[codes], minlength=len(CLASSES))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    values = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + values[i:i + n]
    order = np.argsort(mixed, kind="stable")
    same = np.zeros(n, bool)
    equal = mixed[order[1:]] == mixed[order[:-1]]
    same[order[1:]] |= equal
    same[order[:-1]] |= equal
    if not same.any():
        return 0
    starts = np.nonzero(same)[0].tolist()  # equal windows have equal sums; the windows themselves decide
    times = Counter(tuple(words[i:i + window]) for i in starts)
    cover = np.zeros(len(words) + 1, np.int64)
    for i in starts:
        if times[tuple(words[i:i + window])] > 1:
            cover[i] += 1
            cover[i + window] -= 1
    return int((np.cumsum(cover) > 0).sum())


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; 0 where one is empty."""
    a, b = p.sum(), q.sum()
    if not a or not b:
        return 0.0
    p, q = p / a, q / b
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return math.sqrt(max(0.0, d / 2))


def language(docs: DataFrame, lang: str | None):
    """The tag's primary subtag, or the empty string for every other value."""
    if lang is None:
        return F.lit("")
    low = F.lower(F.trim(F.col(f"`{lang}`").cast("string")))
    return F.coalesce(F.regexp_extract(low, "^([a-z]{2,3})([-_].*)?$", 1), F.lit(""))


def _source(docs: DataFrame, key: str, text: str, lang: str | None) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias(key), language(docs, lang).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def references(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = "lang") -> "References":
    """Of all documents, by language and pooled."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        chars: dict[str, np.ndarray] = {}

        def out(final: bool) -> Iterator[pd.DataFrame]:
            if final or len(words) >= FLUSH:
                yield pd.DataFrame([(lg, w.decode(), n) for (lg, w), n in words.items()], columns=["lang", "item", "n"])
                words.clear()
            if final:
                yield pd.DataFrame([(k, f"\n{i}", int(n)) for k, c in chars.items() for i, n in enumerate(c)], columns=["lang", "item", "n"])

        for b in batches:
            for lg, t in zip(b["lang"], b["text"]):
                own = Counter(t.encode().split())
                total = sum(own.values())
                for w, n in own.items():
                    if len(w) <= COMMON_CHARS or len(w) <= 4 * COMMON_CHARS and len(w.decode()) <= COMMON_CHARS:
                        words[lg, w] += n
                words[lg, b"\nall"] += total
                chars[lg] = chars.get(lg, 0) + characters(t)
                yield from out(False)
        yield from out(True)

    counts = _source(docs, key, text, lang).mapInPandas(run, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))
    counts = stored(counts, "language-counts")
    pooled = counts.groupBy("item").agg(F.sum("n").alias("n")).select(F.lit("").alias("lang"), "item", "n")
    each = counts.where("lang != ''").unionByName(pooled)
    marks = each.where(F.col("item").startswith("\n"))
    # ranks within a language: the lower limit by total cuts each language to few rows first
    totals = marks.where("item = '\nall'").select(F.col("lang").alias("of"), F.col("n").alias("total"))
    likely = each.where(~F.col("item").startswith("\n")).join(F.broadcast(totals), F.col("lang") == F.col("of")).where("n * 1000 >= total")
    top = likely.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "item"))).where(f"r <= {COMMON}")
    refs: dict[str, dict] = {}
    for r in marks.unionByName(top.select("lang", "item", "n")).collect():
        refs.setdefault(r.lang, {})[r.item] = r.n
    out = {}
    for lg, own in refs.items():
        total = own.pop("\nall", 0)
        chars = np.array([own.pop(f"\n{i}", 0) for i in range(len(CLASSES))])
        words = sorted(own, key=lambda w: (-own[w], w))
        n = np.array([own[w] for w in words] + [total - sum(own[w] for w in words)])
        out[lg] = (chars, [w.encode() for w in words], n)
    return References(out)


def shape(chars: np.ndarray) -> np.ndarray:
    return np.bincount(SHAPE, chars, SHAPE.max() + 1)


class References:
    """by_language: language, or "" for all -> (class counts, common words, their counts with those of all other words last)."""

    def __init__(self, by_language: dict[str, tuple[np.ndarray, list[bytes], np.ndarray]]):
        self.by_language = by_language
        pool = by_language.get("")
        self.words = int(pool[2].sum()) if pool else 0
        lean = shape(pool[0]) * (PRIOR / self.words) if self.words else 0.0
        shapes = [shape(chars) + lean for chars, _, _ in by_language.values()] if self.words else []
        self.shapes = np.array([x / x.sum() for x in shapes if x.sum()])

    def weight(self, lang: str) -> float:
        n = int(self.by_language[lang][2].sum()) if lang in self.by_language else 0
        return n / (n + PRIOR)

    def nearest_shape(self, chars: np.ndarray) -> float:
        """The least Jensen-Shannon distance of the shape to any language's."""
        p = shape(chars)
        if not len(self.shapes) or not p.sum():
            return 0.0
        p = p / p.sum()
        m = (p + self.shapes) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            d = (np.where(p > 0, p * np.log2(p / m), 0) + np.where(self.shapes > 0, self.shapes * np.log2(self.shapes / m), 0)).sum(1)
        return math.sqrt(max(0.0, d.min() / 2))


def measure(text: str, lang: str, refs: References) -> tuple:
    """The columns of ``judge`` after the key."""
    words = text.encode().split()
    n, own_ref = len(words), refs.by_language.get(lang) if lang else None
    weight = refs.weight(lang) if lang else 0.0
    repeats = repeated_words(words)
    c = w = 0.0
    if len(text) >= CHAR_LEAST:
        chars = characters(text)
        whole = refs.words / (refs.words + PRIOR)
        c = (1 - weight) * whole * refs.nearest_shape(chars) + (weight * distance(chars, own_ref[0]) if own_ref else 0.0)
    if own_ref and n >= WORD_LEAST:
        _, common, counts = own_ref
        bins = {x: i for i, x in enumerate(common)}
        own = np.bincount(np.array([bins.get(x, len(common)) for x in words]), minlength=len(counts))
        w = weight * distance(own, counts)
    failed = n < LEAST_WORDS or 100 * repeats > REPEATED_PERCENT * n
    return (n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeats, failed, c, w,
            not failed and c <= CHAR_LIMIT and w <= WORD_LIMIT)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept")


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept)."""
    refs = docs.sparkSession.sparkContext.broadcast(references(docs, key, text, lang))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = pd.DataFrame([measure(t, lg, refs.value) for lg, t in zip(b["lang"], b["text"])], columns=list(COLUMNS))
            out.insert(0, key, b[key].to_numpy())
            yield out

    src = _source(docs, key, text, lang)
    return src.mapInPandas(run, f"`{key}` {src.schema[key].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                "n_repeat_words long, base_failed boolean, char_distance double, word_distance double, kept boolean")


def keep(docs: DataFrame, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """docs (with or without a column of languages) without the rejected rows, all columns as they are: the verdict is a column beside each row, so nothing is joined."""
    lang = lang if lang in docs.columns else None
    refs = docs.sparkSession.sparkContext.broadcast(references(docs, docs.columns[0], text, lang))

    @F.pandas_udf("boolean")
    def fine(texts: pd.Series, langs: pd.Series) -> pd.Series:
        return pd.Series([measure(t or "", lg, refs.value)[-1] for t, lg in zip(texts, langs)], dtype=bool)

    return docs.where(fine(F.col(f"`{text}`"), language(docs, lang)))

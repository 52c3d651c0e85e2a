"""Language-model scoring: a causal self-attention model over subword ids, and a smoothed word model beside it.

Texts are lower-cased (A-Z).  The word model counts every word of the rows to
learn from, and one end to a row.  The attention model (``attention``) sees the
subword ids of the same texts: ids met twice or more in the rows to learn from
are symbols, put into about sqrt(symbols) classes in the order of their bytes;
the others share one symbol, whose probability is spread evenly over them.

Learning passes over all windows of all rows to learn from, once, in rounds of
1/64, 1/64, 1/32, ... 1/2 of the rows.  In a round each task takes the model of
the round before, makes its steps over its rows, and hands back its state and
the number of symbols it saw; the weighted mean of the states, added up by
Spark piece by piece, is the next model.  A task's share of a round depends on
the size of an input split and not on the size of the table, so more data means
more tasks and more symbols to a mean.  Only the model (bounded by the
vocabulary) and the frequent words (``HEAD_WORDS``) pass the driver.

The counts of words that are not frequent meet the documents in a join, in
which no word is frequent.  Words above ``LONG_WORD`` bytes are counted by
their SHA-256.

A null text is empty, and has the end as its only token.  Rows without an id
are scored, neither learned from nor held out.  Repeated rows are rows of their
own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import attention, library
from kpiloom.llm.common import scratch_path, stored, text_of
from kpiloom.llm.heads import head_limit

FOLDS = 10
SHARES = (1, 1, 2, 4, 8, 16, 32)  # of 64, the rounds' shares of the rows
STEP_BLOCKS, SCORE_BLOCKS = 512, 2048
HELD_SYMBOLS = 1 << 19
HEAD_WORDS = 1 << 17
HELD_WORDS = 500_000
LONG_WORD = 64
PIECE = 1 << 16


def lowered(text: str) -> bytes:
    return text.encode().lower()  # of bytes: A-Z only


def words_of(data: bytes) -> list[bytes]:
    """The words; bytes.split() cuts at blank and \\x09-\\x0D only."""
    words = data.split()
    if len(max(words, key=len, default=b"")) > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else b"\0" + hashlib.sha256(w).hexdigest().encode() for w in words]
    return words


def held_out(key: str) -> Column:
    return F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % FOLDS == 0


def word_counts(src: DataFrame) -> DataFrame:
    """(word, n, n_train) over src(text, learn): all rows, and those to learn from."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = (Counter(), Counter())
        flush = lambda: [pd.DataFrame({"word": list(c), "n": list(c.values()), "learn": bool(k)}) for k, c in enumerate(seen) if c]
        for b in batches:
            for t, learn in zip(b["text"], b["learn"]):
                seen[learn].update(words_of(lowered(t)))
                if len(seen[0]) + len(seen[1]) > HELD_WORDS:
                    yield from flush()
                    for c in seen:
                        c.clear()
        yield from flush()

    part = src.select("text", "learn").mapInPandas(run, "word binary, n long, learn boolean")
    return part.groupBy("word").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("learn"), F.col("n")).otherwise(0)).alias("n_train"))


class _Places(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


def _rows(src: DataFrame, key: str, path: str, head, end: tuple[float, bool]) -> DataFrame:
    """Per row: the share of the frequent words and the end in the word model's figures, the other words, and the ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lib, part = library.load(path), TaskContext.get().partitionId()
        kind = "<u2" if len(lib.ends_sentence) <= 1 << 16 else "<u4"
        words, logs, known = head.value
        places = _Places((w, i) for i, w in enumerate(words))
        row = 0
        for b in batches:
            out = []
            for t in b["text"]:
                data = lowered(t)
                found = words_of(data)
                at = np.fromiter(map(places.__getitem__, found), np.int64, len(found))
                rest = np.nonzero(at < 0)[0].tolist()
                at = at[at >= 0]
                turn = int(np.searchsorted(np.cumsum(SHARES), zlib.crc32(b"%d %d" % (part, row)) & 63, side="right"))
                out.append((part << 33 | row, len(found) + 1, int(known[at].sum()) + end[1], float(logs[at].sum()) + end[0],
                            b" ".join([found[i] for i in rest]), lib.plain_ids(data.decode()).astype(kind).tobytes(), turn))
                row += 1
            o = pd.DataFrame(out, columns=["row", "n_tokens", "n_known", "base", "rest", "ids", "turn"])
            yield o.assign(**{key: b[key].to_numpy(), "held_out": b["held_out"].to_numpy(), "turn": np.where(b["learn"], o["turn"], -1)})

    schema = (f"row long, `{key}` {src.schema[key].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, base double, "
              "rest binary, ids binary, turn int")
    return src.mapInPandas(run, schema)


class Symbols:
    """Ids -> symbols: class 0 holds the end and the rest, the others the known ids in the order of their bytes."""

    def __init__(self, counts: np.ndarray, names: dict[int, bytes], rows: int):
        self.kind = "<u2" if len(counts) <= 1 << 16 else "<u4"
        known = sorted(np.nonzero(counts >= 2)[0].tolist(), key=lambda i: (names[i], i))
        self.width = max(2, math.isqrt(len(known) + 2))
        self.of = np.ones(len(counts), np.int32)
        self.of[known] = self.width + np.arange(len(known))
        places = np.full((1 + math.ceil(len(known) / self.width)) * self.width, -1.0)
        places[0], places[1] = rows, counts[counts < 2].sum()
        places[self.width:self.width + len(known)] = counts[known]
        self.counts = places
        others = len(counts) - len(known)
        self.rest = -math.log(max(1, others))  # natural log share of each id that is no symbol

    def text(self, ids: bytes) -> np.ndarray:
        return self.of[np.frombuffer(ids, self.kind)]


def _held(batches: Iterator[pd.DataFrame], symbols: Symbols) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Rows with their symbols, a bounded number of symbols at a time (or one row)."""
    for b in batches:
        texts, lo, size = [], 0, 0
        for i, x in enumerate(b["ids"]):
            t = symbols.text(x)
            if size and size + len(t) > HELD_SYMBOLS:
                yield b.iloc[lo:i], texts
                texts, lo, size = [], i, 0
            texts.append(t)
            size += len(t) + attention.BLOCK
        if texts:
            yield b.iloc[lo:], texts


def _flat(state: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([v.ravel() for v in state.values()])


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, v in like.items():
        out[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
        at += v.size
    return out


def _added(part: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(x, "<f8") for x in part["state"]], axis=0)
    return pd.DataFrame({"piece": part["piece"].iloc[:1], "some": part["some"].iloc[:1], "weight": [part["weight"].sum()], "state": [total.tobytes()]})


def learn_round(rows: DataFrame, state: dict[str, np.ndarray], symbols: Symbols) -> dict[str, np.ndarray]:
    """The mean of the states that the tasks reach from ``state`` over their rows, by the symbols they saw."""
    sent = rows.sparkSession.sparkContext.broadcast((state, symbols))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, symbols = sent.value
        own, seen = {k: v.copy() for k, v in start.items()}, 0
        for _, texts in _held(batches, symbols):
            seen += attention.learn(own, texts, symbols.width, STEP_BLOCKS)[1]
        if seen:
            flat, some = _flat(own).astype("<f8") * seen, TaskContext.get().partitionId() % 32
            for i in range(0, len(flat), PIECE):
                yield pd.DataFrame({"piece": [i], "some": [some], "weight": [float(seen)], "state": [flat[i:i + PIECE].tobytes()]})

    schema = "piece int, some int, weight double, state binary"
    parts = rows.select("ids").mapInPandas(run, schema)
    for keys in (["piece", "some"], ["piece"]):  # two steps: no task adds up more than a few dozen states at once
        parts = parts.groupBy(*keys).applyInPandas(_added, schema)
    got = sorted(parts.collect(), key=lambda r: r.piece)
    sent.unpersist()
    if not got:
        return state
    return _shaped(np.concatenate([np.frombuffer(r.state, "<f8") / r.weight for r in got]), state)


def train(rows: DataFrame, names: dict[int, bytes], kind: str, n_rows: int) -> tuple[Symbols, dict[str, np.ndarray]]:
    """rows(ids, turn): all rows to learn from have a turn from 0 on."""
    size = max(names) + 1

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(size, np.int64)
        for b in batches:
            n += np.bincount(np.frombuffer(b"".join(b["ids"]), kind), minlength=size)
        at = np.nonzero(n)[0]
        yield pd.DataFrame({"id": at, "n": n[at]})

    learned = rows.where("turn >= 0").select("ids", "turn")
    found = learned.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[found["id"]] = found["n"]
    symbols = Symbols(counts, names, n_rows)
    state = attention.initial(symbols.counts, symbols.width)
    for turn in range(len(SHARES)):
        state = learn_round(learned.where(F.col("turn") == turn), state, symbols)
    return symbols, {k: v for k, v in state.items() if not k.startswith("g_")}


def score_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", head_words: int = HEAD_WORDS) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    lib = library.load(path)
    src = text_of(docs, key, text).withColumnRenamed(text, "text") if text != key else text_of(docs, key, text)
    src = src.withColumn("held_out", F.coalesce(held_out(key), F.lit(False))).withColumn("learn", F.col(f"`{key}`").isNotNull() & ~F.col("held_out"))
    counts = stored(word_counts(src), "word-counts")
    n_rows = src.where("learn").count()
    got = counts.agg(F.coalesce(F.sum("n_train"), F.lit(0)).alias("n"), F.count_if(F.col("n_train") > 0).alias("v")).first()
    total, distinct = got.n + n_rows, got.v + (n_rows > 0)
    below = total + 0.1 * (distinct + 1)
    log10 = lambda c: np.log10((c + 0.1) / below)
    least = head_limit(counts, head_words)
    head = (counts.where(F.col("n") >= least) if least is not None else counts.limit(0)).toPandas()
    n_train = head["n_train"].to_numpy(np.float64)
    sent = spark.sparkContext.broadcast(([bytes(w) for w in head["word"]], log10(n_train), n_train > 0))
    made = _rows(src, key, path, sent, (float(log10(n_rows)), n_rows > 0))
    folder = scratch_path(spark, "subword-ids")
    made.write.partitionBy("turn").parquet(folder, compression="zstd")
    rows = spark.read.schema(made.schema).parquet(folder)
    kind = "<u2" if len(lib.ends_sentence) <= 1 << 16 else "<u4"
    symbols, model = train(rows, lib.own.piece_bytes, kind, n_rows)
    model_sent = spark.sparkContext.broadcast((symbols, model))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        symbols, model = model_sent.value
        for b, texts in _held(batches, symbols):
            s = attention.text_scores(model, texts, symbols.width, SCORE_BLOCKS)
            s += symbols.rest * np.array([(t == 1).sum() for t in texts])
            yield b.drop(columns=["ids"]).assign(score=s / math.log(10))

    use = rows.select("row", f"`{key}`", "held_out", "n_tokens", "n_known", "base", "ids")
    out = use.mapInPandas(run, use.drop("ids").schema.add("score", "double"))
    rare = counts.where(F.col("n") < least) if least is not None else counts
    rest = rows.where(F.length("rest") > 0).select("row", F.explode(F.split(F.col("rest").cast("string"), " ")).alias("word"))
    rest = rest.withColumn("word", F.col("word").cast("binary")).join(rare, "word").groupBy("row").agg(F.sum(F.log10((F.col("n_train") + 0.1) / F.lit(below))).alias("more"), F.count_if(F.col("n_train") > 0).alias("more_known"))
    out = out.join(rest, "row", "left")
    return out.select(key, "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")

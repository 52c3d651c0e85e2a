"""Token counts through a digest cache.

Stored counts are keyed by two digests: of the content, and of the tokenizer
(its file and the rule that applies it).  A run joins the distinct content
digests to the stored counts, encodes one representative text for each digest
that is missing, appends those counts to the cache, and joins the counts back
to the documents.  Content is normalised by the tokenizer's own rules only
(null is the empty text), because any other normalisation would change counts.

The cache is a Parquet table partitioned by tokenizer digest.  An append that
is repeated after a failure, or by two writers at once, stores equal counts
twice; reading takes one per digest.  Text moves once, and only the
representatives of missing digests are encoded; copies share one count however
many they are.  Null keys are kept; repeated rows keep their own row; an empty
table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import library
from kpiloom.llm.common import scratch_path, stored, text_of

NO_KEY = -(1 << 62)  # stands for a null key while a representative is looked up
RULE = "1"  # raise when the way of counting changes


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Callable[[str], int]:
    """Tokens of a text without begin, end or added special tokens: .model by sentencepiece; .json as byte-level BPE
    where it is one, else by its library."""
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(model.encode(t, num_threads=1))
    try:
        return library.load(path).count
    except ValueError:
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return lambda s: len(t.encode(s, add_special_tokens=False).ids)


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(RULE.encode() + b"\0" + f.read()).hexdigest()


def _read(spark: SparkSession, cache: str, version: str) -> DataFrame:
    try:
        found = spark.read.schema("digest binary, n_tokens long").parquet(f"{cache}/version={version}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encode(texts: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(path)
        for b in batches:
            yield pd.DataFrame({"digest": b["digest"], "n_tokens": [count(t) for t in b["text"]]})

    return texts.select("digest", "text").mapInPandas(run, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, path: str, cache: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens).  cache: folder of the stored counts; without one a new folder below the shared folder serves this call."""
    spark = docs.sparkSession
    cache, version = cache or scratch_path(spark, "token-counts"), tokenizer_digest(path)
    src = text_of(docs, key, text).withColumn("digest", F.unhex(F.sha2(F.col(text), 256)))
    keys = stored(src.select(key, "digest", F.octet_length(text).cast("long").alias("n_bytes")), "digests")
    held = _read(spark, cache, version)
    missing = keys.groupBy("digest").agg(F.min(F.coalesce(key, F.lit(NO_KEY))).alias("rep")).join(held, "digest", "left_anti")
    # the representatives, a few bytes each, are the build side; the texts stream past them
    texts = src.select(F.coalesce(key, F.lit(NO_KEY)).alias("rep"), F.col("digest").alias("of"), F.col(text).alias("text"))
    texts = texts.join(missing.hint("shuffle_hash"), "rep").where("of = digest")
    # rows that repeat both id and text may be encoded twice; they are stored once
    _encode(texts, path).dropDuplicates(["digest"]).write.mode("append").parquet(f"{cache}/version={version}")
    return keys.join(_read(spark, cache, version), "digest").select(key, "n_bytes", "n_tokens")

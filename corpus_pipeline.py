"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns what is kept, with the
columns of documents (n_chars follows the text); the last gives the packed
pieces.  ``run`` writes each stage's rows to the shared folder and reads them
again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import lines, packing, pii, quality, simhash
from kpiloom.llm.common import free_name, ship, stored, table
from kpiloom.llm.queries import tokenizer


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars after a change of the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    ship(spark)
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go; a document without any line left stays as an empty text."""
    ship(spark)
    names = (free_name(docs, "n_exact"), free_name(docs, "n_near"))
    return _counted(lines.dedup_lines(docs, least_words=lines.EVERY_LINE, names=names).select(*[f"`{c}`" for c in docs.columns]))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship(spark)
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by its kind."""
    ship(spark)
    return _counted(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("pii", personal_data),
    ("packing", pack),
]

#: SQL can express none of the methods as a whole; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

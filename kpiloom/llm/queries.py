"""The registered queries of this subpackage: name -> (fn(spark, sf_dir), DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import alignment, bpe, embeddings, hard_negatives, lines, lm, packing, pii, quality, simhash, token_cache, toxicity, url_templates
from kpiloom.llm.common import ship, table

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
TOKEN_LIMIT = 1024

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def tokenizer() -> str:
    return public_tokenizers.path(TOKENIZER)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = (run, sql)
        return fn
    return deco


@register("op1_url_filters")
def url_filters(spark, sf_dir):
    return url_templates.judge(table(spark, sf_dir, "pages"), URL_RULES)


@register("op2_simhash")
def simhash_near_dedup(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@register("op3_embeddings")
def embedding_near_dedup(spark, sf_dir):
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@register("op4_bpe")
def bpe_round_trip(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer())


@register("op5_pii")
def personal_data(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


@register("op6_line_dedup")
def line_dedup(spark, sf_dir):
    return lines.dedup_lines(table(spark, sf_dir, "documents"), least_words=lines.EVERY_LINE).select("doc_id", "text", "n_exact", "n_near")


@register("op7_token_counts")
def token_counts(spark, sf_dir):
    return token_cache.count_tokens(table(spark, sf_dir, "documents"), tokenizer()).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@register("op8_toxicity")
def toxicity_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@register("op9_quality")
def quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@register("op10_packing")
def sequence_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


@register("op11_hard_negatives", """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS alike,
           CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
    FROM rows a JOIN rows c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
held AS (
    SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS place
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
     AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM held WHERE place <= 3""")
def hard_negative_mining(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


@register("op12_lm_scores")
def language_model_scores(spark, sf_dir):
    return lm.score_texts(table(spark, sf_dir, "documents"), tokenizer())


@register("op13_token_alignment")
def token_alignment(spark, sf_dir):
    return alignment.align_tokens(table(spark, sf_dir, "documents"), tokenizer(), public_tokenizers.path(PIECES))


@register("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)

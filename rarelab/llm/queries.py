"""The operators' registered queries, over whole tables with production
parameters, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rarelab.llm import langid, sentencepiece_codec, toxicity
from rarelab.llm.centroids import centroid_clusters, sql_clusters
from rarelab.llm.embedding_dedup import embedding_dedup
from rarelab.llm.exact_dedup import exact_dedup
from rarelab.llm.minhash_dedup import near_dedup
from rarelab.llm.mixing import mix, sql_mix
from rarelab.llm.pii import pseudonyms
from rarelab.llm.secrets import find_secrets, secret_digest
from rarelab.llm.token_alignment import token_links
from rarelab.llm.token_counts import length_histogram
from rarelab.llm.token_files import read_tokens, write_tokens
from rarelab.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_exact_dedup", r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256, cp AS text_chars
FROM n WINDOW w AS (PARTITION BY norm ORDER BY cp DESC, doc_id NULLS LAST)""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op6_source_mix", sql_mix())
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    return mix(docs, labels).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards, folder = write_tokens(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                  public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_tokens(shards, folder)


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(read_table(spark, sf_dir, "documents", "text"),
                            public_tokenizers.path("word_bpe_49k.json"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model)


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return langid.identify(docs, langid.train(docs))


#: The query's key; an application passes its own secret.
PSEUDONYM_KEY = b"documents pseudonym key, round 1"


@query("op2_pseudonyms")
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms(read_table(spark, sf_dir, "documents", "doc_id", "text"), PSEUDONYM_KEY)


@query("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return sentencepiece_codec.encode(read_table(spark, sf_dir, "documents", "doc_id", "text"), model, with_ids=False)


@query("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_table(spark, sf_dir, "documents", "doc_id", "text"), width=2, percent=80)


@query("op4_embedding_dedup")
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), threshold=0.93)


@query("op11_centroid_clusters", sql_clusters())
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")).drop("n_verified")


@query("op12_token_links")
def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                       public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_guess_cost_secrets")
def op13_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(find_secrets(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                      public_tokenizers.path("byte_bpe_50k.json")))

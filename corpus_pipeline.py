"""A training corpus from ``documents``: the stages in order, each over all rows
that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rarelab.llm import toxicity
from rarelab.llm.exact_dedup import keep_unique
from rarelab.llm.minhash_dedup import keep_one
from rarelab.llm.mixing import mixed_rows
from rarelab.llm.sentencepiece_codec import encode
from rarelab.session import cut_lineage
from rarelab.sources.tables import read_table

#: The SentencePiece model file of the last stage.
MODEL_FILE = public_tokenizers.path("piece_bpe_32k.model")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that score 0.5 or more go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the longest original stays."""
    return keep_unique(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup over five-word shingles: the first document of each group stays."""
    return keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: whole documents, as often as the mix takes them."""
    return mixed_rows(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: the token ids of every row."""
    with open(MODEL_FILE, "rb") as f:
        return encode(docs, f.read())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("minhash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Trained scores, sampled signatures and token ids have no SQL form; the tests
#: hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written down before the next reads them."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs

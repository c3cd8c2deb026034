"""Token counts from an exact length histogram.

Documents are aggregated by encoded length, so what is left grows with the
number of distinct lengths.  Suffix sums over the lengths answer the totals,
quantiles and truncated totals of every context limit without another pass."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.llm.common import column, map_arrow, pieces
from rarelab.llm.encoding import ENCODE_BYTES, encoder
from rarelab.operators.ordered import running_sum


def _counter(tokenizer: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ENCODE_BYTES):
            length, n = np.unique(encoder(tokenizer).lengths(column(piece, "text")), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length.astype(np.int64)), pa.array(n.astype(np.int64))],
                                             ["length", "n_docs"])
    return count


def length_histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``length, n_docs, n_tokens, docs_at_least, tokens_at_least, tokens_within``, one row per
    distinct encoded length of the whole texts (null and empty: 0).

    ``docs_at_least`` and ``tokens_at_least`` are suffix sums over longer
    documents, the row's own included; ``tokens_within`` is the corpus total
    when every document is cut after ``length`` tokens.  Repeated rows count
    each.  An empty table gives an empty result."""
    lengths = map_arrow(docs.select(F.col(text_col).alias("text")), _counter(tokenizer),
                        "length bigint, n_docs bigint")
    hist = lengths.groupBy("length").agg(F.sum("n_docs").alias("n_docs")).withColumn(
        "n_tokens", F.col("length") * F.col("n_docs"))
    cum = running_sum(hist, [], ["length"], ["n_docs", "n_tokens"])
    total = hist_totals(cum)
    out = cum.withColumns({
        "docs_at_least": F.lit(total["docs"]) - F.col("cum_n_docs") + F.col("n_docs"),
        "tokens_at_least": F.lit(total["tokens"]) - F.col("cum_n_tokens") + F.col("n_tokens")})
    within = F.lit(total["tokens"]) - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("length")
    return out.select("length", "n_docs", "n_tokens", "docs_at_least", "tokens_at_least",
                      within.alias("tokens_within"))


def hist_totals(hist: DataFrame) -> dict:
    """``docs`` and ``tokens`` of the whole corpus."""
    row = hist.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
                   F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens")).first()
    return row.asDict()


def length_quantile(hist: DataFrame, p: float) -> int | None:
    """The smallest length that at least the share ``p`` of all documents does not exceed; None without documents."""
    if not 0 <= p <= 1:
        raise ValueError("p must lie in [0, 1]")
    docs = hist_totals(hist)["docs"]
    rank = max(1, math.ceil(p * docs))
    return hist.where(F.lit(docs) - F.col("docs_at_least") + F.col("n_docs") >= rank).agg(F.min("length")).first()[0]


def truncated_total(hist: DataFrame, limit: int) -> int:
    """Tokens of the corpus when every document is cut after ``limit`` tokens, any limit: read
    from the suffix sums of the next longer length that occurs."""
    row = hist.where(F.col("length") >= limit).agg(F.min_by(F.struct("docs_at_least", "tokens_at_least"), "length")).first()[0]
    tokens = hist_totals(hist)["tokens"]
    return tokens if row is None else tokens - row["tokens_at_least"] + limit * row["docs_at_least"]

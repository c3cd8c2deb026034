"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams.

Features are the distinct words, word pairs and pairs with one word between
them, hashed into 2^24 slots.  Every slot keeps its own learning rate, and the
L1 term keeps all but the telling slots at zero, so the trained model is a short
list of (slot, weight) pairs that every task can hold.  Training reads a bounded
sample of labelled documents in a fixed pseudo-random order; scoring reads every
whole text once and shuffles nothing."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarelab.llm.common import column, hash64, held_out, map_arrow, mix64, pieces, unit_hash, word_codes

BITS = 24
BIAS = -1  # slot number of the intercept in a stored model
SAMPLE = 12_000  # labelled documents that training reads at most
EPOCHS = 4

_MARKS = re.compile(r"[\W_]+")
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Ftrl:
    """Learning rate ``alpha / (beta + sqrt(sum of squared gradients))`` per slot, L1 and L2 strength."""

    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.3


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of whole texts: ``(text number, slot)``, in text order, repeats included.

    Words are lower-cased and freed of everything but letters and digits;
    words that are empty then are skipped."""
    offsets, codes, distinct = word_codes(texts)
    clean = pa.array([_MARKS.sub("", w.lower()) for w in distinct.to_pylist()], pa.string())
    h = hash64(clean)
    empty = np.fromiter((len(w) == 0 for w in clean.to_pylist()), dtype=bool, count=len(clean))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    full = ~empty[codes]
    doc, word = doc[full], h[codes[full]]
    docs, slots = [doc], [word]
    for gap, salt in ((1, _PAIR), (2, _SKIP)):
        same = doc[gap:] == doc[:-gap] if len(doc) > gap else np.zeros(0, bool)
        docs.append(doc[:len(same)][same])
        slots.append(mix64(word[:len(same)][same] * salt + word[gap:gap + len(same)][same]))
    slot = (np.concatenate(slots) >> np.uint64(64 - BITS)).astype(np.int64)
    return np.concatenate(docs), slot


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        doc, slot = features(column(piece, "text"))
        pair = np.unique((doc.astype(np.int64) << BITS) | slot)
        n = piece.num_rows
        ends = np.searchsorted(pair >> BITS, np.arange(n + 1))
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                         pa.array((pair & ((1 << BITS) - 1)).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([column(piece, "key"), column(piece, "y"), lists], ["key", "y", "slots"])


def _trainer(rule: Ftrl):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << BITS) + 1
        z, n = np.zeros(size, np.float32), np.zeros(size, np.float32)
        l1 = np.float32(rule.l1)
        for batch in batches:
            lists, y = batch.column("slots"), batch.column("y").to_numpy()
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for i in range(batch.num_rows):
                x = np.append(flat[ends[i]:ends[i + 1]], size - 1)  # the last slot is the intercept
                zi, ni = z[x], n[x]
                root = np.sqrt(ni)
                excess = np.abs(zi) - l1
                excess[-1] = abs(zi[-1])
                w = np.where(excess > 0, -np.sign(zi) * excess / ((rule.beta + root) / rule.alpha + rule.l2), 0)
                g = 1 / (1 + np.exp(-np.clip(w.sum(dtype=np.float64), -35, 35))) - y[i]
                z[x] = zi + g - (np.sqrt(ni + g * g) - root) / rule.alpha * w
                n[x] = ni + g * g
        if n[-1] == 0:
            return
        # a stretch at a time: a copy of all slots would double the task's memory
        live = np.concatenate([at + np.flatnonzero(np.abs(z[at:at + (1 << 20)]) > l1) for at in range(0, 1 << BITS, 1 << 20)])
        live = np.append(live[live < size - 1], size - 1)
        excess = np.abs(z[live]) - l1
        excess[-1] = abs(z[-1])
        w = -np.sign(z[live]) * excess / ((rule.beta + np.sqrt(n[live])) / rule.alpha + rule.l2)
        slot = np.where(live == size - 1, BIAS, live)
        for at in range(0, len(slot), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(slot[at:at + 10_000], pa.int64()),
                                              pa.array(w[at:at + 10_000].astype(np.float64))], ["slot", "weight"])
    return train


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS, rule: Ftrl = Ftrl(),
          learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> list[tuple[int, float]]:
    """The nonzero weights ``(slot, weight)``, the intercept under :data:`BIAS`; empty without labelled rows.

    At most ``sample`` labelled documents are read, chosen by a hash of the
    id; ``learn_from`` (a condition on ``labels``, default: the id's crc32 is
    not held out) limits them further.  Of several labels the highest counts,
    null labels and ids are ignored, and rows that repeat an id train once, on
    the greatest text."""
    allowed = ~held_out(F.col("doc_id")) if learn_from is None else learn_from
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & allowed)
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    total = known.count()
    if total == 0:
        return []
    order = unit_hash("doc_id", seed=11)
    # a first cut by the hash leaves a little more than the sample; the sort then ends it at the bound
    near = known.withColumn("key", order).where(F.col("key") < min(1.0, (sample + 6 * sample ** 0.5) / total))
    chosen = near.orderBy("key", "doc_id").limit(sample)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the sample's ids are bounded by `sample`, so they go to every task and no text is shuffled to meet them
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y", "key").agg(F.max("text").alias("text"))
    found = map_arrow(rows.select("key", "y", "text"), _extract, "key double, y int, slots array<int>")
    passes = found.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    ordered = passes.repartition(1).sortWithinPartitions("epoch", "key")  # the bounded sample, in one task
    model = map_arrow(ordered.select("y", "slots"), _trainer(rule), "slot bigint, weight double")
    return [(r["slot"], r["weight"]) for r in model.collect()]


class _Weights:
    """The model of a task: the slots in order, and a flag for every slot there is."""

    def __init__(self, model):
        slot, weight = model.value
        self.bias = float(weight[slot == BIAS].sum())
        order = np.argsort(slot[slot != BIAS])
        self.slots, self.weights = slot[slot != BIAS][order], weight[slot != BIAS][order]
        self.known = np.zeros(1 << BITS, bool)
        self.known[self.slots] = True

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 of whole texts, each distinct slot counted once."""
        doc, slot = features(texts)
        live = np.flatnonzero(self.known[slot])
        pair = np.unique((doc[live].astype(np.int64) << BITS) | slot[live])
        weight = self.weights[np.searchsorted(self.slots, pair & ((1 << BITS) - 1))]
        logit = self.bias + np.bincount(pair >> BITS, weights=weight, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(model)
        for piece in pieces(batches):
            yield pa.RecordBatch.from_arrays([column(piece, "doc_id"), pa.array(weights.score(column(piece, "text")))],
                                             ["doc_id", "score"])
    return run


def _filter(model, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(model)
        for piece in pieces(batches):
            clean = weights.score(column(piece, text_col)) < 0.5
            yield from piece.filter(pa.array(clean)).to_batches()
    return run


def _share(docs: DataFrame, model: list[tuple[int, float]]):
    """The model as a broadcast: at most 2^24 pairs, a few hundred in practice."""
    return docs.sparkSession.sparkContext.broadcast((np.asarray([s for s, _ in model]), np.asarray([w for _, w in model])))


def score(docs: DataFrame, model: list[tuple[int, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    ``score`` is the probability of label 1 by the distinct slots of the whole
    text; a null or empty text has the intercept's.  An empty model knows
    nothing toxic: score 0.  Rows without an id are scored and count as held
    out.  Repeated rows are scored each; an empty table gives an empty result."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if model:
        scored = map_arrow(rows, _scorer(_share(docs, model)), "doc_id bigint, score double")
    else:
        scored = rows.select("doc_id", F.lit(0.0).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: list[tuple[int, float]], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with all their columns; all rows where the model is empty.
    A text is scored where its row lies: nothing is shuffled."""
    return map_arrow(docs, _filter(_share(docs, model), text_col), docs.schema) if model else docs

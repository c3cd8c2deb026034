"""Language identification by interpolated Kneser-Ney character models.

Every language has a model of the characters of its words: five-grams backed by
shorter ones through absolute discounting and continuation counts.  The n-grams
of all languages lie in one sorted array of 64-bit hashes, with a probability for
each language that has the n-gram, so one binary search serves all of them.  A text's
language is the one of the lowest cross-entropy per character; a language's
calibration documents, which its counts never saw, set the cross-entropy from
which a text is marked as rejected, and the sharpness of the score.

Counts come from a bounded sample per language; its bounds in documents and
characters are parameters.  All of the sample's n-grams are kept.  Every whole
text is scored, each distinct word of a batch once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarelab.llm.common import column, held_out, map_arrow, mix64, pieces, unit_hash, word_codes
from rarelab.llm.encoding import ranges

ORDER = 5
START, END = 2, 3  # code points that stand before and after a word
SAMPLE_DOCS = 3000  # documents per language, about
SAMPLE_CHARS = 8_000_000  # characters per language, about
CELLS_AT_ONCE = 4_000_000  # positions times languages that are scored at once
CALIBRATE = 0.15  # share of the sample that calibrates instead of being counted
REJECT = 0.002  # share of a language's own calibration documents beyond its threshold
SHARPNESS = 2.0 ** np.arange(-2, 9)

_BASE = 0x100000001B3
_SALT = 0x9E3779B97F4A7C15


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter; its lower case (where that is one code point)."""
    letter = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    return letter, lower


def padded_runs(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of letters of all words, lower-cased, each with ORDER - 1 start marks and an end mark.

    Returns ``(codes, at, word)``: the code points in turn, the positions that
    a model predicts (letters and end marks) and the number of the word that
    each such position belongs to."""
    letter, lower = _tables()
    codes = np.frombuffer("\n".join(words).encode("utf-32-le"), dtype="<u4")
    is_letter = letter[codes]
    edge = np.diff(np.concatenate(([0], is_letter.view(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    length = end - begin
    word_of_code = np.cumsum(codes == 10)
    pad = ORDER - 1
    total = length + pad + 1
    offset = np.cumsum(total) - total
    out = np.full(int(total.sum()), START, dtype=np.uint32)
    out[ranges(offset + pad, length)] = lower[codes[ranges(begin, length)]]
    out[offset + total - 1] = END
    at = ranges(offset + pad, length + 1)
    word = np.repeat(word_of_code[begin] if len(begin) else begin, length + 1)
    return out, at, word


def gram_keys(codes: np.ndarray) -> list[np.ndarray]:
    """``keys[k][i]``: hash of the k characters that end at position i (k = 0: nothing)."""
    keys, h, power = [np.zeros(len(codes), np.uint64)], np.zeros(len(codes), np.uint64), 1
    wide = codes.astype(np.uint64)
    for k in range(1, ORDER + 1):
        shifted = np.zeros_like(wide)
        shifted[k - 1:] = wide[:len(wide) - k + 1]
        h = h + shifted * np.uint64(power)
        power = power * _BASE % (1 << 64)
        keys.append(mix64(h + np.uint64(k * _SALT % (1 << 64))))
    return keys


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


@dataclass
class Rows:
    """A sparse table of (hash, language, value): the rows of ``keys[i]`` stand at ``start[i] .. start[i + 1] - 1``."""

    keys: np.ndarray
    start: np.ndarray
    lang: np.ndarray
    value: np.ndarray

    @classmethod
    def merge(cls, parts: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        """``parts[j]``: the distinct hashes of language j and their values."""
        key = np.concatenate([k for k, _ in parts])
        lang = np.repeat(np.arange(len(parts), dtype=np.int32), [len(k) for k, _ in parts])
        order = np.argsort(key, kind="stable")
        keys, start = np.unique(key[order], return_index=True)
        return cls(keys, np.append(start, len(key)), lang[order],
                   np.concatenate([v for _, v in parts]).astype(np.float32)[order])

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(i, language, value)`` of every row whose hash is ``wanted[i]``."""
        where, found = _find(self.keys, wanted)
        some = np.flatnonzero(found)
        first = self.start[where[some]]
        size = self.start[where[some] + 1] - first
        at = ranges(first, size)
        return np.repeat(some, size), self.lang[at], self.value[at]


@dataclass
class KneserNey:
    """``grams[k]``: the probabilities of the k-grams; ``contexts[k]``: the weights that the contexts of
    order k leave to order k - 1.  A language has rows for what its own sample holds."""

    langs: list[str]
    floor: float
    grams: list[Rows]
    contexts: list[Rows]
    sharpness: float = 1.0
    thresholds: np.ndarray | None = None

    @property
    def prob(self) -> list[np.ndarray]:
        return [rows.value for rows in self.grams]

    def probabilities(self, keys: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """P(character | up to ORDER - 1 before it) at the positions, a column per language."""
        out = np.full((len(at), len(self.langs)), self.floor, np.float32)
        for k, (contexts, grams) in enumerate(zip(self.contexts, self.grams, strict=True), 1):
            i, lang, left = contexts.find(keys[k - 1][at - 1])
            out[i, lang] *= left
            i, lang, prob = grams.find(keys[k][at])
            out[i, lang] = prob
        return out


def _estimate(gram: np.ndarray, n: np.ndarray, floor: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """One language: per order the hashes of its grams, their probabilities, its contexts, their weights."""
    # counts of each order: how often at the top and after a word's start, else in how many longer grams
    tables = []
    raw = use = n.astype(np.float64)
    for k in range(ORDER, 0, -1):
        short, back = np.unique(gram[:, 1:], axis=0, return_inverse=True) if k > 1 else (gram, np.zeros(len(gram), int))
        back = back.reshape(-1)
        tables.append((gram, use, back))
        if k > 1:
            raw = np.bincount(back, weights=raw, minlength=len(short))
            kinds = np.bincount(back, minlength=len(short)).astype(np.float64)
            gram, use = short, np.where(short[:, 0] == START, raw, kinds)
    out, lower = [], np.asarray([floor])
    for k, (gram, use, back) in enumerate(reversed(tables), 1):
        hashes = gram_keys(np.ascontiguousarray(gram).reshape(-1).astype(np.uint32))
        key = hashes[k].reshape(len(gram), k)[:, -1]
        context = hashes[k - 1].reshape(len(gram), k)[:, -2] if k > 1 else np.zeros(len(gram), np.uint64)
        contexts, ctx = np.unique(context, return_inverse=True)
        ones, twos = (use == 1).sum(), (use == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        total = np.bincount(ctx, weights=use, minlength=len(contexts))
        left = discount * np.bincount(ctx, minlength=len(contexts)) / total
        lower = np.maximum(use - discount, 0) / total[ctx] + left[ctx] * lower[back]
        out.append((key, lower, contexts, left))
    return out


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> KneserNey:
    """``counts[lang] = (code points of its five-grams, one row each; how often each occurs)``."""
    langs = sorted(counts)
    chars = np.unique(np.concatenate([np.unique(g[:, -1]) for g, _ in counts.values()]))
    floor = 1.0 / (len(chars) + 1)
    orders = list(zip(*[_estimate(*counts[lang], floor) for lang in langs], strict=True))
    return KneserNey(langs, floor, [Rows.merge([(key, prob) for key, prob, _, _ in parts]) for parts in orders],
                     [Rows.merge([(key, left) for _, _, key, left in parts]) for parts in orders])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Five-grams of whole texts with their counts, added up within a piece per language."""
    for piece in pieces(batches):
        langs = column(piece, "lang").dictionary_encode()
        lang_of = langs.indices.to_numpy()
        offsets, codes, words = word_codes(column(piece, "text"))
        chars, at, word = padded_runs(words.to_pylist())
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        for j, lang in enumerate(langs.dictionary.to_pylist()):
            times = np.bincount(codes[lang_of[doc] == j], minlength=len(words))
            weight = times[word]
            spots = at[weight > 0]
            if not len(spots):
                continue
            window = np.stack([chars[spots - ORDER + 1 + t] for t in range(ORDER)], axis=1)
            gram, back = np.unique(window, axis=0, return_inverse=True)
            n = np.bincount(back.reshape(-1), weights=weight[weight > 0]).astype(np.int64)
            text = ["".join(map(chr, g)) for g in gram.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(text), pa.string()), pa.array(text, pa.string()),
                                              pa.array(n)], ["lang", "gram", "n"])


def entropies(texts: pa.Array, model: KneserNey) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy in nats per character of every whole text under every language (infinite
    without a letter), and the number of characters that were predicted."""
    offsets, codes, words = word_codes(texts)
    n, langs = len(offsets) - 1, len(model.langs)
    chars, at, word = padded_runs(words.to_pylist())
    keys = gram_keys(chars)
    size = np.bincount(word, minlength=len(words)).astype(np.float64)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    total = np.bincount(doc, weights=size[codes], minlength=n)
    turn = np.argsort(codes, kind="stable")
    sorted_codes, doc = codes[turn], doc[turn]
    bits = np.zeros((n, langs))
    step = max(1, CELLS_AT_ONCE // langs)
    for lo in range(0, len(at), step):
        spots, own = at[lo:lo + step], word[lo:lo + step]
        # a five-gram's probabilities are looked up once
        _, first, back = np.unique(keys[ORDER][spots], return_index=True, return_inverse=True)
        logs = np.log(model.probabilities(keys, spots[first]))
        a, b = np.searchsorted(sorted_codes, [own[0], own[-1] + 1])
        of, where = doc[a:b], sorted_codes[a:b] - own[0]
        for j in range(langs):
            sums = np.bincount(own - own[0], weights=logs[back, j])
            bits[:, j] -= np.bincount(of, weights=sums[where], minlength=n)
    out = np.full((n, langs), np.inf)
    some = total > 0
    out[some] = bits[some] / total[some, None]
    return out, total


def _entropy_rows(shared):
    """Per document with a letter: its language, its cross-entropy there and its log loss at each sharpness."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            model = shared.value
            h, total = entropies(column(piece, "text"), model)
            some = total > 0
            langs = column(piece, "lang").filter(pa.array(some))
            truth = np.searchsorted(model.langs, langs.to_pylist()) if len(langs) else np.zeros(0, np.int64)
            own, loss = losses(h[some], truth)
            yield pa.RecordBatch.from_arrays([langs, pa.array(own, pa.float64()),
                                              pa.array(list(loss), pa.list_(pa.float64()))], ["lang", "own", "loss"])
    return run


def _softmax(h: np.ndarray, sharpness: float) -> np.ndarray:
    z = -sharpness * (h - h.min(axis=1, keepdims=True))
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def losses(h: np.ndarray, truth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of documents' cross-entropies: those under the true language, and the log losses, a column per sharpness."""
    rows = np.arange(len(truth))
    loss = [-np.log(np.maximum(_softmax(h, s)[rows, truth], 1e-12)) for s in SHARPNESS] if len(truth) else []
    return h[rows, truth], np.stack(loss, axis=1) if loss else np.zeros((0, len(SHARPNESS)))


def calibrate(model: KneserNey, langs: list[str], own: np.ndarray, loss: np.ndarray, reject: float = REJECT) -> None:
    """Set the thresholds (per language, the 1 - reject quantile of its own documents' cross-entropy)
    and the sharpness (of a geometric series, the one with the least log loss)."""
    truth = np.searchsorted(model.langs, langs) if langs else np.zeros(0, np.int64)
    model.thresholds = np.full(len(model.langs), np.inf)
    for j in np.unique(truth):
        model.thresholds[j] = np.quantile(own[truth == j], 1 - reject)
    if len(truth):
        model.sharpness = float(SHARPNESS[int(np.argmin(loss.mean(axis=0)))])


def train(docs: DataFrame, learn_from: Column | None = None, sample_docs: int = SAMPLE_DOCS,
          sample_chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> KneserNey | None:
    """Count, fit and calibrate; None where no document may be learned from.

    Rows need a language, a text and (by default) an id whose crc32 is not held
    out.  A language's rows are sampled by a hash of the id at the rate that
    meets both bounds on average.  Every n-gram of the sample counts, whatever
    the number of languages."""
    allowed = ~held_out(F.col(id_col)) if learn_from is None else learn_from
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & allowed).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("chars")).collect()
    if not sizes:
        return None
    rates = [min(1.0, sample_docs / r["n"], sample_chars / max(r["chars"], 1)) for r in sizes]
    rate = F.map_from_arrays(F.lit([r["lang"] for r in sizes]), F.lit(rates))[F.col("lang")]
    u = unit_hash("id", seed=23)
    drawn = rows.where(u < rate).withColumn("calibrates", unit_hash("id", seed=29) < CALIBRATE)
    grams = (map_arrow(drawn.where("NOT calibrates").select("lang", "text"), _count_grams,
                       "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    table = grams.toArrow().combine_chunks()
    if not table.num_rows:
        return None
    coded = column(table, "lang").dictionary_encode()
    number = coded.indices.to_numpy()
    order = np.argsort(number, kind="stable")
    ends = np.cumsum(np.bincount(number))
    counts = {}
    for lang, a, b in zip(coded.dictionary.to_pylist(), np.concatenate(([0], ends[:-1])), ends, strict=True):
        own = table.take(pa.array(order[a:b]))
        codes = np.frombuffer("".join(own["gram"].to_pylist()).encode("utf-32-le"), dtype="<u4").reshape(-1, ORDER)
        counts[lang] = (codes, own["n"].to_numpy())
    model = fit(counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = F.col("lang").isin(model.langs)
    seen = map_arrow(drawn.where(F.col("calibrates") & own).select("lang", "text"), _entropy_rows(shared),
                     "lang string, own double, loss array<double>").collect()
    calibrate(model, [r["lang"] for r in seen], np.asarray([r["own"] for r in seen]), np.asarray([r["loss"] for r in seen]))
    return model


def _predictor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            model = shared.value
            h, total = entropies(column(piece, "text"), model)
            some = total > 0
            names, score = np.full(len(h), "und", dtype=object), np.zeros(len(h))
            rejected, best = np.ones(len(h), bool), np.zeros(len(h))
            if some.any():
                first = h[some].argmin(axis=1)
                low = h[some].min(axis=1)
                names[some] = np.asarray(model.langs, dtype=object)[first]
                score[some] = _softmax(h[some], model.sharpness)[np.arange(len(first)), first]
                rejected[some] = low > model.thresholds[first]
                best[some] = low
            yield pa.RecordBatch.from_arrays([
                column(piece, "doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected),
                pa.array(best, mask=~some)], ["doc_id", "lang_pred", "score", "rejected", "nats_per_char"])
    return run


def identify(docs: DataFrame, model: KneserNey | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score, rejected, nats_per_char``.

    ``lang_pred`` is the language of the lowest cross-entropy of the whole
    text (ties: the first by code point), ``und`` for a null text and one
    without a letter; then ``score`` is 0 and ``rejected`` true.  ``rejected``
    also marks texts beyond their language's calibrated threshold, whose
    ``lang_pred`` still names the nearest language.  Without a model every
    text is ``und``.  Repeated rows are judged each; an empty table gives an
    empty result."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        out = rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                          F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("nats_per_char"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the sample's n-grams
        out = map_arrow(rows, _predictor(shared),
                        "doc_id bigint, lang_pred string, score double, rejected boolean, nats_per_char double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected",
                      "nats_per_char")

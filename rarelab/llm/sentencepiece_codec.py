"""SentencePiece models run by the `tokenizers` library.

The model file (a protobuf message) is parsed here; from it the parts of a
`tokenizers` pipeline are rebuilt: the normaliser, the marker that stands for a
space, the pieces with their scores (a unigram model) or the merges that the
scores imply (a BPE model), and the fallback to byte pieces.

No piece of such a model runs on from another character into a space marker, so
a text's ids are those of its space-separated words.  Each distinct word of a
batch is encoded once, in batches with a thread for each core of the task
(`spark.task.cpus`, one by default), and compared with the SentencePiece
library's own ids: where the two differ the document says so."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

from rarelab.llm.common import column, map_arrow, pieces
from rarelab.llm.encoding import ranges

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
UNIGRAM, BPE = 1, 2
WORDS_KEPT = 100_000  # words whose ids a worker keeps
WORDS_AT_ONCE = 8192
ENCODE_BYTES = 2 << 20  # text encoded at once


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message: integers and raw bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, message[at:at + n]
            at += n


@dataclass
class SentencePieceModel:
    """What the model file says.  Field numbers are those of the public schema."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    space_after: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> SentencePieceModel:
        model = cls()
        for number, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode("utf-8")
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                model.pieces.append((piece, score, kind))
            elif number == 2:
                for n, v in _fields(value):
                    if n == 3:
                        model.kind = v
                    elif n == 35:
                        model.byte_fallback = bool(v)
                    elif n == 24:
                        model.space_after = bool(v)
                    elif n == 40:
                        model.unk_id = v
            elif number == 3:
                for n, v in _fields(value):
                    if n == 2:
                        model.charsmap = v
                    elif n == 3:
                        model.dummy_prefix = bool(v)
                    elif n == 4:
                        model.squeeze = bool(v)
                    elif n == 5:
                        model.escape = bool(v)
        return model


def merges_of(model: SentencePieceModel) -> list[tuple[str, str]]:
    """The merges of a BPE model, best first: every way to make a piece of two
    others, by the piece's score, then by its two halves' ids."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind == NORMAL}
    found = []
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                found.append((-model.pieces[i][1], left, right, piece[:cut], piece[cut:]))
    return [(a, b) for *_, a, b in sorted(found)]


def normaliser(model: SentencePieceModel) -> normalizers.Normalizer | None:
    """The normaliser of a SentencePiece model."""
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix and not model.space_after:
        steps.append(normalizers.Prepend(SPACE if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", SPACE))
    return normalizers.Sequence(steps) if steps else None


def build(model: SentencePieceModel) -> Tokenizer:
    """The `tokenizers` pipeline of a SentencePiece model.

    User-defined pieces are added tokens.  They are found in normalised text,
    and a normaliser of the pipeline would put a marker before each, so such a
    pipeline has none and takes text that :func:`normaliser` has been through."""
    unk = model.pieces[model.unk_id][0]
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, merges_of(model), unk_token=unk,
                          fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models are supported")
    out = Tokenizer(core)
    own = [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        out.add_tokens(own)
    elif (steps := normaliser(model)) is not None:
        out.normalizer = steps
    ends = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        ends.append(decoders.Strip(" ", 1, 0))
    out.decoder = decoders.Sequence(ends)
    return out


def use_cores() -> int:
    """The threads of a batch: the cores of this task, one outside of tasks."""
    task = TaskContext.get()
    n = max(1, task.cpus()) if task else 1
    os.environ["RAYON_NUM_THREADS"] = str(n)
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if n > 1 else "false"
    return n


class Codec:
    """Encode and decode whole texts with a SentencePiece model file's bytes."""

    def __init__(self, data: bytes):
        self.model = SentencePieceModel.parse(data)
        self.tokenizer = build(self.model)
        self.before = normaliser(self.model) if any(k == USER_DEFINED for _, _, k in self.model.pieces) else None
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        m = self.model
        crossing = any(SPACE in p.lstrip(SPACE) for p, _, kind in m.pieces if kind == NORMAL)
        # a word at a time: the identity normaliser, one marker before each word, no piece over its end
        self.wordwise = (not m.charsmap and not m.squeeze and m.escape and m.dummy_prefix and not m.space_after
                         and not crossing and all(kind != USER_DEFINED for _, _, kind in m.pieces))
        self.bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind in (CONTROL, UNUSED)
                      else " ⁇ ".encode() if kind == UNKNOWN else p.replace(SPACE, " ").encode()
                      for p, _, kind in m.pieces]
        self.byte_flat = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.byte_count = np.asarray([len(b) for b in self.bytes], dtype=np.int64)
        self.byte_start = np.cumsum(self.byte_count) - self.byte_count
        self.place: dict[str, int] = {}
        self.ids, self.count, self.same = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, bool)

    def _fresh(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in turn, how many each text has, and whether the two libraries agree on it."""
        threads = use_cores()
        ids, counts, agree = [np.empty(0, np.int32)], [np.empty(0, np.int64)], [np.empty(0, bool)]
        for at in range(0, len(texts), WORDS_AT_ONCE):
            part = texts[at:at + WORDS_AT_ONCE]
            given = [self.before.normalize_str(t) for t in part] if self.before else part
            ours = [e.ids for e in self.tokenizer.encode_batch_fast(given, add_special_tokens=False)]
            theirs = self.library.encode(part, num_threads=threads)
            same = [a == b for a, b in zip(ours, theirs, strict=True)]
            count = np.fromiter(map(len, ours), dtype=np.int64, count=len(part))
            ids.append(np.fromiter((i for x in ours for i in x), dtype=np.int32, count=int(count.sum())))
            counts.append(count)
            agree.append(np.asarray(same, dtype=bool))
        return np.concatenate(ids), np.concatenate(counts), np.concatenate(agree)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, offsets, parity)`` of whole texts; null: no ids.  ``parity``: the two libraries agree on
        every part of the text."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        if self.wordwise:
            # a text that starts or ends with a space, doubles one or spells the marker is encoded as a whole
            odd = pc.match_substring_regex(texts, f"^ | $|  |{SPACE}").to_numpy(zero_copy_only=False)
        else:
            odd = np.ones(n, bool)
        whole = np.flatnonzero(odd)
        plain = pc.if_else(pa.array(odd), "", texts)
        lists = pc.split_pattern(plain, " ")
        flat = lists.flatten()
        coded = flat.dictionary_encode()
        at = lists.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary.to_pylist()
        get = self.place.get
        where = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(where < 0)
        new = [words[i] for i in missing]
        extra = [texts[int(i)].as_py() for i in whole]
        ids, count, same = self._fresh(new + extra)
        base = len(self.count)
        ids, count = np.concatenate((self.ids, ids)), np.concatenate((self.count, count))
        same = np.concatenate((self.same, same))
        where[missing] = base + np.arange(len(new))
        room = max(0, WORDS_KEPT - len(self.place))
        kept = new[:room]
        self.place.update((w, base + k) for k, w in enumerate(kept))
        starts = np.cumsum(count) - count
        word = where[codes]
        doc = np.repeat(np.arange(n), np.diff(at))
        if len(whole):  # put each whole text in the place of its empty word
            word[at[whole]] = base + len(new) + np.arange(len(whole))
        bad = np.bincount(doc[~same[word]], minlength=n)
        lengths = count[word]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        out = ids[ranges(starts[word], lengths)]
        self.count, self.same = count[:base + len(kept)], same[:base + len(kept)]
        self.ids = ids[:int(self.count.sum())]
        return out, ends[at], bad == 0

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of id sequences (binary: byte pieces may spell anything); control pieces vanish, and so
        does the space of the first marker."""
        n = self.byte_count[ids]
        flat = self.byte_flat[ranges(self.byte_start[ids], n)]
        ends = np.concatenate(([0], np.cumsum(n)))[offsets]
        if self.model.dummy_prefix:
            some = np.flatnonzero(np.diff(ends) > 0)
            drop = some[flat[ends[some]] == 32]
            flat = np.delete(flat, ends[drop])
            shift = np.zeros(len(ends), np.int64)
            shift[drop + 1] = 1
            ends = ends - np.cumsum(shift)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [
            None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())])


@lru_cache(2)
def codec(data: bytes) -> Codec:
    """The codec of this Python worker; its word table serves task after task."""
    return Codec(data)


def _encoder(shared, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ENCODE_BYTES):
            c = codec(shared.value)
            texts = column(piece, "text")
            ids, offsets, parity = c.encode(texts)
            raw = ids.astype("<u4").tobytes()
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            back = c.decode(ids, offsets)
            spaced = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
            whole = pc.equal(back, spaced.cast(pa.large_binary()))
            cols = [column(piece, "doc_id"), pa.array(np.diff(offsets)), pa.array(crc, pa.int64()), pa.array(parity), whole]
            names = ["doc_id", "n_tokens", "ids_crc32", "parity", "round_trip"]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)
    return run


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids_crc32, parity, round_trip`` and ``ids``.

    ``model`` holds the model file's bytes.  A null or empty text has no ids.
    The ids are the rebuilt pipeline's; ``parity``: the SentencePiece library
    gives the same ids.  ``round_trip``: decoding gives the
    text again, the marker character itself standing for a space.  Nothing is
    shuffled; repeated rows are encoded alike; an empty table gives an empty
    result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a model file, some hundred kilobytes
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(rows, _encoder(shared, with_ids), "doc_id bigint, n_tokens bigint, ids_crc32 bigint, "
                     "parity boolean, round_trip boolean" + (", ids array<int>" if with_ids else ""))


def _decoder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            lists = column(piece, "ids")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            back = codec(shared.value).decode(lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lengths))))
            text = [b.decode("utf-8", errors="replace") for b in back.to_pylist()]
            yield pa.RecordBatch.from_arrays([column(piece, "doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])
    return run


def decode(tokens: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``; null ids give an empty text, bytes that are no UTF-8 U+FFFD."""
    shared = tokens.sparkSession.sparkContext.broadcast(model)
    return map_arrow(tokens.select("doc_id", "ids"), _decoder(shared), "doc_id bigint, text string")

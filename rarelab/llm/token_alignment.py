"""Alignment of two tokenizers' tokens, and how often their ids meet.

Both tokenizers write the same bytes, a space and the text, so a token is a byte
range.  In a batch, `merge_asof` by document finds for the start of every token
the other side's token that covers it; both directions together give every pair
of tokens whose ranges overlap, and byte offsets where tokens of both sides end
cut a document into groups.

How many documents hold an id pair linked is counted over the corpus.  A batch
(a chunk) writes down its documents' pairs as numbers into its own list of
distinct pairs, and only those lists, far shorter than the texts, are counted,
joined with the counts and brought back to the chunk.

Both tokenizers break before a space that follows a character other than white
space.  A long text is aligned in stretches that end there, and the pieces
between such breaks are encoded once and kept from batch to batch."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rarelab.llm.common import column, map_arrow, pieces
from rarelab.llm.encoding import ranges
from rarelab.session import cut_lineage, expose_package

STRETCH_BYTES = 4 << 20  # text aligned at once
SEGMENTS_KEPT = 200_000  # encoded pieces that a worker keeps
ZSTD = pa.Codec("zstd", 1)


def byte_level_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes stand for
    themselves, the others take the characters from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = count(0x100)
    return {chr(b) if b in shown else chr(next(spare)): b for b in range(256)}


class ByteLevel:
    """Side A: a byte-level BPE of the `tokenizers` library; the strings of special tokens are plain text."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get(
                "use_regex", True) or pre.get("add_prefix_space"):
            raise ValueError("side A must be a byte-level BPE without a normaliser that cuts at spaces itself")
        alphabet = byte_level_alphabet()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(c in alphabet for c in token)
            self.bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()

    def encode(self, segments: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]


class Pieces:
    """Side B: a SentencePiece model, which puts a space before a text itself."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in names) or self.library.encode(["a  b "]) != [
                self.library.encode("a") + self.library.encode(" b ")]:
            raise ValueError("side B must keep its spaces and have no piece that runs on over one")
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.bytes = [bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for p in names]

    def encode(self, segments: list[str]) -> list[list[int]]:
        return self.library.encode([s[1:] for s in segments], num_threads=1)


def breaks(raw: np.ndarray) -> np.ndarray:
    """Offsets of spaces behind a character that is no white space of any kind: both sides start a token there."""
    at = np.flatnonzero(raw == 0x20)
    at = at[at > 0]
    one = raw[at - 1]
    two, three = raw[np.maximum(at - 2, 0)], raw[np.maximum(at - 3, 0)]
    # U+0085 and U+00A0 start with C2, the wider white space with E1, E2 or E3; other characters of those are spared
    wide = (one >= 0x80) & (((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
                            | ((two >= 0x80) & (two < 0xC0) & (three >= 0xE1) & (three <= 0xE3)))
    plain = (one != 0x20) & ~((one >= 9) & (one <= 13)) & ~((one >= 0x1C) & (one <= 0x1F))
    return at[plain & ~wide]


class Side:
    """Ids and byte lengths of the encoded pieces, one after the other."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.width = np.asarray([len(b) for b in tokenizer.bytes], dtype=np.int64)
        self.ids, self.count = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, segments: list[str]) -> list[bool]:
        """Encode pieces behind those known; whether the tokens' bytes are the piece's."""
        found = self.tokenizer.encode(segments)
        self.count = np.concatenate((self.count, [len(x) for x in found])).astype(np.int64)
        self.ids = np.concatenate((self.ids, [i for x in found for i in x])).astype(np.int64)
        spelled = self.tokenizer.bytes
        return [b"".join([spelled[i] for i in x]) == s.encode() for x, s in zip(found, segments, strict=True)]

    def forget(self, kept: int) -> None:
        self.count = self.count[:kept]
        self.ids = self.ids[:int(self.count.sum())]

    def read(self, codes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
        """Of pieces in turn: the tokens' ids, the offset behind each, and ``start, doc, token`` rows."""
        n = self.count[codes]
        starts = np.cumsum(self.count) - self.count
        ids = self.ids[ranges(starts[codes], n)]
        ends = np.cumsum(self.width[ids])
        rows = pd.DataFrame({"start": ends - self.width[ids], "doc": np.repeat(doc, n), "token": np.arange(len(ids))})
        return ids, ends, rows


class Stretch:
    """The alignment of consecutive pieces of one or more documents."""

    def __init__(self, a: Side, b: Side, codes: np.ndarray, doc: np.ndarray):
        self.a_ids, a_ends, a_rows = a.read(codes, doc)
        self.b_ids, b_ends, b_rows = b.read(codes, doc)
        self.a_doc, self.b_doc = a_rows["doc"].to_numpy(), b_rows["doc"].to_numpy()
        over_a = pd.merge_asof(a_rows, b_rows, on="start", by="doc", suffixes=("", "_b"))["token_b"].to_numpy()
        over_b = pd.merge_asof(b_rows, a_rows, on="start", by="doc", suffixes=("", "_a"))["token_a"].to_numpy()
        # the second direction adds the starts that lie inside a token; equal starts came with the first
        inside = np.flatnonzero(a_rows["start"].to_numpy()[over_b] < b_rows["start"].to_numpy())
        self.link_a = np.concatenate((np.arange(len(self.a_ids)), over_b[inside]))
        self.link_b = np.concatenate((over_a, inside))
        self.a_last, self.b_last = np.isin(a_ends, b_ends), np.isin(b_ends, a_ends)  # tokens that end a group

    def group_of(self, last: np.ndarray) -> np.ndarray:
        """The group of every token, numbered over the stretch."""
        return np.cumsum(last) - last


class Aligner:
    """Both tokenizers of a worker, and the pieces they have encoded."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = Side(ByteLevel(a_path)), Side(Pieces(b_path))
        self.place: dict[bytes, int] = {}
        self.good = np.empty(0, bool)
        texts = [f"{i}{end}" for side, ends in ((self.a, ",|"), (self.b, ",;")) for i in range(len(side.width)) for end in ends]
        self.spelled = np.asarray(texts, dtype=object)  # an id with "," behind it, or with the end of its side of a group

    def _codes(self, segments: pa.Array) -> np.ndarray:
        coded = segments.dictionary_encode()
        words = coded.dictionary.to_pylist()
        where = np.fromiter((self.place.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(where < 0)
        if len(missing):
            where[missing] = len(self.good) + np.arange(len(missing))
            new = [words[i].decode() for i in missing]
            same = np.logical_and(self.a.add(new), self.b.add(new))
            room = max(0, SEGMENTS_KEPT - len(self.place))
            self.place.update((words[i], int(where[i])) for i in missing[:room])
            self.good = np.concatenate((self.good, same))
        return where[coded.indices.to_numpy(zero_copy_only=False)]

    def _forget(self) -> None:
        kept = len(self.place)
        self.good = self.good[:kept]
        self.a.forget(kept)
        self.b.forget(kept)

    def stretches(self, texts: pa.Array) -> Iterator[Stretch]:
        """The stretches of whole texts, in order; ``doc`` is the text's place.  Texts without tokens are left out."""
        large = pa.large_string()
        spaced = pc.binary_join_element_wise(pa.scalar("", large), pc.fill_null(texts, "").cast(large), pa.scalar(" ", large))
        spaced = pc.if_else(pc.equal(pc.binary_length(spaced), 1), pa.scalar("", large), spaced)  # empty: no space either
        starts = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset:spaced.offset + len(spaced) + 1]
        if starts[-1] == starts[0]:
            return
        raw = np.frombuffer(spaced.buffers()[2], np.uint8)[:starts[-1]]
        own = starts[:-1][np.diff(starts) > 0]
        inner = breaks(raw)
        cuts = np.union1d(inner[~np.isin(inner + 1, starts)], own)  # a text's last space stays with what is before it
        edges = np.append(cuts, starts[-1])
        segments = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [
            None, pa.py_buffer(edges.astype(np.int64).tobytes()), spaced.buffers()[2]])
        doc = np.searchsorted(starts, cuts, side="right") - 1
        codes = self._codes(segments)
        bad = np.unique(doc[~self.good[codes]])
        live = ~np.isin(doc, bad)
        codes, doc, size = codes[live], doc[live], np.diff(edges)[live]
        part = (np.cumsum(size) - 1) // STRETCH_BYTES
        for lo, hi in zip(*(lambda e: (e[:-1], e[1:]))(np.flatnonzero(np.diff(part, prepend=-1, append=-1))), strict=True):
            yield Stretch(self.a, self.b, codes[lo:hi], doc[lo:hi])
        self._forget()


@lru_cache(1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this Python worker; its pieces serve task after task."""
    return Aligner(a_path, b_path)


def _runs(doc: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(document, from, to)`` of the runs of equal numbers."""
    edges = np.concatenate(([0], np.flatnonzero(np.diff(doc)) + 1, [len(doc)])) if len(doc) else [0]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield int(doc[lo]), int(lo), int(hi)


class Chunk:
    """What the documents of one batch have: counts, the digest of their groups, and their id pairs."""

    def __init__(self, tools: Aligner, texts: pa.Array):
        n = len(texts)
        self.sums = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
        digests: dict[int, object] = {}
        width = len(tools.b.width)
        span = len(tools.a.width) * width
        keys, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s in tools.stretches(texts):
            for name, which in (("n_a", s.a_doc), ("n_b", s.b_doc), ("n_groups", s.a_doc[s.a_last]),
                                ("n_links", s.a_doc[s.link_a])):
                self.sums[name] += np.bincount(which, minlength=n)
            self._digest(tools, s, digests)
            key, m = np.unique(s.a_doc[s.link_a] * span + s.a_ids[s.link_a] * width + s.b_ids[s.link_b], return_counts=True)
            keys.append(key)
            times.append(m)
        self.sha = [digests[i].hexdigest() if i in digests else "" for i in range(n)]
        key, back = np.unique(np.concatenate(keys), return_inverse=True)  # a long text has a pair in several stretches
        self.times = np.bincount(back, weights=np.concatenate(times), minlength=len(key)).astype(np.int64)
        self.pairs, self.codes, self.n_docs = np.unique(key % span, return_inverse=True, return_counts=True)
        self.ends = np.searchsorted(key, np.arange(n + 1) * span)

    @staticmethod
    def _digest(tools: Aligner, s: Stretch, digests: dict) -> None:
        group = np.concatenate((2 * s.group_of(s.a_last), 2 * s.group_of(s.b_last) + 1))
        text = np.concatenate((2 * s.a_ids + s.a_last, 2 * (len(tools.a.width) + s.b_ids) + s.b_last))
        doc = np.concatenate((s.a_doc, s.b_doc))
        order = np.argsort(group, kind="stable")
        words = tools.spelled[text[order]].tolist()
        for i, lo, hi in _runs(doc[order]):
            part = "".join(words[lo:hi])[:-1]
            if i in digests:
                digests[i].update(b";" + part.encode())
            else:
                digests[i] = hashlib.sha256(part.encode())

    def packed(self, i: int) -> bytes:
        """The pairs of a document, ascending, and how often it links each; compressed."""
        lo, hi = self.ends[i], self.ends[i + 1]
        both = np.concatenate((np.diff(self.codes[lo:hi], prepend=0), self.times[lo:hi])).astype("<u4")
        return ZSTD.compress(both.tobytes(), asbytes=True)


def _unpack(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(ZSTD.decompress(blob, 8 * n, asbytes=True), "<u4").astype(np.int64)
    return np.cumsum(both[:n]), both[n:]


_CHUNKS = ("chunk string, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "n_pairs int, packed binary, pairs array<bigint>, n_docs array<int>")


def _chunks(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, task = aligner(a_path, b_path), TaskContext.get().partitionId()
        for k, piece in enumerate(pieces(batches, STRETCH_BYTES)):
            c = Chunk(tools, column(piece, "text"))
            n, name = piece.num_rows, f"{task}:{k}"
            empty = pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))
            names = [f.split()[0] for f in _CHUNKS.split(", ")]
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * n), column(piece, "doc_id"), *[pa.array(c.sums[x]) for x in names[2:6]], pa.array(c.sha),
                pa.array(np.diff(c.ends).astype(np.int32)), pa.array([c.packed(i) for i in range(n)], pa.binary()), *empty],
                names)
            if len(c.pairs):  # the chunk's own list of pairs: a row without a packed document
                none = [pa.nulls(1, pa.int64())] * 5
                yield pa.RecordBatch.from_arrays([
                    pa.array([name]), *none, pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
                    pa.array([c.pairs], pa.list_(pa.int64())), pa.array([c.n_docs], pa.list_(pa.int32()))], names)
    return run


def _weigh(docs: pa.Table, found: pa.Table) -> pa.Table:
    """A chunk's documents with what the corpus says of their pairs."""
    count_of, best_of = np.zeros(found.num_rows, np.int64), np.zeros(found.num_rows, bool)
    at = found["code"].to_numpy()
    count_of[at], best_of[at] = found["n"].to_numpy(), found["best"].to_numpy(zero_copy_only=False)
    best, total = [], []
    for blob, n in zip(docs["packed"].to_pylist(), docs["n_pairs"].to_pylist(), strict=True):
        codes, times = _unpack(blob, n)
        best.append(int(times[best_of[codes]].sum()))
        total.append(int((times * count_of[codes]).sum()))
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return (out.append_column("n_best", pa.array(best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
            .append_column("groups_sha256", docs["groups_sha256"]))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))


def _with_pair_counts(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    chunks = cut_lineage(map_arrow(docs, _chunks(a_path, b_path), _CHUNKS))
    lists = chunks.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("code", "p"))
    lists = lists.select("chunk", "code", F.col("p.pairs").alias("pair"), F.col("p.n_docs").alias("n_docs"))
    width = len(Pieces(b_path).bytes)
    counts = lists.groupBy("pair").agg(F.sum("n_docs").alias("n")).withColumn("a_id", F.floor(F.col("pair") / F.lit(width)))
    # an id has at most as many partners as the other vocabulary has ids
    best = F.col("n") == F.max("n").over(Window.partitionBy("a_id"))
    counts = cut_lineage(counts.select("pair", "n", best.alias("best")))
    return chunks.where("packed IS NOT NULL").drop("pairs", "n_docs"), lists.join(counts, "pair").select(
        "chunk", "code", "pair", "n", "best", "n_docs")


def token_links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``a_path`` is a byte-level BPE file of the `tokenizers` library, ``b_path`` a
    SentencePiece model.  A encodes a space and the whole text, B the text, whose
    space it adds.  ``n_links`` counts pairs of tokens whose byte ranges overlap;
    a pair's count is the number of rows that hold its ids linked, and
    ``count_sum`` adds it up over the links; ``n_best`` are links whose count is
    the highest of their A id.  ``groups_sha256`` is the sha256 of the groups'
    ids, ``a1,a2|b1;a3|b2``.

    Null and empty texts, and texts whose tokens of either side do not spell the
    space and the text (U+2581 in a text, say), have zeros and ''.  Repeated
    rows count each, rows without an id as well.  An empty table gives an empty
    result."""
    rows, lists = _with_pair_counts(_rows(docs, id_col, text_col), a_path, b_path)
    expose_package(docs.sparkSession)
    found = lists.select(F.col("chunk").alias("of"), "code", "n", "best")
    return rows.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(
        _weigh, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
                "groups_sha256 string")


def pair_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a_id, b_id, n_docs, best``: every id pair linked anywhere, the rows that link it, and whether no
    other pair of its A id has more."""
    _, lists = _with_pair_counts(_rows(docs, id_col, text_col), a_path, b_path)
    width = len(Pieces(b_path).bytes)
    return lists.groupBy("pair").agg(F.first("n").alias("n_docs"), F.first("best").alias("best")).select(
        F.floor(F.col("pair") / F.lit(width)).cast("int").alias("a_id"), (F.col("pair") % F.lit(width)).cast("int").alias("b_id"),
        "n_docs", "best")


def _aligned(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = aligner(a_path, b_path)
        for piece in pieces(batches, STRETCH_BYTES):
            found = [[[] for _ in range(6)] for _ in range(piece.num_rows)]
            for s in tools.stretches(column(piece, "text")):
                order = np.lexsort((s.link_b, s.link_a))
                left, right = s.link_a[order], s.link_b[order]
                b_at = {i: (lo, hi) for i, lo, hi in _runs(s.b_doc)}
                l_at = {i: (lo, hi) for i, lo, hi in _runs(s.a_doc[left])}
                a_group, b_group = s.group_of(s.a_last), s.group_of(s.b_last)
                for i, lo, hi in _runs(s.a_doc):
                    (b0, b1), (l0, l1), out = b_at[i], l_at[i], found[i]
                    na, nb = len(out[0]), len(out[1])
                    groups = out[2][-1] + 1 if out[2] else 0
                    for k, part in enumerate((s.a_ids[lo:hi], s.b_ids[b0:b1], a_group[lo:hi] - a_group[lo] + groups,
                                              b_group[b0:b1] - b_group[b0] + groups, left[l0:l1] - lo + na,
                                              right[l0:l1] - b0 + nb)):
                        out[k].extend(part.tolist())
            yield pa.RecordBatch.from_arrays([column(piece, "doc_id"), *[
                pa.array([x[k] for x in found], pa.list_(pa.int32())) for k in range(6)]],
                ["doc_id", "a_ids", "b_ids", "a_group", "b_group", "link_a", "link_b"])
    return run


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment itself, one row per input row: ``doc_id, a_ids, b_ids``, the group of every token
    (``a_group, b_group``, from 0) and the overlapping tokens' places (``link_a, link_b``).  Texts
    without tokens, as in :func:`token_links`, have empty lists."""
    return map_arrow(_rows(docs, id_col, text_col), _aligned(a_path, b_path), "doc_id bigint, a_ids array<int>, b_ids array<int>, "
                     "a_group array<int>, b_group array<int>, link_a array<int>, link_b array<int>")

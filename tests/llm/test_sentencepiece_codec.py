import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from rarelab.llm import sentencepiece_codec as m
from tests.llm.messy import messy, messy_rows, nothing

DATA = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=DATA)


def split(ids, offsets):
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


def test_the_model_file_is_parsed():
    model = m.SentencePieceModel.parse(DATA)
    assert len(model.pieces) == LIBRARY.vocab_size() == 32_000
    for i in (0, 1, 2, 3, 258, 259, 31_999):
        piece, score, kind = model.pieces[i]
        assert piece == LIBRARY.id_to_piece(i) and score == pytest.approx(LIBRARY.get_score(i))
        assert (kind == m.BYTE) == LIBRARY.is_byte(i) and (kind == m.CONTROL) == LIBRARY.is_control(i)
    assert model.kind == m.BPE and model.byte_fallback and not model.squeeze and model.dummy_prefix


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(alphabet="ab ▁\n é<s>0x41", max_size=30), max_size=4))
def test_parity_and_round_trip(texts):
    c = m.codec(DATA)
    ids, at, parity = c.encode(pa.array(texts, pa.string()))
    assert split(ids, at) == [LIBRARY.encode(t) for t in texts] and parity.all()
    assert [c.tokenizer.encode(t, add_special_tokens=False).ids for t in texts] == split(ids, at)
    assert c.decode(ids, at).to_pylist() == [t.replace("▁", " ").encode() for t in texts]
    assert [c.tokenizer.decode(x) for x in split(ids, at)] == [t.replace("▁", " ") for t in texts]


def test_a_full_word_table(monkeypatch):
    monkeypatch.setattr(m, "WORDS_KEPT", 4)
    c = m.Codec(DATA)
    texts = [r[1] for r in messy_rows() if r[0] != 8]
    for _ in range(3):
        ids, at, parity = c.encode(pa.array(texts, pa.string()))
        assert split(ids, at) == [LIBRARY.encode(t or "") for t in texts] and parity.all()


def field(number, kind, value):
    key = bytes([*_varint(number << 3 | kind)])
    if kind == 0:
        return key + bytes(_varint(value))
    return key + (value if kind == 5 else bytes(_varint(len(value))) + value)


def _varint(n):
    while n > 127:
        yield n & 127 | 128
        n >>= 7
    yield n


def unigram_model():
    """A small unigram model with byte fallback, written by hand."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", -9.0, 6) for i in range(256)]
    for i, p in enumerate(["▁", "a", "b", "c", "ab", "▁ab", "abc", "bc", "▁a", "ca", "▁▁", "cab"]):
        pieces.append((p, -2.0 - 0.37 * i, 1))
    body = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, k)) for p, s, k in pieces)
    trainer = field(3, 0, 1) + field(35, 0, 1) + field(40, 0, 0)
    return body + field(2, 2, trainer) + field(3, 2, field(3, 0, 1) + field(4, 0, 0) + field(5, 0, 1))


def test_unigram_model():
    data = unigram_model()
    library, c = sentencepiece.SentencePieceProcessor(model_proto=data), m.Codec(data)
    texts = ["abc cab", "a b  c", "", "abcabcab ab", "é ab", "ca bca"]
    ids, at, _ = c.encode(pa.array(texts))
    assert split(ids, at) == [library.encode(t) for t in texts]
    assert [c.tokenizer.encode(t).ids for t in texts] == [library.encode(t) for t in texts]
    assert c.decode(ids, at).to_pylist() == [t.encode() for t in texts]


def test_messy_rows(spark):
    got = m.encode(messy(spark), DATA).collect()
    key = lambda x: (str(x[0]), x[1])
    expected = [(r[0], LIBRARY.encode(r[1] or "")) for r in messy_rows()]
    assert sorted([(r["doc_id"], list(r["ids"])) for r in got], key=key) == sorted(expected, key=key)
    assert all(r["parity"] and r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
    assert all(r["ids_crc32"] == zlib.crc32(np.asarray(r["ids"], "<u4").tobytes()) for r in got)
    back = m.decode(m.encode(messy(spark), DATA), DATA).collect()
    assert sorted([(r["doc_id"], r["text"]) for r in back], key=str) == sorted(
        [(r[0], (r[1] or "").replace("▁", " ")) for r in messy_rows()], key=str)
    assert m.encode(nothing(spark), DATA).collect() == []
    assert m.decode(m.encode(nothing(spark), DATA), DATA).collect() == []


def bpe_model_with_user_pieces():
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("<sep>", 0.0, 4), ("ab", 0.0, 4)]
    pieces += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    for i, p in enumerate(["▁a", "bc", "▁ab", "abc", "cab", "▁", "a", "b", "c"]):
        pieces.append((p, -float(i), 1))
    body = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, k)) for p, s, k in pieces)
    trainer = field(3, 0, 2) + field(35, 0, 1) + field(40, 0, 0)
    return body + field(2, 2, trainer) + field(3, 2, field(3, 0, 1) + field(4, 0, 0) + field(5, 0, 1))


def test_user_defined_pieces_are_tokens():
    data = bpe_model_with_user_pieces()
    library, c = sentencepiece.SentencePieceProcessor(model_proto=data), m.Codec(data)
    texts = ["abc cab", "a<sep>bc", "<sep>", "a b <sep> c", "", "abcabcab ab", "ca bca"]
    ids, at, parity = c.encode(pa.array(texts))
    assert split(ids, at) == [library.encode(t) for t in texts] and parity.all()


def test_the_ids_are_the_rebuilt_pipelines_own():
    c = m.Codec(DATA)

    class Other:
        def encode(self, texts, num_threads):
            return [[5] if "b" in t else LIBRARY.encode(t) for t in texts]

    c.library = Other()
    ids, at, parity = c.encode(pa.array(["a", "a b"]))
    assert split(ids, at) == [LIBRARY.encode("a"), LIBRARY.encode("a b")] and parity.tolist() == [True, False]

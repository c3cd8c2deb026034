import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rarelab.llm import encoding
from rarelab.llm.token_counts import hist_totals, length_histogram, length_quantile, truncated_total
from rarelab.llm.token_files import NO_ID, read_tokens, write_tokens
from tests.llm.messy import messy, messy_rows, nothing

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PLAIN = {p: Tokenizer.from_file(p) for p in (WORDS, BYTES)}


def ids_of(path, text):
    return PLAIN[path].encode(text or "", add_special_tokens=False).ids


def split(ids, offsets):
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


def test_only_the_word_tokenizer_goes_by_words():
    assert encoding.encoder(WORDS).wordwise and not encoding.encoder(BYTES).wordwise


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(alphabet="aB.,'s <|>é\n\t1́ İ", max_size=40), max_size=5))
def test_ids_are_those_of_whole_texts(texts):
    e = encoding.encoder(WORDS)
    ids, at = e.encode(pa.array(texts, pa.string()))
    assert split(ids, at) == [ids_of(WORDS, t) for t in texts]
    assert e.lengths(pa.array(texts, pa.string())).tolist() == [len(x) for x in split(ids, at)]


def test_special_tokens_and_a_full_word_table(monkeypatch):
    monkeypatch.setattr(encoding, "WORDS_KEPT", 3)
    monkeypatch.setattr(encoding, "WORDS_AT_ONCE", 2)
    e = encoding.WordEncoder(WORDS)
    texts = [r[1] for r in messy_rows() if r[0] != 8] + ["<|startoftext|>", "a<|endoftext|>b <|STARTOFTEXT|> c", "x " * 9, "don't, we'll. a.b,c ."]
    for _ in range(3):
        ids, at = e.encode(pa.array(texts, pa.string()))
        assert split(ids, at) == [ids_of(WORDS, t) for t in texts]
    assert len(e.place) == 3 == len(e.known_count)


def expected_files(rows, path, end_id):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    counts = [(i, len(ids_of(path, t)) + 1) for i, t in rows]
    return counts, sorted(zlib.crc32(np.asarray([*ids_of(path, t), end_id], "<u4").tobytes()) for _, t in rows)


@pytest.mark.parametrize(("path", "end_id"), [(WORDS, 2), (BYTES, 50256), (WORDS, 70_000)])
def test_files(spark, tmp_path, path, end_id):
    rows = [(r[0], r[1]) for r in messy_rows()]
    shards, folder = write_tokens(messy(spark).repartition(5), path, end_id, folder=str(tmp_path / "tokens"))
    got = sorted(read_tokens(shards, folder).collect(), key=lambda r: r["start"])
    counts, sums = expected_files(rows, path, end_id)
    assert [r["doc_id"] for r in got] == [i for i, _ in counts]
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted((str(i), n) for i, n in counts)
    assert [r["start"] for r in got] == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in got])))[:-1].tolist()
    assert sorted(r["ids_crc32"] for r in got) == sums
    # the format, read by hand
    seen = 0
    kind = "<u4" if end_id >= 1 << 16 else "<u2"
    for r in sorted(shards.collect(), key=lambda r: r["part"]):
        data, index = r["name"].split("|")
        flat, head = np.memmap(f"{folder}/{data}", kind, "r"), np.memmap(f"{folder}/{index}", "<i8", "r")
        n = int(head[0])
        assert head[1] == flat.dtype.itemsize and len(head) == 2 * n + 3 and head[2] == seen
        seen = int(head[n + 2])
        assert len(flat) == seen - head[2] and flat[-1] == end_id
        ids = head[n + 3:].tolist()
        assert ids == sorted(ids) and (NO_ID in ids) == (r["part"] == min(x["part"] for x in shards.collect()))
    assert seen == sum(n for _, n in counts)


def test_no_files_for_an_empty_table(spark, tmp_path):
    shards, folder = write_tokens(nothing(spark), WORDS, 2, folder=str(tmp_path / "tokens"))
    assert shards.collect() == [] and read_tokens(shards, folder).collect() == []


def test_length_histogram(spark):
    hist = length_histogram(messy(spark), WORDS)
    lengths = np.asarray([len(ids_of(WORDS, r[1])) for r in messy_rows()])
    got = {r["length"]: r for r in hist.collect()}
    assert sorted(got) == sorted(set(lengths.tolist()))
    for n, r in got.items():
        assert r["n_docs"] == (lengths == n).sum() and r["n_tokens"] == n * r["n_docs"]
        assert r["docs_at_least"] == (lengths >= n).sum() and r["tokens_at_least"] == lengths[lengths >= n].sum()
        assert r["tokens_within"] == np.minimum(lengths, n).sum()
    assert hist_totals(hist) == {"docs": len(lengths), "tokens": lengths.sum()}
    for p in (0, 0.3, 0.5, 0.9, 1):
        assert length_quantile(hist, p) == np.quantile(lengths, p, method="inverted_cdf")
    for limit in (0, 1, 5, 1000, 10**7):
        assert truncated_total(hist, limit) == np.minimum(lengths, limit).sum()
    empty = length_histogram(nothing(spark), WORDS)
    assert empty.collect() == [] and length_quantile(empty, 0.5) is None and truncated_total(empty, 5) == 0

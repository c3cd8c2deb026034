import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rarelab.llm import token_alignment as m
from rarelab.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.messy import SCHEMA, messy, messy_rows

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spelled():
    """Bytes of every token, A from the library's own decoder table, B by the contract."""
    alphabet, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            alphabet[chr(b)] = b
        else:
            alphabet[chr(256 + n)] = b
            n += 1
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    a = {i: bytes(alphabet[c] for c in tok) for tok, i in t.get_vocab().items()}
    b = {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        b[i] = bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
    return t, sp, a, b


T, SP, A_BYTES, B_BYTES = spelled()


def whole(text):
    """Ids and byte ranges of a whole text on both sides; None without tokens."""
    if not text:
        return None
    sides = []
    for ids, table in ((T.encode(" " + text, add_special_tokens=False).ids, A_BYTES), (SP.encode(text), B_BYTES)):
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return None
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(table[i])))
            at += len(table[i])
        sides.append(out)
    return sides


def groups_and_links(sides):
    a, b = sides
    common = {e for *_, e in a} & {e for *_, e in b}
    groups, i, j = [], 0, 0
    for end in sorted(common):
        i2 = next(k for k in range(i, len(a)) if a[k][2] == end) + 1
        j2 = next(k for k in range(j, len(b)) if b[k][2] == end) + 1
        groups.append(([x[0] for x in a[i:i2]], [x[0] for x in b[j:j2]]))
        i, j = i2, j2
    links, low = [], 0
    for x, (_, s, e) in enumerate(a):
        while b[low][2] <= s:
            low += 1
        y = low
        while y < len(b) and b[y][1] < e:
            links.append((x, y))
            y += 1
    return groups, links


def brute(rows):
    found = {}
    for _, text in rows:
        if text not in found:
            s = whole(text)
            found[text] = s and (s, *groups_and_links(s))
    pairs = Counter()
    for _, text in rows:
        if found[text]:
            (a, b), _, links = found[text]
            pairs.update({(a[x][0], b[y][0]) for x, y in links})
    best = {}
    for (a, _), n in pairs.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for i, text in rows:
        if not found[text]:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        (a, b), groups, links = found[text]
        ns = [pairs[a[x][0], b[y][0]] for x, y in links]
        line = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(n == best[a[x][0]] for n, (x, _) in zip(ns, links)),
                    sum(ns), hashlib.sha256(line.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_messy(spark):
    got = m.token_links(messy(spark), A, B)
    assert got.columns == COLUMNS
    assert rows_of(got) == brute([(r[0], r[1]) for r in messy_rows()])


def test_odd_texts(spark):
    texts = ["x", " ", "  ", " a", "a ", "a  b", "a \n b", "a\xa0b c", "a　 b", "é ñ ü", "日本 語 テ", "don't  we'll 'S", "\x00 a \x1f b",
             "🙂 🙂🙂 x🙂", "a▁b", "▁", "<0x41> <s> </s> <unk>", "<|endoftext|> <|endoftext|>", "\x85 a\x85 b", "1 000 000", "\t\t a",
             "ⅷ  z", "a" * 5000, "\U0010ffff \U0010ffff", "é á b"]
    rows = [(k, t, None, None, None) for k, t in enumerate(texts)] * 2
    assert rows_of(m.token_links(spark.createDataFrame(rows, SCHEMA), A, B)) == brute([r[:2] for r in rows])


def test_nothing(spark):
    assert m.token_links(spark.createDataFrame([], SCHEMA), A, B).collect() == []
    assert m.token_links(spark.createDataFrame([(1, None, None, None, None)], SCHEMA), A, B).collect() == [
        (1, 0, 0, 0, 0, 0, 0, "")]


def test_pair_counts_and_alignment(spark):
    rows = [(k, t, None, None, None) for k, t in enumerate(["the token aligner", "the tokens", "", None, "the token aligner"])]
    df = spark.createDataFrame(rows, SCHEMA)
    pairs = {(r[0], r[1]): (r[2], r[3]) for r in m.pair_counts(df, A, B).collect()}
    want = Counter()
    for row in m.align_tokens(df, A, B).collect():
        sides = whole(rows[row["doc_id"]][1])
        if sides is None:
            assert [*row][1:] == [[]] * 6
            continue
        groups, links = groups_and_links(sides)
        assert (row["a_ids"], row["b_ids"]) == tuple([x[0] for x in s] for s in sides)
        assert list(zip(row["link_a"], row["link_b"])) == links
        for g, (a, b) in enumerate(groups):
            assert [i for i, x in zip(row["a_ids"], row["a_group"]) if x == g] == a
            assert [i for i, x in zip(row["b_ids"], row["b_group"]) if x == g] == b
        want.update({(row["a_ids"][x], row["b_ids"][y]) for x, y in links})
    assert {k: v[0] for k, v in pairs.items()} == want
    assert all(best == (n == max(v for k, v in want.items() if k[0] == a)) for (a, _), (n, best) in pairs.items())


def test_long_text_in_stretches(monkeypatch):
    """Stretches give what a whole text gives, here with documents that span many."""
    rng = random.Random(1)
    words = ["alpha", "béta", "tokenisation", "x", "12345", "日本", "\n\nnext", "  wide", "it's", "naïve", "🙂"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (3000, 0, 5, 4000, 1)] + [None, "a▁b " * 500]
    tools = m.Aligner(A, B)
    want = m.Chunk(tools, pa.array(texts))
    monkeypatch.setattr(m, "STRETCH_BYTES", 500)
    monkeypatch.setattr(m, "SEGMENTS_KEPT", 5)
    small = m.Aligner(A, B)
    assert len(list(small.stretches(pa.array(texts)))) > 50
    got = m.Chunk(small, pa.array(texts))
    assert got.sha == want.sha and all((got.sums[k] == want.sums[k]).all() for k in got.sums)
    assert [got.packed(i) for i in range(7)] == [want.packed(i) for i in range(7)] and (got.pairs == want.pairs).all()
    (a, b), line = whole(texts[3]), []
    for g, h in groups_and_links((a, b))[0]:
        line.append(",".join(map(str, g)) + "|" + ",".join(map(str, h)))
    assert got.sha[3] == hashlib.sha256(";".join(line).encode()).hexdigest() and got.sums["n_a"][3] == len(a)


TOOLS = m.Aligner(A, B)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab'sé日 \n\t\xa0\x85 　\x1c1.,🙂ñ"), max_size=30))
def test_pieces_equal_the_whole(text):
    got = [s.a_ids.tolist() for s in TOOLS.stretches(pa.array([text]))], [s.b_ids.tolist() for s in TOOLS.stretches(pa.array([text]))]
    sides = whole(text)
    assert got == (([], []) if sides is None else ([[x[0] for x in sides[0]]], [[x[0] for x in sides[1]]]))


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_token_links"](spark, SF_SMALL)
    assert got.columns == COLUMNS and rows_of(got) == brute([tuple(r) for r in docs])

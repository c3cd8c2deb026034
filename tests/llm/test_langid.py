import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rarelab.llm import langid as m
from tests.conftest import SF_CV
from tests.llm.messy import messy, messy_rows, nothing

PAD = chr(m.START) * (m.ORDER - 1)


def grams(words):
    out = Counter()
    for w in words:
        s = PAD + w + chr(m.END)
        out.update(s[i - m.ORDER + 1:i + 1] for i in range(m.ORDER - 1, len(s)))
    return out


class Plain:
    """Interpolated Kneser-Ney by dictionaries."""

    def __init__(self, counts, chars):
        self.floor, self.tables = 1 / (chars + 1), {}
        raw = dict(counts)
        use = dict(counts)
        for k in range(m.ORDER, 0, -1):
            ones, twos = sum(v == 1 for v in use.values()), sum(v == 2 for v in use.values())
            total, kinds = Counter(), Counter()
            for g, v in use.items():
                total[g[:-1]] += v
                kinds[g[:-1]] += 1
            self.tables[k] = (use, ones / (ones + 2 * twos) if ones and twos else 0.5, total, kinds)
            short, n = Counter(), Counter()
            for g, v in raw.items():
                short[g[1:]] += v
                n[g[1:]] += 1
            raw = short
            use = {g: short[g] if g[:1] == chr(m.START) else n[g] for g in short}

    def p(self, gram):
        if not gram:
            return self.floor
        use, d, total, kinds = self.tables[len(gram)]
        lower, h = self.p(gram[1:]), gram[:-1]
        if not total[h]:
            return lower
        return max(use.get(gram, 0) - d, 0) / total[h] + d * kinds[h] / total[h] * lower


def model_of(corpora):
    counts = {}
    for lang, words in corpora.items():
        c = grams(words)
        codes = np.frombuffer("".join(c).encode("utf-32-le"), "<u4").reshape(-1, m.ORDER)
        counts[lang] = (codes, np.asarray(list(c.values())))
    model = m.fit(counts)
    chars = len({g[-1] for w in corpora.values() for g in grams(w)})
    return model, {lang: Plain(grams(words), chars) for lang, words in corpora.items()}


def corpora():
    rng = random.Random(1)
    return {lang: ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(200)]
            for lang, parts in {"xx": ["ab", "ba", "ca"], "yy": ["bad", "ca", "é"]}.items()}


def test_probabilities_match_a_plain_model():
    model, plain = model_of(corpora())
    texts = ["abca", "badéca", "zzz", "a", "caé", "ABBA"]
    h, n = m.entropies(pa.array(texts), model)
    for i, t in enumerate(texts):
        s = PAD + t.lower() + chr(m.END)
        assert n[i] == len(t) + 1
        for j, lang in enumerate(model.langs):
            logs = [math.log(plain[lang].p(s[k - m.ORDER + 1:k + 1])) for k in range(m.ORDER - 1, len(s))]
            assert h[i, j] == pytest.approx(-sum(logs) / len(logs), rel=1e-4)


def test_probabilities_of_a_context_sum_to_one():
    _, plain = model_of(corpora())
    for lang, p in plain.items():
        letters = {g[-1] for g in p.tables[1][0]}
        for h in [PAD, PAD[1:] + "b", "abab", "zzzz"]:
            assert sum(p.p(h + c) for c in letters) <= 1 + 1e-9


def test_only_letters_count():
    model, _ = model_of(corpora())
    one, n = m.entropies(pa.array(["ab, ca! 12_ba", "ab ca ba", "AB-Ca\nba2", None, "", "12 !", "²"]), model)
    assert n.tolist() == [9, 9, 9, 0, 0, 0, 0] and np.isinf(one[3:]).all()
    assert one[0] == pytest.approx(one[1]) and one[0] == pytest.approx(one[2])


def test_held_out_documents_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_CV}/documents.parquet")
    model = m.train(docs)
    got = m.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got) and sum(r["rejected"] for r in got) < 0.1 * len(got)
    strange = spark.createDataFrame([(1, "zxqv kjwx qqzx vvkj " * 20)], "doc_id bigint, text string")
    row = m.identify(strange, model).first()
    assert row["rejected"] and row["lang_pred"] in model.langs


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, "abab caba " * 5 if i % 2 else "badé cabad " * 5, "xx" if i % 2 else "yy") for i in range(300)]
    schema = "doc_id bigint, text string, lang string"
    honest = spark.createDataFrame(rows, schema)
    import zlib
    lies = spark.createDataFrame([(i, t, x if zlib.crc32(str(i).encode()) % 5 else "zz") for i, t, x in rows], schema)
    a, b = m.train(honest), m.train(lies)
    assert a.langs == b.langs == ["xx", "yy"] and a.sharpness == b.sharpness
    assert all((x == y).all() for x, y in zip(a.prob, b.prob))


def test_messy_rows(spark):
    df = messy(spark)
    model = m.train(df)
    got = m.identify(df, model).collect()
    key = lambda x: (str(x[0]), str(x[1]))
    letters = lambda t: any(c.isalpha() for c in t or "")
    assert sorted([(r["doc_id"], r["lang_pred"] == "und") for r in got], key=key) == sorted(
        [(r[0], not letters(r[1])) for r in messy_rows()], key=key)
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") for r in got)
    assert m.train(nothing(spark)) is None and m.train(df.where("lang IS NULL")) is None
    assert {(r["lang_pred"], r["score"]) for r in m.identify(df, None).collect()} == {("und", 0.0)}
    assert m.identify(nothing(spark), model).collect() == []


def test_junk_languages_leave_the_others_whole(spark):
    docs = spark.read.parquet(f"{SF_CV}/documents.parquet").select("doc_id", "text", "lang")
    junk = spark.createDataFrame([(10**6 + i, "the", f"junk{i:03d}") for i in range(100)], docs.schema)
    alone, mixed = m.train(docs), m.train(docs.unionAll(junk))
    assert len(mixed.langs) > 60
    texts = pa.array([r["text"] for r in docs.orderBy("doc_id").limit(40).collect()])
    a, b = m.entropies(texts, alone)[0], m.entropies(texts, mixed)[0]
    own = [mixed.langs.index(x) for x in alone.langs]
    assert np.allclose(a, b[:, own], rtol=1e-5)


def test_scores_do_not_depend_on_how_many_positions_are_scored_at_once(monkeypatch):
    model, _ = model_of(corpora())
    texts = pa.array(["abca badéca, zzz", None, "a caé" * 9, "ABBA ab a ab"])
    whole = m.entropies(texts, model)[0]
    monkeypatch.setattr(m, "CELLS_AT_ONCE", 6)
    assert np.allclose(whole, m.entropies(texts, model)[0])

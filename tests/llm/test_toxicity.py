import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rarelab.llm import toxicity as tox
from rarelab.llm.common import hash64, mix64
from tests.conftest import SF_CV
from tests.llm.messy import messy, nothing


def brute_slots(text):
    words = [w for w in (re.sub(r"[\W_]+", "", x.lower()) for x in re.split(r"[\x20\x09-\x0D]+", text)) if w]
    h = hash64(pa.array(words, pa.string())) if words else np.empty(0, np.uint64)
    out = [int(x) for x in h]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        out += [int(mix64(np.array([(int(a) * salt + int(b)) % 2**64], np.uint64))[0]) for a, b in zip(h, h[gap:])]
    return sorted(x >> (64 - tox.BITS) for x in out)


def test_features_are_words_pairs_and_skips():
    texts = ["You, idiot! you", "", None, "a", " _ b\tc ", "x y z w x"]
    doc, slot = tox.features(pa.array(texts))
    for i, t in enumerate(texts):
        assert sorted(slot[doc == i].tolist()) == brute_slots(t or "")


def test_ftrl_matches_a_plain_loop():
    rule = tox.Ftrl(alpha=0.5, beta=1.0, l1=0.3, l2=0.1)
    rng = np.random.default_rng(1)
    data = [(rng.choice(40, size=rng.integers(0, 6), replace=False).astype(np.int32), int(rng.random() < 0.4)) for _ in range(120)]
    batch = pa.RecordBatch.from_arrays([pa.array([y for _, y in data], pa.int32()),
                                        pa.array([x.tolist() for x, _ in data], pa.list_(pa.int32()))], ["y", "slots"])
    got = {}
    for b in tox._trainer(rule)([batch]):
        got.update(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    z, n = {}, {}

    def weight(k):
        l1 = 0.0 if k == tox.BIAS else rule.l1
        zk = z.get(k, 0.0)
        if abs(zk) <= l1:
            return 0.0
        return -math.copysign(abs(zk) - l1, zk) / ((rule.beta + math.sqrt(n.get(k, 0.0))) / rule.alpha + rule.l2)

    for x, y in data:
        keys = [*x.tolist(), tox.BIAS]
        w = {k: weight(k) for k in keys}
        g = 1 / (1 + math.exp(-sum(w.values()))) - y
        for k in keys:
            root = math.sqrt(n.get(k, 0.0))
            z[k] = z.get(k, 0.0) + g - (math.sqrt(n.get(k, 0.0) + g * g) - root) / rule.alpha * w[k]
            n[k] = n.get(k, 0.0) + g * g
    expected = {k: weight(k) for k in z if weight(k)}
    assert set(got) == set(expected) and len(got) < 41  # L1 leaves some out
    assert all(got[k] == pytest.approx(expected[k], abs=1e-3) for k in got)


def test_held_out_documents_of_the_table(spark):
    docs, labels = spark.read.parquet(f"{SF_CV}/documents.parquet"), spark.read.parquet(f"{SF_CV}/labels.parquet")
    model = tox.train(docs, labels)
    assert 1 < len(model) < 2000  # sparse
    got = tox.score(docs, model)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.95 * len(rows)
    assert not [r for r in rows if r["predicted"] == 1 and r["toxic"] == 0]
    again = {r["doc_id"]: r["score"] for r in tox.score(docs.repartition(5).drop("lang", "source"), model).collect()}
    assert again == {r["doc_id"]: r["score"] for r in got.collect()}
    assert dict(tox.train(docs.repartition(3), labels.repartition(4))) == dict(model)


def test_learns_from_allowed_rows_only(spark):
    docs = spark.createDataFrame([(i, "foul word here" if i % 2 else "kind word here") for i in range(200)], "doc_id bigint, text string")
    flipped = spark.createDataFrame([(i, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(200)],
                                    "doc_id bigint, toxic int")
    honest = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, toxic int")
    assert tox.train(docs, flipped) == tox.train(docs, honest)


def test_messy_rows(spark):
    docs = messy(spark)
    labels = spark.createDataFrame([(5, 0), (8, 1), (8, 0), (2, None), (None, 1), (99, 1), (4, 0), (7, 1)], "doc_id bigint, toxic int")
    model = tox.train(docs, labels)
    got = tox.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1  # null, empty and white space alike
    assert tox.keep_clean(docs, model).columns == docs.columns
    assert tox.keep_clean(docs, model).count() == sum(r["score"] < 0.5 for r in got)
    assert tox.train(docs, labels.where("false")) == [] and tox.train(nothing(spark), labels) == []
    assert {(r["score"], r["predicted"]) for r in tox.score(docs, []).collect()} == {(0.0, 0)}
    assert tox.score(nothing(spark), model).collect() == []
    assert tox.keep_clean(docs, []).count() == docs.count()

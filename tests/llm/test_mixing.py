import random
import re

import pytest

from rarelab.llm.mixing import mix, mixed_rows, source_targets
from tests.llm.messy import messy, messy_rows, nothing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(text):
    return len(WORD.findall(text or ""))


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rate = (total - sum(fixed.values())) / sum(w[s] for s in free) if free else 0
        over = [s for s in free if rate * w[s] > cap * sizes[s]]
        if not over:
            return {s: fixed.get(s, rate * w[s]) for s in names}
        fixed.update({s: cap * sizes[s] for s in over})


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 1, "c": 5, "d": 70, None: 30}, {None: 9}, {"": 0, "b": 4},
                                   {"Z": 3, "a": 50, "é": 7, "\U0001F600": 11, "￮": 13}, {"x": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def corpus(spark, n=600):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 30)), rng.choice(["hot"] * 6 + ["b", "c", None])) for i in range(n)]
    quality = [(i, rng.choice([0, 1])) for i in range(0, n, 2)]
    return (rows, spark.createDataFrame(rows, "doc_id bigint, text string, source string"), dict(quality),
            spark.createDataFrame(quality, "doc_id bigint, quality int"))


def test_mix(spark):
    rows, docs, quality, labels = corpus(spark)
    got = {r["doc_id"]: r for r in mix(docs, labels).collect()}
    assert len(got) == len(rows)
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
        assert got[i]["size"] == size(t) and 0 <= got[i]["taken"] <= 2 * size(t)
    target = brute_targets(sizes)
    for s in sizes:
        own = [got[i] for i, _, x in rows if x == s]
        assert {r["source_size"] for r in own} == {sizes[s]} and own[0]["target"] == pytest.approx(target[s])
        assert sum(r["taken"] for r in own) == int(target[s])
        # every document stands for the complete epochs before any stands once more
        assert all(r["taken"] >= int(target[s] // sizes[s]) * r["size"] for r in own)
    again = {r["doc_id"]: r["taken"] for r in mix(docs.repartition(11), labels.repartition(3)).collect()}
    assert again == {i: r["taken"] for i, r in got.items()}


def test_quality_sets_the_rate(spark):
    docs = spark.createDataFrame([(i, "a b c d", "s") for i in range(3000)], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 2000)], "doc_id bigint, quality int")
    drawn = mix(docs, labels, share=0.4).where("taken > 0").collect()
    good = sum(r["doc_id"] < 2000 and r["doc_id"] % 2 == 1 for r in drawn)
    poor = sum(r["doc_id"] < 2000 and r["doc_id"] % 2 == 0 for r in drawn)
    plain = sum(r["doc_id"] >= 2000 for r in drawn)
    assert poor < plain < good and sum(r["taken"] for r in drawn) == 4800


def test_mixed_rows_are_whole_documents_near_the_target(spark):
    rows, docs, _, labels = corpus(spark)
    out = mixed_rows(docs, labels)
    assert out.columns == docs.columns
    sizes, taken, texts = {}, {}, {i: t for i, t, _ in rows}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    for r in out.collect():
        assert r["text"] == texts[r["doc_id"]]
        taken[r["source"]] = taken.get(r["source"], 0) + size(r["text"])
    for s, goal in brute_targets(sizes).items():
        assert abs(taken[s] - goal) <= 16  # half of the longest document, and rounding


def test_messy_rows(spark):
    df = messy(spark)
    labels = spark.createDataFrame([(5, 1), (5, 0), (8, None), (None, 1)], "doc_id bigint, quality int")
    got = mix(df, labels).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r[0]), size(r[1])) for r in messy_rows())
    by_source = {}
    for r in got:
        by_source.setdefault(r["source"], []).append(r)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by_source.items()}
    for s, goal in brute_targets(sizes).items():
        assert sum(r["taken"] for r in by_source[s]) == int(goal + 1e-9)
    out = mixed_rows(df, labels)
    assert out.columns == df.columns and out.count() > 0
    assert mix(nothing(spark)).collect() == [] and mixed_rows(nothing(spark)).collect() == []
    with pytest.raises(ValueError):
        mix(df, share=2.5)


def test_rows_that_repeat_an_id_are_drawn_each(spark):
    docs = spark.createDataFrame([(1, "a b", "s", k) for k in range(20)], "doc_id bigint, text string, source string, k int")
    out = [r["k"] for r in mixed_rows(docs, share=1.5).collect()]
    assert len(out) == 30 and set(out) == set(range(20))
    half = [r["k"] for r in mixed_rows(docs, share=0.5).collect()]
    assert len(half) == len(set(half)) == 10

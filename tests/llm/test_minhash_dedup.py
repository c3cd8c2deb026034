import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from rarelab.llm import minhash_dedup as m
from rarelab.llm.blocks import forest, shared_counts
from rarelab.llm.components import connected_components
from tests.conftest import SF_SMALL
from tests.llm.messy import messy, messy_rows, nothing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def brute(rows, width, percent=80):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and rows[a][0] is not None and rows[b][0] is not None:
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                root[find(a)] = find(b)
    out = []
    for i, (doc, _) in enumerate(rows):
        low = min((rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None), default=None)
        out.append((doc, len(sets[i]), low, doc == low))
    return sorted(out, key=repr)


def check(df, rows, width):
    got = sorted([tuple(r) for r in m.near_dedup(df, width=width).collect()], key=repr)
    assert got == brute(rows, width)


@pytest.mark.parametrize("width", [1, 2, 5])
def test_shingle_sets(width):
    texts = ["a b c a b c", "A b", "a", "", None, " \t", "x  y\nz x y z", "É é É é", "a b\x1c c d e f"]
    value, at = m.shingle_sets(pa.array(texts), width)
    hashes = [set(value[at[i]:at[i + 1]].tolist()) for i in range(len(texts))]
    truth = [shingles(t, width) for t in texts]
    assert [len(h) for h in hashes] == [len(t) for t in truth] == np.diff(at).tolist()
    for a, b in combinations(range(len(texts)), 2):
        assert len(hashes[a] & hashes[b]) == len(truth[a] & truth[b])


def test_least_matches_bounds_the_posterior():
    least = m.least_matches(0.8)
    assert len(least) == m.HASHES // m.BATCH and all(a < b for a, b in zip(least, least[1:]))
    rng = np.random.default_rng(0)
    for k, need in enumerate(least):  # uniform prior: matches given the similarity are binomial
        n = (k + 1) * m.BATCH
        high = rng.binomial(n, rng.uniform(0.8, 1.0, 200_000))
        assert (high < need).mean() < 1e-3
        assert need > n / 2 or n < 40


def test_shared_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 80))).astype(np.uint64) for _ in range(20)] + [np.empty(0, np.uint64)]
    got = shared_counts(sets)
    for a, b in combinations(range(len(sets)), 2):
        assert got[a, b] == len(np.intersect1d(sets[a], sets[b]))


def test_forest_connects_what_the_links_connect():
    rng = random.Random(1)
    links = [(rng.randrange(30), rng.randrange(30)) for _ in range(40)]

    def reach(pairs):
        seen = {i: {i} for i in range(30)}
        for _ in range(30):
            for a, b in pairs:
                seen[a] = seen[b] = seen[a] | seen[b]
                for x in seen[a]:
                    seen[x] = seen[a]
        return seen

    kept = forest(30, np.array([a for a, _ in links]), np.array([b for _, b in links]))
    assert len(kept) < 30 and set(kept) <= set(links) and reach(kept) == reach(links)


def edited(rng, base, n):
    words = list(base)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [1024, 8])
def test_groups_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(m, "BLOCK", block)
    rng = random.Random(5)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(60)]
        rows += [(len(rows) + i, edited(rng, base, rng.randrange(6))) for i in range(25)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)] + [(2000 + i, f"only {i} here") for i in range(20)]
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), rows, 2)


def test_similarity_at_the_threshold(spark):
    """Eight of ten shingles in common link, one fewer does not."""
    rows = []
    for g in range(40):
        w = [f"g{g}x{i}" for i in range(9)]
        rows += [(10 * g, " ".join([*w, f"p{g}"])), (10 * g + 1, " ".join([*w, f"q{g}"]))]  # 8 of 10
        w = [f"h{g}x{i}" for i in range(9)]
        rows += [(10 * g + 2, " ".join([*w, f"p{g}", f"s{g}"])), (10 * g + 3, " ".join([*w, f"q{g}"]))]  # 8 of 11
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), rows, 2)


@pytest.mark.parametrize("width", [2, 5])
def test_table(spark, width):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check(df, [(r["doc_id"], r["text"]) for r in df.collect()], width)


def test_messy_rows(spark):
    df = messy(spark)
    check(df, [(r[0], r[1]) for r in messy_rows()], 2)
    assert m.near_dedup(nothing(spark)).collect() == []
    kept = m.keep_one(df, width=2)
    assert kept.columns == df.columns
    gone = {r[0] for r in brute([(r[0], r[1]) for r in messy_rows()], 2) if not r[3] and r[0] is not None}
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in messy_rows()} - gone
    assert m.keep_one(nothing(spark)).collect() == []


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 620)]
    loose = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in chain + star + loose + [(7, 7), (100, 101)]]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_one_row_of_each_group_stays(spark):
    t = " ".join(f"w{i}" for i in range(60))
    near, other, lone = t + " x", " ".join(f"u{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(3, t), (5, near), (5, other), (7, lone), (7, lone + " y"), (None, lone + " z"), (None, "a b c d e f g h i j k"),
            (None, "a b c d e f g h i j k l"), (9, "same here"), (9, "same here"), (11, None), (11, "")]
    kept = m.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"), width=2).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["11", "11", "3", "5", "7", "9", "None"]
    assert {tuple(r) for r in kept} >= {(3, t), (5, other), (9, "same here")}


def test_rows_whose_64_bit_hashes_are_equal_stay(spark, monkeypatch):
    """With one 64-bit hash for everything no row is taken for another."""
    rng = random.Random(31)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(400)], k=60)) for _ in range(6)]
    texts += [texts[0] + " more", "", None, "short one"]  # a near copy of the first, and texts on their own
    rows = [(i + 1, t, None, None, None) for i, t in enumerate(texts)] + [(1, texts[0], None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    monkeypatch.setattr(m.F, "xxhash64", lambda *cols: m.F.lit(7).cast("bigint"))
    kept = sorted(r["doc_id"] for r in m.keep_one(df).collect())
    assert kept == [1, 2, 3, 4, 5, 6, 8, 9, 10]

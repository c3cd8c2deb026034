"""Co-moment states against numpy on pairwise-complete rows, merged in any order."""
import numpy as np
import pytest

from rarelab.functions.comoments import batch_state, correlations, empty_state, merge_states
from rarelab.operators.profile import correlation_long


def brute(x, known):
    p = x.shape[1]
    out = np.full((p, p), -np.inf)
    for i in range(p):
        for j in range(p):
            both = known[:, i] & known[:, j]
            a, b = x[both, i], x[both, j]
            if len(a) and len(set(a)) > 1 and len(set(b)) > 1:
                a, b = a - a.mean(), b - b.mean()
                out[i, j] = (a @ b) / np.sqrt((a @ a) * (b @ b))
    return out


def data():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 6))
    x[:, 1] += 2 * x[:, 0]
    x[:, 2] = 1e9 + 1e-3 * np.round(x[:, 0] + rng.standard_normal(500), 3)  # nearly constant, large mean
    x[:, 3] = 7.0  # constant
    x[:, 4] = np.where(np.arange(500) < 250, 3.0, x[:, 4])  # constant where column 5 has values
    known = rng.random((500, 6)) < 0.8
    known[250:, 5] = False
    return x, known


@pytest.mark.parametrize("cuts", [[], [1, 7, 8, 300], list(range(0, 500, 11))])
def test_states_merge(cuts):
    x, known = data()
    state = empty_state(6)
    for part, there in zip(np.split(x, cuts), np.split(known, cuts)):
        if len(part):
            state = merge_states(state, batch_state(np.where(there, part, 0.0), there))
    want = brute(x, known)
    assert (np.isneginf(want) == np.isneginf(correlations(state))).all() and np.isneginf(want).any()
    some = ~np.isneginf(want)
    assert correlations(state)[some] == pytest.approx(want[some], abs=1e-7)


def test_frame_and_edges(spark):
    x, known = data()
    rows = [tuple(float(v) if k else None for v, k in zip(a, b)) for a, b in zip(x, known)]
    names = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    want = brute(x, known)
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation_long(df, names).collect()}
    assert len(got) == 36
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            assert got[a, b] is None if np.isneginf(want[i, j]) else got[a, b] == pytest.approx(want[i, j], abs=1e-7)
    none = correlation_long(df.limit(0), names[:2]).collect()
    assert sorted(tuple(r) for r in none) == [("c0", "c0", None), ("c0", "c1", None), ("c1", "c0", None), ("c1", "c1", None)]
    odd = spark.createDataFrame([(1.0, 2.0, 1), (float("nan"), 3.0, 2), (2.0, None, 4), (5.0, 1.0, 3)], "a double, b double, c int")
    r = {(x["feature_a"], x["feature_b"]): x["r"] for x in correlation_long(odd, ["a", "b", "c"]).collect()}
    assert np.isnan(r["a", "b"]) and np.isnan(r["c", "a"]) and r["b", "c"] == pytest.approx(brute(
        np.array([[2.0, 1], [3, 2], [1, 3]]), np.ones((3, 2), bool))[0, 1])

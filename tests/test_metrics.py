"""Metrics against hand formulas and pairwise AUC."""
import itertools

import pytest

from rarelab.operators import metrics


def _preds(spark, rows):
    return spark.createDataFrame(rows, "label boolean, pred boolean, score double")


def test_auc_equals_pairwise_count_with_ties(spark):
    rows = [(True, True, 0.8), (True, False, 0.4), (False, False, 0.4), (False, True, 0.8),
            (True, True, 0.6), (False, False, 0.2), (False, False, 0.4), (True, True, 0.9), (False, False, 0.6)]
    pos = [s for y, _, s in rows if y]
    neg = [s for y, _, s in rows if not y]
    pair = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    got = metrics.roc_auc(_preds(spark, rows)).first()["roc_auc"]
    assert got == pytest.approx(pair / (len(pos) * len(neg)))


def test_weighted_prf_and_never_predicted_class(spark):
    rows = [(True, False, 0.0)] * 3 + [(False, False, 0.0)] * 7
    r = metrics.weighted_prf(_preds(spark, rows)).first()
    # class True never predicted: its precision is 0
    assert r["precision"] == pytest.approx(0.7 * 0.7)
    assert r["recall"] == pytest.approx(0.7)
    f1_false = 2 * 7 / (7 + 10)
    assert r["f1"] == pytest.approx(0.7 * f1_false)


def test_confusion_has_all_cells(spark):
    rows = [(True, True, 0.0), (False, False, 0.0), (False, False, 0.0)]
    cm = {(r["actual"], r["predicted"]): r["count"] for r in metrics.confusion_counts(_preds(spark, rows)).collect()}
    assert cm == {(True, True): 1, (True, False): 0, (False, True): 0, (False, False): 2}


def test_report_rows(spark):
    rows = [(True, True, 0.0), (True, False, 0.0), (False, False, 0.0), (False, True, 0.0)]
    rep = {r["row"]: r for r in metrics.classification_report(_preds(spark, rows)).collect()}
    assert set(rep) == {"true", "false", "accuracy", "macro avg", "weighted avg"}
    assert rep["accuracy"]["f1"] == pytest.approx(0.5) and rep["accuracy"]["precision"] is None


def test_auc_missing_class_is_null(spark):
    rows = [(True, True, 0.3), (True, True, 0.5)]
    assert metrics.roc_auc(_preds(spark, rows)).first()["roc_auc"] is None

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from riskweave.operators import metrics, staged


def frame(spark, label, parts, slices=5):
    return spark.createDataFrame(pd.DataFrame({"label": label, "parts": list(parts.tolist())}), "label int, parts array<double>").repartition(slices)


def plain(label, x):
    """(KS, AUC) from sorted distinct scores."""
    values, place = np.unique(x, return_inverse=True)
    bad, good = np.bincount(place[label == 1], minlength=len(values)), np.bincount(place[label == 0], minlength=len(values))
    tpr, fpr = np.cumsum(bad) / bad.sum(), np.cumsum(good) / good.sum()
    wins = (bad * (np.cumsum(good) - good / 2)).sum()
    return np.abs(tpr - fpr).max(), wins / (bad.sum() * good.sum())


def made(seed, n=6000, rounds=100):
    rng = np.random.default_rng(seed)
    parts = np.round(rng.normal(size=(n, rounds)), 1) * rng.uniform(0.01, 1, rounds)
    parts[:, 3] = 0
    parts[:, 0] = np.where(rng.random(n) < 0.9, 1.0, parts[:, 0])  # one value fills most of a round
    parts[:, 1] *= np.exp(rng.normal(size=n) * 4)  # most of a round in one cell
    label = (rng.random(n) < 1 / (1 + np.exp(-parts[:, 5:].sum(axis=1) / 8))).astype(int)
    return label, parts


@pytest.mark.parametrize("cells, by_value", [(256, 20_000), (8, 50), (4, 0)])
def test_ks_of_every_round_is_exact(spark, monkeypatch, cells, by_value):
    monkeypatch.setattr(staged, "CELLS", cells)
    monkeypatch.setattr(staged, "BY_VALUE_ROWS", by_value)
    monkeypatch.setattr(staged, "PIECES", 64)
    rounds = 100 if cells == 256 else 12
    label, parts = made(cells, 6000 if cells == 256 else 1500, rounds)
    margins = np.cumsum(parts, axis=1)
    guess = [(float(m.min()), float(m.max())) for m in margins.T]
    got = {r["round"]: r for r in staged.ks_by_round(frame(spark, label, parts), guess).collect()}
    for k in range(rounds):
        ks, auc = plain(label, margins[:, k])
        assert got[k + 1].ks == ks and got[k + 1].auc_low - 1e-12 <= auc <= got[k + 1].auc_high + 1e-12, k
    if cells == 256:
        one = frame(spark, label, margins[:, -1:]).selectExpr("label", "parts[0] AS score")
        whole = metrics.auc_ks(one, "score").first()
        assert got[rounds].ks == whole.ks and got[rounds].auc_high - got[rounds].auc_low < 0.05


def test_what_is_shuffled_does_not_grow_with_the_rows(spark):
    """Rows of the exchange: a task's counts per round, at most."""
    for n in (500, 5000):
        label, parts = made(2, n, 6)
        looks = {k: staged.Look(np.array([0.0]), np.ones(2, dtype=bool)) for k in range(6)}
        sent = frame(spark, label, parts, 3).mapInPandas(staged._own_counts(looks, "label", True), staged._COUNTS)
        assert sent.count() == 3 * 6 and max(len(r.slot) for r in sent.collect()) <= 2


def test_edges(spark):
    parts = np.array([[1.0, 2.0], [3.0, -1.0], [0.5, 0.5]])
    for label in ([0, 0, 0], [1, 1, 1]):
        rows = staged.ks_by_round(frame(spark, np.array(label), parts), [(0, 1), (0, 1)]).collect()
        assert [r.ks for r in rows] == [None, None] and all(r.log_loss > 0 for r in rows)
    same = staged.ks_by_round(frame(spark, np.array([0, 1, 0]), np.ones((3, 2))), [(1.0, 1.0), (0.0, 9.0)]).collect()
    assert [(r.ks, r.auc_low, r.auc_high) for r in same] == [(0.0, 0.5, 0.5)] * 2
    wrong = staged.ks_by_round(frame(spark, np.array([0, 1, 0]), parts), [(100.0, 101.0), (-7.0, -6.0)]).collect()  # guesses far off
    assert [r.ks for r in wrong] == [plain(np.array([0, 1, 0]), m)[0] for m in np.cumsum(parts, axis=1).T]
    none = staged.ks_by_round(frame(spark, np.array([0]), np.ones((1, 2))).where("false"), [(0, 1), (0, 1)]).collect()
    assert [(r.ks, r.log_loss) for r in none] == [(None, None)] * 2

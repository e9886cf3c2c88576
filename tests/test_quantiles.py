from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.operators import metrics
from riskweave.operators.quantiles import exact_quantiles, running_totals

PROBS = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def samples(kind, rng):
    if kind == "normal":
        return rng.normal(size=5000)
    if kind == "hot":  # one value holds a third of the rows
        return np.where(rng.random(5000) < 0.34, 7.0, rng.normal(scale=50, size=5000))
    if kind == "few":
        return rng.integers(0, 4, size=5000).astype(float)
    return np.exp(rng.normal(scale=5, size=5000))


@pytest.mark.parametrize("kind", ["normal", "hot", "few", "skewed"])
@pytest.mark.parametrize("accuracy", [20, 200, 10_000])
def test_quantiles_are_exact_whatever_the_sketch(spark, kind, accuracy):
    values = samples(kind, np.random.default_rng(1))
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(5)
    found, row = exact_quantiles(df, {"x": ("x", PROBS)}, ["count(1) AS rows"], accuracy)
    assert found["x"] == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12, abs=1e-12)
    assert row.rows == 5000


def test_nulls_empty_and_single_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (None, 3.0)], "a double, b double")
    found, _ = exact_quantiles(df, {"a": ("a", [0.5]), "b": ("b", [0.0, 0.5, 1.0])})
    assert found == {"a": [None], "b": [1.0, 2.0, 3.0]}


def test_missed_brackets_are_widened(spark, monkeypatch):
    import riskweave.operators.quantiles as q

    values = np.random.default_rng(5).permutation(4000).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    real = q._look_up
    calls = []

    def wrong_first(vals, brackets, todo, row):
        calls.append(1)
        if len(calls) == 1:  # a bracket far from every wanted rank
            brackets = {i: [(3999.0, 3999.0)] for i in brackets}
        return real(vals, brackets, todo, row)

    monkeypatch.setattr(q, "_look_up", wrong_first)
    found, _ = exact_quantiles(df, {"x": ("x", [0.1, 0.5])}, accuracy=50)
    assert found["x"] == pytest.approx(np.quantile(values, [0.1, 0.5]).tolist())
    assert len(calls) > 1


def test_running_totals_match_cumsum(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 900, p=[0.9, 0.1]), "x": rng.permutation(900).astype(float), "n": rng.integers(1, 5, 900)})
    got = running_totals(spark.createDataFrame(pdf), "x", ["n"], ["g"]).toPandas().sort_values(["g", "x"])
    want = pdf.sort_values(["g", "x"])
    want["below_n"] = want.groupby("g").n.cumsum() - want.n
    assert got.below_n.tolist() == want.below_n.tolist()


def brute(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    ks = max(abs((pos <= t).mean() - (neg <= t).mean()) for t in np.unique(s))
    return wins / (len(pos) * len(neg)), ks


@pytest.mark.parametrize("ties", [False, True])
def test_auc_and_ks_match_brute_force(spark, ties):
    rng = np.random.default_rng(4)
    s = rng.random(600)
    s = np.round(s, 1) if ties else s
    y = (rng.random(600) < s).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"label": y, "p": s}))
    row = metrics.auc_ks(df, "p").first()
    assert (row.auc, row.ks) == pytest.approx(brute(y, s))
    # Both survive a strictly increasing change of the score.
    grown = metrics.auc_ks(df.withColumn("p", F.exp("p") * 3 - 7), "p").first()
    assert (grown.auc, grown.ks) == pytest.approx((row.auc, row.ks))
    assert metrics.KSEvaluator("p").evaluate(df) == pytest.approx(row.ks)


def test_one_class_and_equal_scores(spark):
    df = spark.createDataFrame([("a", 1, 0.2), ("a", 1, 0.4), ("b", 0, 0.5), ("b", 1, 0.5)], "g string, label int, p double")
    rows = {r.col: r for r in metrics.auc_ks_by(df, "p", "g").collect()}
    assert rows["a"].auc is None and rows["a"].ks is None
    assert rows["b"].auc == 0.5 and rows["b"].ks == 0.0
    assert rows["overall"].total == 4

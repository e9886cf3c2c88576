from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.operators import importance, nullforest

FEATURES = ["x", "z", "cat"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(6)
    n = 1200
    frame = pd.DataFrame({"id": np.arange(n), "x": rng.normal(size=n).round(1), "z": rng.integers(0, 5, n).astype(float), "cat": rng.choice(list("uvwxy"), n)})
    frame["label"] = (rng.random(n) < 0.1 + 0.5 * (frame["x"] > 0.3)).astype(int)
    frame.loc[::97, "x"] = np.nan
    return spark.createDataFrame(frame).withColumn("x", F.nanvl("x", F.lit(None).cast("double"))).repartition(5).cache()


def prepared(table, runs, trees=3, share=0.6):
    rows = importance.prepare(table.filter("label IN (0, 1)"), FEATURES)
    return nullforest.prepared(rows, FEATURES, "label", runs, trees, share, 0.8, 11)


def gini(y):
    p = y.mean()
    return 2 * p * (1 - p)


def brute(rows, design, depth):
    """Trees by plain recursion over the rows' bins: every cut of numbers, every set of categories."""
    pdf = rows.toPandas()
    bins = pdf[[f"b{i}" for i in range(len(design.features))]].to_numpy()
    out = []

    def grow(run, tree, level, node, at, y):
        if level == depth:
            return
        best = None
        for f in nullforest.columns_of(run, tree, node, level, design):
            own = bins[at, f]
            values = np.unique(own)
            sets = [values[: k + 1] for k in range(len(values) - 1)] if design.ordered[f] else [
                values[[i for i in range(len(values)) if mask >> i & 1]] for mask in range(1, (1 << len(values)) - 1)
            ]
            for left in sets:
                go = np.isin(own, left)
                if not design.ordered[f] and y[go].mean() > y[~go].mean():
                    continue  # the same split with its sides exchanged
                gain = gini(y) - go.mean() * gini(y[go]) - (~go).mean() * gini(y[~go])
                if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                    best = (gain, f, go)
        if best:
            out.append((run, tree, level, node, int(best[1]), best[0]))
            grow(run, tree, level + 1, 2 * node, at[best[2]], y[best[2]])
            grow(run, tree, level + 1, 2 * node + 1, at[~best[2]], y[~best[2]])

    for run in range(design.runs):
        y = (pdf[f"w{run // nullforest.WORD}"].to_numpy() >> (run % nullforest.WORD)) & 1
        for tree in range(design.trees):
            at = np.flatnonzero(nullforest.in_bag(pdf["serial"].to_numpy(), tree, design))
            grow(run, tree, 0, 0, at, y[at].astype(float))
    return sorted(out)


@pytest.mark.parametrize("depth, count_bytes", [(1, 1 << 28), (3, 1 << 28), (3, 5000)])
def test_forests_equal_brute_force(table, monkeypatch, depth, count_bytes):
    monkeypatch.setattr(nullforest, "COUNT_BYTES", count_bytes)
    monkeypatch.setattr(nullforest, "BUFFER_ROWS", 200)
    rows, design = prepared(table, 4)
    got, want = nullforest.grow(rows, design, depth), brute(rows, design, depth)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], atol=1e-12)


def test_labels_are_permutations(table):
    rows, design = prepared(table, 130)
    real = table.agg(F.sum("label")).first()[0]
    labels = [F.sum(F.expr(f"(w{r // nullforest.WORD} >> {r % nullforest.WORD}) & 1")).alias(f"n{r}") for r in range(130)]
    assert list(rows.agg(*labels).first()) == [real] * 130
    pdf = rows.toPandas()
    word = pdf["w0"].to_numpy()
    first, second = word & 1, (word >> 1) & 1
    assert 0 < (first & second).sum() < real
    shares = [nullforest.in_bag(pdf["serial"].to_numpy(), t, design).mean() for t in range(3)]
    assert all(abs(s - 0.6) < 0.06 for s in shares)


def test_jobs_don_t_grow_with_the_runs(spark, table):
    tracker, counts = spark.sparkContext.statusTracker(), []
    for runs in (2, 40):
        rows, design = prepared(table, runs, 2)
        spark.sparkContext.setJobGroup(f"runs-{runs}", "growing")
        nullforest.grow(rows, design, 3)
        counts.append(len(tracker.getJobIdsForGroup(f"runs-{runs}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]


def test_importances_under_permuted_labels_are_small(table):
    null = importance.null_importance(table, FEATURES, nb_runs=6, trees=4)
    assert null.count() == 18 and {r.run for r in null.collect()} == set(range(1, 7))
    actual = importance.actual_importance(table, FEATURES, trees=4)
    scores = {r.feature: r.gain_score for r in importance.null_score(actual, null).collect()}
    assert max(scores, key=scores.get) == "x" and scores["x"] > scores["z"] + 1
    one = importance.null_importance(table.where("label = 0"), FEATURES, nb_runs=2, trees=2)
    assert {r.importance_split for r in one.collect()} == {0}
    same = importance.null_importance(table, FEATURES, nb_runs=6, trees=4)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, null.collect()))

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression

from riskweave.operators import regression

NAMES = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(12)
    n = 3000
    x = rng.normal(size=(n, 6)) * [1, 1000, 0.01, 1, 1, 1] + [0, 5e4, 0, 0, 3, 0]
    x[:, 3] = x[:, 0] * 0.9 + rng.normal(size=n) * 0.3
    p = 1 / (1 + np.exp(-(0.8 * x[:, 0] - 0.5 * (x[:, 1] - 5e4) / 1000 + 30 * x[:, 2] - 1)))
    frame = pd.DataFrame(x, columns=NAMES).assign(label=(rng.random(n) < p).astype(int), twice=x[:, 0] * 2 + 1, same=4.0)
    return spark.createDataFrame(frame).repartition(4).cache()


def library(table, names):
    ready = VectorAssembler(inputCols=list(names), outputCol="features").transform(table)
    model = GeneralizedLinearRegression(family="binomial", labelCol="label", maxIter=50, tol=1e-12).fit(ready)
    return dict(zip(names, model.summary.pValues))


def test_p_values_equal_the_library_s(table):
    fits = regression.LogisticFits(regression._logistic_rows(table, [*NAMES, "twice", "same"], "label"), [*NAMES, "twice", "same"])
    lists = [["f0"], ["f5"], ["f0", "f3"], NAMES, ["f0", "twice"], ["same"]]
    got = fits.fit(lists)
    assert got[4] is None and got[5] is None
    for names, found in zip(lists[:4], got):
        want = library(table, names)
        assert all(found[f] == pytest.approx(want[f], rel=1e-5, abs=1e-14) for f in names)
    again = fits.fit([["f0", "f3", "f1"]])[0]  # starts from the fit of f0 and f3
    want = library(table, ["f0", "f3", "f1"])
    assert all(again[f] == pytest.approx(want[f], rel=1e-5, abs=1e-14) for f in again)


def test_same_steps_as_one_fit_for_each_candidate(table):
    for stepwise, alpha in ((True, 0.05), (False, 0.3), (True, 0.3)):
        want = regression._walk(NAMES, lambda lists: [library(table, x) for x in lists], alpha, stepwise)
        got = [tuple(r) for r in regression.stepwise_logistic(table, NAMES, alpha=alpha, stepwise=stepwise).orderBy("step").collect()]
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert all(g[3] == pytest.approx(w[3], rel=1e-4, abs=1e-12) for g, w in zip(got, want))


def test_jobs_of_a_step_don_t_grow_with_the_features(spark, table):
    fits = regression.LogisticFits(regression._logistic_rows(table, NAMES, "label"), NAMES)
    tracker, counts = spark.sparkContext.statusTracker(), []
    for k in (1, 6):
        spark.sparkContext.setJobGroup(f"score-{k}", "score tests")
        fits.score_tests([], NAMES[:k])
        counts.append(len(tracker.getJobIdsForGroup(f"score-{k}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]


def test_score_tests_given_a_model(table):
    fits = regression.LogisticFits(regression._logistic_rows(table, NAMES, "label"), NAMES)
    fits.fit([["f0"]])
    got = fits.score_tests(["f0"], ["f1", "f3", "f0"])
    pdf = table.toPandas()
    x, y = pdf[["f0"]].to_numpy(), pdf["label"].to_numpy()
    design, beta = np.column_stack([np.ones(len(y)), x]), np.zeros(2)
    for _ in range(30):
        mu = 1 / (1 + np.exp(-design @ beta))
        beta += np.linalg.solve((design * (mu * (1 - mu))[:, None]).T @ design, design.T @ (y - mu))
    w = mu * (1 - mu)
    for f in ("f1", "f3"):
        z = pdf[f].to_numpy() - pdf[f].mean()
        resid = z - design @ np.linalg.solve((design * w[:, None]).T @ design, design.T @ (w * z))
        assert got[f] == pytest.approx((resid @ (y - mu)) ** 2 / (w * resid**2).sum(), rel=1e-6)
    assert got["f0"] is None


def test_separated_and_empty_tables(spark):
    apart = spark.createDataFrame([(float(i), int(i >= 20)) for i in range(40)], "x double, label int")
    log = regression.stepwise_logistic(apart, ["x"]).collect()
    assert log == [] or math.isfinite(log[0].p_value)
    assert regression.stepwise_logistic(apart.where("false"), ["x"]).count() == 0
    assert regression.stepwise_logistic(apart.where("label = 1"), ["x"]).count() == 0

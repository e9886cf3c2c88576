from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.operators import importance, metrics, recode, regression, select, train


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(11)
    n = 800
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    x3 = x1 + 0.3 * rng.normal(size=n)
    y = 2 * x1 - x2 + rng.normal(size=n)
    label = (rng.random(n) < 1 / (1 + np.exp(-1.5 * x1))).astype(int)
    cat = rng.choice(["u", "v", "w"], n)
    gap = np.where(rng.random(n) < 0.1, np.nan, x1 * 10)
    return pd.DataFrame({"id": range(n), "x1": x1, "x2": x2, "x3": x3, "y": y, "label": label, "cat": cat, "gap": gap})


@pytest.fixture(scope="module")
def table(spark, noisy):
    return spark.createDataFrame(noisy).repartition(3).cache()


def test_variance_inflation_equals_the_regressions(table, noisy):
    got = {r.feature: r.vif for r in select.variance_inflation(table, ["x1", "x2", "x3"]).collect()}
    for f in got:
        others = [c for c in got if c != f]
        a = np.column_stack([np.ones(len(noisy)), noisy[others]])
        rest = noisy[f] - a @ np.linalg.lstsq(a, noisy[f], rcond=None)[0]
        r2 = 1 - rest.var() / noisy[f].var()
        assert got[f] == pytest.approx(1 / (1 - r2), rel=1e-6)


def test_correlation_ways_agree_with_pandas(table, noisy):
    names = ["x1", "x2", "gap"]
    want = noisy[names].corr()
    rows = table.selectExpr(*[f"{select._known(table, f)} AS x{i}" for i, f in enumerate(names)])
    for matrix in (select.correlation_matrix(table, names), select._correlation_by_sums(rows, names)):
        for r in matrix.collect():
            assert r.r == pytest.approx(want.loc[r.feature_i, r.feature_j], abs=1e-9)


def test_prune_keeps_the_first_of_a_correlated_pair(table):
    assert select.prune_correlated(table, ["x3", "x1", "x2"], 0.8) == ["x1"]
    assert select.prune_correlated(table, ["x1", "x2", "x3"], 0.8) == ["x3"]


def test_t_tail_matches_simulation_free_values():
    # Known two-sided 5 % points of Student's t.
    for t, free in ((12.706, 1), (2.571, 5), (2.042, 30), (1.96, 100_000)):
        assert regression.two_sided_t(t, free) == pytest.approx(0.05, abs=2e-4)


def test_stepwise_linear_finds_the_drivers(table):
    log = regression.stepwise_linear(table, ["x1", "x2", "x3"], "y", alpha=0.001)
    assert set(regression.selected_features(log)) == {"x1", "x2"}


def test_stepwise_logistic_finds_the_driver(table):
    log = regression.stepwise_logistic(table, ["x1", "x2"], alpha=0.001)
    assert regression.selected_features(log) == ["x1"]


def test_small_logits_match_a_penalised_fit(table, noisy):
    rows, binary = recode.event_column(table, "label")
    assert binary
    chosen = recode.best_transforms(rows, ["x1"])
    chosen["x1"]["besttrans"] = "origin"
    chosen["x1"].update(mean_x=float(noisy.x1.mean()), sxx=float(((noisy.x1 - noisy.x1.mean()) ** 2).sum()))
    a, b = recode.univariate_logits(rows, chosen)["x1"]
    p = 1 / (1 + np.exp(-(a + b * noisy.x1)))
    assert (noisy.label - p).sum() == pytest.approx(0, abs=1e-6)
    assert ((noisy.label - p) * noisy.x1).sum() - b == pytest.approx(0, abs=1e-6)


def test_recoding_of_a_feature_with_gaps(table):
    profile = recode.continuous_profile(table, ["gap", "x2"])
    out = recode.apply_recoding(table.select("id", "gap", "x2"), recode.continuous_recoding(profile))
    low, high = (profile.bounds["gap"][k] for k in ("lowerbound", "upperbound"))
    ends = out.agg(F.min("r_gap").alias("lo"), F.max("r_gap").alias("hi"), F.count_if(F.isnan("gap") & F.col("r_gap").isNull()).alias("left")).first()
    assert low <= ends.lo and ends.hi <= high
    assert ends.left == 0
    missing = {r.w for r in out.filter(F.col("gap").isNull() | F.isnan("gap")).select(F.col("r_woe_gap").alias("w")).collect()}
    assert missing == {profile.woe["gap"][None]}
    total = profile.table.filter("variable = 'gap' AND group = 'TOTAL'").first()
    assert total["count"] == 800
    parts = profile.table.filter("variable = 'gap' AND group <> 'TOTAL'").agg(F.sum("count").alias("n")).first()
    assert parts.n == 800


def test_nominal_groups_hold_every_category_once(table):
    profile = recode.nominal_profile(table, ["cat"])
    members = [c for g in profile.groups["cat"] for c in g["categories"]]
    assert sorted(members) == ["u", "v", "w"]
    out = recode.apply_recoding(table.select("cat"), recode.nominal_recoding(profile))
    assert out.filter("r_woe_cat IS NULL").count() == 0


def test_last_round_has_the_ks_of_the_model(table):
    features = ["x1", "x2", "cat"]
    model = train.fit_boosting(table, features, {"n_estimators": 4, "num_leaves": 4})
    stages = train.staged_ks(model, table, features).orderBy("round").collect()
    whole = metrics.auc_ks(train.score(model, table, features), train.PROB).first()
    assert len(stages) == 4
    assert stages[-1].ks == pytest.approx(whole.ks) and stages[-1].auc_low - 1e-9 <= whole.auc <= stages[-1].auc_high + 1e-9
    truth = train.score(model, table, features).selectExpr("avg(CASE WHEN label = 1 THEN -ln(prob_) ELSE -ln(1 - prob_) END) AS loss").first().loss
    assert stages[-1].log_loss == pytest.approx(truth)


def test_saved_model_scores_the_same(spark, table, tmp_path):
    features = ["x1", "cat"]
    model = train.fit_boosting(table, features, {"n_estimators": 3, "scale_pos_weight": 2.0})
    train.save_model(model, str(tmp_path / "m"))
    again = train.load_model(str(tmp_path / "m"))
    a = train.score(model, table, features).agg(F.sum("prob_").alias("s")).first().s
    assert train.score(again, table, features).agg(F.sum("prob_").alias("s")).first().s == pytest.approx(a)


def test_trial_tiers(spark):
    rows = [
        (0, 0.30, 0.29, 0.01, 2.0, 0.3, 0.0, 0.05),   # all conditions hold
        (1, 0.50, 0.40, 0.10, 2.5, 0.2, 0.0, 0.05),   # best, but gap too wide
        (2, 0.28, 0.27, 0.01, 1.5, 0.5, 0.0, 0.05),   # beaten by trial 0
        (3, 0.36, 0.35, 0.01, 1.9, 0.4, 0.1, 0.05),   # not monotone
        (4, 0.20, 0.31, 0.11, 1.0, 0.9, 0.0, 0.05),
        (5, 0.30, 0.29, 0.01, 2.0, 0.3, 0.0, 0.50),   # ties with trial 0, unstable
    ]
    df = spark.createDataFrame(rows, "trial int, ks_train double, ks_test double, ks_gap double, lift_head10 double, lift_tail10 double, mono_violation double, psi double")
    # Trial 1 beats every other trial, so the front is that trial alone.
    marked = train.summarise_trials(df)
    assert {r.trial for r in marked.filter("is_pareto_front").collect()} == {1}
    assert train.choose_trial(marked).first().status == "not_found"
    without = train.summarise_trials(df.filter("trial <> 1"))
    best = train.choose_trial(without).first()
    assert (best.trial, best.status) == (0, "found")

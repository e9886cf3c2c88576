"""Model fits, search, leaderboard, importances and the retrain check."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import query
from checks.selection import dev_oot
from riskweave.operators import report, score, train
from riskweave.sources import demo

FEATURES = ["amt", "bal", "nation", "sum_qty", "sig"]
WITH_TEXT = [*FEATURES, "seg"]
SMALL = {"n_estimators": 5, "num_leaves": 8, "max_bin": 32}


def three_samples(spark, sf_dir):
    rows = demo.samples_table(spark, sf_dir)
    sets = F.array_compact(F.array(
        F.when(F.col("date") < demo.CUT_DATE, F.lit("dev")).otherwise(F.lit("oot")),
        F.when(F.col("date") >= 20000101, F.lit("psi")),
    ))
    return rows.select("*", F.explode(sets).alias("dataset"))


@query("boosting_scores")
def boosting_scores(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    model = train.fit_boosting(dev, WITH_TEXT, SMALL)
    return train.score(model, oot, WITH_TEXT).select("id", "label", train.PROB)


@query("fit_metrics")
def fit_metrics(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    model = train.fit_boosting(dev, FEATURES, SMALL)
    scored = train.score(model, train._both(dev, oot, FEATURES, "label"), FEATURES)
    return spark.createDataFrame([train.evaluate_fit(scored)])


@query("staged_ks")
def staged_ks(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    return train.staged_ks(train.fit_boosting(dev, FEATURES, SMALL), oot, FEATURES)


@query("boosting_search")
def boosting_search(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    trials = train.search_boosting(dev, oot, ["nation", "sum_qty", "sig"], 2, {"n_estimators": 4}, {**train.SEARCH_SPACE, "max_bin": (20, 64), "num_leaves": (4, 16)})
    return train.summarise_trials(trials).drop("params")


@query("logistic_search")
def logistic_search(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    return train.search_logistic(dev, oot, ["nation", "sum_qty", "sig"], 3, max_iter=10)


@query("leaderboard")
def leaderboard(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    features = ["nation", "sum_qty", "sig"]
    board = train.compare_models(dev, oot, features, families=train.model_families("label", len(features), rounds=5, max_iter=10))
    return report.leaderboard_report(board)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    dev, _ = dev_oot(spark, sf_dir)
    model = train.fit_boosting(dev, FEATURES, SMALL)
    return train.feature_importance_table(train.tree_importances(spark, model.stages[-1], FEATURES))


@query("nonzero_importance")
def nonzero_importance(spark, sf_dir):
    return score.nonzero_importances(feature_importance(spark, sf_dir))


@query("retrain_check")
def retrain_check(spark, sf_dir):
    result, _, _ = score.retrain_check(three_samples(spark, sf_dir), FEATURES, SMALL)
    return result

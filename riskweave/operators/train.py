"""Training on Spark ML: fits, staged evaluation, parameter search, leaderboard, importances."""

from __future__ import annotations

import math
import re
import time
import warnings
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    FMClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import MinMaxScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.cleaning import as_double, identify_types
from riskweave.operators.joins import pareto_front
from riskweave.operators.metrics import head_and_tail_lift, level_table, performance
from riskweave.operators.stability import score_psi
from riskweave.operators.staged import ks_by_round
from riskweave.session import shared_dir
from riskweave.spec import MISSING_CODE

# Default boosting parameters and the ranges the search draws from.
DEFAULT_PARAMS = {
    "learning_rate": 0.1,
    "n_estimators": 20,
    "num_leaves": 15,
    "max_bin": 64,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "min_child_samples": 20,
    "min_split_gain": 0.0,
    "random_state": 42,
}
SEARCH_SPACE = {
    "learning_rate": (0.03, 0.2),
    "num_leaves": (8, 60),
    "max_bin": (20, 350),
    "subsample": (0.2, 1.0),
    "colsample_bytree": (0.2, 1.0),
}
SEARCHABLE = frozenset({*DEFAULT_PARAMS, "max_depth", "scale_pos_weight"}) - {"random_state"}
PSI_LIMIT = 0.2
PROB = "prob_"
WEIGHT = "_weight"


def prepare(df: DataFrame, features: Sequence[str], missing: float = MISSING_CODE) -> DataFrame:
    """Numeric features as doubles without NULL, so that no row drops out of a fit."""
    numeric, _ = identify_types(df.select(*features))
    return df.withColumns({f: F.coalesce(as_double(df, f), F.lit(missing)) for f in numeric})


def feature_stages(df: DataFrame, features: Sequence[str], out: str = "features") -> list:
    """Indexing of text features and assembly into one vector."""
    numeric, categorical = identify_types(df.select(*features))
    stages = []
    if categorical:
        stages.append(
            StringIndexer(inputCols=categorical, outputCols=[f"{c}_idx" for c in categorical], handleInvalid="keep")
        )
    inputs = [f"{f}_idx" if f in categorical else f for f in features]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep")]


def boosting(params: Mapping, label: str = "label", n_rows: int = 1, categories: int = 0) -> GBTClassifier:
    """Gradient-boosted trees with the usual parameter names mapped to Spark ML's.

    ``min_split_gain`` is a sum over rows, Spark ML's gain a mean, hence the
    division. ``scale_pos_weight`` becomes a weight column. The ridge and lasso
    penalties on leaves and ``subsample_freq`` have no counterpart. A text feature
    needs a bin for each of its ``categories``. The library allows a depth of 30 at most and says so.
    """
    p = {**DEFAULT_PARAMS, **params}
    depth = p.get("max_depth", -1)
    if depth is None or depth < 1:
        depth = max(1, math.ceil(math.log2(max(2, p["num_leaves"]))))
    share = min(1.0, max(0.01, float(p["colsample_bytree"])))
    trees = GBTClassifier(
        labelCol=label,
        featuresCol="features",
        stepSize=float(p["learning_rate"]),
        maxIter=int(p["n_estimators"]),
        maxDepth=int(depth),
        maxBins=max(2, int(p["max_bin"]), categories + 2),
        subsamplingRate=float(p["subsample"]),
        featureSubsetStrategy="all" if share >= 1.0 else str(share),
        minInstancesPerNode=int(p["min_child_samples"]),
        minInfoGain=float(p["min_split_gain"]) / max(n_rows, 1),
        seed=int(p["random_state"]),
    )
    return trees.setWeightCol(WEIGHT) if p.get("scale_pos_weight", 1) != 1 else trees


def fit_boosting(dev: DataFrame, features: Sequence[str], params: Mapping | None = None, label: str = "label") -> PipelineModel:
    params = params or {}
    rows = prepare(dev.filter(F.col(label).isin(0, 1)), features)
    n_rows = rows.count() if params.get("min_split_gain") else 1
    positive = float(params.get("scale_pos_weight", 1) or 1)
    if positive != 1:
        rows = rows.withColumn(WEIGHT, F.when(F.col(label) == 1, positive).otherwise(1.0))
    front = Pipeline(stages=feature_stages(rows, features)).fit(rows)
    categories = max((len(names) for stage in front.stages if hasattr(stage, "labelsArray") for names in stage.labelsArray), default=0)
    trees = boosting(params, label, n_rows, categories).fit(front.transform(rows))
    return PipelineModel([*front.stages, trees])


def searchable(space: Mapping[str, Sequence[float]]) -> dict:
    """The parts of a search space that the trees have a parameter for; the others are named in a warning."""
    absent = sorted(set(space) - SEARCHABLE)
    if absent:
        warnings.warn(f"no such parameter in the tree library, not searched: {absent}", stacklevel=2)
    return {k: v for k, v in space.items() if k in SEARCHABLE}


def score(model, df: DataFrame, features: Sequence[str], out: str = PROB) -> DataFrame:
    """Adds the probability of the bad class; scoring stays inside the JVM."""
    base = df.columns
    scored = model.transform(prepare(df, features))
    keep = [F.col(f"`{c}`") for c in base if c != out]
    if "probability" in scored.columns:
        return scored.select(*keep, vector_to_array("probability")[1].alias(out))
    return scored.select(*keep, vector_to_array("rawPrediction")[1].alias(out))


def evaluate_fit(scored: DataFrame, label: str = "label", prob: str = PROB, dataset: str = "dataset") -> dict:
    """KS, AUC, gap, decile lifts, violation and PSI of a scored dev/oot table as one record."""
    rows = {r[dataset]: r for r in performance(scored, prob, label, dataset).collect()}
    dev, oot = rows["dev"], rows["oot"]
    test = scored.filter(F.col(dataset) == "oot")
    lifts = head_and_tail_lift(level_table(test, prob, label)).first()
    psi = score_psi(scored.filter(F.col(dataset) == "dev"), test, prob).first().psi
    return {
        "ks_train": dev.ks, "ks_test": oot.ks, "ks_gap": abs(dev.ks - oot.ks), "auc_train": dev.auc,
        "auc_test": oot.auc, "psi": psi, "lift_head10": lifts.lift_head, "lift_tail10": lifts.lift_tail,
        "mono_violation": lifts.mono_violation, "overall_bad_rate": oot.bad / oot.total,
    }


def _leaf_range(tree) -> tuple[float, float]:
    """Smallest and largest prediction of a tree, as its description has them."""
    leaves = [float(x) for x in re.findall(r"Predict: (-?[0-9.]+(?:E-?[0-9]+)?)", tree.toDebugString)]
    return min(leaves), max(leaves)


def staged_ks(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """KS, bounds of the AUC and log loss on ``df`` after each boosting round, from the weighted outputs of the single trees."""
    *front, booster = model.stages
    rows = prepare(df.filter(F.col(label).isin(0, 1)), features)
    for stage in front:
        rows = stage.transform(rows)
    rows = rows.select(label, "features")
    outputs, ranges, low, high = [], [], 0.0, 0.0
    for i, (tree, weight) in enumerate(zip(booster.trees, booster.treeWeights)):
        tree.setPredictionCol(f"_t{i}")
        rows = tree.transform(rows)
        outputs.append(F.col(f"_t{i}") * float(weight))
        ends = sorted(float(weight) * x for x in _leaf_range(tree))
        low, high = low + ends[0], high + ends[1]
        ranges.append((low, high))
    return ks_by_round(rows.select(label, F.array(*outputs).alias("parts")), ranges, label)


def best_round(stages: DataFrame) -> DataFrame:
    """First round with the highest KS."""
    return stages.orderBy(F.desc("ks"), "round").limit(1)


def sample_params(space: Mapping[str, Sequence[float]], n_trials: int, seed: int = 42) -> list[dict]:
    rng = np.random.default_rng(seed)
    trials = []
    for _ in range(n_trials):
        drawn = {}
        for name, bounds in space.items():
            low, high = bounds[0], bounds[-1] if len(bounds) < 3 else bounds[1]
            whole = name in ("num_leaves", "max_bin", "n_estimators", "max_depth", "min_child_samples")
            value = rng.uniform(low, high)
            drawn[name] = int(round(value)) if whole else float(value)
        trials.append(drawn)
    return trials


def _both(dev: DataFrame, oot: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    columns = [label, *features]
    rows = dev.select(*columns).withColumn("dataset", F.lit("dev")).unionByName(
        oot.select(*columns).withColumn("dataset", F.lit("oot"))
    )
    return rows.filter(F.col(label).isin(0, 1))


def search_boosting(
    dev: DataFrame,
    oot: DataFrame,
    features: Sequence[str],
    n_trials: int = 10,
    base_params: Mapping | None = None,
    space: Mapping = SEARCH_SPACE,
    label: str = "label",
    parallelism: int = 2,
    seed: int = 42,
    early_stop: bool = True,
) -> DataFrame:
    """Trial table of a seeded parameter sweep.

    Each trial is a distributed fit; a few run at the same time so that small
    stages of one trial fill the gaps of another.
    """
    base = dict(base_params or {})
    both = prepare(_both(dev, oot, features, label), features).persist(StorageLevel.MEMORY_AND_DISK)
    train, test = both.filter("dataset = 'dev'"), both.filter("dataset = 'oot'")

    def run(item):
        number, drawn = item
        params = {**base, **drawn}
        model = fit_boosting(train, features, params, label)
        rounds = model.stages[-1].getNumTrees
        if early_stop:
            rounds = best_round(staged_ks(model, test, features, label)).first()["round"]
            if rounds < model.stages[-1].getNumTrees:
                params = {**params, "n_estimators": int(rounds)}
                model = fit_boosting(train, features, params, label)
        scored = score(model, both, features).select("dataset", label, PROB).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            metrics = evaluate_fit(scored, label)
        finally:
            scored.unpersist()
        params = {**params, "n_estimators": int(rounds)}
        return {"trial": number, **metrics, "params": {k: float(v) for k, v in params.items() if _is_number(v)}}

    try:
        with ThreadPool(parallelism) as pool:
            rows = pool.map(run, list(enumerate(sample_params(space, n_trials, seed))))
    finally:
        both.unpersist()
    schema = (
        "trial int, ks_train double, ks_test double, ks_gap double, auc_train double, auc_test double, psi double, "
        "lift_head10 double, lift_tail10 double, mono_violation double, overall_bad_rate double, params map<string,double>"
    )
    return dev.sparkSession.createDataFrame(rows, schema)


def _is_number(v) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def summarise_trials(
    trials: DataFrame, ks_threshold_min: float = 0.01, ks_gap_threshold: float = 0.05, psi_limit: float = PSI_LIMIT
) -> DataFrame:
    """Adds the constraint and business conditions and the Pareto mark to a trial table."""
    flagged = trials.select(
        "*",
        (F.col("ks_gap") <= ks_gap_threshold).alias("constraint_gap_ok"),
        (F.col("mono_violation") <= 0).alias("constraint_mono_ok"),
        (F.col("ks_train") > F.col("ks_test")).alias("business_order_ok"),
        (F.col("ks_test") >= ks_threshold_min).alias("business_ks_threshold_ok"),
        (F.col("psi") <= psi_limit).alias("business_psi_ok"),
    )
    marked = pareto_front(flagged, ["ks_test", "lift_head10"], ["lift_tail10"])
    return marked.withColumn(
        "all_conditions_ok",
        hard_conditions() & F.col("business_ks_threshold_ok") & F.col("business_psi_ok"),
    )


def hard_conditions():
    return F.col("constraint_gap_ok") & F.col("constraint_mono_ok") & F.col("business_order_ok")


def choose_trial(trials: DataFrame) -> DataFrame:
    """Best test KS on the Pareto front inside the best tier that has a trial.

    Tiers: all conditions (found), hard constraints only (partial), any (not_found).
    """
    status = F.when(F.col("all_conditions_ok"), "found").when(hard_conditions(), "partial").otherwise("not_found")
    tier = F.when(F.col("all_conditions_ok"), 0).when(hard_conditions(), 1).otherwise(2)
    pool = trials.filter("is_pareto_front")
    return pool.withColumn("status", status).orderBy(tier, F.desc("ks_test"), "trial").limit(1)


def search_logistic(
    dev: DataFrame, oot: DataFrame, features: Sequence[str], n_trials: int = 10, ks_threshold_min: float = 0.01,
    ks_gap_threshold: float = 0.05, label: str = "label", seed: int = 42, max_iter: int = 50,
) -> DataFrame:
    """Logistic regressions over a log-uniform penalty draw, ridge or lasso.

    ``objective`` is the test KS when all conditions hold, else 0.
    """
    both = prepare(_both(dev, oot, features, label), features)
    assembled = Pipeline(stages=feature_stages(both, features)).fit(both).transform(both)
    assembled = assembled.select("dataset", label, "features").persist(StorageLevel.MEMORY_AND_DISK)
    train = assembled.filter("dataset = 'dev'")
    n = train.count()
    rng = np.random.default_rng(seed)
    rows = []
    try:
        for number in range(n_trials):
            c = float(10 ** rng.uniform(-3, 2))
            lasso = bool(rng.integers(2))
            model = LogisticRegression(
                labelCol=label, regParam=1.0 / (c * n), elasticNetParam=1.0 if lasso else 0.0, maxIter=max_iter
            ).fit(train)
            scored = model.transform(assembled).select("dataset", label, vector_to_array("probability")[1].alias(PROB))
            perf = {r.dataset: r for r in performance(scored, PROB, label).collect()}
            ks_train, ks_test = perf["dev"].ks, perf["oot"].ks
            good = ks_test >= ks_threshold_min and abs(ks_train - ks_test) <= ks_gap_threshold and ks_train > ks_test
            rows.append((number, c, "l1" if lasso else "l2", ks_train, ks_test, perf["dev"].auc, perf["oot"].auc, ks_test if good else 0.0))
    finally:
        assembled.unpersist()
    return dev.sparkSession.createDataFrame(
        rows, "trial int, c double, penalty string, ks_train double, ks_test double, auc_train double, auc_test double, objective double"
    )


def fit_logistic(dev: DataFrame, features: Sequence[str], c: float = 1.0, penalty: str = "l2", label: str = "label") -> PipelineModel:
    rows = prepare(dev.filter(F.col(label).isin(0, 1)), features)
    model = LogisticRegression(labelCol=label, regParam=1.0 / (c * rows.count()), elasticNetParam=1.0 if penalty == "l1" else 0.0)
    return Pipeline(stages=[*feature_stages(rows, features), model]).fit(rows)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def tree_importances(spark: SparkSession, tree_model, features: Sequence[str], name: str = "trees") -> DataFrame:
    """Split count and summed gain per feature from the node table of a saved tree model."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{time.time_ns()}"
    tree_model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("nodeData.split.featureIndex").alias("idx"), F.col("nodeData.gain").alias("gain"),
        F.col("nodeData.leftChild").alias("left"),
    )
    used = nodes.filter("left >= 0").groupBy("idx").agg(
        F.count(F.lit(1)).alias("importance_split"), F.sum("gain").alias("importance_gain")
    )
    names = spark.createDataFrame(list(enumerate(features)), "idx int, feature string")
    return names.join(used, "idx", "left").na.fill(0, ["importance_split", "importance_gain"]).drop("idx")


def empty_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "Feature string, feature_cn string, data_source string")


def feature_importance_table(importances: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Importances with shares and dictionary names, best gain first (one row per feature)."""
    spark = importances.sparkSession
    dictionary = dictionary if dictionary is not None else empty_dictionary(spark)
    totals = importances.agg(F.sum("importance_split").alias("s"), F.sum("importance_gain").alias("g")).first()
    named = dictionary.select(F.col("Feature").alias("feature"), "feature_cn", "data_source")
    joined = named.join(importances, "feature", "right")
    return joined.select(
        "feature", "feature_cn", "data_source",
        F.col("importance_split").alias("importance_score_split"),
        F.col("importance_gain").alias("importance_score_gain"),
        F.try_divide(F.col("importance_split"), F.lit(float(totals.s or 0))).alias("imp_split_ratio"),
        F.try_divide(F.col("importance_gain"), F.lit(float(totals.g or 0))).alias("imp_gain_ratio"),
    ).orderBy(F.desc("importance_score_gain"), "feature")


def model_families(label: str, n_features: int, seed: int = 42, rounds: int = 20, max_iter: int = 50) -> dict:
    return {
        "logistic": LogisticRegression(labelCol=label, maxIter=max_iter),
        "decision_tree": DecisionTreeClassifier(labelCol=label, maxDepth=5, seed=seed),
        "random_forest": RandomForestClassifier(labelCol=label, numTrees=rounds, maxDepth=5, seed=seed),
        "boosted_trees": GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=4, seed=seed),
        "naive_bayes": NaiveBayes(labelCol=label, featuresCol="scaled"),
        "linear_svc": LinearSVC(labelCol=label, maxIter=max_iter),
        "factorization_machine": FMClassifier(labelCol=label, featuresCol="scaled", maxIter=max_iter, factorSize=4, stepSize=0.05, seed=seed),
        "neural_net": MultilayerPerceptronClassifier(labelCol=label, featuresCol="scaled", layers=[n_features, 8, 2], maxIter=max_iter, seed=seed),
    }


def compare_models(
    dev: DataFrame, oot: DataFrame, features: Sequence[str], time_limit: float = 300.0, label: str = "label",
    families: Mapping | None = None,
) -> DataFrame:
    """Leaderboard of model families by test KS; families past the time limit have the status ``not started``."""
    both = prepare(_both(dev, oot, features, label), features)
    stages = [*feature_stages(both, features), MinMaxScaler(inputCol="features", outputCol="scaled")]
    train_rows = both.filter("dataset = 'dev'")
    assembled = Pipeline(stages=stages).fit(train_rows).transform(both)
    # Rows outside the training range would turn negative, which naive Bayes refuses.
    assembled = assembled.select("dataset", label, "features", "scaled").persist(StorageLevel.MEMORY_AND_DISK)
    train = assembled.filter("dataset = 'dev'")
    began, rows = time.monotonic(), []
    try:
        for name, estimator in (families or model_families(label, len(features))).items():
            if time.monotonic() - began > time_limit:
                rows.append((name, "not started", None, None, None, None, None))
                continue
            at = time.monotonic()
            scored = estimator.fit(train).transform(assembled)
            raw = "probability" if "probability" in scored.columns else "rawPrediction"
            scored = scored.select("dataset", label, vector_to_array(raw)[1].alias(PROB))
            perf = {r.dataset: r for r in performance(scored, PROB, label).collect()}
            rows.append((name, "fitted", perf["oot"].ks, perf["oot"].auc, perf["dev"].ks, perf["dev"].auc, time.monotonic() - at))
    finally:
        assembled.unpersist()
    board = dev.sparkSession.createDataFrame(
        rows, "model string, status string, ks_test double, auc_test double, ks_train double, auc_train double, seconds double"
    )
    return board.orderBy(F.desc_nulls_last("ks_test"), "model")

"""Random-forest importances and the null-importance score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators import nullforest
from riskweave.operators.metrics import auc_ks
from riskweave.operators.train import feature_stages, prepare, tree_importances

# Size of the forests and the number of shuffled runs.
TREES, DEPTH, ROW_SHARE, COLUMN_SHARE = 60, 4, 0.6, "0.8"
NULL_RUNS = 80


def _assemble(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    rows = prepare(df.filter(F.col(label).isin(0, 1)), features)
    ready = Pipeline(stages=feature_stages(rows, features)).fit(rows).transform(rows)
    return ready.select(F.col(label).cast("double").alias("_y"), "features")


def _fit(rows: DataFrame, features: Sequence[str], trees: int, seed: int) -> DataFrame:
    model = RandomForestClassifier(
        labelCol="_y", numTrees=trees, maxDepth=DEPTH, subsamplingRate=ROW_SHARE,
        featureSubsetStrategy=COLUMN_SHARE, seed=seed,
    ).fit(rows)
    scored = model.transform(rows).select(F.col("_y").alias("label"), vector_to_array("probability")[1].alias("p"))
    return tree_importances(rows.sparkSession, model, features, "forest").withColumn("trn_score", F.lit(auc_ks(scored, "p").first().auc))


def actual_importance(
    df: DataFrame, features: Sequence[str], label: str = "label", id_col: str = "id", trees: int = TREES, seed: int = 817
) -> DataFrame:
    """Gain and split importance of a forest on the real label, with its train AUC."""
    rows = _assemble(df, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(rows, features, trees, seed)
    finally:
        rows.unpersist()


def null_importance(
    df: DataFrame, features: Sequence[str], label: str = "label", id_col: str = "id", nb_runs: int = NULL_RUNS, trees: int = TREES, seed: int = 817
) -> DataFrame:
    """Importances of forests on permuted labels: run, feature, importance_split, importance_gain; one job for each level of all trees."""
    rows = prepare(df.filter(F.col(label).isin(0, 1)), features)
    ready, design = nullforest.prepared(rows, list(features), label, nb_runs, trees, ROW_SHARE, float(COLUMN_SHARE), seed)
    return nullforest.importances(df.sparkSession, nullforest.grow(ready, design, DEPTH), design)


def null_score(actual: DataFrame, null: DataFrame) -> DataFrame:
    """log of the actual importance over the upper quartile of the shuffled ones.

    The quartile is taken over the runs of one feature, a list of bounded length.
    """
    quartiles = null.groupBy("feature").agg(
        F.percentile("importance_gain", 0.75).alias("null_gain"), F.percentile("importance_split", 0.75).alias("null_split")
    )
    mean = actual.groupBy("feature").agg(
        F.avg("importance_gain").alias("gain"), F.avg("importance_split").alias("split")
    )

    def ratio(value, base):
        return F.ln(F.lit(1e-10) + F.col(value) / (1 + F.col(base)))

    return mean.join(quartiles, "feature").select(
        "feature", ratio("split", "null_split").alias("split_score"), ratio("gain", "null_gain").alias("gain_score")
    )


def top_by_null_score(scores: DataFrame, top_n: int = 500) -> DataFrame:
    return scores.orderBy(F.desc("gain_score"), "feature").limit(top_n)

"""Joins between sample tables, and set operations on feature lists."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def merge_samples(tables: Sequence[DataFrame], features: Sequence[Sequence[str]], base: Sequence[str]) -> DataFrame:
    """Inner join of sample tables on the base columns, keeping chosen features of each.

    A missing key equals a missing key. All joins share one key list, so the
    shuffles of the chain are reused and skewed keys are split by adaptive execution.
    """
    picked = [t.select(*base, *names) for t, names in zip(tables, features)]
    return reduce(lambda a, b: null_safe_join(a, b, base), picked)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys where NULL equals NULL; an outer join fills the keys from whichever side has the row."""
    names = {k: f"_right_{i}" for i, k in enumerate(keys)}
    renamed = right.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()])
    joined = left.join(renamed, same, how)
    own = {k: F.col(f"`{k}`") for k in keys}
    if how != "inner":
        # Where the left row is absent its keys are NULL, and so are those of a left row without keys: then both agree.
        own = {k: F.coalesce(F.col(f"`{k}`"), F.col(n)) for k, n in names.items()}
    rest = [c for c in [*left.columns, *right.columns] if c not in names]
    return joined.select(*[c.alias(k) for k, c in own.items()], *[F.col(f"`{c}`") for c in rest])


def by_column_batches(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    process: Callable[[DataFrame, Sequence[str]], DataFrame],
    batch_size: int = 50,
) -> DataFrame:
    """Processes features in column batches and joins the results on the keys again."""
    parts = []
    for at in range(0, len(features), batch_size):
        names = list(features[at : at + batch_size])
        parts.append(process(df.select(*keys, *names), names))
    return reduce(lambda a, b: null_safe_join(a, b, keys, "full_outer"), parts)


def feature_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "feature string")


def present_features(spark: SparkSession, wanted: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return feature_table(spark, wanted).join(feature_table(spark, columns), "feature", "left_semi")


def missing_features(spark: SparkSession, wanted: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return feature_table(spark, wanted).join(feature_table(spark, columns), "feature", "left_anti")


def union_tables(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def top_rows(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(k)


def pareto_front(
    trials: DataFrame, maximise: Sequence[str], minimise: Sequence[str] = (), out: str = "is_pareto_front"
) -> DataFrame:
    """Marks rows no other row beats: at least as good everywhere and better somewhere.

    Equal rows do not beat each other. Every task first drops rows beaten inside
    its own batch; the survivors of all tasks, which are few, are compared once
    more, and all rows whose goal values survived are marked. Pairs of rows are
    never emitted.
    """
    goals = [*maximise, *minimise]
    signed = trials.select(
        *[F.col(c).cast("double").alias(c) for c in maximise],
        *[(-F.col(c).cast("double")).alias(c) for c in minimise],
    ).dropna()
    fields = ", ".join(f"`{c}` double" for c in goals)

    def survivors(batches):
        import numpy as np
        import pandas as pd

        best = np.empty((0, len(goals)))
        for batch in batches:
            best = _undominated(np.unique(np.concatenate([best, batch[goals].to_numpy(dtype=float)]), axis=0))
        if len(best):
            yield pd.DataFrame(best, columns=goals)

    local = signed.mapInPandas(survivors, fields)
    front = local.repartition(1).mapInPandas(survivors, fields)
    marked = front.select(
        *[F.col(c).alias(f"_g_{c}") for c in maximise], *[(-F.col(c)).alias(f"_g_{c}") for c in minimise]
    ).withColumn("_front", F.lit(True))
    match = reduce(
        lambda a, b: a & b, [F.col(c).cast("double") == F.col(f"_g_{c}") for c in goals]
    )
    joined = trials.join(marked, match, "left")
    return joined.select(*trials.columns, F.coalesce("_front", F.lit(False)).alias(out))


def _undominated(points):
    """Rows of a numpy array (all goals to be maximised) that no other row beats."""
    import numpy as np

    order = np.lexsort(points.T[::-1])[::-1]
    kept: list = []
    for row in points[order]:
        if kept:
            front = np.asarray(kept)
            if (((front >= row).all(axis=1)) & ((front > row).any(axis=1))).any():
                continue
        kept.append(row)
    return np.asarray(kept).reshape(-1, points.shape[1])

"""KS, AUC, level tables and lift.

All ranking metrics start from counts per distinct score, so tied rows combine
before the shuffle and the remaining order work is done per score range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.bins import with_bin, with_infinite_ends
from riskweave.operators.binning import level_edges, quantile_edges
from riskweave.operators.quantiles import running_totals
from riskweave.session import write_stage

LEVELS = 10


def score_counts(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Good and bad rows per distinct score (binary labels, known scores)."""
    rows = df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    return rows.groupBy(*keys, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 0).alias("good"), F.count_if(F.col(label) == 1).alias("bad")
    )


def grouped_scores(df: DataFrame, score: str, label: str, group: str) -> DataFrame:
    """Score counts for every group and for all rows together, as ``dim`` and ``col``."""
    rows = df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull()).select(
        F.col(group).cast("string").alias("col"), F.col(score).cast("double").alias("score"), label
    )
    counts = rows.groupingSets([["col", "score"], ["score"]], "col", "score").agg(
        F.grouping("col").alias("_all"),
        F.count_if(F.col(label) == 0).alias("good"),
        F.count_if(F.col(label) == 1).alias("bad"),
    )
    return counts.select(
        F.when(F.col("_all") == 1, "overall").otherwise(F.lit(group)).alias("dim"),
        F.when(F.col("_all") == 1, F.lit("overall")).otherwise(F.col("col")).alias("col"),
        "score", "good", "bad",
    )


def ranking(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Total, good, bad, bad ratio, AUC and KS per key from score counts.

    AUC gives tied scores half weight; both metrics are NULL when a class is missing.
    """
    keys = list(keys)
    counts = write_stage(counts, "score_counts")
    placed = running_totals(counts, "score", ["good", "bad"], keys, written=True)
    totals = counts.groupBy(*keys).agg(F.sum("good").alias("_g"), F.sum("bad").alias("_b"))
    if keys:
        condition = None
        renamed = totals.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "_g", "_b")
        for k in keys:
            test = F.col(k).eqNullSafe(F.col(f"_t_{k}"))
            condition = test if condition is None else condition & test
        placed = placed.join(renamed, condition)
    else:
        one = totals.first()
        placed = placed.select("*", F.lit(one._g or 0).alias("_g"), F.lit(one._b or 0).alias("_b"))
    good, bad = F.col("good").cast("double"), F.col("bad").cast("double")
    tpr = F.try_divide(F.col("below_bad") + bad, F.col("_b"))
    fpr = F.try_divide(F.col("below_good") + good, F.col("_g"))
    both = (F.col("goods") > 0) & (F.col("bads") > 0)
    stats = placed.groupBy(*keys).agg(
        F.sum("good").alias("goods"),
        F.sum("bad").alias("bads"),
        F.sum(bad * (F.col("below_good") + good / 2)).alias("_wins"),
        F.max(F.abs(tpr - fpr)).alias("_ks"),
    )
    return stats.select(
        *keys,
        (F.col("goods") + F.col("bads")).alias("total"),
        F.col("goods").alias("good"),
        F.col("bads").alias("bad"),
        F.try_divide("bads", F.col("goods") + F.col("bads")).alias("bad_ratio"),
        F.when(both, F.try_divide(F.col("_wins"), F.col("goods").cast("double") * F.col("bads"))).alias("auc"),
        F.when(both, F.col("_ks")).alias("ks"),
    )


def auc_ks(df: DataFrame, score: str, label: str = "label") -> DataFrame:
    return ranking(score_counts(df, score, label))


def auc_ks_by(df: DataFrame, score: str, group: str, label: str = "label") -> DataFrame:
    """Overall row and one row per group."""
    return ranking(grouped_scores(df, score, label, group), ["dim", "col"])


def performance(df: DataFrame, score: str, label: str = "label", dataset: str = "dataset", higher_is_good: bool = False) -> DataFrame:
    """Summary row per sample; for points, where high means good, AUC is turned round."""
    out = ranking(score_counts(df, score, label, [dataset]), [dataset])
    auc = 1 - F.col("auc") if higher_is_good else F.col("auc")
    return out.select(dataset, "total", "bad", F.bround("bad_ratio", 4).alias("bad_ratio"), auc.alias("auc"), "ks")


def roc_points(df: DataFrame, score: str, label: str = "label", dataset: str = "dataset") -> DataFrame:
    """False and true positive rate at every distinct score, from the highest down."""
    counts = score_counts(df, score, label, [dataset]).withColumn("_down", -F.col("score"))
    placed = running_totals(counts, "_down", ["good", "bad"], [dataset])
    totals = counts.groupBy(F.col(dataset).alias("_d")).agg(F.sum("good").alias("_g"), F.sum("bad").alias("_b"))
    joined = placed.join(totals, F.col(dataset) == F.col("_d"))
    return joined.select(
        dataset,
        "score",
        F.try_divide(F.col("below_good") + F.col("good"), F.col("_g")).alias("fpr"),
        F.try_divide(F.col("below_bad") + F.col("bad"), F.col("_b")).alias("tpr"),
    ).withColumn("gap", F.col("tpr") - F.col("fpr"))


def ks_cut(points: DataFrame, dataset: str = "dataset") -> DataFrame:
    """The score with the widest gap between the two rates; the highest score on a tie."""
    order = F.struct(F.abs("gap"), F.col("score"))
    return points.groupBy(dataset).agg(
        F.max(F.abs("gap")).alias("ks"), F.max_by("score", order).alias("cut_score"),
        F.max_by("tpr", order).alias("tpr"), F.max_by("fpr", order).alias("fpr"),
    )


def _level_rows(binned: DataFrame, label: str, bin_col: str) -> DataFrame:
    rows = binned.filter(F.col(label).isin(0, 1))
    return rows.groupBy(bin_col).agg(
        F.count(F.lit(1)).alias("num"),
        F.count_if(F.col(label) == 0).alias("good"),
        F.count_if(F.col(label) == 1).alias("bad"),
    )


def _accumulate(rows: DataFrame, order: str) -> DataFrame:
    """Running shares over the rows of a level table (a dozen rows at most)."""
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cum = rows.select(
        "*",
        F.try_divide("bad", F.col("num")).alias("bad_rate"),
        F.try_divide(F.sum("bad").over(upto), F.sum("bad").over(every)).alias("acc_bad"),
        F.try_divide(F.sum("num").over(upto), F.sum("num").over(every)).alias("acc_num"),
        F.try_divide(F.sum("bad").over(upto), F.sum("num").over(upto)).alias("acc_precision"),
        F.try_divide(F.sum("bad").over(every), F.sum("num").over(every)).alias("base_rate"),
    )
    return cum.select(
        "*",
        F.try_divide("acc_precision", F.min("acc_precision").over(every)).alias("lift"),
        F.try_divide("acc_precision", F.col("base_rate")).alias("lift_base"),
    )


def level_table(
    df: DataFrame, score: str, label: str = "label", n_bins: int = LEVELS, cut_points: Sequence[float] | None = None
) -> DataFrame:
    """Level table, level 1 holding the highest probabilities."""
    rows = df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    edges = with_infinite_ends(cut_points) if cut_points else level_edges(rows, score, n_bins)
    last = len(edges) - 1
    binned = with_bin(rows.select(label, score), score, edges, "_bin", include_lowest=True)
    counts = _level_rows(binned, label, "_bin")
    bounds = df.sparkSession.createDataFrame(
        [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:]))], "_bin int, lo double, hi double"
    )
    rows = counts.join(F.broadcast(bounds), "_bin").withColumn("level", F.lit(last) - F.col("_bin")).drop("_bin")
    table = _accumulate(rows, "level")
    return table.select(
        "level", "lo", "hi", "num", "good", "bad", "bad_rate", "acc_bad", "acc_num", "acc_precision",
        "base_rate", "lift", "lift_base",
    )


def head_and_tail_lift(levels: DataFrame) -> DataFrame:
    """Bad rate of the first and last level against the base rate, and the largest upward jump."""
    jump = F.greatest(F.col("bad_rate") - F.lag("bad_rate").over(Window.orderBy("level")), F.lit(0.0))
    return levels.withColumn("_jump", jump).agg(
        F.min_by(F.try_divide("bad_rate", F.col("base_rate")), "level").alias("lift_head"),
        F.max_by(F.try_divide("bad_rate", F.col("base_rate")), "level").alias("lift_tail"),
        F.coalesce(F.max("_jump"), F.lit(0.0)).alias("mono_violation"),
    )


def monotonic_violation(levels: DataFrame) -> DataFrame:
    """Largest rise of the bad rate from one level to the next, 0 when there is none."""
    known = levels.filter("bad_rate IS NOT NULL")
    rise = F.col("bad_rate") - F.lag("bad_rate").over(Window.orderBy("level"))
    return known.select(rise.alias("rise")).agg(F.greatest(F.coalesce(F.max("rise"), F.lit(0.0)), F.lit(0.0)).alias("mono_violation"))


def score_bands(df: DataFrame, score: str, cut_points: Sequence[float], label: str = "label") -> DataFrame:
    """Right-closed score bands in ascending order; rows outside all bands come last."""
    edges = [float(c) for c in cut_points]
    outside = len(edges) - 1
    rows = df.filter(F.col(label).isin(0, 1)).select(label, score)
    binned = with_bin(rows, score, edges, "band").withColumn("band", F.coalesce("band", F.lit(outside)))
    names = [(i, f"({a:g}, {b:g}]") for i, (a, b) in enumerate(zip(edges, edges[1:]))] + [(outside, "out_of_range")]
    labels = df.sparkSession.createDataFrame(names, "band int, range string")
    table = _accumulate(_level_rows(binned, label, "band").join(F.broadcast(labels), "band"), "band")
    every = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return table.select(
        F.row_number().over(Window.orderBy("band")).alias("index"), "range", "num", "good", "bad", "bad_rate",
        "acc_bad", "acc_precision", "acc_num", (F.col("num") / F.sum("num").over(every)).alias("num_ratio"), "lift",
    )


def lift_curve(df: DataFrame, score: str, label: str = "label", ncut: int = 20) -> DataFrame:
    """Cumulative count, response and lift over quantile cuts from the riskiest down."""
    rows = df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull()).select(label, (-F.col(score)).alias("_down"))
    edges = quantile_edges(rows, {"x": "_down"}, ncut)["x"]
    counts = _level_rows(with_bin(rows, "_down", edges, "cut", include_lowest=True), label, "cut")
    upto = Window.orderBy("cut").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy("cut").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    overall = F.sum("bad").over(every) / F.sum("num").over(every)
    return counts.select(
        "cut", F.sum("num").over(upto).alias("count"), F.sum("bad").over(upto).alias("response"),
        F.try_divide(F.sum("bad").over(upto), F.sum("num").over(upto) * overall).alias("lift"),
    )


class KSEvaluator(Evaluator, HasLabelCol):
    """KS of a probability column, for tuning with Spark ML."""

    def __init__(self, scoreCol: str = "prob_", labelCol: str = "label"):
        super().__init__()
        self.score_col = scoreCol
        self._set(labelCol=labelCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        return auc_ks(dataset, self.score_col, self.getLabelCol()).first().ks or 0.0

    def isLargerBetter(self) -> bool:
        return True

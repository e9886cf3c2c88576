"""Result tables that stand for the stage reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.cleaning import identify_types
from riskweave.operators import metrics
from riskweave.operators.joins import top_rows, union_tables
from riskweave.operators.profile import concentration, missing_profile, numeric_profile
from riskweave.operators.split import date_bounds, split_report
from riskweave.operators.stability import score_psi, verdict


def missing_and_top(df: DataFrame, features: Sequence[str], missing_list: Sequence = ()) -> DataFrame:
    """Missing rates next to the most frequent value of each feature."""
    missing = missing_profile(df, features, missing_list)
    return missing.join(concentration(df, features, missing_list).drop("type"), "feature")


def feature_report(df: DataFrame, features: Sequence[str], missing_list: Sequence = ()) -> DataFrame:
    """Missing rate, valid and distinct counts, top value and numeric statistics per feature."""
    numeric, _ = identify_types(df.select(*features))
    base = missing_and_top(df, features, missing_list).select(
        "feature", "type", "missing_tot", F.col("count").alias("valid_count"), "unique_cnt", "top", "freq_ratio"
    )
    stats = numeric_profile(df, numeric, missing_list).drop("count")
    return base.join(stats, "feature", "left")


def type_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    numeric, categorical = identify_types(df.select(*features))
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(numeric)).alias("numeric_features"), F.lit(len(categorical)).alias("categorical_features")
    )


def first_features(df: DataFrame, features: Sequence[str], missing_list: Sequence = (), k: int = 5) -> DataFrame:
    """The first features, numeric before categorical, with missing rate and top value."""
    numeric, categorical = identify_types(df.select(*features))
    chosen = [*numeric, *categorical][:k]
    place = df.sparkSession.createDataFrame(list(enumerate(chosen)), "place int, feature string")
    rows = missing_and_top(df, chosen, missing_list).select("feature", "type", "missing_tot", "top", "freq_ratio")
    return place.join(rows, "feature", "left").orderBy("place").limit(k)


def split_overview(raw: DataFrame, cleaned: DataFrame, split: DataFrame, channel_col: str = "channel", date_col: str = "date") -> DataFrame:
    """Raw and cleaned row counts and the channels, with the date range of each sample."""
    counts = raw.agg(F.count(F.lit(1)).alias("raw_rows")).first()
    channels = cleaned.groupBy(channel_col).agg(F.count(F.lit(1)).alias("n"))
    clean = channels.agg(
        F.sum("n").alias("cleaned_rows"), F.array_sort(F.collect_list(channel_col)).alias("channels")
    ).first()
    names = [c for c in clean.channels or [] if c is not None]
    return date_bounds(split, date_col).select(
        "*", F.lit(counts.raw_rows).alias("raw_rows"), F.lit(clean.cleaned_rows or 0).alias("cleaned_rows"),
        F.array(*[F.lit(c) for c in names]).cast("array<string>").alias("channels"),
    )


def selection_report(stats: DataFrame, kept: Sequence[str], k: int = 10) -> DataFrame:
    """Counts of all, kept and removed features beside the best kept features."""
    names = stats.sparkSession.createDataFrame([(f,) for f in kept], "feature string")
    total = stats.count()
    best = top_rows(stats.join(names, "feature", "left_semi"), k, F.desc("iv"), "feature")
    return best.select(
        F.lit(total).cast("bigint").alias("total_features"), F.lit(len(kept)).cast("bigint").alias("kept_features"),
        F.lit(total - len(kept)).cast("bigint").alias("removed_features"), "feature", "iv", "psi", "missing",
    )


def training_report(metrics_row: DataFrame, importances: DataFrame, k: int = 15) -> DataFrame:
    """Best importances with their share among the shown ones, and the metric row beside them."""
    used = importances.agg(
        F.count_if(F.col("importance_score_split") > 0).alias("nonzero"),
        F.count_if(F.col("importance_score_split") == 0).alias("zero"),
    ).first()
    row = metrics_row.first().asDict()
    top = top_rows(importances, k, F.desc("importance_score_gain"), "feature")
    every = Window.orderBy(F.desc("importance_score_gain"), "feature").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return top.select(
        "feature", "importance_score_split", "importance_score_gain",
        F.try_divide("importance_score_gain", F.sum("importance_score_gain").over(every)).alias("share_of_top"),
        F.lit(used.nonzero).alias("nonzero_features"), F.lit(used.zero).alias("zero_features"),
        *[F.lit(v).alias(k) for k, v in row.items()],
    )


def leaderboard_report(board: DataFrame, k: int = 15) -> DataFrame:
    rounded = [F.bround(c, 4).alias(c) for c in ("ks_test", "auc_test", "ks_train", "auc_train")]
    return top_rows(board.select("model", "status", *rounded), k, F.desc_nulls_last("ks_test"), "model")


def model_effect(scored: DataFrame, score: str = "prob_", group: str = "channel", label: str = "label", dataset: str = "dataset") -> DataFrame:
    """Dev and oot rows, overall and per group, from one table of score counts."""
    rows = scored.filter(F.col(dataset).isin("dev", "oot") & F.col(label).isin(0, 1) & F.col(score).isNotNull()).select(
        F.col(dataset).alias("dataset"), F.col(group).cast("string").alias("col"), F.col(score).cast("double").alias("score"), label
    )
    counts = rows.groupingSets([["dataset", "col", "score"], ["dataset", "score"]], "dataset", "col", "score").agg(
        F.grouping("col").alias("_all"), F.count_if(F.col(label) == 0).alias("good"), F.count_if(F.col(label) == 1).alias("bad")
    )
    named = counts.select(
        "dataset", F.when(F.col("_all") == 1, "overall").otherwise(F.lit(group)).alias("dim"),
        F.when(F.col("_all") == 1, F.lit("overall")).otherwise(F.col("col")).alias("col"), "score", "good", "bad",
    )
    return metrics.ranking(named, ["dataset", "dim", "col"])


def evaluation_report(
    scored: DataFrame, score: str = "prob_", group: str = "channel", label: str = "label", date_col: str = "date", bin_num: int = 10
) -> dict[str, DataFrame]:
    """Performance with date ranges, stability of dev against psi, level lifts and their overview.

    ``scored`` holds all rows of dev, oot and psi: rows without a binary label count for stability only.
    """
    effect = model_effect(scored, score, group, label)
    dates = date_bounds(scored.filter(F.col("dataset").isin("dev", "oot") & F.col(label).isin(0, 1)), date_col).drop("n_rows")
    overall = effect.filter("dim = 'overall'").drop("dim", "col").join(dates, "dataset")
    dev, psi_rows = scored.filter("dataset = 'dev'"), scored.filter("dataset = 'psi'")
    psi = score_psi(dev, psi_rows, score).withColumn("verdict", verdict(F.col("psi")))
    oot = scored.filter((F.col("dataset") == "oot") & F.col(label).isin(0, 1))
    levels = metrics.level_table(oot, score, label, bin_num)
    return {
        "performance": overall,
        "stability": psi,
        "channels": effect.filter(f"dim = '{group}' AND dataset = 'oot'").drop("dim", "dataset"),
        "lift_levels": levels,
        "lift_overview": lift_overview(levels),
        "model_effect": effect,
    }


def lift_overview(levels: DataFrame) -> DataFrame:
    """Lift of the first and of the first two levels with the share of rows they hold."""
    def at(level, name):
        return F.max(F.when(F.col("level") == level, F.col(name)))

    return levels.agg(
        at(1, "acc_num").alias("first_share"), at(1, "lift").alias("first_lift"),
        F.coalesce(at(2, "acc_num"), at(1, "acc_num")).alias("second_share"), F.coalesce(at(2, "lift"), at(1, "lift")).alias("second_lift"),
    )


def importances_with_stats(importances: DataFrame, stats: DataFrame) -> DataFrame:
    """Model features with their univariate statistics (one row per feature)."""
    return importances.join(stats, "feature", "left").orderBy(F.desc("importance_score_gain"), "feature")


def stacked(tables: dict[str, DataFrame], name: str = "section") -> DataFrame:
    return union_tables(*[t.withColumn(name, F.lit(k)) for k, t in tables.items()])

"""Report and importance tables over inputs derived from the samples, and properties of fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import long_numeric, query, union, with_risk
from checks.models import FEATURES, SMALL, WITH_TEXT
from checks.profile import rounded
from checks.selection import dev_oot
from riskweave.operators import metrics, report, score, staged, train
from riskweave.sources import demo

NAMES = ("amt", "bal", "sum_qty", "sig", "sparse")
# Importances that no model made: rows above zero as splits, the mean size as gain.
GIVEN = f"""
x AS ({long_numeric(NAMES)}),
imp AS (SELECT feature, CASE WHEN feature = 'sparse' THEN 0 ELSE CAST(count(*) FILTER (v > 0) AS BIGINT) END AS importance_split, avg(abs(v)) AS importance_gain FROM x GROUP BY 1),
named AS (SELECT feature, CASE WHEN feature = 'amt' THEN 'amount' END AS feature_cn, CASE WHEN feature = 'amt' THEN 'orders' END AS data_source,
  importance_split AS importance_score_split, importance_gain AS importance_score_gain,
  importance_split / sum(importance_split) OVER () AS imp_split_ratio, importance_gain / sum(importance_gain) OVER () AS imp_gain_ratio FROM imp)"""
SHOWN = """feature, importance_score_split, round(importance_score_gain, 6) AS importance_score_gain,
  round(imp_split_ratio, 8) AS imp_split_ratio, round(imp_gain_ratio, 8) AS imp_gain_ratio"""


def given(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, *NAMES)
    long = rows.unpivot([], list(NAMES), "feature", "v")
    table = long.groupBy("feature").agg(F.count_if(F.col("v") > 0).alias("n"), F.avg(F.abs("v")).alias("importance_gain"))
    table = table.select("feature", F.when(F.col("feature") == "sparse", F.lit(0)).otherwise(F.col("n")).cast("bigint").alias("importance_split"), "importance_gain")
    dictionary = spark.createDataFrame([("amt", "amount", "orders"), ("ghost", "none", "none")], "Feature string, feature_cn string, data_source string")
    return train.feature_importance_table(table, dictionary)


def shown(df):
    return rounded(rounded(df, "imp_split_ratio", "imp_gain_ratio"), "importance_score_gain", digits=6)


@query("feature_importance_table", with_risk(GIVEN, body=f"SELECT {SHOWN}, feature_cn, data_source FROM named"))
def feature_importance_table(spark, sf_dir):
    return shown(given(spark, sf_dir))


@query("nonzero_importance_given", with_risk(GIVEN, body="""
SELECT feature, importance_score_split, round(imp_split_ratio, 8) AS imp_split_ratio, round(imp_gain_ratio, 8) AS imp_gain_ratio FROM named WHERE importance_score_split > 0"""))
def nonzero_importance_given(spark, sf_dir):
    return rounded(score.nonzero_importances(given(spark, sf_dir)), "imp_split_ratio", "imp_gain_ratio")


@query("importances_with_stats", with_risk(GIVEN, "st AS (SELECT feature, round(avg(v), 4) AS mean, CAST(count(v) AS BIGINT) AS known FROM x WHERE feature <> 'sig' GROUP BY 1)", body=f"""
SELECT {SHOWN}, mean, known FROM named LEFT JOIN st USING (feature)"""))
def importances_with_stats(spark, sf_dir):
    names = [n for n in NAMES if n != "sig"]
    long = demo.risk_samples(spark, sf_dir, *names).unpivot([], names, "feature", "v")
    stats = long.groupBy("feature").agg(F.round(F.avg("v"), 4).alias("mean"), F.count("v").alias("known"))
    return shown(report.importances_with_stats(given(spark, sf_dir), stats)).drop("feature_cn", "data_source")


@query("training_report", with_risk(GIVEN, body="""
SELECT feature, importance_score_split, round(importance_score_gain, 6) AS importance_score_gain,
  round(importance_score_gain / sum(importance_score_gain) OVER (), 8) AS share_of_top, CAST(4 AS BIGINT) AS nonzero_features, CAST(1 AS BIGINT) AS zero_features,
  0.5::DOUBLE AS ks_test FROM (SELECT * FROM named ORDER BY importance_score_gain DESC, feature LIMIT 3)"""))
def training_report(spark, sf_dir):
    out = report.training_report(spark.createDataFrame([(0.5,)], "ks_test double"), given(spark, sf_dir), k=3)
    return rounded(rounded(out, "share_of_top"), "importance_score_gain", digits=6)


@query("leaderboard_report", with_risk("""
b AS (SELECT channel AS model, 'fitted' AS status, avg(amt) / 1e6 AS ks_test, avg(sig) / 1e4 AS auc_test, avg(bal) / 1e6 AS ks_train, avg(nation) / 100 AS auc_train FROM risk_samples GROUP BY 1)""", body="""
SELECT model, status, round_even(ks_test, 4) AS ks_test, round_even(auc_test, 4) AS auc_test, round_even(ks_train, 4) AS ks_train, round_even(auc_train, 4) AS auc_train
FROM b ORDER BY 3 DESC, 1 LIMIT 3"""))
def leaderboard_report(spark, sf_dir):
    """Channels in the place of model families."""
    rows = demo.risk_samples(spark, sf_dir, "channel", "amt", "sig", "bal", "nation")
    board = rows.groupBy(F.col("channel").alias("model")).agg(
        (F.avg("amt") / 1e6).alias("ks_test"), (F.avg("sig") / 1e4).alias("auc_test"), (F.avg("bal") / 1e6).alias("ks_train"), (F.avg("nation") / 100).alias("auc_train")
    )
    return report.leaderboard_report(board.withColumn("status", F.lit("fitted")), k=3)


OOT = "o AS (SELECT * FROM risk_samples WHERE label IN (0, 1) AND date >= 19990101)"


@query("boosting_scores_valid", with_risk(OOT, body="""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT id) AS BIGINT) AS n_ids, CAST(sum(label) AS BIGINT) AS n_bad, CAST(count(*) AS BIGINT) AS n_in_range FROM o"""))
def boosting_scores_valid(spark, sf_dir):
    """A fit scores every row once, with a probability."""
    dev, oot = dev_oot(spark, sf_dir)
    scored = train.score(train.fit_boosting(dev, WITH_TEXT, SMALL), oot, WITH_TEXT)
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.sum(F.col("label").cast("bigint")).alias("n_bad"),
        F.count_if(F.col(train.PROB).between(0, 1)).alias("n_in_range"),
    )


@query("staged_ks_ends_at_the_model", with_risk(OOT, body="""
SELECT CAST(5 AS BIGINT) AS rounds, CAST(count(*) AS BIGINT) AS n_rows, true AS last_equals_model FROM o"""))
def staged_ks_ends_at_the_model(spark, sf_dir):
    """The staged table has a row per round, and its last KS is that of the whole model."""
    dev, oot = dev_oot(spark, sf_dir)
    model = train.fit_boosting(dev, FEATURES, SMALL)
    steps = train.staged_ks(model, oot, FEATURES)
    whole = metrics.auc_ks(train.score(model, oot, FEATURES), train.PROB)
    last = steps.agg(F.max("round").cast("bigint").alias("rounds"), F.max_by("ks", "round").alias("last")).first()
    return whole.select(F.lit(last.rounds).alias("rounds"), F.col("total").alias("n_rows"), (F.abs(F.col("ks") - last.last) < 1e-9).alias("last_equals_model"))


PARTS = ("sig", "coalesce(sum_qty, 0)", "-amt / 1000", "CAST(nation * 7 AS DOUBLE)", "coalesce(bal, 0) / 100")


def _rounds_sql():
    scores = [f"SELECT {k + 1} AS round, label, {' + '.join(f'({p})' for p in PARTS[: k + 1])} AS score FROM risk_samples WHERE label IN (0, 1)" for k in range(len(PARTS))]
    return with_risk(
        f"s AS ({union(scores)})",
        "c AS (SELECT round, score, count(*) FILTER (label = 0) AS g, count(*) FILTER (label = 1) AS b FROM s GROUP BY 1, 2)",
        "r AS (SELECT *, sum(g) OVER o AS below_g, sum(b) OVER o AS below_b, sum(g) OVER (PARTITION BY round) AS all_g, sum(b) OVER (PARTITION BY round) AS all_b FROM c WINDOW o AS (PARTITION BY round ORDER BY score))",
        body="""
SELECT CAST(round AS INT) AS round, round(max(abs(below_b / all_b - below_g / all_g)), 8) AS ks, true AS auc_within,
  round(any_value(loss), 8) AS log_loss
FROM r JOIN (SELECT round, avg(ln(1 + exp(-abs(2 * score))) + greatest(CASE WHEN label = 1 THEN -2 * score ELSE 2 * score END, 0)) AS loss FROM s GROUP BY 1) USING (round) GROUP BY round""")


@query("ks_by_round", _rounds_sql())
def ks_by_round(spark, sf_dir):
    """KS after each of several parts of a score; the exact AUC of the last one lies within its bounds."""
    rows = demo.risk_samples(spark, sf_dir, "label", "sig", "sum_qty", "amt", "nation", "bal").where("label IN (0, 1)")
    parts = rows.select("label", F.array(*[F.expr(p).cast("double") for p in PARTS]).alias("parts"))
    steps = staged.ks_by_round(parts, [(0.0, 1000.0 * (k + 1)) for k in range(len(PARTS))])
    last = rows.select("label", F.expr(" + ".join(f"({p})" for p in PARTS)).cast("double").alias("score"))
    auc = metrics.auc_ks(last, "score").first().auc
    within = (F.col("round") < len(PARTS)) | F.lit(auc).between(F.col("auc_low") - 1e-12, F.col("auc_high") + 1e-12)
    return rounded(steps.select("round", "ks", within.alias("auc_within"), "log_loss"), "ks", "log_loss")

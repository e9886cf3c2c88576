"""Ranking metrics, level tables, score scaling and trial choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.bins import DECILES
from checks.common import interpolated, query, union, with_risk, with_scored
from checks.profile import rounded
from riskweave.functions.scores import to_points
from riskweave.operators import joins, metrics, score, train
from riskweave.sources import demo

CURVE = """
c AS (SELECT prob_ AS s, count(*) FILTER (label = 0) AS g, count(*) FILTER (label = 1) AS b FROM scored GROUP BY 1),
r AS (SELECT *, sum(g) OVER w AS cg, sum(b) OVER w AS cb, sum(g) OVER () AS tg, sum(b) OVER () AS tb FROM c
  WINDOW w AS (ORDER BY s ROWS UNBOUNDED PRECEDING))"""
AUC = "sum(b * (cg - g + g / 2)) / (any_value(tb)::DOUBLE * any_value(tg))"
KS = "max(abs(cb / tb - cg / tg))"


@query("ks", with_scored(CURVE, body=f"SELECT round({KS}, 8) AS ks FROM r"))
def ks(spark, sf_dir):
    return rounded(metrics.auc_ks(demo.scored(spark, sf_dir), "prob_").select("ks"), "ks")


@query("auc", with_scored(CURVE, body=f"SELECT round({AUC}, 8) AS auc FROM r"))
def auc(spark, sf_dir):
    return rounded(metrics.auc_ks(demo.scored(spark, sf_dir), "prob_").select("auc"), "auc")


GROUPED = """
x AS (SELECT 'overall' AS dim, 'overall' AS col, prob_, label FROM scored
      UNION ALL SELECT 'channel', channel, prob_, label FROM scored),
c AS (SELECT dim, col, prob_ AS s, count(*) FILTER (label = 0) AS g, count(*) FILTER (label = 1) AS b FROM x GROUP BY ALL),
r AS (SELECT *, sum(g) OVER w AS cg, sum(b) OVER w AS cb, sum(g) OVER (PARTITION BY dim, col) AS tg,
    sum(b) OVER (PARTITION BY dim, col) AS tb FROM c
  WINDOW w AS (PARTITION BY dim, col ORDER BY s ROWS UNBOUNDED PRECEDING))"""


@query("auc_ks_by_group", with_scored(GROUPED, body=f"""
SELECT dim, col, CAST(sum(g) + sum(b) AS BIGINT) AS total, CAST(sum(g) AS BIGINT) AS good, CAST(sum(b) AS BIGINT) AS bad,
  round(sum(b) / (sum(g) + sum(b)), 8) AS bad_ratio, round({AUC}, 8) AS auc, round({KS}, 8) AS ks FROM r GROUP BY 1, 2"""))
def auc_ks_by_group(spark, sf_dir):
    out = metrics.auc_ks_by(demo.scored(spark, sf_dir), "prob_", "channel")
    return rounded(out, "bad_ratio", "auc", "ks")


SETS = """
x AS (SELECT CASE WHEN date < 19990101 THEN 'dev' ELSE 'oot' END AS dataset, {score} AS s, label FROM scored),
c AS (SELECT dataset, s, count(*) FILTER (label = 0) AS g, count(*) FILTER (label = 1) AS b FROM x GROUP BY ALL),
r AS (SELECT *, sum(g) OVER w AS cg, sum(b) OVER w AS cb, sum(g) OVER (PARTITION BY dataset) AS tg,
    sum(b) OVER (PARTITION BY dataset) AS tb FROM c
  WINDOW w AS (PARTITION BY dataset ORDER BY s {down} ROWS UNBOUNDED PRECEDING))"""
POINTS = """least(greatest(round_even(410 + (91 / ln(0.5::DOUBLE)) * ln(8.6::DOUBLE) - (91 / ln(0.5::DOUBLE)) *
  ln((CASE WHEN prob_ = 1 THEN 1e-8::DOUBLE WHEN prob_ = 0 THEN 0.99999999::DOUBLE ELSE 1 - prob_ END)
   / (1 - CASE WHEN prob_ = 1 THEN 1e-8::DOUBLE WHEN prob_ = 0 THEN 0.99999999::DOUBLE ELSE 1 - prob_ END)), 0), 0), 1000)"""


def _datasets(spark, sf_dir):
    return demo.with_dataset(demo.scored(spark, sf_dir))


@query("performance_summary", with_scored(SETS.format(score="prob_", down=""), body=f"""
SELECT dataset, CAST(sum(g) + sum(b) AS BIGINT) AS total, CAST(sum(b) AS BIGINT) AS bad, round(sum(b) / (sum(g) + sum(b)), 4) AS bad_ratio,
  round({AUC}, 8) AS auc, round({KS}, 8) AS ks FROM r GROUP BY 1"""))
def performance_summary(spark, sf_dir):
    return rounded(metrics.performance(_datasets(spark, sf_dir), "prob_"), "auc", "ks")


@query("performance_points", with_scored(SETS.format(score=POINTS, down=""), body=f"""
SELECT dataset, CAST(sum(g) + sum(b) AS BIGINT) AS total, CAST(sum(b) AS BIGINT) AS bad, round(sum(b) / (sum(g) + sum(b)), 4) AS bad_ratio,
  round(1 - {AUC}, 8) AS auc, round({KS}, 8) AS ks FROM r GROUP BY 1"""))
def performance_points(spark, sf_dir):
    rows = _datasets(spark, sf_dir).withColumn("score_", to_points(F.col("prob_")))
    return rounded(metrics.performance(rows, "score_", higher_is_good=True), "auc", "ks")


@query("roc_points", with_scored(SETS.format(score="prob_", down="DESC"), body="""
SELECT dataset, s AS score, round(cg / tg, 8) AS fpr, round(cb / tb, 8) AS tpr, round(cb / tb - cg / tg, 8) AS gap FROM r"""))
def roc_points(spark, sf_dir):
    return rounded(metrics.roc_points(_datasets(spark, sf_dir), "prob_"), "fpr", "tpr", "gap")


@query("ks_cut", with_scored(SETS.format(score="prob_", down="DESC"), body="""
SELECT dataset, round(max(abs(cb / tb - cg / tg)), 8) AS ks, first(s ORDER BY abs(cb / tb - cg / tg) DESC, s DESC) AS cut_score,
  round(first(cb / tb ORDER BY abs(cb / tb - cg / tg) DESC, s DESC), 8) AS tpr,
  round(first(cg / tg ORDER BY abs(cb / tb - cg / tg) DESC, s DESC), 8) AS fpr FROM r GROUP BY 1"""))
def ks_cut(spark, sf_dir):
    return rounded(metrics.ks_cut(metrics.roc_points(_datasets(spark, sf_dir), "prob_")), "ks", "tpr", "fpr")


LEVELS = (*DECILES, """
b AS (SELECT greatest(len(list_filter(e, lambda v: v < prob_)), 1) AS i, len(e) AS k, label, e FROM scored, e),
c AS (SELECT k - i AS level, any_value(e[i]) AS lo, any_value(e[i + 1]) AS hi, count(*) AS num, count(*) FILTER (label = 0) AS good,
  count(*) FILTER (label = 1) AS bad FROM b GROUP BY 1),
r AS (SELECT *, bad / num AS bad_rate, sum(bad) OVER w / sum(bad) OVER () AS acc_bad, sum(num) OVER w / sum(num) OVER () AS acc_num,
  sum(bad) OVER w / sum(num) OVER w AS acc_precision, sum(bad) OVER () / sum(num) OVER () AS base_rate FROM c
  WINDOW w AS (ORDER BY level ROWS UNBOUNDED PRECEDING))""")


@query("decile_table", with_scored(*LEVELS, body="""
SELECT CAST(level AS INTEGER) AS level, round(lo, 8) AS lo, round(hi, 8) AS hi, CAST(num AS BIGINT) AS num, CAST(good AS BIGINT) AS good,
  CAST(bad AS BIGINT) AS bad, round(bad_rate, 8) AS bad_rate, round(acc_bad, 8) AS acc_bad, round(acc_num, 8) AS acc_num,
  round(acc_precision, 8) AS acc_precision, round(base_rate, 8) AS base_rate,
  round(acc_precision / min(acc_precision) OVER (), 8) AS lift, round(acc_precision / base_rate, 8) AS lift_base FROM r"""))
def decile_table(spark, sf_dir):
    out = metrics.level_table(demo.scored_table(spark, sf_dir), "prob_")
    return rounded(out, "lo", "hi", "bad_rate", "acc_bad", "acc_num", "acc_precision", "base_rate", "lift", "lift_base")


@query("decile_lift", with_scored(*LEVELS, body="""
SELECT round(first(bad_rate / base_rate ORDER BY level), 8) AS lift_head, round(last(bad_rate / base_rate ORDER BY level), 8) AS lift_tail,
  round(coalesce(max(greatest(jump, 0)), 0), 8) AS mono_violation FROM (SELECT *, bad_rate - lag(bad_rate) OVER (ORDER BY level) AS jump FROM r)"""))
def decile_lift(spark, sf_dir):
    out = metrics.head_and_tail_lift(metrics.level_table(demo.scored_table(spark, sf_dir), "prob_"))
    return rounded(out, "lift_head", "lift_tail", "mono_violation")


NOISE_LEVELS = tuple(part.replace("prob_", "bal").replace("FROM scored", "FROM (SELECT * FROM scored WHERE bal IS NOT NULL)") for part in LEVELS)


@query("monotonic_violation", with_scored(*NOISE_LEVELS, body="""
SELECT round(coalesce(max(greatest(jump, 0)), 0), 8) AS mono_violation FROM (SELECT bad_rate - lag(bad_rate) OVER (ORDER BY level) AS jump FROM r)"""))
def monotonic_violation(spark, sf_dir):
    return rounded(metrics.monotonic_violation(metrics.level_table(demo.scored_table(spark, sf_dir), "bal")), "mono_violation")


BANDS = (0, 400, 450, 500, 550, 600, 650, 700, 750, 800, 850, 999)
BAND_CASE = "CASE " + " ".join(f"WHEN s > {a} AND s <= {b} THEN {i}" for i, (a, b) in enumerate(zip(BANDS, BANDS[1:]))) + f" ELSE {len(BANDS) - 1} END"
BAND_NAME = "CASE band " + " ".join(f"WHEN {i} THEN '({a}, {b}]'" for i, (a, b) in enumerate(zip(BANDS, BANDS[1:]))) + " ELSE 'out_of_range' END"


@query("score_bands", with_scored(f"""
b AS (SELECT {BAND_CASE} AS band, label FROM (SELECT {POINTS} AS s, label FROM scored WHERE date >= 19990101)),
c AS (SELECT band, count(*) AS num, count(*) FILTER (label = 0) AS good, count(*) FILTER (label = 1) AS bad FROM b GROUP BY 1),
r AS (SELECT *, bad / num AS bad_rate, sum(bad) OVER w / sum(bad) OVER () AS acc_bad, sum(num) OVER w / sum(num) OVER () AS acc_num,
  sum(bad) OVER w / sum(num) OVER w AS acc_precision FROM c WINDOW w AS (ORDER BY band ROWS UNBOUNDED PRECEDING))""", body=f"""
SELECT CAST(row_number() OVER (ORDER BY band) AS INTEGER) AS index, {BAND_NAME} AS range, CAST(num AS BIGINT) AS num, CAST(good AS BIGINT) AS good,
  CAST(bad AS BIGINT) AS bad, round(bad_rate, 8) AS bad_rate, round(acc_bad, 8) AS acc_bad, round(acc_precision, 8) AS acc_precision,
  round(acc_num, 8) AS acc_num, round(num / sum(num) OVER (), 8) AS num_ratio,
  round(acc_precision / nullif(min(acc_precision) OVER (), 0), 8) AS lift FROM r"""))
def score_bands(spark, sf_dir):
    rows = demo.scored(spark, sf_dir).filter(F.col("date") >= demo.CUT_DATE)
    out = metrics.score_bands(rows.withColumn("score_", to_points(F.col("prob_"))), "score_", BANDS)
    return rounded(out, "bad_rate", "acc_bad", "acc_precision", "acc_num", "num_ratio", "lift")


@query("lift_curve", with_scored(
    "l AS (SELECT list(-prob_ ORDER BY -prob_) AS l FROM scored)",
    f"e AS (SELECT list(DISTINCT e ORDER BY e) AS e FROM (SELECT {interpolated('l', 'k / 20.0::DOUBLE')} AS e FROM l, range(0, 21) t(k)))",
    "b AS (SELECT greatest(len(list_filter(e, lambda v: v < -prob_)), 1) - 1 AS cut, label FROM scored, e)",
    "c AS (SELECT cut, count(*) AS n, sum(label) AS bad FROM b GROUP BY 1)", body="""
SELECT CAST(cut AS INTEGER) AS cut, CAST(sum(n) OVER w AS BIGINT) AS count, CAST(sum(bad) OVER w AS BIGINT) AS response,
  round(sum(bad) OVER w / (sum(n) OVER w * (sum(bad) OVER () / sum(n) OVER ())), 8) AS lift FROM c WINDOW w AS (ORDER BY cut ROWS UNBOUNDED PRECEDING)"""))
def lift_curve(spark, sf_dir):
    return rounded(metrics.lift_curve(demo.scored_table(spark, sf_dir), "prob_"), "lift")


@query("score_transfer", with_scored(body=f"SELECT id, {POINTS} AS score_ FROM scored"))
def score_transfer(spark, sf_dir):
    return demo.scored(spark, sf_dir).select("id", to_points(F.col("prob_")).alias("score_"))


def _three_way_sql(*first, source="scored"):
    counts = ", ".join(
        f"count(*) FILTER (ds = '{d}' AND label = {v}) AS {d}_{v}" for d in ("dev", "oot") for v in (0, 1)
    )
    return with_scored(
        *first,
        f"p AS (SELECT {POINTS} AS s, label, date FROM {source})",
        """x AS (SELECT s, label, 'dev' AS ds FROM p WHERE date < 19990101 UNION ALL SELECT s, label, 'oot' FROM p WHERE date >= 19990101
           UNION ALL SELECT s, label, 'psi' FROM p WHERE date >= 20000101)""",
        "m AS (SELECT min(s) FILTER (s > -1) AS lo, max(s) AS hi FROM x WHERE ds = 'dev')",
        """e AS (SELECT list(DISTINCT e ORDER BY e) AS e FROM (SELECT round(lo - 0.0001::DOUBLE, 4) AS e FROM m
           UNION ALL SELECT round(lo + (hi - lo) / 11 + k * ((hi - lo) / 11), 4) FROM m, range(0, 11) t(k)))""",
        """g AS (SELECT i - 1 AS band, CASE WHEN i = 1 THEN 0 ELSE e[i] END AS lo, CASE WHEN i + 1 = len(e) THEN 1000 ELSE e[i + 1] END AS hi
           FROM (SELECT e, unnest(range(1, len(e))) AS i FROM e))""",
        f"""c AS (SELECT band, g.lo, g.hi, {counts}, count(*) FILTER (ds = 'psi') AS psi FROM g LEFT JOIN x ON s > g.lo AND s <= g.hi GROUP BY 1, 2, 3)""",
        body="""
SELECT CAST(band AS INTEGER) AS band, lo, hi, CAST(dev_0 AS BIGINT) AS dev_0, CAST(dev_1 AS BIGINT) AS dev_1, CAST(oot_0 AS BIGINT) AS oot_0,
  CAST(oot_1 AS BIGINT) AS oot_1, CAST(psi AS BIGINT) AS psi, CAST(dev_0 + dev_1 + oot_0 + oot_1 + psi AS BIGINT) AS "all",
  round((dev_0 + dev_1) / sum(dev_0 + dev_1) OVER (), 8) AS total_pcnt_dev, round((oot_0 + oot_1) / sum(oot_0 + oot_1) OVER (), 8) AS total_pcnt_oot,
  round(psi / sum(psi) OVER (), 8) AS total_pcnt_psi, round(CASE WHEN dev_0 + dev_1 > 0 THEN dev_1 / (dev_0 + dev_1) ELSE 0 END, 8) AS bad_rate_dev,
  round(CASE WHEN oot_0 + oot_1 > 0 THEN oot_1 / (oot_0 + oot_1) ELSE 0 END, 8) AS bad_rate_oot FROM c""",
    )


@query("band_table_3way", _three_way_sql())
def band_table_3way(spark, sf_dir):
    rows = demo.scored(spark, sf_dir).withColumn("score", to_points(F.col("prob_")))
    sets = F.array_compact(F.array(
        F.when(F.col("date") < demo.CUT_DATE, F.lit("dev")).otherwise(F.lit("oot")),
        F.when(F.col("date") >= 20000101, F.lit("psi")),
    ))
    return score.band_table(rows.select("score", "label", F.explode(sets).alias("dataset")), "score")


TRIALS = """
t AS (SELECT r.nation AS trial, s.prob_, s.label, s.date < 19990101 AS dev FROM scored s JOIN risk_samples r ON r.id = s.id),
c AS (SELECT trial, dev, prob_ AS s, count(*) FILTER (label = 0) AS g, count(*) FILTER (label = 1) AS b FROM t GROUP BY ALL),
r AS (SELECT *, sum(g) OVER w AS cg, sum(b) OVER w AS cb, sum(g) OVER (PARTITION BY trial, dev) AS tg, sum(b) OVER (PARTITION BY trial, dev) AS tb
  FROM c WINDOW w AS (PARTITION BY trial, dev ORDER BY s ROWS UNBOUNDED PRECEDING)),
k AS (SELECT trial, dev, max(abs(cb / nullif(tb, 0) - cg / nullif(tg, 0))) AS ks,
  sum(b * (cg - g + g / 2)) / nullif(any_value(tb)::DOUBLE * any_value(tg), 0) AS auc FROM r GROUP BY 1, 2),
h AS (SELECT trial, avg(label) FILTER (prob_ >= 0.7) / avg(label) AS head, avg(label) FILTER (prob_ < 0.3) / avg(label) AS tail FROM t GROUP BY 1),
m AS (SELECT h.trial, round(d.ks, 8) AS ks_train, round(o.ks, 8) AS ks_test, round(abs(round(d.ks, 8) - round(o.ks, 8)), 8) AS ks_gap,
  round(d.auc, 8) AS auc_train, round(o.auc, 8) AS auc_test, round(head, 8) AS lift_head10, round(tail, 8) AS lift_tail10,
  round(greatest(tail - head, 0), 8) AS mono_violation, round(abs(d.auc - o.auc), 8) AS psi
  FROM h JOIN k d ON d.trial = h.trial AND d.dev JOIN k o ON o.trial = h.trial AND NOT o.dev),
f AS (SELECT *, ks_gap <= 0.05 AS constraint_gap_ok, mono_violation <= 0 AS constraint_mono_ok, ks_train > ks_test AS business_order_ok,
  ks_test >= 0.1 AS business_ks_threshold_ok, psi <= 0.2 AS business_psi_ok,
  NOT EXISTS (SELECT 1 FROM m o WHERE o.ks_test >= m.ks_test AND o.lift_head10 >= m.lift_head10 AND o.lift_tail10 <= m.lift_tail10
    AND (o.ks_test > m.ks_test OR o.lift_head10 > m.lift_head10 OR o.lift_tail10 < m.lift_tail10)) AS is_pareto_front FROM m)"""
ALL_OK = "constraint_gap_ok AND constraint_mono_ok AND business_order_ok AND business_ks_threshold_ok AND business_psi_ok"


def segment_trials(spark, sf_dir):
    """One trial per nation: how well the probability ranks that nation's applications."""
    rows = demo.scored(spark, sf_dir, "nation").withColumn("trial", F.col("nation"))
    rows = rows.withColumn("sample", F.when(F.col("date") < demo.CUT_DATE, "train").otherwise("test"))
    ranks = metrics.ranking(metrics.score_counts(rows, "prob_", "label", ["trial", "sample"]), ["trial", "sample"])

    def of(sample, name):
        return F.max(F.when(F.col("sample") == sample, F.col(name)))

    wide = ranks.groupBy("trial").agg(
        *[of(s, m).alias(f"{m}_{s}") for m in ("ks", "auc") for s in ("train", "test")]
    )
    label, prob = F.col("label"), F.col("prob_")
    ends = rows.groupBy("trial").agg(
        F.try_divide(F.avg(F.when(prob >= 0.7, label)), F.avg(label)).alias("lift_head10"),
        F.try_divide(F.avg(F.when(prob < 0.3, label)), F.avg(label)).alias("lift_tail10"),
    )
    joined = wide.join(ends, "trial").select(
        "*",
        F.greatest(F.col("lift_tail10") - F.col("lift_head10"), F.lit(0.0)).alias("mono_violation"),
        F.abs(F.col("auc_train") - F.col("auc_test")).alias("psi"),
    )
    joined = rounded(joined, "ks_train", "ks_test", "auc_train", "auc_test", "lift_head10", "lift_tail10", "mono_violation", "psi")
    joined = rounded(joined.withColumn("ks_gap", F.abs(F.col("ks_train") - F.col("ks_test"))), "ks_gap")
    return joined


@query("pareto_trials", with_scored(TRIALS, body=f"""
SELECT trial, ks_train, ks_test, ks_gap, auc_train, auc_test, lift_head10, lift_tail10, mono_violation, psi, constraint_gap_ok, constraint_mono_ok,
  business_order_ok, business_ks_threshold_ok, business_psi_ok, is_pareto_front, {ALL_OK} AS all_conditions_ok FROM f"""))
def pareto_trials(spark, sf_dir):
    return train.summarise_trials(segment_trials(spark, sf_dir), ks_threshold_min=0.1, ks_gap_threshold=0.05)


HARD = "constraint_gap_ok AND constraint_mono_ok AND business_order_ok"


@query("trial_choice", with_scored(TRIALS, body=f"""
SELECT trial, ks_test, CASE WHEN {ALL_OK} THEN 'found' WHEN {HARD} THEN 'partial' ELSE 'not_found' END AS status
FROM f WHERE is_pareto_front ORDER BY CASE WHEN {ALL_OK} THEN 0 WHEN {HARD} THEN 1 ELSE 2 END, ks_test DESC, trial LIMIT 1"""))
def trial_choice(spark, sf_dir):
    trials = train.summarise_trials(segment_trials(spark, sf_dir), ks_threshold_min=0.1, ks_gap_threshold=0.05)
    return train.choose_trial(trials).select("trial", "ks_test", "status")


@query("evaluator_folds", with_scored(
    "c AS (SELECT id % 3 AS fold, prob_ AS s, count(*) FILTER (label = 0) AS g, count(*) FILTER (label = 1) AS b FROM scored GROUP BY 1, 2)",
    "r AS (SELECT fold, sum(g) OVER w AS cg, sum(b) OVER w AS cb, sum(g) OVER (PARTITION BY fold) AS tg, sum(b) OVER (PARTITION BY fold) AS tb FROM c WINDOW w AS (PARTITION BY fold ORDER BY s ROWS UNBOUNDED PRECEDING))",
    body=f"SELECT CAST(fold AS INT) AS fold, round({KS}, 8) AS ks, true AS larger_is_better FROM r GROUP BY fold"))
def evaluator_folds(spark, sf_dir):
    """KS of the Spark ML evaluator on the folds that a cross validation would use."""
    rows = demo.scored(spark, sf_dir).withColumn("fold", (F.col("id") % 3).cast("int"))
    judge = metrics.KSEvaluator()
    found = [(k, round(judge.evaluate(rows.filter(F.col("fold") == k)), 8), judge.isLargerBetter()) for k in range(3)]
    return spark.createDataFrame(found, "fold int, ks double, larger_is_better boolean")

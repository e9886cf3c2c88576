"""Sources, sinks, report tables and whole stages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.clean import CLEANED, MONTH, SPLIT, STATS, SPEC
from checks.common import interpolated, long_numeric, query, union, with_risk, with_scored
from checks.metrics import AUC, KS, LEVELS, POINTS, _three_way_sql
from checks.models import FEATURES as MODEL_FEATURES, SMALL, three_samples
from checks.profile import CONCENTRATED, TOKENS, _values_sql, rounded
from checks.selection import FEATURES as ALL_FEATURES, STATS_SQL, dev_oot, stats
from checks.stability import SCORE_PSI
from riskweave.functions.scores import to_points
from riskweave.operators import clean, joins, metrics, report, score, select, train
from riskweave.plans import stages
from riskweave.plans.configs import EvalSettings, ProfileSettings, SelectSettings, SplitSettings, TrainSettings
from riskweave.session import shared_dir
from riskweave.sources import demo, samples


SPLIT_CONFIG = SplitSettings(train_split_range=(19950101, 19981231), oot_split_range=(19990101, 20010801), psi_split_range=(20000101, 20010801))


BANDS_OF_ALL = _three_way_sql("everyone AS (SELECT date, label, (CAST(sig AS BIGINT) * 8 + (id * 31) % 800) / CAST(10000 AS DOUBLE) AS prob_ FROM risk_samples)", source="everyone")


def fresh_path(spark, name):
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"


@query("csv_roundtrip", with_risk(body="SELECT id, date, label, channel, amt, bal, CASE WHEN seg <> '' THEN seg END AS seg, n_lines FROM risk_samples"))
def csv_roundtrip(spark, sf_dir):
    columns = ["id", "date", "label", "channel", "amt", "bal", "seg", "n_lines"]
    path = samples.write_table(demo.risk_samples(spark, sf_dir, *columns), fresh_path(spark, "export") + ".csv")
    return samples.read_samples(spark, path, SPEC.base_fea).withColumn("label", F.col("label").cast("int"))


@query("read_by_config", with_risk(body="SELECT id, date, label, channel, amt, bal, sig FROM risk_samples"))
def read_by_config(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id", "date", "label", "channel", "amt", "bal", "sig")
    path = samples.write_table(rows, fresh_path(spark, "source"))
    return samples.read_by_config(
        spark, {"data_path": path, "base_fea": ["id", "date", "label", "channel"], "batch_columns": True, "batch_size": 2, "save_path": fresh_path(spark, "joined")}
    )


@query("read_folder", with_risk(body="SELECT id, amt FROM risk_samples"))
def read_folder(spark, sf_dir):
    path = samples.write_table(demo.risk_samples(spark, sf_dir, "id", "amt"), fresh_path(spark, "folder"), "csv")
    return joins.union_tables(*[t for _, t in samples.read_folder(spark, path, ["id"])])


REPRODUCED = f"""
p AS (SELECT *, {POINTS} AS score_ FROM scored),
x AS (SELECT *, CASE WHEN date < 19990101 THEN 'dev' ELSE 'oot' END AS dataset FROM p)"""


def scored_with_points(spark, sf_dir):
    rows = demo.with_dataset(demo.scored(spark, sf_dir))
    return rows.withColumn("score_", to_points(F.col("prob_")))


@query("reproduction_rows", with_scored(REPRODUCED, body=f"SELECT dataset, id, date, label, channel, sig, prob_, score_, {MONTH} AS month FROM x"))
def reproduction_rows(spark, sf_dir):
    return samples.reproduction_rows(scored_with_points(spark, sf_dir), SPEC.base_fea, ["sig"])


@query("parity_rows", with_scored(body="SELECT id, sig, prob_ FROM scored ORDER BY id LIMIT 100"))
def parity_rows(spark, sf_dir):
    return score.parity_rows(demo.scored(spark, sf_dir), ["id", "sig", "prob_"])


@query("parity_sample", with_scored(body="""
SELECT id FROM (SELECT id FROM scored ORDER BY id LIMIT 100) ORDER BY md5(concat_ws('-', CAST(id AS VARCHAR), '42')) LIMIT 5"""))
def parity_sample(spark, sf_dir):
    return score.parity_sample(demo.scored(spark, sf_dir), ["id", "sig", "prob_"]).select("id")


def _missing_cte():
    parts = []
    for f in CONCENTRATED:
        tok = "'-9998'" if f in ("seg", "channel") else "-9999"
        parts.append(f"SELECT '{f}' AS feature, round(avg(CASE WHEN {f} IS NULL OR {f} = {tok} THEN 1 ELSE 0 END), 8) AS missing_tot, CAST(count(*) AS BIGINT) AS total_count FROM risk_samples")
    return f"miss AS ({union(parts)})"


CONC = """conc AS (SELECT c.feature, type, CAST(coalesce(sum(cnt) FILTER (v IS NOT NULL), 0) AS BIGINT) AS valid_count, CAST(count(v) AS BIGINT) AS unique_cnt,
  first(v ORDER BY (v IS NULL), cnt DESC, v) AS top, round(max(cnt) FILTER (v IS NOT NULL) / sum(cnt), 8) AS freq_ratio FROM c GROUP BY 1, 2)"""


@query("missing_and_top", with_risk(_values_sql(True), CONC, _missing_cte(), body="""
SELECT feature, type, total_count, missing_tot, valid_count AS count, unique_cnt, top, freq_ratio FROM miss JOIN conc USING (feature)"""))
def missing_and_top(spark, sf_dir):
    out = report.missing_and_top(demo.risk_samples(spark, sf_dir, *CONCENTRATED), CONCENTRATED, TOKENS)
    return rounded(out, "missing_tot", "freq_ratio").select("feature", "type", "total_count", "missing_tot", "count", "unique_cnt", "top", "freq_ratio")


NUMERIC_SHOWN = [f for f in CONCENTRATED if f not in ("seg", "channel")]


@query("feature_report", with_risk(_values_sql(True), CONC, _missing_cte(),
    f"x2 AS ({long_numeric(NUMERIC_SHOWN)})",
    f"s AS (SELECT feature, list(v ORDER BY v) AS l, avg(v) AS m, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM x2 WHERE v IS NOT NULL AND v <> -9999 GROUP BY 1)",
    body=f"""
SELECT feature, type, missing_tot, valid_count, unique_cnt, top, freq_ratio, round(m, 4) AS mean, round(sd, 4) AS std, lo AS min,
  round({interpolated('l', '0.5::DOUBLE')}, 6) AS p50, hi AS max FROM miss JOIN conc USING (feature) LEFT JOIN s USING (feature)"""))
def feature_report(spark, sf_dir):
    out = report.feature_report(demo.samples_table(spark, sf_dir), CONCENTRATED, TOKENS)
    out = rounded(rounded(out, "missing_tot", "freq_ratio"), "mean", "std", digits=4)
    return rounded(out, "p50", digits=6).select(
        "feature", "type", "missing_tot", "valid_count", "unique_cnt", "top", "freq_ratio", "mean", "std", "min", "p50", "max"
    )


@query("first_features", with_risk(_values_sql(True), CONC, _missing_cte(), body="""
SELECT CAST(place AS INTEGER) AS place, feature, type, missing_tot, top, freq_ratio FROM miss JOIN conc USING (feature)
JOIN (SELECT unnest(['nation', 'n_lines', 'konst', 'bal', 'sparse']) AS feature, unnest(range(0, 5)) AS place) USING (feature)"""))
def first_features(spark, sf_dir):
    out = report.first_features(demo.risk_samples(spark, sf_dir, *CONCENTRATED), CONCENTRATED, TOKENS)
    return rounded(out, "missing_tot", "freq_ratio")


@query("type_counts", with_risk(body="SELECT CAST(count(*) AS BIGINT) AS n_rows, 6 AS numeric_features, 2 AS categorical_features FROM risk_samples"))
def type_counts(spark, sf_dir):
    return report.type_counts(demo.risk_samples(spark, sf_dir, *CONCENTRATED), CONCENTRATED)


@query("split_overview", with_risk(CLEANED, body="""
SELECT dataset, CAST(count(*) AS BIGINT) AS n_rows, min(date) AS min_date, max(date) AS max_date,
  (SELECT CAST(count(*) AS BIGINT) FROM risk_samples) AS raw_rows, (SELECT CAST(count(*) AS BIGINT) FROM cleaned) AS cleaned_rows,
  (SELECT list_sort(list(DISTINCT channel)) FROM cleaned) AS channels
FROM (SELECT *, CASE WHEN date < 19990101 THEN 'dev' ELSE 'oot' END AS dataset FROM cleaned) GROUP BY 1"""))
def split_overview(spark, sf_dir):
    raw = demo.risk_samples(spark, sf_dir, "id", "date", "label", "channel")
    cleaned = clean.clean_samples(raw, SPEC)
    return report.split_overview(raw, cleaned, demo.with_dataset(cleaned))


@query("selection_report", f"""
WITH s AS (SELECT * FROM ({STATS_SQL})), k AS (SELECT * FROM s WHERE iv >= 0.01 AND missing < 0.9 AND psi < 0.2)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM s) AS total_features, (SELECT CAST(count(*) AS BIGINT) FROM k) AS kept_features,
  (SELECT CAST(count(*) AS BIGINT) FROM s) - (SELECT CAST(count(*) AS BIGINT) FROM k) AS removed_features, feature, iv, psi, missing
FROM k ORDER BY iv DESC, feature LIMIT 10""")
def selection_report(spark, sf_dir):
    table = stats(spark, sf_dir)
    table = spark.createDataFrame(table.collect(), table.schema)
    kept = [r.feature for r in select.passing_features(table, 0.01, 0.2, 0.9).collect()]
    return report.selection_report(table, kept)


EFFECT = """
x AS (SELECT CASE WHEN date < 19990101 THEN 'dev' ELSE 'oot' END AS dataset, dim, col, prob_, label FROM (
  SELECT date, 'overall' AS dim, 'overall' AS col, prob_, label FROM scored UNION ALL SELECT date, 'channel', channel, prob_, label FROM scored)),
c AS (SELECT dataset, dim, col, prob_ AS s, count(*) FILTER (label = 0) AS g, count(*) FILTER (label = 1) AS b FROM x GROUP BY ALL),
r AS (SELECT *, sum(g) OVER w AS cg, sum(b) OVER w AS cb, sum(g) OVER (PARTITION BY dataset, dim, col) AS tg,
    sum(b) OVER (PARTITION BY dataset, dim, col) AS tb FROM c
  WINDOW w AS (PARTITION BY dataset, dim, col ORDER BY s ROWS UNBOUNDED PRECEDING)),
effect AS (SELECT dataset, dim, col, CAST(sum(g) + sum(b) AS BIGINT) AS total, CAST(sum(g) AS BIGINT) AS good, CAST(sum(b) AS BIGINT) AS bad,
  round(sum(b) / (sum(g) + sum(b)), 8) AS bad_ratio, round({auc}, 8) AS auc, round({ks}, 8) AS ks FROM r GROUP BY 1, 2, 3)""".format(auc=AUC, ks=KS)


@query("model_effect", with_scored(EFFECT, body="SELECT * FROM effect"))
def model_effect(spark, sf_dir):
    out = report.model_effect(demo.with_dataset(demo.scored(spark, sf_dir)), "prob_")
    return rounded(out, "bad_ratio", "auc", "ks")


@query("evaluation_performance", with_scored(EFFECT,
    "d AS (SELECT CASE WHEN date < 19990101 THEN 'dev' ELSE 'oot' END AS dataset, min(date) AS min_date, max(date) AS max_date FROM scored GROUP BY 1)",
    body="SELECT dataset, total, good, bad, bad_ratio, auc, ks, min_date, max_date FROM effect JOIN d USING (dataset) WHERE dim = 'overall'"))
def evaluation_performance(spark, sf_dir):
    tables = report.evaluation_report(demo.with_dataset(demo.scored_table(spark, sf_dir)))
    return rounded(tables["performance"], "bad_ratio", "auc", "ks")


OOT_LEVELS = tuple(p.replace("FROM scored", "FROM (SELECT * FROM scored WHERE date >= 19990101)") for p in LEVELS)


@query("evaluation_lift", with_scored(*OOT_LEVELS, "m AS (SELECT *, acc_precision / min(acc_precision) OVER () AS lift FROM r)", body="""
SELECT round(max(acc_num) FILTER (level = 1), 8) AS first_share, round(max(lift) FILTER (level = 1), 8) AS first_lift,
  round(max(acc_num) FILTER (level = 2), 8) AS second_share, round(max(lift) FILTER (level = 2), 8) AS second_lift FROM m"""))
def evaluation_lift(spark, sf_dir):
    rows = demo.scored_table(spark, sf_dir).filter(F.col("date") >= demo.CUT_DATE)
    out = report.lift_overview(metrics.level_table(rows, "prob_"))
    return rounded(out, "first_share", "first_lift", "second_share", "second_lift")


# Every row scored, also grey and unlabelled ones; psi overlaps with oot.
EVERYONE = """
everyone AS (SELECT id, date, label, channel, bal, sig, (CAST(sig AS BIGINT) * 8 + (id * 31) % 800) / CAST(10000 AS DOUBLE) AS prob_ FROM risk_samples)"""


def everyone(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id", "date", "label", "channel", "bal", "sig")
    rows = rows.withColumn("prob_", (F.col("sig").cast("bigint") * 8 + (F.col("id") * 31) % 800) / F.lit(10000.0))
    sets = F.array_compact(F.array(
        F.when(F.col("date") < demo.CUT_DATE, F.lit("dev")).otherwise(F.lit("oot")), F.when(F.col("date") >= 20000101, F.lit("psi")),
    ))
    return rows.select("*", F.explode(sets).alias("dataset"))


@query("evaluation_stability", with_risk(EVERYONE, SCORE_PSI.replace("scored", "everyone").replace(">= 19990101", ">= 20000101"), body="""
SELECT round(sum((q - p) * least(greatest(ln(q / p), -10), 10)), 8) AS psi,
  CASE WHEN sum((q - p) * least(greatest(ln(q / p), -10), 10)) < 0.1 THEN 'stable' ELSE 'unstable' END AS verdict FROM s"""))
def evaluation_stability(spark, sf_dir):
    """Score distribution of dev against psi, over all rows of both."""
    return rounded(report.evaluation_report(everyone(spark, sf_dir))["stability"], "psi").select("psi", "verdict")


@query("evaluation_reproduction", with_risk(EVERYONE, f"""
x AS (SELECT *, CASE WHEN date < 19990101 THEN 'dev' ELSE 'oot' END AS dataset, {POINTS} AS score_ FROM everyone
  UNION ALL SELECT *, 'psi', {POINTS} FROM everyone WHERE date >= 20000101)""", body=f"SELECT dataset, id, date, label, channel, sig, prob_, score_, {MONTH} AS month FROM x"))
def evaluation_reproduction(spark, sf_dir):
    return samples.reproduction_rows(everyone(spark, sf_dir).withColumn("score_", to_points(F.col("prob_"))), SPEC.base_fea, ["sig"])


@query("evaluation_bands", BANDS_OF_ALL)
def evaluation_bands(spark, sf_dir):
    """Bands of the dev scores; psi counts hold grey and unlabelled rows."""
    rows = everyone(spark, sf_dir).withColumn("score", to_points(F.col("prob_")))
    return score.band_table(rows.select("score", "label", "dataset"), "score")


@query("stage_profile", with_risk(body="""
SELECT 'all' AS "group", CAST(count(label) AS BIGINT) AS total_samples FROM risk_samples"""))
def stage_profile(spark, sf_dir):
    rows = demo.samples_table(spark, sf_dir).drop("cust")
    tables = stages.profile_stage(rows, ProfileSettings())
    return tables["default_rates"].filter("dim = 'all'").select("group", "total_samples")


SPLIT_ROWS = """z AS (SELECT *, 'dev' AS dataset FROM cleaned WHERE date < 19990101 UNION ALL SELECT *, 'oot' FROM cleaned WHERE date >= 19990101
  UNION ALL SELECT *, 'psi' FROM cleaned WHERE date >= 20000101)"""


@query("stage_split", with_risk(CLEANED, SPLIT_ROWS, body=f"""
SELECT dataset, 'Overall' AS month, {STATS} FROM z WHERE dataset <> 'psi' GROUP BY 1
UNION ALL SELECT dataset, {MONTH}, {STATS} FROM z WHERE dataset <> 'psi' GROUP BY 1, 2"""))
def stage_split(spark, sf_dir):
    """All sample statistics of the stage, overall and by month."""
    tables = stages.split_stage(demo.samples_table(spark, sf_dir).drop("cust"), SPLIT_CONFIG)
    return rounded(tables["target_stats"], "bad_rate")


@query("stage_split_rows", with_risk(CLEANED, SPLIT_ROWS, body="SELECT * FROM z"))
def stage_split_rows(spark, sf_dir):
    """The samples that the stage writes, every row and column."""
    return stages.split_stage(demo.samples_table(spark, sf_dir), SPLIT_CONFIG)["samples"]


@query("stage_select", f"""
SELECT feature FROM ({STATS_SQL}) WHERE iv >= 0.01 AND missing < 0.9 AND psi < 0.2 AND feature <> 'sig_dup'""")
def stage_select(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    names = [*SPEC.base_fea, *ALL_FEATURES]
    return stages.select_stage(dev.select(*names), oot.select(*names), SelectSettings())["use_fea"].select("feature")


@query("stage_train")
def stage_train(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    cfg = TrainSettings(n_trials=1, model_param={"n_estimators": 4, "max_bin": 32}, model_selection_params={"learning_rate": (0.05, 0.2), "num_leaves": (4, 16)})
    return stages.train_stage(dev, oot, ["nation", "sum_qty", "sig"], cfg)["training_report"]


@query("stage_evaluate")
def stage_evaluate(spark, sf_dir):
    rows = three_samples(spark, sf_dir)
    model = train.fit_boosting(rows.filter("dataset = 'dev'"), MODEL_FEATURES, SMALL)
    return stages.evaluate_stage(rows, model, MODEL_FEATURES, EvalSettings(run_retrain=False), params=SMALL)["model_effect"]


@query("json_roundtrip", with_risk(body="""
SELECT channel AS name, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (label = 1) AS BIGINT) AS bad, [min(date), max(date)] AS range,
  CAST(count(*) FILTER (label = 1) AS VARCHAR) AS bad_text FROM risk_samples GROUP BY 1"""))
def json_roundtrip(spark, sf_dir):
    """Nested results written as JSON lines and read again with their schema; a field is also read from the raw line."""
    rows = demo.risk_samples(spark, sf_dir, "channel", "label", "date")
    made = rows.groupBy(F.col("channel").alias("name")).agg(
        F.count(F.lit(1)).alias("total"), F.struct(F.count_if(F.col("label") == 1).alias("bad"), F.array(F.min("date"), F.max("date")).alias("range")).alias("detail")
    )
    path = samples.write_table(made, fresh_path(spark, "result") + ".json")
    again = samples.read_samples(spark, path, ["name"], schema=made.schema)
    raw = spark.read.text(path).select(F.get_json_object("value", "$.name").alias("name"), F.get_json_object("value", "$.detail.bad").alias("bad_text"))
    return again.select("name", "total", "detail.bad", "detail.range").join(raw, "name")

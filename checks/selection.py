"""Feature statistics, correlation, selection, importances and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import SENTINEL_LIST, long_numeric, query, union, with_risk
from checks.profile import rounded
from riskweave.functions.cleaning import double_sql
from riskweave.operators import importance, regression, rules, select
from riskweave.operators.quantiles import exact_quantiles
from riskweave.operators.woe import binary_rows
from riskweave.sources import demo

NUMERIC = demo.NUMERIC
FEATURES = (*NUMERIC, "seg")


def dev_oot(spark, sf_dir):
    rows = binary_rows(demo.samples_table(spark, sf_dir), "label")
    return rows.filter(F.col("date") < demo.CUT_DATE), rows.filter(F.col("date") >= demo.CUT_DATE)


BINARY = "bin AS (SELECT * FROM risk_samples WHERE label IN (0, 1))"


def _stats_sql():
    from checks.bins import IV_EDGES, IV_LISTS, IV_PARTS, NODES
    from checks.stability import PSI_BODY, PSI_EDGES, _psi_sql

    iv_lists = IV_LISTS.replace("WHERE label IN (0, 1)", "WHERE label IN (0, 1) AND date < 19990101")
    psi_edges = PSI_EDGES.replace("risk_samples", "bin")
    iv = f"iv AS (WITH {iv_lists}, {NODES}, {IV_EDGES}, {IV_PARTS} SELECT feature, sum(part) AS iv FROM parts GROUP BY 1)"
    psi = f"psi AS (WITH {psi_edges}, {_psi_sql('true')} {PSI_BODY.format('psi')})"
    psi_valid = f"psi_valid AS (WITH {psi_edges}, {_psi_sql(f'x.v NOT IN {SENTINEL_LIST}')} {PSI_BODY.format('psi_valid')})"
    dev = "dev AS (SELECT * FROM bin WHERE date < 19990101)"
    seg = """seg AS (
      WITH c AS (SELECT coalesce(seg, '-9999') AS v, count(*) FILTER (date < 19990101) AS p, count(*) FILTER (date >= 19990101) AS q,
          sum(label) FILTER (date < 19990101) AS bad FROM bin GROUP BY 1),
        s AS (SELECT *, (p - bad) / sum(p - bad) OVER () AS pg, bad / sum(bad) OVER () AS pb,
          round(greatest(p, 1) / sum(p) OVER (), 8) AS ps, round(greatest(q, 1) / sum(q) OVER (), 8) AS qs FROM c)
      SELECT sum(CASE WHEN pg > 0 AND pb > 0 THEN (pg - pb) * ln(pg / pb) ELSE 0 END) AS iv,
        sum((ps - qs) * round(ln(ps / qs), 4)) AS psi FROM s)"""
    long = f"x AS ({long_numeric(source='dev', keep='id')})"
    top = "top AS (SELECT feature, max(c) AS c FROM (SELECT feature, v, count(*) AS c FROM x WHERE v > -9990 GROUP BY 1, 2) GROUP BY 1)"
    body = f"""
SELECT x.feature, round(any_value(iv.iv), 6) AS iv, any_value(psi.psi) AS psi, any_value(psi_valid.psi_valid) AS psi_valid,
  round(avg(CASE WHEN v IS NULL OR v IN {SENTINEL_LIST} THEN 1 ELSE 0 END), 8) AS missing,
  round(avg(v) FILTER (v > -9990), 4) AS mean, round(stddev_samp(v) FILTER (v > -9990), 4) AS std, min(v) FILTER (v > -9990) AS min,
  max(v) FILTER (v > -9990) AS max, round(any_value(top.c) / count(*), 8) AS unique_rate,
  round(avg(CASE WHEN v < 0 THEN 1 ELSE 0 END), 8) AS neg_rate, round(avg(CASE WHEN v < 0 AND v > -9990 THEN 1 ELSE 0 END), 8) AS neg_rate_valid
FROM x JOIN iv USING (feature) JOIN psi USING (feature) JOIN psi_valid USING (feature) JOIN top USING (feature) GROUP BY 1
UNION ALL SELECT 'seg', round((SELECT iv FROM seg), 6), round((SELECT psi FROM seg), 6), round((SELECT psi FROM seg), 6),
  round(avg(CASE WHEN seg IS NULL THEN 1 ELSE 0 END), 8), NULL, NULL, NULL, NULL,
  round((SELECT max(c) FROM (SELECT count(*) AS c FROM dev WHERE seg IS NOT NULL GROUP BY seg)) / count(*), 8), NULL, NULL FROM dev"""
    return with_risk(BINARY, iv, psi, psi_valid, dev, seg, long, top, body=body)


STATS_SQL = _stats_sql()


def stats(spark, sf_dir):
    out = select.feature_stats(*dev_oot(spark, sf_dir), FEATURES)
    out = rounded(out, "iv", "psi", "psi_valid", digits=6)
    out = rounded(out, "mean", "std", digits=4)
    return rounded(out, "missing", "unique_rate", "neg_rate", "neg_rate_valid")


@query("feature_stats", STATS_SQL)
def feature_stats(spark, sf_dir):
    return stats(spark, sf_dir)


@query("passing_features", f"SELECT feature, iv, psi, missing FROM ({STATS_SQL}) WHERE iv >= 0.01 AND missing < 0.9 AND psi < 0.2")
def passing_features(spark, sf_dir):
    return select.passing_features(stats(spark, sf_dir), 0.01, 0.2, 0.9).select("feature", "iv", "psi", "missing")


@query("select_features", f"""
SELECT feature, iv FROM ({STATS_SQL}) WHERE iv >= 0.01 AND missing < 0.9 AND psi < 0.2 AND feature <> 'sig_dup'""")
def select_features(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    table, kept = select.select_features(dev, oot, FEATURES)
    return rounded(table.filter(F.col("feature").isin(kept)), "iv", digits=6).select("feature", "iv")


def _corr_sql(features, source="risk_samples"):
    clean = ", ".join(f"CASE WHEN {f} NOT IN {SENTINEL_LIST} THEN CAST({f} AS DOUBLE) END AS {f}" for f in features)
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    cells = union(
        f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, corr({a}, {b}) AS r FROM c" for a, b in pairs
    )
    return with_risk(f"c AS (SELECT {clean} FROM {source})", f"m AS ({cells})", body="""
SELECT feature_i, feature_j, CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) + 0.0 END AS r FROM m""")


CORR_SQL = _corr_sql(NUMERIC)
FEW = ("amt", "bal", "bal_dup", "sum_qty", "konst", "sig", "sig_dup")


@query("corr_matrix", CORR_SQL)
def corr_matrix(spark, sf_dir):
    """Many pairs: masked cross products per task."""
    return rounded(select.correlation_matrix(demo.risk_samples(spark, sf_dir, *NUMERIC), NUMERIC), "r", digits=6)


@query("corr_matrix_few", _corr_sql(FEW))
def corr_matrix_few(spark, sf_dir):
    """Few pairs: one aggregate per pair."""
    return rounded(select.correlation_matrix(demo.risk_samples(spark, sf_dir, *FEW), FEW), "r", digits=6)


@query("corr_upper_prune", f"""
SELECT feature_j AS feature, round(max(abs(r)), 6) AS max_r FROM ({CORR_SQL}) GROUP BY 1 HAVING max(abs(r)) > 0.8""")
def corr_upper_prune(spark, sf_dir):
    matrix = select.correlation_matrix(demo.risk_samples(spark, sf_dir, *NUMERIC), NUMERIC)
    return rounded(select.correlated_with_earlier(matrix, 0.8), "max_r", digits=6)


@query("variance_inflation")
def variance_inflation(spark, sf_dir):
    rows = demo.samples_table(spark, sf_dir)
    return select.variance_inflation(rows, ["amt", "nation", "n_lines", "sum_qty", "drift", "sig"])


@query("variance_inflation_three", with_risk("k AS (SELECT CAST(amt AS DOUBLE) AS a, CAST(n_lines AS DOUBLE) AS b, CAST(sum_qty AS DOUBLE) AS c FROM risk_samples WHERE amt IS NOT NULL AND n_lines IS NOT NULL AND sum_qty IS NOT NULL)",
    "r AS (SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(b, c) AS bc FROM k)",
    "d AS (SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS det FROM r)", body="""
SELECT 'amt' AS feature, round((1 - bc * bc) / det, 5) AS vif FROM d UNION ALL SELECT 'n_lines', round((1 - ac * ac) / det, 5) FROM d
UNION ALL SELECT 'sum_qty', round((1 - ab * ab) / det, 5) FROM d UNION ALL SELECT 'konst', NULL"""))
def variance_inflation_three(spark, sf_dir):
    """Three features, against the closed form, and a constant one, which has none."""
    rows = demo.samples_table(spark, sf_dir)
    return rounded(select.variance_inflation(rows, ["amt", "n_lines", "sum_qty", "konst"]), "vif", digits=5)


QUARTILES = ("amt", "bal", "sig", "max_disc")


@query("quantiles_bracketed", with_risk(f"x AS ({long_numeric(QUARTILES)})", body="""
SELECT feature, round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.99), 6) AS p99 FROM x WHERE v IS NOT NULL GROUP BY 1"""))
def quantiles_bracketed(spark, sf_dir):
    """A sketch of 50 cells, so that every quantile is looked up between brackets."""
    rows = demo.samples_table(spark, sf_dir)
    found, _ = exact_quantiles(rows, {f: (double_sql(rows, f), [0.1, 0.5, 0.99]) for f in QUARTILES}, accuracy=50)
    table = [(f, *[round(v, 6) for v in vs]) for f, vs in found.items()]
    return spark.createDataFrame(table, "feature string, p10 double, p50 double, p99 double")


NULLS = f"""
x AS ({long_numeric(('amt', 'bal', 'sum_qty', 'sig'), keep='channel')}),
actual AS (SELECT feature, avg(abs(v)) AS gain, CAST(count(v) AS DOUBLE) AS split FROM x GROUP BY 1),
runs AS (SELECT feature, channel, avg(abs(v)) AS gain, CAST(count(v) AS DOUBLE) AS split FROM x GROUP BY 1, 2),
nulls AS (SELECT feature, quantile_cont(gain, 0.75) AS g, quantile_cont(split, 0.75) AS s FROM runs GROUP BY 1)"""


@query("null_score", with_risk(NULLS, body="""
SELECT feature, round(ln(1e-10::DOUBLE + split / (1 + s)), 6) AS split_score, round(ln(1e-10::DOUBLE + gain / (1 + g)), 6) AS gain_score
FROM actual JOIN nulls USING (feature)"""))
def null_score(spark, sf_dir):
    """Scores from importance tables derived from the samples: whole table against channels."""
    names = ["amt", "bal", "sum_qty", "sig"]
    rows = demo.risk_samples(spark, sf_dir, "channel", *names)
    long = rows.unpivot(["channel"], names, "feature", "v")
    sizes = [F.avg(F.abs("v")).alias("importance_gain"), F.count("v").cast("double").alias("importance_split")]
    scores = importance.null_score(long.groupBy("feature").agg(*sizes), long.groupBy("feature", "channel").agg(*sizes))
    return rounded(importance.top_by_null_score(scores), "split_score", "gain_score", digits=6)


@query("forest_importance")
def forest_importance(spark, sf_dir):
    dev, _ = dev_oot(spark, sf_dir)
    return importance.actual_importance(dev, ["amt", "bal", "nation", "sum_qty", "sig"], trees=10)


@query("null_importance")
def null_importance(spark, sf_dir):
    dev, _ = dev_oot(spark, sf_dir)
    features = ["amt", "sum_qty", "sig"]
    actual = importance.actual_importance(dev, features, trees=5)
    return importance.null_score(actual, importance.null_importance(dev, features, nb_runs=3, trees=5))


@query("stepwise_logistic")
def stepwise_logistic(spark, sf_dir):
    dev, _ = dev_oot(spark, sf_dir)
    return regression.stepwise_logistic(dev, ["amt", "nation", "sum_qty", "sig"])


@query("stepwise_linear")
def stepwise_linear(spark, sf_dir):
    dev, _ = dev_oot(spark, sf_dir)
    return regression.stepwise_linear(dev, ["bal_dup", "nation", "n_lines", "amt", "sig"], "sum_qty")


CONDITIONS = {"sig": "CAST(least(floor(sig / 100), 11) AS BIGINT)", "nation": "nation", "channel": "channel", "lines": "n_lines"}


def _rules_sql():
    names = list(CONDITIONS)
    single = [f"SELECT '{a}' AS feature_1, {a} AS value_1, NULL AS feature_2, NULL AS value_2, label FROM c WHERE {a} IS NOT NULL" for a in names]
    double = [
        f"SELECT '{a}', {a}, '{b}', {b}, label FROM c WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
        for i, a in enumerate(names) for b in names[i + 1 :]
    ]
    columns = ", ".join(f"CAST({e} AS VARCHAR) AS {n}" for n, e in CONDITIONS.items())
    return with_risk(
        f"c AS (SELECT label, {columns} FROM risk_samples WHERE label IN (0, 1))",
        f"x AS ({union([*single, *double])})",
        "t AS (SELECT count(*) AS n, avg(label) AS rate FROM c)",
        body="""
SELECT feature_1, value_1, feature_2, value_2, CAST(count(*) AS BIGINT) AS covered, CAST(sum(label) AS BIGINT) AS bad,
  round(count(*) / any_value(n), 8) AS coverage, round(avg(label), 8) AS score, round(avg(label) / any_value(rate), 8) AS lift,
  round(any_value(rate), 8) AS overall_rate FROM x, t GROUP BY 1, 2, 3, 4
HAVING count(*) / any_value(n) >= 0.01 AND avg(label) > 1.2 * any_value(rate)""")


@query("rule_lift", _rules_sql())
def rule_lift(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "label", "sig", "nation", "channel", "n_lines")
    out = rules.lift_rules(rows, {n: F.expr(e) for n, e in CONDITIONS.items()}, threshold_lift=1.2)
    return rounded(out, "coverage", "score", "lift", "overall_rate")


def _holds(rule: str) -> str:
    """Whether a row of s fulfils the rule."""
    value = "CASE {} " + " ".join(f"WHEN '{n}' THEN s.{n}" for n in CONDITIONS) + " END"
    return f"{value.format(rule + '.f1')} = {rule}.v1 AND ({rule}.f2 IS NULL OR {value.format(rule + '.f2')} = {rule}.v2)"


def _differs(own: str, parent_all: str, parent_bad: str) -> str:
    """Chi-square of a rule's classes against its parent's, from the likelihood ratio."""
    good, bad, share = f"({own}.wn - {own}.wb)::DOUBLE", f"{own}.wb::DOUBLE", f"({parent_bad}::DOUBLE / {parent_all}::DOUBLE)"
    terms = [f"CASE WHEN {o} > 0 THEN {o} * ln({o} / ({own}.wn::DOUBLE * {e})) ELSE 0 END" for o, e in ((good, f"(1 - {share})"), (bad, share))]
    return f"2 * ({' + '.join(terms)}) > 3.841458820694124"


def _learner_sql(share: float, gamma: float, steps: int, lift: float, rate: float = 0.01, beam: int = 10, seed: int = 817):
    """Covering of one resample, step by step; each step is a beam search of two levels."""
    names = list(CONDITIONS)
    columns = ", ".join(f"CAST({e} AS VARCHAR) AS {n}" for n, e in CONDITIONS.items())
    flat = union(f"SELECT id, label, {i} AS o, '{n}' AS f, {n} AS v FROM s WHERE {n} IS NOT NULL" for i, n in enumerate(names))
    hashed = f"('0x' || substr(md5('{seed}:0:' || id), 1, 8))::BIGINT"
    sums = "sum(w)::HUGEINT AS wn, sum(w * {0}.label)::HUGEINT AS wb, count(*) AS n, sum({0}.label)::BIGINT AS b"
    parts = [
        f"c AS (SELECT id, label, {columns} FROM risk_samples WHERE label IN (0, 1))",
        "t AS (SELECT count(*) AS n, sum(label) AS bad, avg(label) AS rate FROM c)",
        f"s AS (SELECT c.* FROM c, t WHERE label = 1 OR {hashed} < least(4294967296, round(bad * (1 - {share}::DOUBLE) / {share}::DOUBLE / (n - bad) * 4294967296)))",
        f"x AS ({flat})",
    ]
    units = [round((1 << 20) * gamma**k) for k in range(steps + 1)]
    for k in range(steps):
        cover = " + ".join(f"coalesce((SELECT count(*) FROM r{j} r WHERE {_holds('r')}), 0)" for j in range(k)) or "0"
        parts += [
            f"w{k} AS (SELECT id, CASE {cover} " + " ".join(f"WHEN {i} THEN {u}" for i, u in enumerate(units[: k + 1])) + " END AS w FROM s)",
            f"a{k} AS (SELECT {sums.format('s')} FROM s JOIN w{k} USING (id))",
            f"g{k} AS (SELECT o AS o1, f AS f1, v AS v1, {sums.format('x')} FROM x JOIN w{k} USING (id) GROUP BY 1, 2, 3)",
            f"l{k} AS (SELECT g.* FROM g{k} g, a{k} a WHERE g.n >= {rate} * a.n AND {_differs('g', 'a.wn', 'a.wb')})",
            f"h{k} AS (SELECT l.* FROM l{k} l, a{k} a ORDER BY l.wb * a.wn - l.wn * a.wb DESC, o1, v1 LIMIT {beam})",
            f"""q{k} AS (SELECT h.o1, h.f1, h.v1, x2.o AS o2, x2.f AS f2, x2.v AS v2, any_value(h.wn) AS p_wn, any_value(h.wb) AS p_wb, {sums.format('x1')}
              FROM h{k} h JOIN x x1 ON x1.f = h.f1 AND x1.v = h.v1 JOIN x x2 ON x2.id = x1.id AND x2.f <> x1.f JOIN w{k} w ON w.id = x1.id GROUP BY 1, 2, 3, 4, 5, 6)""",
            f"""p{k} AS (SELECT DISTINCT least(o1, o2) AS o1, if(o1 < o2, f1, f2) AS f1, if(o1 < o2, v1, v2) AS v1, greatest(o1, o2) AS o2, if(o1 < o2, f2, f1) AS f2, if(o1 < o2, v2, v1) AS v2, q.wn, q.wb, q.n, q.b
              FROM q{k} q, a{k} a WHERE q.n >= {rate} * a.n AND {_differs('q', 'a.wn', 'a.wb')} AND {_differs('q', 'q.p_wn', 'q.p_wb')})""",
            f"""r{k} AS (SELECT c.* FROM (SELECT 1 AS size, o1, f1, v1, NULL AS o2, NULL AS f2, NULL AS v2, wn, wb, n, b FROM l{k}
              UNION ALL SELECT 2, o1, f1, v1, o2, f2, v2, wn, wb, n, b FROM p{k}) c, a{k} a
              WHERE c.wb * a.wn > c.wn * a.wb ORDER BY c.wb * a.wn - c.wn * a.wb DESC, size, o1, v1, o2, v2 LIMIT 1)""",
        ]
    chosen = union(f"SELECT {k} AS step, * FROM r{k}" for k in range(steps))
    offset = "ln(1 - rate) + ln(all_b / all_n) - ln(rate) - ln(1 - all_b / all_n)"
    return with_risk(*parts, body=f"""
SELECT 0 AS loop, CAST(step AS INT) AS step, f1 || '=' || v1 || CASE WHEN size = 2 THEN ' AND ' || f2 || '=' || v2 ELSE '' END AS rule, f1 AS feature_1, v1 AS value_1, f2 AS feature_2, v2 AS value_2,
  CAST(size AS INT) AS n_conditions, CAST(n - b AS BIGINT) AS n_good, CAST(b AS BIGINT) AS n_bad, round(p, 8) AS p_bad, round(score, 8) AS score, round(score / rate, 8) AS lift, round(rate, 8) AS overall_rate
FROM (SELECT *, 1 / (1 + exp({offset} - ln(p / (1 - p)))) AS score
      FROM (SELECT c.*, rate, all_n, all_b, (wb / 1048576 + 1) / (wn / 1048576 + 2) AS p FROM ({chosen}) c, t, (SELECT n AS all_n, b AS all_b FROM a0) z))
QUALIFY row_number() OVER (PARTITION BY f1, v1, f2, v2 ORDER BY step) = 1 AND score > {lift} * rate""")


@query("rule_learner", _learner_sql(0.6, 0.7, 3, 1.05))
def rule_learner(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id", "label", "sig", "nation", "channel", "n_lines")
    out = rules.rule_learner(
        rows, {n: F.expr(e) for n, e in CONDITIONS.items()}, loop_num=1, threshold_lift=1.05, oversampled_dep_rate=0.6, gamma=0.7, max_rules=3,
    )
    return rounded(out, "p_bad", "score", "lift", "overall_rate", digits=8)


@query("rule_learner_resamples")
def rule_learner_resamples(spark, sf_dir):
    """Five resamples with a full run's settings; the learner is compared with brute force in the tests."""
    rows = demo.risk_samples(spark, sf_dir, "id", "label", "sig", "nation", "channel", "n_lines")
    return rules.rule_learner(rows, {n: F.expr(e) for n, e in CONDITIONS.items()}, threshold_lift=1.05)


TESTED = ("amt", "nation", "sum_qty", "sig")


@query("entry_tests", with_risk(
    f"d AS (SELECT * FROM risk_samples WHERE label IN (0, 1) AND {' AND '.join(f'{f} IS NOT NULL' for f in TESTED)})",
    "x AS (" + union(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, label FROM d" for f in TESTED) + ")",
    "c AS (SELECT *, v - avg(v) OVER w AS z, avg(label) OVER w AS rate FROM x WINDOW w AS (PARTITION BY feature))",
    body="SELECT feature, round(sum(z * (label - rate)) ^ 2 / (sum(z * z) * any_value(rate) * (1 - any_value(rate))), 6) AS chi_square FROM c GROUP BY 1"))
def entry_tests(spark, sf_dir):
    """Score statistics of the first step of the stepwise selection."""
    rows = demo.risk_samples(spark, sf_dir, "label", *TESTED)
    return rounded(regression.entry_tests(rows, list(TESTED)).drop("p_value"), "chi_square", digits=6)

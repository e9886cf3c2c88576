"""Feature profiles against the target, bounds, transforms and recoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import interpolated, long_numeric, query, union, with_risk
from checks.profile import rounded
from riskweave.functions.cleaning import double_sql
from riskweave.operators import recode, treebins
from riskweave.operators.woe import binary_rows
from riskweave.sources import demo

FEATURES = ("amt", "bal", "nation", "n_lines", "sum_qty", "sig")
BIN = "bin AS (SELECT * FROM risk_samples WHERE label IN (0, 1))"


def labelled(spark, sf_dir):
    return binary_rows(demo.samples_table(spark, sf_dir), "label")


def _profile_ctes(features=FEATURES):
    return (
        BIN,
        f"x AS ({long_numeric(features, 'bin')})",
        "l AS (SELECT feature, list(v ORDER BY v) FILTER (v IS NOT NULL) AS l FROM x GROUP BY 1)",
        f"e AS (SELECT feature, list(DISTINCT e ORDER BY e) AS e FROM (SELECT feature, {interpolated('l', 'k / 10.0::DOUBLE')} AS e FROM l, range(0, 11) t(k)) GROUP BY 1)",
        "p AS (SELECT x.feature, v, label, CASE WHEN v IS NULL THEN NULL ELSE greatest(len(list_filter(e, lambda q: q < v)), 1) - 1 END AS bin_idx, e FROM x JOIN e USING (feature))",
        "t AS (SELECT count(*) AS n, sum(label) AS ev FROM bin)",
        """b AS (SELECT feature, bin_idx, any_value(e) AS e, min(v) AS lo, max(v) AS hi, count(*) AS c, sum(label) AS bad FROM p GROUP BY 1, 2)""",
        """w AS (SELECT *, bad / ev AS re, (c - bad) / (n - ev) AS rn,
            CASE WHEN bad = 0 THEN -20 WHEN c = bad THEN 20 ELSE ln((bad / ev) / ((c - bad) / (n - ev))) END AS woe FROM b, t)""",
        "iv AS (SELECT feature, sum((re - rn) * woe) AS iv FROM w GROUP BY 1)",
    )


PROFILE_BODY = """
SELECT round(iv, 6) AS iv, feature AS variable, CASE WHEN bin_idx IS NULL THEN '_MISSING_' ELSE 'bin' END AS kind, lo AS min, hi AS max,
  CAST(c AS BIGINT) AS count, round(c / n, 8) AS proportion, CAST(bad AS BIGINT) AS depvar_n, round(bad / c, 8) AS depvar_rate,
  round((bad / c) * 100 / (ev / n), 6) AS lift, round(woe, 6) AS woe FROM w JOIN iv USING (feature)
UNION ALL SELECT round(iv, 6), feature, 'TOTAL', NULL, NULL, CAST(n AS BIGINT), 1, CAST(ev AS BIGINT), round(ev / n, 8), round((ev / n) * 100 / (ev / n), 6), NULL FROM iv, t"""


def _profile_rows(table):
    kind = F.when(F.col("group").isin("TOTAL", "_MISSING_"), F.col("group")).otherwise("bin")
    table = rounded(table.withColumn("kind", kind).drop("group"), "iv", "lift", "woe", digits=6)
    return rounded(table, "proportion", "depvar_rate")


@query("cont_profile", with_risk(*_profile_ctes(), body=PROFILE_BODY))
def cont_profile(spark, sf_dir):
    return _profile_rows(recode.continuous_profile(labelled(spark, sf_dir), FEATURES, tree=False, monotonic=False).table)


@query("cont_profile_tree")
def cont_profile_tree(spark, sf_dir):
    return recode.continuous_profile(labelled(spark, sf_dir), FEATURES).table


@query("cont_profile_monotone")
def cont_profile_monotone(spark, sf_dir):
    return recode.continuous_profile(labelled(spark, sf_dir), FEATURES, tree=False, monotonic=True).table


def _tree_ctes(splits: int, min_share: float = 0.05):
    """Best-first entropy tree, one split after the other, over all distinct values."""
    def h(good, bad):
        return f"(CASE WHEN {bad} > 0 THEN {bad} * log2({bad} / ({good} + {bad})) ELSE 0 END + CASE WHEN {good} > 0 THEN {good} * log2({good} / ({good} + {bad})) ELSE 0 END)"

    parts = [
        BIN, f"x AS MATERIALIZED ({long_numeric(FEATURES, 'bin')})",
        f"small AS (SELECT greatest(CAST(floor(count(*) * {min_share}) AS BIGINT), 1) AS small FROM bin)",
        """v AS (SELECT feature, v, sum(c) OVER w AS n, sum(e) OVER w AS e, lead(v) OVER w AS following, sum(c) OVER (PARTITION BY feature) AS n_all, sum(e) OVER (PARTITION BY feature) AS e_all
            FROM (SELECT feature, v, count(*) AS c, sum(label) AS e FROM x WHERE v IS NOT NULL GROUP BY 1, 2) WINDOW w AS (PARTITION BY feature ORDER BY v))""",
        """s0 AS MATERIALIZED (SELECT feature, v, following, n, e * (n_all::DOUBLE / (2 * e_all)) AS b, (n - e) * (n_all::DOUBLE / (2 * (n_all - e_all))) AS g, 0 AS node FROM v WHERE e_all > 0 AND e_all < n_all)""",
    ]
    for k in range(splits):
        parts += [
            f"""m{k} AS MATERIALIZED (SELECT *, coalesce(lag(n1) OVER o, 0) AS n0, coalesce(lag(b1) OVER o, 0) AS b0, coalesce(lag(g1) OVER o, 0) AS g0
              FROM (SELECT feature, node, max(n) AS n1, max(b) AS b1, max(g) AS g1, max(v) AS last FROM s{k} GROUP BY 1, 2) WINDOW o AS (PARTITION BY feature ORDER BY last))""",
            f"""c{k} AS (SELECT s.feature, s.node, s.v, s.following, ({h('(g - g0)', '(b - b0)')} + {h('(g1 - g)', '(b1 - b)')} - {h('(g1 - g0)', '(b1 - b0)')}) AS gain, last
              FROM s{k} s JOIN m{k} m ON m.feature = s.feature AND m.node = s.node, small WHERE s.n - n0 >= small AND n1 - s.n >= small AND following - v > 1e-7)""",
            f"r{k} AS MATERIALIZED (SELECT *, (v + following) / 2 AS cut FROM c{k} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, last, v) = 1)",
            f"s{k + 1} AS MATERIALIZED (SELECT s.* REPLACE (CASE WHEN r.node = s.node AND s.v > r.cut THEN {k + 1} ELSE s.node END AS node) FROM s{k} s LEFT JOIN r{k} r ON r.feature = s.feature)",
        ]
    return [*parts, f"cuts AS ({union(f'SELECT feature, cut FROM r{k}' for k in range(splits))})"]


@query("tree_thresholds", with_risk(*_tree_ctes(9), body="SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY cut) - 1 AS INT) AS idx, cut AS threshold FROM cuts"))
def tree_thresholds(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    return treebins.thresholds_table(spark, treebins.tree_edges(rows, {f: double_sql(rows, f) for f in FEATURES}, "label", rows.count(), monotonic=False))


@query("cont_profile_tree_bins", with_risk(
    *_tree_ctes(9), "e AS (SELECT feature, list(DISTINCT e ORDER BY e) AS e FROM (SELECT feature, cut AS e FROM cuts UNION ALL SELECT feature, min(v) FROM x GROUP BY 1 UNION ALL SELECT feature, max(v) FROM x GROUP BY 1) GROUP BY 1)",
    *_profile_ctes()[4:], body=PROFILE_BODY))
def cont_profile_tree_bins(spark, sf_dir):
    return _profile_rows(recode.continuous_profile(labelled(spark, sf_dir), FEATURES, tree=True, monotonic=False).table)


def _bounds_sql():
    q = {n: interpolated("l", f"{p}::DOUBLE") for n, p in (("p1", "0.01"), ("p25", "0.25"), ("p50", "0.5"), ("p75", "0.75"), ("p99", "0.99"))}
    return (
        BIN, f"x AS ({long_numeric(FEATURES, 'bin')})",
        "l AS (SELECT feature, list(v ORDER BY v) FILTER (v IS NOT NULL) AS l, min(v) AS lo, max(v) AS hi FROM x GROUP BY 1)",
        "q AS (SELECT feature, lo, hi, " + ", ".join(f"{e} AS {n}" for n, e in q.items()) + " FROM l)",
        "i AS (SELECT *, greatest(p75 - p25, p99 - p75, p25 - p1) AS iqr FROM q)",
        "u AS (SELECT *, greatest(least(p75 + 1.5::DOUBLE * iqr, hi), p99) AS up, least(greatest(p25 - 1.5::DOUBLE * iqr, lo), p1) AS low FROM i)",
    )


@query("robust_bounds", with_risk(*_bounds_sql(), body="""
SELECT feature AS variable, round(p50, 6) AS median, lo AS min, hi AS max, round(CASE WHEN up = low THEN hi ELSE up END, 6) AS upperbound,
  round(CASE WHEN up = low THEN lo ELSE low END, 6) AS lowerbound, round((hi + lo) / 2, 6) AS midrange FROM u"""))
def robust_bounds(spark, sf_dir):
    out = recode.bounds_table(spark, recode.robust_bounds(labelled(spark, sf_dir), FEATURES))
    return rounded(out, "median", "upperbound", "lowerbound", "midrange", digits=6)


def _transform_sql():
    tests = {"origin": "v", "square": "v * v", "sqrt": "sqrt(greatest(v, 0))", "log": "ln(greatest(v, 0.00001::DOUBLE))"}
    cells = union(f"SELECT feature, '{t}' AS besttrans, {i} AS o, abs(corr({e}, label)) AS r FROM x WHERE v IS NOT NULL GROUP BY 1" for i, (t, e) in enumerate(tests.items()))
    return with_risk(BIN, f"x AS ({long_numeric(FEATURES, 'bin')})", f"c AS ({cells})", body="""
SELECT feature AS variable, first(besttrans ORDER BY round(r, 12) DESC, o) AS besttrans FROM c GROUP BY 1""")


@query("best_transform", _transform_sql())
def best_transform(spark, sf_dir):
    rows, _ = recode.event_column(labelled(spark, sf_dir), "label")
    found = recode.best_transforms(rows, FEATURES)
    return spark.createDataFrame([(f, found[f]["besttrans"]) for f in FEATURES], "variable string, besttrans string")


RECODED = ("amt", "sig", "nation")


def _recode_sql():
    ctes = [*_profile_ctes(RECODED)]
    q = [c.replace("x AS (", "y AS (", 1).replace("l AS (", "yl AS (", 1).replace(" FROM x GROUP", " FROM y GROUP").replace(" FROM l)", " FROM yl)") for c in _bounds_sql()[1:]]
    q = [c.replace(long_numeric(FEATURES, "bin"), long_numeric(RECODED, "bin")) for c in q]
    shown, joins = [], []
    for f in RECODED:
        shown += [
            f"round(least(greatest(CAST(r.{f} AS DOUBLE), u_{f}.low), u_{f}.up), 6) AS r_{f}",
            f"round((least(greatest(CAST(r.{f} AS DOUBLE), u_{f}.low), u_{f}.up) - u_{f}.low) / (u_{f}.up - u_{f}.low), 8) AS r_std_{f}",
            f"round(coalesce(w_{f}.woe, 0), 6) AS r_woe_{f}",
        ]
        joins.append(f"JOIN u u_{f} ON u_{f}.feature = '{f}'")
        joins.append(f"JOIN e e_{f} ON e_{f}.feature = '{f}'")
        joins.append(
            f"LEFT JOIN w w_{f} ON w_{f}.feature = '{f}' AND w_{f}.bin_idx = greatest(len(list_filter(e_{f}.e, lambda q: q < least(greatest(CAST(r.{f} AS DOUBLE), u_{f}.low), u_{f}.up))), 1) - 1"
        )
    return with_risk(*ctes, *q, body=f"SELECT r.id, {', '.join(shown)} FROM bin r " + " ".join(joins))


@query("recode", _recode_sql())
def recode_columns(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    profile = recode.continuous_profile(rows, RECODED, tree=False, monotonic=False)
    out = recode.apply_recoding(rows.select("id", *RECODED), recode.continuous_recoding(profile))
    shown = [c for c in out.columns if c == "id" or c in {f"r_{k}{f}" for f in RECODED for k in ("", "std_", "woe_")}]
    out = rounded(out.select(*shown), *[f"r_std_{f}" for f in RECODED])
    return rounded(out, *[f"r_{f}" for f in RECODED], *[f"r_woe_{f}" for f in RECODED], digits=6)


@query("cont_statistics")
def cont_statistics(spark, sf_dir):
    return recode.continuous_profile(labelled(spark, sf_dir), FEATURES, tree=False, monotonic=False).statistics


@query("nominal_profile")
def nominal_profile(spark, sf_dir):
    return recode.nominal_profile(labelled(spark, sf_dir), ["seg", "channel"]).table


@query("nominal_recode")
def nominal_recode(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    steps = recode.nominal_recoding(recode.nominal_profile(rows, ["seg", "channel"]))
    return recode.apply_recoding(rows.select("id", "seg", "channel"), steps)


@query("all_profiles")
def all_profiles(spark, sf_dir):
    table, _, _ = recode.all_profiles(labelled(spark, sf_dir), ["amt", "sig"], ["seg", "channel"])
    return table


@query("target_coercion", with_risk(
    "y AS (SELECT id, amt FROM risk_samples WHERE amt IS NOT NULL)",
    f"m AS (SELECT {interpolated('l', '0.5::DOUBLE')} AS m FROM (SELECT list(amt ORDER BY amt) AS l FROM y))",
    body="SELECT id, CAST(CASE WHEN amt >= m THEN 1 ELSE 0 END AS INTEGER) AS target FROM y, m"))
def target_coercion(spark, sf_dir):
    rows, _ = recode.event_column(demo.samples_table(spark, sf_dir), "amt")
    return rows.select("id", F.col("_event").alias("target"))

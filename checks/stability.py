"""Population stability."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import SENTINEL_LIST, interpolated, long_numeric, query, union, with_risk, with_scored
from checks.profile import rounded
from riskweave.operators import stability
from riskweave.sources import demo

def expected():
    return F.col("date") < demo.CUT_DATE

CLEAN = "(label IN (0, 1))"

PSI_EDGES = f"""
x AS (SELECT date < 19990101 AS ex, feature, v FROM ({long_numeric()})),
lists AS (SELECT feature, max(v) + 0.1::DOUBLE AS hi, min(v) FILTER (v > -1) AS lo,
  list(v ORDER BY v) FILTER (ex AND v > -1) AS l FROM x GROUP BY 1),
e AS (SELECT DISTINCT feature, e FROM (
  SELECT feature, {interpolated('l', 'k / 10.0::DOUBLE')} AS e FROM lists, range(1, 10) t(k)
  UNION ALL SELECT feature, unnest([-10000.0::DOUBLE, lo, hi]) FROM lists) WHERE e IS NOT NULL),
edges AS (SELECT feature, e AS lo, lead(e) OVER (PARTITION BY feature ORDER BY e) AS hi,
  row_number() OVER (PARTITION BY feature ORDER BY e) - 1 AS bin_idx FROM e),
n AS (SELECT count(*) FILTER (date < 19990101) AS np, count(*) FILTER (date >= 19990101) AS nq FROM risk_samples)"""


def _psi_sql(keep: str):
    return f"""
b AS (SELECT g.feature, g.bin_idx, count(x.v) FILTER (x.ex) AS p, count(x.v) FILTER (NOT x.ex) AS q
  FROM edges g LEFT JOIN x ON x.feature = g.feature AND x.v >= g.lo AND x.v < g.hi AND {keep}
  WHERE g.hi IS NOT NULL GROUP BY 1, 2),
s AS (SELECT feature, round(greatest(p, 1) / np, 8) AS p, round(greatest(q, 1) / nq, 8) AS q FROM b, n)"""


PSI_BODY = "SELECT feature, round(sum((p - q) * round(ln(p / q), 4)), 6) AS {} FROM s GROUP BY 1"


@query("psi_numeric", with_risk(PSI_EDGES, _psi_sql("true"), body=PSI_BODY.format("psi")))
def psi_numeric(spark, sf_dir):
    out = stability.psi_numeric(demo.samples_table(spark, sf_dir), demo.NUMERIC, expected())
    return rounded(out, "psi", digits=6).select("feature", "psi")


@query("psi_no_sentinel", with_risk(PSI_EDGES, _psi_sql(f"x.v NOT IN {SENTINEL_LIST}"), body=PSI_BODY.format("psi_valid")))
def psi_no_sentinel(spark, sf_dir):
    out = stability.psi_numeric(demo.samples_table(spark, sf_dir), demo.NUMERIC, expected())
    return rounded(out, "psi_valid", digits=6).select("feature", "psi_valid")


@query("psi_categorical", with_risk("""
x AS (SELECT date < 19990101 AS ex, 'seg' AS feature, coalesce(seg, '-9999') AS v FROM risk_samples
      UNION ALL SELECT date < 19990101, 'channel', coalesce(channel, '-9999') FROM risk_samples),
n AS (SELECT count(*) FILTER (date < 19990101) AS np, count(*) FILTER (date >= 19990101) AS nq FROM risk_samples),
b AS (SELECT feature, v, count(*) FILTER (ex) AS p, count(*) FILTER (NOT ex) AS q FROM x GROUP BY 1, 2),
s AS (SELECT feature, round(greatest(p, 1) / np, 8) AS p, round(greatest(q, 1) / nq, 8) AS q FROM b, n)""",
    body="SELECT feature, round(sum((p - q) * round(ln(p / q), 4)), 8) AS psi FROM s GROUP BY 1"))
def psi_categorical(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "date", "seg", "channel")
    return rounded(stability.psi_categorical(rows, ["seg", "channel"], expected()), "psi").select("feature", "psi")


SCORE_PSI = f"""
dev AS (SELECT * FROM scored WHERE date < 19990101), oot AS (SELECT * FROM scored WHERE date >= 19990101),
l AS (SELECT list(prob_ ORDER BY prob_) AS l FROM dev),
e0 AS (SELECT list(DISTINCT e ORDER BY e) AS e FROM (SELECT {interpolated('l', 'k / 10.0::DOUBLE')} AS e FROM l, range(0, 11) t(k))),
e1 AS (SELECT e, e[len(e)] - e[1] AS span, unnest(range(1, len(e))) AS i FROM e0),
edges AS (SELECT i - 1 AS bin_idx, e[i] - CASE WHEN i = 1 THEN span * 0.2::DOUBLE ELSE 0 END AS lo,
  e[i + 1] + CASE WHEN i + 1 = len(e) THEN span * 0.2::DOUBLE ELSE 0 END AS hi FROM e1),
c AS (SELECT bin_idx, lo, hi,
  (SELECT count(*) FROM dev WHERE (prob_ > lo OR (bin_idx = 0 AND prob_ = lo)) AND prob_ <= hi) AS expected,
  (SELECT count(*) FROM oot WHERE (prob_ > lo OR (bin_idx = 0 AND prob_ = lo)) AND prob_ <= hi) + 0.0001::DOUBLE AS actual FROM edges),
s AS (SELECT *, expected / sum(expected) OVER () AS p, actual / sum(actual) OVER () AS q FROM c)"""


def _dev_oot(spark, sf_dir):
    rows = demo.scored_table(spark, sf_dir)
    return rows.filter(expected()), rows.filter(~expected())


@query("psi_score", with_scored(SCORE_PSI, body="""
SELECT round(sum((q - p) * least(greatest(ln(q / p), -10), 10)), 8) AS psi,
  round((SELECT avg(CASE WHEN prob_ > (SELECT max(hi) FROM edges) OR prob_ < (SELECT min(lo) FROM edges) THEN 1 ELSE 0 END) FROM oot), 8) AS extreme_ratio,
  CASE WHEN sum((q - p) * least(greatest(ln(q / p), -10), 10)) < 0.1 THEN 'stable' ELSE 'unstable' END AS verdict FROM s"""))
def psi_score(spark, sf_dir):
    out = stability.score_psi(*_dev_oot(spark, sf_dir), "prob_")
    return rounded(out, "psi", "extreme_ratio").withColumn("verdict", stability.verdict(F.col("psi")))


@query("psi_score_bins", with_scored(SCORE_PSI, body="""
SELECT CAST(bin_idx AS INTEGER) AS bin_idx, round(lo, 8) AS lo, round(hi, 8) AS hi, round(p, 8) AS p, round(q, 8) AS q,
  round((q - p) * least(greatest(ln(q / p), -10), 10), 8) AS psi_part FROM s"""))
def psi_score_bins(spark, sf_dir):
    dev, oot = _dev_oot(spark, sf_dir)
    out = stability.psi_bins(stability.psi_fit(dev, "prob_"), oot, "prob_")
    return rounded(out, "lo", "hi", "p", "q", "psi_part").drop("expected", "actual")


@query("psi_extreme", with_risk(f"""
dev AS (SELECT drift FROM risk_samples WHERE date < 19990101), oot AS (SELECT drift FROM risk_samples WHERE date >= 19990101),
m AS (SELECT min(drift) - (max(drift) - min(drift)) * 0.2::DOUBLE AS lo, max(drift) + (max(drift) - min(drift)) * 0.2::DOUBLE AS hi FROM dev)""",
    body="SELECT round(avg(CASE WHEN drift < lo OR drift > hi THEN 1 ELSE 0 END), 8) AS extreme_ratio FROM oot, m"))
def psi_extreme(spark, sf_dir):
    rows = demo.samples_table(spark, sf_dir).select("date", "drift")
    out = stability.score_psi(rows.filter(expected()), rows.filter(~expected()), "drift")
    return rounded(out, "extreme_ratio").select("extreme_ratio")


@query("psi_bins_retrain", with_risk(f"""
x AS (SELECT date < 19990101 AS ex, amt AS v FROM risk_samples),
lists AS (SELECT max(v) + 0.1::DOUBLE + 1 AS hi, min(v) FILTER (v > -1) AS lo, list(v ORDER BY v) FILTER (ex AND v > -1) AS l FROM x),
e AS (SELECT DISTINCT e FROM (SELECT {interpolated('l', 'k / 20.0::DOUBLE')} AS e FROM lists, range(1, 20) t(k)
  UNION ALL SELECT unnest([-10000.0::DOUBLE, lo, hi]) FROM lists)),
edges AS (SELECT e AS lo, lead(e) OVER (ORDER BY e) AS hi, row_number() OVER (ORDER BY e) - 1 AS bin_idx FROM e),
b AS (SELECT bin_idx, g.lo, g.hi, count(v) FILTER (ex) AS n_expected, count(v) FILTER (NOT ex) AS n_actual
  FROM edges g LEFT JOIN x ON v >= g.lo AND v < g.hi WHERE g.hi IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT *, round(greatest(n_expected, 1) / sum(n_expected) OVER (), 8) AS p,
  round(greatest(n_actual, 1) / sum(n_actual) OVER (), 8) AS q FROM b)""",
    body="""SELECT 'amt' AS feature, CAST(bin_idx AS INTEGER) AS bin_idx, round(lo, 6) AS lo, round(hi, 6) AS hi,
  CAST(n_expected AS BIGINT) AS n_expected, CAST(n_actual AS BIGINT) AS n_actual, p, q, round((p - q) * ln(p / q), 4) AS psi_part FROM s"""))
def psi_bins_retrain(spark, sf_dir):
    rows = demo.samples_table(spark, sf_dir).select("date", "amt")
    return rounded(rounded(stability.retrain_psi(rows, "amt", expected()), "lo", "hi", digits=6), "psi_part", digits=4)

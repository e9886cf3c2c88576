"""Bin edges, information value and weight of evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import SENTINEL_LIST, interpolated, long_numeric, query, union, with_risk, with_scored
from checks.profile import rounded

from riskweave.operators import binning, woe
from riskweave.sources import demo

IV_FEATURES = demo.NUMERIC

# Sorted valid values per feature, with the number of bins of that feature.
IV_LISTS = f"""
x AS (
  SELECT id, label, feature,
         CASE WHEN v IS NULL OR v IN {SENTINEL_LIST} THEN -9999.0::DOUBLE ELSE v END AS v
  FROM ({long_numeric()}) WHERE label IN (0, 1)),
lists AS (
  SELECT feature, count(DISTINCT v) AS d, max(v) AS top,
         list(v ORDER BY v) FILTER (v > -9996) AS l
  FROM x GROUP BY feature)"""
NODES = f"""
nodes AS (
  SELECT feature, {interpolated('l', "CAST(k AS DOUBLE) / least(10, d)")} AS e
  FROM lists, range(1, 10) t(k) WHERE k < least(10, d) AND l IS NOT NULL)"""
IV_EDGES = """
e AS (
  SELECT DISTINCT feature, e FROM (
    SELECT feature, e FROM nodes
    UNION ALL SELECT feature, top FROM lists
    UNION ALL SELECT feature, unnest([-10000.0::DOUBLE, -9999.0::DOUBLE]) FROM lists) WHERE e IS NOT NULL),
edges AS (
  SELECT feature, e AS lo, lead(e) OVER (PARTITION BY feature ORDER BY e) AS hi,
         row_number() OVER (PARTITION BY feature ORDER BY e) - 1 AS bin_idx FROM e),
bins AS (
  SELECT g.feature, g.bin_idx, g.lo, g.hi, count(x.id) AS total, coalesce(sum(x.label), 0) AS bad
  FROM edges g LEFT JOIN x ON x.feature = g.feature AND x.v > g.lo AND x.v <= g.hi
  WHERE g.hi IS NOT NULL GROUP BY 1, 2, 3, 4)"""
IV_PARTS = """
parts AS (
  SELECT *, CASE WHEN pg > 0 AND pb > 0 THEN ln(pg / pb) ELSE 0 END AS woe,
         CASE WHEN pg > 0 AND pb > 0 THEN (pg - pb) * ln(pg / pb) ELSE 0 END AS part
  FROM (SELECT *, (total - bad) / sum(total - bad) OVER (PARTITION BY feature) AS pg,
               bad / sum(bad) OVER (PARTITION BY feature) AS pb FROM bins))"""


@query(
    "iv_numeric",
    with_risk(IV_LISTS, NODES, IV_EDGES, IV_PARTS, body="SELECT feature, round(sum(part), 6) AS iv FROM parts GROUP BY feature"),
)
def iv_numeric(spark, sf_dir):
    out = woe.iv_numeric(demo.samples_table(spark, sf_dir), IV_FEATURES)
    return out.select("feature", F.round("iv", 6).alias("iv"))


@query("mono_bins", with_risk(IV_LISTS, NODES, IV_EDGES, IV_PARTS, body="""
SELECT feature, CAST(bin_idx AS INTEGER) AS bin_idx, round(lo, 6) AS lo, round(hi, 6) AS hi, CAST(total AS BIGINT) AS total_count,
  CAST(bad AS BIGINT) AS bad_count, round(total / sum(total) OVER (PARTITION BY feature), 8) AS total_pcnt,
  round(CASE WHEN total > 0 THEN bad / total ELSE 0 END, 8) AS bad_rate, round(woe, 6) AS woe, round(part, 8) AS iv_part FROM parts"""))
def mono_bins(spark, sf_dir):
    out = woe.with_iv(woe.iv_numeric_bins(demo.samples_table(spark, sf_dir), IV_FEATURES))
    return rounded(rounded(out, "total_pcnt", "bad_rate", "iv_part"), "lo", "hi", "woe", digits=6)


@query("edges_equal_freq", with_risk(IV_LISTS, NODES, IV_EDGES, body="""
SELECT feature, CAST(bin_idx AS INTEGER) AS bin_idx, round(lo, 6) AS lo, round(hi, 6) AS hi FROM edges WHERE hi IS NOT NULL"""))
def edges_equal_freq(spark, sf_dir):
    rows = woe.binary_rows(demo.samples_table(spark, sf_dir), "label")
    edges = binning.iv_edges(rows, IV_FEATURES)
    return rounded(binning.edges_table(spark, edges), "lo", "hi", digits=6)


WIDE_NODES = """
nodes AS (
  SELECT feature, lo + k * ((top - lo) / n) AS e
  FROM (SELECT feature, top, least(10, d) AS n, l[1] AS lo FROM lists WHERE l IS NOT NULL), range(0, 11) t(k) WHERE k <= n)"""
# The last node may differ from the maximum by rounding; the larger one counts.
WIDE_EDGES = """
ends AS (SELECT feature, max(lo + n * ((top - lo) / n)) AS e, max(top) AS top
  FROM (SELECT feature, top, least(10, d) AS n, l[1] AS lo FROM lists WHERE l IS NOT NULL) GROUP BY feature),
inner_nodes AS (SELECT n.feature, n.e FROM nodes n JOIN ends x ON n.feature = x.feature WHERE n.e < x.e),
e AS (
  SELECT DISTINCT feature, e FROM (
    SELECT feature, e FROM inner_nodes UNION ALL SELECT feature, greatest(e, top) FROM ends
    UNION ALL SELECT feature, unnest([-10000.0::DOUBLE, -9999.0::DOUBLE]) FROM lists)),
edges AS (
  SELECT feature, e AS lo, lead(e) OVER (PARTITION BY feature ORDER BY e) AS hi,
         row_number() OVER (PARTITION BY feature ORDER BY e) - 1 AS bin_idx FROM e)"""
WIDE = ("amt", "bal", "sig", "sum_qty", "drift")


@query("edges_equal_width", with_risk(IV_LISTS, WIDE_NODES, WIDE_EDGES, body=f"""
SELECT feature, CAST(bin_idx AS INTEGER) AS bin_idx, round(lo, 6) AS lo, round(hi, 6) AS hi
FROM edges WHERE hi IS NOT NULL AND feature IN {WIDE}"""))
def edges_equal_width(spark, sf_dir):
    rows = woe.binary_rows(demo.samples_table(spark, sf_dir), "label")
    edges = binning.iv_edges(rows, WIDE, method=binning.EQUAL_WIDTH)
    return rounded(binning.edges_table(spark, edges), "lo", "hi", digits=6)


SEG_IV = """
c AS (SELECT 'seg' AS feature, coalesce(seg, '-9999') AS category, count(*) AS n, sum(label) AS bad FROM risk_samples WHERE label IN (0, 1) GROUP BY 2
      UNION ALL SELECT 'channel', coalesce(channel, '-9999'), count(*), sum(label) FROM risk_samples WHERE label IN (0, 1) GROUP BY 2),
s AS (SELECT *, (n - bad) / sum(n - bad) OVER (PARTITION BY feature) AS pg, bad / sum(bad) OVER (PARTITION BY feature) AS pb FROM c),
parts AS (SELECT *, CASE WHEN pg > 0 AND pb > 0 THEN ln(pg / pb) ELSE 0 END AS woe FROM s)"""


@query("iv_categorical", with_risk(SEG_IV, body="SELECT feature, round(sum((pg - pb) * woe), 8) AS iv FROM parts GROUP BY 1"))
def iv_categorical(spark, sf_dir):
    out = woe.iv_categorical(demo.risk_samples(spark, sf_dir, "label", "seg", "channel"), ["seg", "channel"])
    return rounded(out, "iv")


@query("category_bins", with_risk(SEG_IV, body="""
SELECT feature, category, CAST(n AS BIGINT) AS total_count, CAST(bad AS BIGINT) AS bad_count,
  round(n / sum(n) OVER (PARTITION BY feature), 8) AS total_pcnt, round(bad / n, 8) AS bad_rate,
  round(woe, 8) AS woe, round((pg - pb) * woe, 8) AS iv_part FROM parts"""))
def category_bins(spark, sf_dir):
    out = woe.iv_category_rows(demo.risk_samples(spark, sf_dir, "label", "seg", "channel"), ["seg", "channel"])
    return rounded(out, "total_pcnt", "bad_rate", "woe", "iv_part")


def _capped_sql(columns):
    parts = union(f"SELECT '{n}' AS feature, {e} AS category, label FROM b" for n, e in columns.items())
    return ("b AS (SELECT * FROM risk_samples WHERE label IN (0, 1))", f"x AS ({parts})", """
t AS (SELECT count(*) FILTER (label = 1) AS ev, count(*) FILTER (label = 0) AS non FROM b),
w AS (SELECT feature, category, count(*) AS n, sum(label) AS events, sum(label) / any_value(ev) AS re,
        (count(*) - sum(label)) / any_value(non) AS rn FROM x, t WHERE category IS NOT NULL GROUP BY 1, 2),
woe AS (SELECT *, CASE WHEN re = 0 THEN -20 WHEN rn = 0 THEN 20 ELSE ln(re / rn) END AS woe FROM w)""")


CAPPED = _capped_sql({"seg": "seg", "channel": "channel", "nation": "CAST(nation AS VARCHAR)", "n_lines": "CAST(n_lines AS VARCHAR)"})
CAPPED_ROWS = """SELECT feature, category, CAST(n AS BIGINT) AS n, CAST(events AS BIGINT) AS events,
  round(woe, 8) AS woe, round((re - rn) * woe, 8) AS iv_part FROM woe"""


@query("woe_capped", with_risk(*CAPPED, body=CAPPED_ROWS))
def woe_capped(spark, sf_dir):
    names = ["seg", "channel", "nation", "n_lines"]
    rows = woe.binary_rows(demo.risk_samples(spark, sf_dir, "label", *names), "label")
    return rounded(woe.capped_woe(rows, {n: F.col(n) for n in names}), "woe", "iv_part")


@query("woe_replace", with_risk(*CAPPED, body="""
SELECT b.id, round(s.woe, 8) AS seg, round(n.woe, 8) AS nation FROM b
LEFT JOIN woe s ON s.feature = 'seg' AND s.category = b.seg
LEFT JOIN woe n ON n.feature = 'nation' AND n.category = CAST(b.nation AS VARCHAR)"""))
def woe_replace(spark, sf_dir):
    rows = woe.binary_rows(demo.risk_samples(spark, sf_dir, "id", "label", "seg", "nation"), "label")
    table = woe.capped_woe(rows, {"seg": F.col("seg"), "nation": F.col("nation")})
    return rounded(woe.replace_by_woe(rows.drop("label"), table, ["seg", "nation"]), "seg", "nation")


@query("combined_iv", with_risk(
    *_capped_sql({"channel|nation": "concat_ws('|', channel, CAST(nation AS VARCHAR))"}), body=CAPPED_ROWS))
def combined_iv(spark, sf_dir):
    rows = woe.binary_rows(demo.risk_samples(spark, sf_dir, "label", "channel", "nation"), "label")
    return rounded(woe.combined_iv(rows, ["channel", "nation"]), "woe", "iv_part")


DECILES = (
    "l AS (SELECT list(prob_ ORDER BY prob_) AS l FROM scored)",
    f"e AS (SELECT list(DISTINCT e ORDER BY e) AS e FROM (SELECT {interpolated('l', 'k / 10.0::DOUBLE')} AS e FROM l, range(0, 11) t(k)))",
)


@query("qcut_levels", with_scored(*DECILES, body="""
SELECT id, CAST(greatest(len(list_filter(e, lambda v: v < prob_)), 1) - 1 AS INTEGER) AS bin_idx FROM scored, e"""))
def qcut_levels(spark, sf_dir):
    rows = demo.scored_table(spark, sf_dir)
    edges = binning.level_edges(rows, "prob_")
    return binning.bin_by_edges(rows, "prob_", edges).select("id", "bin_idx")


@query("bins_points", with_scored(body="""
SELECT id, CAST(CASE WHEN prob_ <= 0.2 THEN 0 WHEN prob_ <= 0.5 THEN 1 WHEN prob_ <= 0.8 THEN 2 ELSE 3 END AS INTEGER) AS bin_idx FROM scored"""))
def bins_points(spark, sf_dir):
    return binning.bin_by_points(demo.scored(spark, sf_dir), "prob_", [0.2, 0.5, 0.8]).select("id", "bin_idx")


@query("bins_edges", with_risk(body="""
SELECT id, CAST(CASE WHEN bal >= -9999 AND bal <= 0 THEN 0 WHEN bal > 0 AND bal <= 2500 THEN 1
  WHEN bal > 2500 AND bal <= 5000 THEN 2 END AS INTEGER) AS bin_idx FROM risk_samples"""))
def bins_edges(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id", "bal")
    return binning.bin_by_edges(rows, "bal", [-9999, 0, 2500, 5000]).select("id", "bin_idx")


def _quintile_sql():
    parts = []
    for f in ("amt", "bal"):
        steps = " + ".join(f"CASE WHEN {f} >= {interpolated('l', p + '::DOUBLE')} THEN 1 ELSE 0 END" for p in ("0.0", "0.2", "0.4", "0.6", "0.8"))
        parts.append(f"SELECT id, '{f}' AS feature, CASE WHEN {f} IS NOT NULL THEN {steps} END AS level "
                     f"FROM risk_samples, (SELECT list({f} ORDER BY {f}) FILTER ({f} IS NOT NULL) AS l FROM risk_samples)")
    return with_risk(f"x AS ({union(parts)})", body="""
SELECT r.id, CAST(a.level AS INTEGER) AS amt, CAST(b.level AS INTEGER) AS bal, r.nation, r.channel FROM risk_samples r
JOIN x a ON a.id = r.id AND a.feature = 'amt' JOIN x b ON b.id = r.id AND b.feature = 'bal'""")


@query("quintile_levels", _quintile_sql())
def quintile_levels(spark, sf_dir):
    rows = demo.samples_table(spark, sf_dir).select("id", "amt", "bal", "nation", "channel")
    return binning.discretise_continuous(rows, ["amt", "bal", "nation", "channel"])


@query("equal_width_bands", with_scored(body="""
SELECT CAST(row_number() OVER (ORDER BY e) - 1 AS INTEGER) AS bin_idx, CASE WHEN row_number() OVER (ORDER BY e) = 1 THEN 0 ELSE e END AS lo,
  CASE WHEN row_number() OVER (ORDER BY e) = 11 THEN 1000 ELSE lead(e) OVER (ORDER BY e) END AS hi
FROM (SELECT DISTINCT e FROM (
  SELECT round(lo - 0.0001::DOUBLE, 4) AS e FROM m UNION ALL
  SELECT round(lo + (hi - lo) / 11 + k * ((hi - lo) / 11), 4) FROM m, range(0, 11) t(k)))
QUALIFY row_number() OVER (ORDER BY e) <= 11""").replace("SELECT CAST(row_number", ", m AS (SELECT min(sig) AS lo, max(sig) AS hi FROM scored)\nSELECT CAST(row_number", 1))
def equal_width_bands(spark, sf_dir):
    edges = binning.equal_width_bands(demo.scored(spark, sf_dir), "sig", 11)
    return binning.edges_table(spark, {"sig": edges}).drop("feature")

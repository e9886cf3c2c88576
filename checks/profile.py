"""Data-quality profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.clean import FEATURES, MONTH
from checks.common import interpolated, long_numeric, query, union, with_risk
from riskweave.functions.dates import month_of
from riskweave.operators import profile
from riskweave.sources import demo

TOKENS = (-9999, "-9998")
NUMERIC = ("cust", *demo.NUMERIC)
TEXT = ("seg", "channel")
RATES = """CAST(count(*) AS BIGINT) AS total_samples, CAST(count(*) FILTER (label = 0) AS BIGINT) AS good,
  CAST(count(*) FILTER (label = 1) AS BIGINT) AS bad, CAST(count(*) FILTER (label = 2) AS BIGINT) AS grey"""
RATE4 = "round(count(*) FILTER (label = 1) / count(*), 4) AS bad_rate"
RATE8 = "round(count(*) FILTER (label = 1) / count(*), 8) AS bad_rate"
LABELLED = "lab AS (SELECT * FROM risk_samples WHERE label IS NOT NULL)"


def rounded(df, *names, digits=8):
    """Rounds doubles; adding zero turns a negative zero into a plain one."""
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in names})


def _missing_sql():
    parts = []
    for f in FEATURES:
        text = f == "seg"
        num = "0" if text else f"avg(CASE WHEN {f} = -9999 THEN 1 ELSE 0 END)"
        txt = f"avg(CASE WHEN {f} = '-9998' THEN 1 ELSE 0 END)" if text else "0"
        nan = f"avg(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END)"
        parts.append(
            f"SELECT '{f}' AS feature, '{'categorical' if text else 'numeric'}' AS type, CAST(count(*) AS BIGINT) AS total_count, "
            f'round({num}, 8)::DOUBLE AS "missing_-9999_num", round({txt}, 8)::DOUBLE AS "missing_-9998_str", '
            f"round({nan}, 8)::DOUBLE AS missing_nan, round({num} + {txt} + {nan}, 8)::DOUBLE AS missing_tot FROM risk_samples"
        )
    return with_risk(body=union(parts))


@query("missing_profile", _missing_sql())
def missing_profile(spark, sf_dir):
    out = profile.missing_profile(demo.risk_samples(spark, sf_dir, *FEATURES), FEATURES, TOKENS)
    return rounded(out, "missing_-9999_num", "missing_-9998_str", "missing_nan", "missing_tot")


@query("missing_ranking", with_risk(body="SELECT feature, missing_tot FROM (" + union(
    f"SELECT '{f}' AS feature, round(avg(CASE WHEN {f} IS NULL OR {f} = {tok} THEN 1 ELSE 0 END), 8) AS missing_tot FROM risk_samples"
    for f, tok in [(f, "'-9998'" if f == "seg" else "-9999") for f in FEATURES]) + ")"))
def missing_ranking(spark, sf_dir):
    out = profile.missing_profile(demo.risk_samples(spark, sf_dir, *FEATURES), FEATURES, TOKENS)
    return rounded(profile.missing_ranking(out), "missing_tot")


@query("missing_rates", with_risk(body=union(
    f"SELECT '{f}' AS feature, round(avg(CASE WHEN {f} IS NULL OR {f} IN {toks} THEN 1 ELSE 0 END), 8) AS missing_rate FROM risk_samples"
    for f, toks in [("bal", "(-9999, -9998)"), ("sparse", "(-9999, -9998)"), ("n_lines", "(-9999, -9998)"), ("seg", "('-9998', '')")])))
def missing_rates(spark, sf_dir):
    names = ["bal", "sparse", "n_lines", "seg"]
    out = profile.missing_rates(demo.risk_samples(spark, sf_dir, *names), names, (-9999, -9998, "-9998", ""))
    return rounded(out, "missing_rate")


@query("numeric_profile", with_risk(
    f"l AS (SELECT feature, list(v ORDER BY v) AS l, count(v) AS n, avg(v) AS m, stddev_samp(v) AS s, min(v) AS lo, max(v) AS hi "
    f"FROM ({long_numeric(NUMERIC)}) WHERE v IS NOT NULL AND v <> -9999 GROUP BY feature)",
    body="SELECT feature, CAST(n AS BIGINT) AS count, round(m, 4) AS mean, round(s, 4) AS std, lo AS min, "
    + ", ".join(f"round({interpolated('l', repr(p) + '::DOUBLE')}, 6) AS {profile.percentile_name(p)}" for p in profile.PROFILE_PERCENTILES)
    + ", hi AS max, CASE WHEN m <> 0 THEN round(s / m, 6) END AS cv FROM l"))
def numeric_profile(spark, sf_dir):
    out = profile.numeric_profile(demo.samples_table(spark, sf_dir), NUMERIC, TOKENS)
    out = rounded(out, *[profile.percentile_name(p) for p in profile.PROFILE_PERCENTILES], "cv", digits=6)
    return rounded(out, "mean", "std", digits=4)


def _category_sql():
    parts = []
    for f in TEXT:
        parts.append(f"SELECT '{f}' AS feature, {f} AS raw, CASE WHEN {f} <> '-9998' THEN {f} END AS v FROM risk_samples")
    ranks = range(1, 6)
    return with_risk(
        f"x AS ({union(parts)})",
        "c AS (SELECT feature, v, count(*) AS cnt, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, v) AS rn FROM x WHERE v IS NOT NULL GROUP BY 1, 2)",
        "n AS (SELECT feature, count(v) AS n, count(DISTINCT raw) AS u, count(DISTINCT v) AS vu FROM x GROUP BY 1)",
        "t AS (SELECT feature, "
        + ", ".join(f"max(v) FILTER (rn = {k}) AS value{k}, max(cnt) FILTER (rn = {k}) AS cnt{k}" for k in ranks)
        + ", sum(cnt) FILTER (rn <= 5) AS shown FROM c GROUP BY 1)",
        body="SELECT n.feature, CAST(n AS BIGINT) AS count, CAST(u AS BIGINT) AS unique_cnt, CAST(vu AS BIGINT) AS valid_unique_cnt, "
        + ", ".join(f"value{k}, CAST(cnt{k} AS BIGINT) AS cnt{k}, round(cnt{k} / n, 8) AS ratio{k}" for k in ranks)
        + ", CAST(n - shown AS BIGINT) AS cnt_other, round((n - shown) / n, 8) AS ratio_other FROM n JOIN t ON n.feature = t.feature",
    )


@query("categorical_profile", _category_sql())
def categorical_profile(spark, sf_dir):
    out = profile.categorical_profile(demo.risk_samples(spark, sf_dir, *TEXT), TEXT, TOKENS)
    return rounded(out, *[f"ratio{k}" for k in range(1, 6)], "ratio_other")


CONCENTRATED = ("seg", "channel", "nation", "n_lines", "konst", "bal", "sparse", "sig")


def _values_sql(token_free: bool):
    parts = []
    for f in CONCENTRATED:
        text = f in TEXT
        v = f if text else f"CAST({f} AS DOUBLE)"
        tok = "'-9998'" if text else "-9999"
        shown = f"CAST(CASE WHEN {f} <> {tok} THEN {v} END AS VARCHAR)" if token_free else f"CAST({v} AS VARCHAR)"
        parts.append(f"SELECT '{f}' AS feature, '{'categorical' if text else 'numeric'}' AS type, {shown} AS v FROM risk_samples")
    return f"x AS ({union(parts)}), c AS (SELECT feature, type, v, count(*) AS cnt FROM x GROUP BY ALL)"


@query("concentration", with_risk(_values_sql(True), body="""
SELECT c.feature, type, CAST(coalesce(sum(cnt) FILTER (v IS NOT NULL), 0) AS BIGINT) AS count, CAST(count(v) AS BIGINT) AS unique_cnt,
  CAST(max(cnt) FILTER (v IS NOT NULL) AS BIGINT) AS freq, first(v ORDER BY (v IS NULL), cnt DESC, v) AS top,
  round(max(cnt) FILTER (v IS NOT NULL) / sum(cnt), 8) AS freq_ratio FROM c GROUP BY 1, 2"""))
def concentration(spark, sf_dir):
    out = profile.concentration(demo.risk_samples(spark, sf_dir, *CONCENTRATED), CONCENTRATED, TOKENS)
    return rounded(out, "freq_ratio")


@query("dominated_columns", with_risk(_values_sql(False), body="""
SELECT feature, CAST(max(cnt) AS BIGINT) AS freq, CAST(sum(cnt) AS BIGINT) AS n, round(max(cnt) / sum(cnt), 8) AS freq_ratio
FROM c GROUP BY 1 HAVING max(cnt) / sum(cnt) > 0.9"""))
def dominated_columns(spark, sf_dir):
    out = profile.dominated_columns(demo.risk_samples(spark, sf_dir, *CONCENTRATED), CONCENTRATED, 0.9)
    return rounded(out, "freq_ratio")


@query("distinct_counts", with_risk(_values_sql(False), body="SELECT feature, CAST(count(v) AS BIGINT) AS unique_cnt FROM c GROUP BY 1"))
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(demo.risk_samples(spark, sf_dir, *CONCENTRATED), CONCENTRATED)


@query("duplicate_ids", with_risk("c AS (SELECT cust, count(*) AS c FROM risk_samples GROUP BY 1)", body="""
SELECT CAST(sum(c) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS unique_cnt, CAST(max(c) AS BIGINT) AS max_dup FROM c"""))
def duplicate_ids(spark, sf_dir):
    return profile.duplicate_ids(demo.risk_samples(spark, sf_dir, "cust"), "cust")


@query("overview", with_risk(
    "c AS (SELECT id, count(*) AS c FROM risk_samples GROUP BY 1)",
    "d AS (SELECT try_strptime(CAST(date AS VARCHAR), '%Y%m%d')::DATE AS d FROM risk_samples)",
    "m AS (SELECT min(d) AS lo, max(d) AS hi, count(d) AS n FROM d)",
    body="""
SELECT (SELECT CAST(sum(c) AS BIGINT) FROM c) AS count, (SELECT CAST(count(*) AS BIGINT) FROM c) AS unique_cnt,
  (SELECT CAST(max(c) AS BIGINT) FROM c) AS max_dup,
  (SELECT CAST(count(DISTINCT channel) AS BIGINT) FROM risk_samples) AS channel_count,
  (SELECT list_sort(list(DISTINCT channel)) FROM risk_samples) AS channel_list,
  lo AS start_date, hi AS end_date, CAST(n AS BIGINT) AS valid_dates,
  CAST(datesub('month', lo, hi) AS INTEGER) AS span_months,
  CAST(datediff('day', lo + to_months(CAST(datesub('month', lo, hi) AS INTEGER)), hi) AS INTEGER) AS span_days FROM m"""))
def overview(spark, sf_dir):
    return profile.overview(demo.risk_samples(spark, sf_dir, "id", "channel", "date"))


@query("default_rates", with_risk(LABELLED, body=f"""
SELECT 'all' AS dim, 'all' AS "group", {RATES}, {RATE4} FROM lab
UNION ALL SELECT 'channel', channel, {RATES}, {RATE4} FROM lab GROUP BY channel
UNION ALL SELECT 'month', {MONTH}, {RATES}, {RATE4} FROM lab GROUP BY {MONTH}"""))
def default_rates(spark, sf_dir):
    return profile.default_rates(demo.risk_samples(spark, sf_dir, "label", "channel", "date"))


@query("default_overall", with_risk(LABELLED, body=f"""SELECT 'all' AS "group", {RATES}, {RATE4} FROM lab"""))
def default_overall(spark, sf_dir):
    return profile.default_overall(demo.risk_samples(spark, sf_dir, "label"))


@query("default_by_channel", with_risk(LABELLED, body=f"""SELECT channel AS "group", {RATES}, {RATE4} FROM lab GROUP BY 1"""))
def default_by_channel(spark, sf_dir):
    return profile.default_by(demo.risk_samples(spark, sf_dir, "label", "channel"), F.col("channel"))


@query("default_by_month", with_risk(LABELLED, body=f"""SELECT {MONTH} AS "group", {RATES}, {RATE4} FROM lab GROUP BY 1"""))
def default_by_month(spark, sf_dir):
    return profile.default_by(demo.risk_samples(spark, sf_dir, "label", "date"), month_of(F.col("date")))


@query("cross_default", with_risk(LABELLED, body=f"SELECT channel AS group1, {MONTH} AS group2, {RATES}, {RATE8} FROM lab GROUP BY 1, 2"))
def cross_default(spark, sf_dir):
    return rounded(profile.cross_default(demo.risk_samples(spark, sf_dir, "label", "channel", "date")), "bad_rate")


MONTHS_2000 = [f"2000-{m:02d}" for m in range(1, 13)]


@query("default_matrix", with_risk(LABELLED, body="SELECT channel AS group1, " + ", ".join(
    f"""round(count(*) FILTER (label = 1 AND {MONTH} = '{m}') / nullif(count(*) FILTER ({MONTH} = '{m}'), 0), 8) AS "{m}" """
    for m in MONTHS_2000) + " FROM lab GROUP BY 1"))
def default_matrix(spark, sf_dir):
    cross = profile.cross_default(demo.risk_samples(spark, sf_dir, "label", "channel", "date"))
    return rounded(profile.default_matrix(cross, MONTHS_2000), *MONTHS_2000)


@query("monthly_trend", with_risk(LABELLED, body=f"""SELECT {MONTH} AS "group", {RATE4} FROM lab GROUP BY 1"""))
def monthly_trend(spark, sf_dir):
    return profile.monthly_trend(profile.default_rates(demo.risk_samples(spark, sf_dir, "label", "channel", "date")))


@query("channel_rates", with_risk(LABELLED, body=f"""SELECT channel AS "group", {RATE4} FROM lab GROUP BY 1"""))
def channel_rates(spark, sf_dir):
    return profile.channel_rates(profile.default_rates(demo.risk_samples(spark, sf_dir, "label", "channel", "date")))


@query("null_rates", with_risk(body=union(
    f"""SELECT '{f}' AS feature, CAST(count(*) - count({f}) AS BIGINT) AS null_cnt,
        round((count(*) - count({f})) / count(*), 8) AS null_rate FROM risk_samples""" for f in FEATURES)))
def null_rates(spark, sf_dir):
    return rounded(profile.null_rates(demo.risk_samples(spark, sf_dir, *FEATURES), FEATURES), "null_rate")


@query("deviations", with_risk(body=union(
    f"SELECT '{f}' AS feature, round(stddev_samp({f}), 4) AS std FROM risk_samples" for f in NUMERIC)))
def deviations(spark, sf_dir):
    return rounded(profile.deviations(demo.risk_samples(spark, sf_dir, *NUMERIC), NUMERIC), "std", digits=4)


def _crosstab_sql(dims, grey=True):
    where = "WHERE label IS NOT NULL" + "".join(f" AND {d} IS NOT NULL" for d in dims) + ("" if grey else " AND label <> 2")
    body = f"""CAST(count(*) FILTER (label = 0) AS BIGINT) AS good, CAST(count(*) FILTER (label = 1) AS BIGINT) AS bad,
      {"CAST(count(*) FILTER (label = 2) AS BIGINT) AS grey," if grey else ""} CAST(count(*) AS BIGINT) AS total,
      round(count(*) FILTER (label = 1) / count(*), 8) AS bad_ratio FROM risk_samples {where}"""
    shown = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dims)
    every = ", ".join(f"'All' AS {d}" for d in dims)
    return with_risk(body=f"SELECT {shown}, {body} GROUP BY {', '.join(dims)} UNION ALL SELECT {every}, {body}")


def _register_crosstab(name, dims, grey=True):
    @query(name, _crosstab_sql(dims, grey))
    def run(spark, sf_dir):
        rows = demo.risk_samples(spark, sf_dir, "label", *dims)
        return rounded(profile.crosstab(rows, dims, grey=grey), "bad_ratio")


_register_crosstab("crosstab_1d", ["channel"])
_register_crosstab("crosstab_1d_binary", ["seg"], grey=False)
_register_crosstab("crosstab_2d", ["channel", "nation"])
_register_crosstab("crosstab_3d", ["channel", "seg", "nation"])

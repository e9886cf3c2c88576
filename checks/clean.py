"""Cleaning, splits, joins and sample statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import SENTINEL_LIST, query, with_risk, with_scored
from riskweave.functions import cleaning, dates
from riskweave.operators import clean, joins, split
from riskweave.sources import demo
from riskweave.spec import SampleSpec

SPEC = SampleSpec()
FEATURES = [c for c in demo.COLUMNS if c not in SPEC.base_fea]
INTEGERS = ("cust", "nation", "n_lines")

CLEANED = f"""
cleaned AS (
  SELECT id, date, label, channel,
    {", ".join(f"coalesce({c}, -9999) AS {c}" for c in FEATURES if c != "seg")},
    CASE WHEN seg IS NULL OR seg = '' THEN '-9999' ELSE seg END AS seg
  FROM risk_samples WHERE label IN (0, 1))"""
STATS = """CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (label = 0) AS BIGINT) AS good,
  CAST(count(*) FILTER (label = 1) AS BIGINT) AS bad, CAST(count(*) FILTER (label = 2) AS BIGINT) AS grey,
  round(count(*) FILTER (label = 1) / count(*), 8) AS bad_rate"""
MONTH = "substr(CAST(date AS VARCHAR), 1, 4) || '-' || substr(CAST(date AS VARCHAR), 5, 2)"


def _rounded(df, name="bad_rate", digits=8):
    return df.withColumn(name, F.round(name, digits))


@query("clean_samples", with_risk(CLEANED, body="SELECT * FROM cleaned"))
def clean_samples(spark, sf_dir):
    return clean.clean_samples(demo.risk_samples(spark, sf_dir), SPEC)


@query(
    "keep_channels",
    with_risk(body="SELECT id, label, channel FROM risk_samples WHERE channel IN ('1-URGENT', '2-HIGH') AND label = 1"),
)
def keep_channels(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id", "label", "channel")
    return clean.keep_labels(clean.keep_channels(rows, "channel", ["1-URGENT", "2-HIGH"]), "label", [1])


@query("feature_types", """
SELECT unnest(['cust','amt','bal','bal_dup','nation','n_lines','sum_qty','max_disc','sparse','konst','drift','sig','sig_dup','seg']) AS feature,
       unnest(['numeric','numeric','numeric','numeric','numeric','numeric','numeric','numeric','numeric','numeric','numeric','numeric','numeric','categorical']) AS type,
       (SELECT CAST(count(*) AS BIGINT) FROM orders JOIN customer ON o_custkey = c_custkey) AS total_count""")
def feature_types(spark, sf_dir):
    df = demo.risk_samples(spark, sf_dir)
    numeric, categorical = cleaning.identify_types(df, SPEC.base_fea)
    pairs = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.lit(t).alias("type"))
          for fs, t in ((numeric, "numeric"), (categorical, "categorical")) for f in fs]
    )
    total = demo.risk_samples(spark, sf_dir, "id").agg(F.count(F.lit(1)).alias("total_count"))
    return total.select(F.inline(pairs), "total_count")


@query("row_check", with_risk(CLEANED, body="SELECT CAST(count(*) AS BIGINT) AS n_rows, count(*) < 500 AS too_few FROM cleaned"))
def row_check(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id", "label", "channel", "date")
    return clean.row_check(clean.clean_samples(rows, SPEC))


@query(
    "sentinels_to_null",
    with_risk(body=f"""SELECT id, CASE WHEN bal NOT IN {SENTINEL_LIST} THEN bal END AS bal,
      CASE WHEN sparse NOT IN {SENTINEL_LIST} THEN sparse END AS sparse FROM risk_samples"""),
)
def sentinels_to_null(spark, sf_dir):
    return clean.sentinels_to_null(demo.risk_samples(spark, sf_dir, "id", "bal", "sparse"), ["bal", "sparse"])


@query("split_date_range", with_risk(body="""
SELECT id, date, 'dev' AS dataset FROM risk_samples WHERE date BETWEEN 19950101 AND 19981231
UNION ALL SELECT id, date, 'oot' FROM risk_samples WHERE date BETWEEN 19990101 AND 20010801
UNION ALL SELECT id, date, 'psi' FROM risk_samples WHERE date BETWEEN 19980701 AND 20001231"""))
def split_date_range(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id", "date")
    return split.split_by_date_range(rows, "date", (19950101, 19981231), (19990101, 20010801), (19980701, 20001231))


@query("split_date_proportion", with_risk(body="""
SELECT id, date, CASE WHEN row_number() OVER (ORDER BY date, id) <= (SELECT floor(count(*) * (1 - 0.2::DOUBLE)) FROM risk_samples)
  THEN 'dev' ELSE 'oot' END AS dataset FROM risk_samples"""))
def split_date_proportion(spark, sf_dir):
    return split.split_by_date_proportion(demo.risk_samples(spark, sf_dir, "id", "date"), "date", "id", 0.2)


NULL_IDS = "nid AS (SELECT CASE WHEN id % 11 <> 0 THEN id END AS id, date, amt FROM risk_samples)"


@query("split_date_proportion_null_ids", with_risk(NULL_IDS, body="""
SELECT dataset, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(id) AS BIGINT) AS n_ids, CAST(sum(id) AS BIGINT) AS sum_ids, min(date) AS min_date, max(date) AS max_date
FROM (SELECT id, date, CASE WHEN row_number() OVER (ORDER BY date, id NULLS FIRST) <= (SELECT floor(count(*) * (1 - 0.3::DOUBLE)) FROM nid)
  THEN 'dev' ELSE 'oot' END AS dataset FROM nid) GROUP BY 1"""))
def split_date_proportion_null_ids(spark, sf_dir):
    """Rows without an id come first on their date; which of them the cut takes doesn't show in the sums."""
    rows = demo.risk_samples(spark, sf_dir, "id", "date", "amt").withColumn("id", F.when(F.col("id") % 11 != 0, F.col("id")))
    out = split.split_by_date_proportion(rows, "date", "id", 0.3)
    return out.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"), F.count("id").alias("n_ids"), F.sum("id").alias("sum_ids"), F.min("date").alias("min_date"), F.max("date").alias("max_date"))


HASH = "CAST(('0x' || substr(md5(concat_ws('-', CAST(id AS VARCHAR), '42')), 1, 8)) AS BIGINT)"


@query("split_hash", with_risk(body=f"""
SELECT id, 'dev' AS dataset FROM risk_samples WHERE {HASH} >= 858993459
UNION ALL SELECT id, unnest(['oot', 'psi']) FROM risk_samples WHERE {HASH} < 858993459"""))
def split_hash(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id")
    return split.with_psi_copy(split.split_by_hash(rows, "id", 0.2, 42))


@query("split_lvo", with_risk(body=f"""
SELECT id, date, CASE WHEN date >= 20000101 THEN 'O' WHEN {HASH} < 3006477107 THEN 'L' ELSE 'V' END AS model_ind
FROM risk_samples"""))
def split_lvo(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id", "date")
    return split.learn_validate_out(rows, "date", "id", out_from=20000101)


@query("sample_stats", with_risk(body=f"SELECT {STATS} FROM risk_samples"))
def sample_stats(spark, sf_dir):
    return _rounded(split.sample_stats(demo.risk_samples(spark, sf_dir, "label")))


@query("sample_stats_monthly", with_risk(body=f"SELECT {MONTH} AS month, {STATS} FROM risk_samples GROUP BY 1"))
def sample_stats_monthly(spark, sf_dir):
    return _rounded(split.monthly_stats(demo.risk_samples(spark, sf_dir, "date", "label")))


SPLIT = "s AS (SELECT *, CASE WHEN date < 19990101 THEN 'dev' ELSE 'oot' END AS dataset FROM risk_samples)"


@query("split_report", with_risk(SPLIT, body=f"""
SELECT dataset, 'Overall' AS month, {STATS} FROM s GROUP BY 1
UNION ALL SELECT dataset, {MONTH}, {STATS} FROM s GROUP BY 1, 2"""))
def split_report(spark, sf_dir):
    rows = demo.with_dataset(demo.risk_samples(spark, sf_dir, "date", "label"))
    return _rounded(split.split_report(rows))


@query("split_dates", with_risk(SPLIT, body="""
SELECT dataset, CAST(count(*) AS BIGINT) AS n_rows, min(date) AS min_date, max(date) AS max_date FROM s GROUP BY 1"""))
def split_dates(spark, sf_dir):
    return split.date_bounds(demo.with_dataset(demo.risk_samples(spark, sf_dir, "date")))


@query("merge_samples", with_risk(body="""
SELECT a.id, a.date, a.label, a.channel, a.amt, b.bal, c.seg FROM risk_samples a
JOIN risk_samples b ON a.id = b.id AND a.date = b.date AND a.label IS NOT DISTINCT FROM b.label AND a.channel = b.channel
JOIN risk_samples c ON a.id = c.id AND a.date = c.date AND a.label IS NOT DISTINCT FROM c.label AND a.channel = c.channel"""))
def merge_samples(spark, sf_dir):
    base = SPEC.base_fea
    tables = [demo.risk_samples(spark, sf_dir, *base, f) for f in ("amt", "bal", "seg")]
    return joins.merge_samples(tables, [["amt"], ["bal"], ["seg"]], base)


@query("column_batches", with_risk(body="""
SELECT id, amt, CASE WHEN bal <> -9999 THEN bal END AS bal, sig, drift, nation FROM risk_samples"""))
def column_batches(spark, sf_dir):
    features = ["amt", "bal", "sig", "drift", "nation"]
    rows = demo.risk_samples(spark, sf_dir, "id", *features)

    def void_missing(batch, names):
        return batch.withColumn("bal", F.when(F.col("bal") != -9999, F.col("bal"))) if "bal" in names else batch

    return joins.by_column_batches(rows, ["id"], features, void_missing, batch_size=2)


@query("feature_sets", with_risk(body="""
SELECT unnest(['amt', 'bal', 'seg']) AS feature, CAST(count(*) AS BIGINT) AS n_rows FROM risk_samples GROUP BY 1"""))
def feature_sets(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id", "amt", "bal", "seg")
    wanted = ["seg", "ghost", "amt", "bal"]
    known = joins.present_features(spark, wanted, rows.columns)
    flat = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    sizes = flat.unpivot([], ["id", "amt", "bal", "seg"], "feature", "value").groupBy("feature")
    return sizes.agg(F.count(F.lit(1)).alias("n_rows")).join(known, "feature", "left_semi")


@query("parse_dates", with_risk(body="""
SELECT id, CASE WHEN id % 3 = 0 THEN try_strptime(CAST(date AS VARCHAR), '%Y%m%d')::DATE
                WHEN id % 3 = 1 THEN try_strptime(CAST(date // 100 AS VARCHAR) || '01', '%Y%m%d')::DATE END AS day
FROM risk_samples"""))
def parse_dates(spark, sf_dir):
    rows = demo.risk_samples(spark, sf_dir, "id", "date")
    text = F.when(F.col("id") % 3 == 0, F.col("date").cast("string")).when(
        F.col("id") % 3 == 1, F.substring(F.col("date").cast("string"), 1, 6)
    ).otherwise("abc")
    return rows.select("id", dates.parse_flexible(text).alias("day"))

"""Data-quality profile: missing rates, distributions, default rates, cross-tabs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.cleaning import double_sql, is_token_sql, known_sql, sql_name, sql_text, type_name, typed_sql
from riskweave.functions.dates import looks_like_month, month_of, parse_flexible, span_days, span_months
from riskweave.operators.quantiles import FEATURES_PER_PASS, exact_quantiles

# The percentiles a numeric profile shows.
PROFILE_PERCENTILES = (0.01, 0.05, 0.10, 0.20, 0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90, 0.95, 0.99)
TOP_VALUES = 5


def percentile_name(p: float) -> str:
    return f"p{round(p * 100):02d}"


def _per_feature(df: DataFrame, features: Sequence[str], measures) -> DataFrame:
    """One row per feature from aggregates of the whole table.

    ``measures(feature)`` gives a list of (name, SQL aggregate). All features of
    a batch share one scan; the single result row is turned into feature rows.
    """
    parts = []
    for at in range(0, len(features), FEATURES_PER_PASS):
        aggs, rows = [], []
        for i, f in enumerate(features[at : at + FEATURES_PER_PASS]):
            fields = [f"{sql_text(f)} AS feature"]
            for j, (name, agg) in enumerate(measures(f)):
                aggs.append(f"{agg} AS m{i}_{j}")
                fields.append(f"m{i}_{j} AS {sql_name(name)}")
            rows.append(f"struct({', '.join(fields)})")
        parts.append(df.selectExpr(*aggs).selectExpr(f"inline(array({', '.join(rows)}))"))
    return reduce(DataFrame.unionByName, parts)


def rate_sql(condition: str) -> str:
    """Share of rows that meet a condition."""
    return f"coalesce(try_divide(count_if({condition}), count(1)), 0.0D)"


def token_name(token) -> str:
    return f"missing_{token}_{'str' if isinstance(token, str) else 'num'}"


def missing_profile(df: DataFrame, features: Sequence[str], missing_list: Sequence = ()) -> DataFrame:
    """Share of each missing token and of NULL per feature, and their sum."""

    def measures(f):
        out = [("type", f"first('{type_name(df, f)}')"), ("total_count", "count(1)")]
        out += [(token_name(t), rate_sql(is_token_sql(df, f, [t]))) for t in missing_list]
        return out + [("missing_nan", rate_sql(f"{typed_sql(df, f)} IS NULL"))]

    total = " + ".join(["missing_nan", *[sql_name(token_name(t)) for t in missing_list]])
    return _per_feature(df, features, measures).selectExpr("*", f"{total} AS missing_tot")


def missing_rates(df: DataFrame, features: Sequence[str], missing_list: Sequence = ()) -> DataFrame:
    """Missing rate per feature with tokens counted as missing."""
    return _per_feature(
        df, features, lambda f: [("missing_rate", rate_sql(f"{known_sql(df, f, missing_list)} IS NULL"))]
    )


def numeric_profile(df: DataFrame, features: Sequence[str], missing_list: Sequence = ()) -> DataFrame:
    """Count, mean, deviation, range, percentiles and variation of valid values."""
    valid = {f: known_sql(df, f, missing_list) for f in features}
    percentiles, _ = exact_quantiles(df, {f: (valid[f], PROFILE_PERCENTILES) for f in features})
    fields = [T.StructField("feature", T.StringType())]
    fields += [T.StructField(percentile_name(p), T.DoubleType()) for p in PROFILE_PERCENTILES]
    found = df.sparkSession.createDataFrame([(f, *percentiles[f]) for f in features], T.StructType(fields))
    aggregates = (("count", "count"), ("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
    moments = _per_feature(df, features, lambda f: [(name, f"{agg}({valid[f]})") for name, agg in aggregates])
    # Both sides hold one row per feature.
    return moments.join(F.broadcast(found), "feature", "left").selectExpr(
        "feature", "count", "mean", "std", "min", *found.columns[1:], "max", "try_divide(std, mean) AS cv"
    )


def value_counts(df: DataFrame, features: Sequence[str], missing_list: Sequence = ()) -> DataFrame:
    """Rows per feature and value (shown as text, NULL included); tokens count as NULL.

    Numbers are grouped as numbers and text as text. Rows combine before the
    shuffle, so a value that fills a third of the table arrives as one row per
    task.
    """
    parts = []
    for kind in ("numeric", "categorical"):
        names = [f for f in features if type_name(df, f) == kind]
        if names:
            flat = df.selectExpr(*[f"{known_sql(df, f, missing_list)} AS {sql_name(f)}" for f in names])
            long = flat.unpivot([], [sql_name(f) for f in names], "feature", "value")
            counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
            parts.append(counts.select("feature", F.col("value").cast("string").alias("value"), "cnt"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def top_values(counts: DataFrame, k: int = TOP_VALUES) -> DataFrame:
    """The ``k`` most frequent values per feature, ties by value.

    The row-number filter lets Spark keep only ``k`` rows per feature and task
    before the shuffle, so the size of the value list does not matter.
    """
    order = Window.partitionBy("feature").orderBy(F.desc("cnt"), F.col("value"))
    return counts.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)


def categorical_profile(df: DataFrame, features: Sequence[str], missing_list: Sequence = ()) -> DataFrame:
    """Count, distinct values and the five most frequent values of text features."""
    counts = value_counts(df, features, missing_list).filter("value IS NOT NULL")
    sizes = counts.groupBy("feature").agg(F.sum("cnt").alias("count"), F.count(F.lit(1)).alias("valid_unique_cnt"))
    raw = (
        df.select(*features)
        .unpivot([], [F.col(f"`{f}`") for f in features], "feature", "value")
        .filter("value IS NOT NULL")
        .distinct()
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("unique_cnt"))
    )
    ranks = range(1, TOP_VALUES + 1)
    tops = top_values(counts).groupBy("feature").agg(
        *[F.max(F.when(F.col("rn") == k, F.col("value"))).alias(f"value{k}") for k in ranks],
        *[F.max(F.when(F.col("rn") == k, F.col("cnt"))).alias(f"cnt{k}") for k in ranks],
    )
    names = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    joined = names.join(raw, "feature", "left").join(sizes, "feature", "left").join(tops, "feature", "left")
    joined = joined.na.fill(0, ["count", "unique_cnt", "valid_unique_cnt"])
    for k in ranks:
        joined = joined.withColumn(f"ratio{k}", F.try_divide(f"cnt{k}", F.col("count")))
    shown = sum((F.coalesce(F.col(f"cnt{k}"), F.lit(0)) for k in ranks), F.lit(0))
    return joined.withColumn("cnt_other", F.col("count") - shown).withColumn(
        "ratio_other", F.try_divide("cnt_other", F.col("count"))
    )


def concentration(df: DataFrame, features: Sequence[str], missing_list: Sequence = ()) -> DataFrame:
    """Valid count, distinct values, most frequent value and its share of all rows."""
    counts = value_counts(df, features, missing_list)
    valid = F.col("value").isNotNull()
    sizes = counts.groupBy("feature").agg(
        F.coalesce(F.sum(F.when(valid, F.col("cnt"))), F.lit(0)).alias("count"),
        F.count_if(valid).alias("unique_cnt"),
        F.max(F.when(valid, F.col("cnt"))).alias("freq"),
        F.sum("cnt").alias("_rows"),
    )
    top = top_values(counts.filter(valid), 1).select("feature", F.col("value").alias("top"))
    names = df.sparkSession.createDataFrame([(f, type_name(df, f)) for f in features], "feature string, type string")
    return (
        names.join(sizes, "feature", "left")
        .join(top, "feature", "left")
        .withColumn("freq_ratio", F.try_divide("freq", F.col("_rows")))
        .drop("_rows")
    )


def dominated_columns(df: DataFrame, features: Sequence[str], share: float = 0.9) -> DataFrame:
    """Features whose most frequent value, NULL included, exceeds a share of the rows.

    Of half the rows or more, a value is the median in any order. So the median of the
    values' hashes, from a bounded sketch, names the only candidate, and a second pass counts it; no
    value is shuffled. A smaller share takes the counts of all values.
    """
    if share < 0.5:
        counts = value_counts(df, features)
        stats = counts.groupBy("feature").agg(F.max("cnt").alias("freq"), F.sum("cnt").alias("n"))
        return stats.withColumn("freq_ratio", F.col("freq") / F.col("n")).filter(F.col("freq_ratio") > share)
    zero = {f: " + 0.0D" if type_name(df, f) == "numeric" else "" for f in features}  # minus zero is zero
    hashed = {f: f"shiftright(xxhash64({known_sql(df, f, ())}{zero[f]}), 12)" for f in features}  # 52 bits: the sketch works on doubles
    medians = {r.feature: r.median for r in _per_feature(df, features, lambda f: [("median", f"percentile_approx({hashed[f]}, 0.5D, 1000)")]).collect()}
    counts = _per_feature(df, features, lambda f: [("freq", f"count_if({hashed[f]} = {medians[f] or 0}L)"), ("n", "count(1)")])
    return counts.withColumn("freq_ratio", F.try_divide("freq", "n")).filter(F.col("freq_ratio") > share)


def duplicate_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows, distinct ids and the largest number of rows of one id."""
    per_id = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("c"))
    known = F.col(id_col).isNotNull()
    return per_id.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("count"),
        F.count_if(known).alias("unique_cnt"),
        F.max(F.when(known, F.col("c"))).alias("max_dup"),
    )


def overview(df: DataFrame, id_col: str = "id", channel_col: str = "channel", date_col: str = "date") -> DataFrame:
    """Duplicate check, channels and date range in one row."""
    channels = df.select(channel_col).filter(F.col(channel_col).isNotNull()).distinct()
    first = channels.orderBy(channel_col).limit(10).agg(F.array_sort(F.collect_list(channel_col)).alias("channel_list"))
    day = parse_flexible(F.col(date_col))
    span = df.agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"), F.count(day).alias("valid_dates"))
    span = span.select(
        "*",
        span_months(F.col("start_date"), F.col("end_date")).alias("span_months"),
        span_days(F.col("start_date"), F.col("end_date")).alias("span_days"),
    )
    parts = [duplicate_ids(df, id_col), channels.agg(F.count(F.lit(1)).alias("channel_count")), first, span]
    # One-row tables with different columns: stack them and keep the filled cell of each column.
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _default_columns(label: str) -> list[Column]:
    col = F.col(label)
    return [
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(col == 0).alias("good"),
        F.count_if(col == 1).alias("bad"),
        F.count_if(col == 2).alias("grey"),
        F.try_divide(F.count_if(col == 1), F.count(F.lit(1))).alias("bad_rate"),
    ]


def default_rates(
    df: DataFrame, label: str = "label", channel_col: str = "channel", date_col: str = "date"
) -> DataFrame:
    """Default statistics overall, by channel and by month in one pass.

    The ``dim`` column says which of the three a row belongs to.
    """
    rows = df.filter(F.col(label).isNotNull()).select(
        F.col(label), F.col(channel_col).alias("channel"), month_of(F.col(date_col)).alias("month")
    )
    stats = rows.groupingSets([[], ["channel"], ["month"]], "channel", "month").agg(
        F.grouping_id().alias("_set"), *_default_columns(label)
    )
    # Bits of the grouping id: channel, then month; 1 means rolled up.
    dim = F.when(F.col("_set") == 3, "all").when(F.col("_set") == 1, "channel").otherwise("month")
    group = F.when(F.col("_set") == 3, F.lit("all")).when(F.col("_set") == 1, F.col("channel")).otherwise(F.col("month"))
    return stats.select(
        dim.alias("dim"), group.alias("group"), "total_samples", "good", "bad", "grey",
        F.bround("bad_rate", 4).alias("bad_rate"),
    ).filter(F.col("group").isNotNull())


def default_overall(df: DataFrame, label: str = "label") -> DataFrame:
    rows = df.filter(F.col(label).isNotNull()).agg(*_default_columns(label))
    return rows.select(F.lit("all").alias("group"), "*").withColumn("bad_rate", F.bround("bad_rate", 4))


def default_by(df: DataFrame, group: Column, label: str = "label") -> DataFrame:
    rows = df.select(label, group.alias("group")).filter(F.col(label).isNotNull() & F.col("group").isNotNull())
    return rows.groupBy("group").agg(*_default_columns(label)).withColumn("bad_rate", F.bround("bad_rate", 4))


def cross_default(
    df: DataFrame, label: str = "label", channel_col: str = "channel", date_col: str = "date"
) -> DataFrame:
    """Default statistics by channel and month, not rounded."""
    rows = df.select(label, F.col(channel_col).alias("group1"), month_of(F.col(date_col)).alias("group2"))
    return rows.dropna().groupBy("group1", "group2").agg(*_default_columns(label))


def default_matrix(cross: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Channels down, months across, bad rate in the cells."""
    if months is None:
        months = sorted(r[0] for r in cross.select("group2").distinct().collect())
    return cross.groupBy("group1").pivot("group2", list(months)).agg(F.first("bad_rate"))


def missing_ranking(profile: DataFrame) -> DataFrame:
    return profile.select("feature", "missing_tot").orderBy(F.desc("missing_tot"), "feature")


def monthly_trend(rates: DataFrame) -> DataFrame:
    return rates.filter(looks_like_month(F.col("group"))).select("group", "bad_rate").orderBy("group")


def channel_rates(rates: DataFrame) -> DataFrame:
    rows = rates.filter(~looks_like_month(F.col("group")) & (F.col("dim") != "all"))
    return rows.select("group", "bad_rate").orderBy("group")


def null_rates(df: DataFrame, features: Sequence[str]) -> DataFrame:
    table = _per_feature(
        df,
        features,
        lambda f: [
            ("null_cnt", f"count_if({typed_sql(df, f)} IS NULL)"),
            ("null_rate", rate_sql(f"{typed_sql(df, f)} IS NULL")),
        ],
    )
    return table.orderBy(F.desc("null_cnt"), "feature")


def distinct_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exact number of distinct values per feature."""
    counts = value_counts(df, features).filter("value IS NOT NULL")
    return counts.groupBy("feature").agg(F.count(F.lit(1)).alias("unique_cnt")).orderBy(F.desc("unique_cnt"), "feature")


def deviations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    table = _per_feature(df, features, lambda f: [("std", f"stddev_samp({double_sql(df, f)})")])
    return table.orderBy(F.desc("std"), "feature")


def crosstab(df: DataFrame, dims: Sequence[str], label: str = "label", grey: bool = True) -> DataFrame:
    """Good, bad and grey counts per combination of dimensions, plus one grand total."""
    rows = df.filter(F.col(label).isNotNull()).select(*dims, label).dropna(subset=list(dims))
    if not grey:
        rows = rows.filter(F.col(label) != 2)
    col = F.col(label)
    stats = rows.groupingSets([list(dims), []], *dims).agg(
        F.grouping_id().alias("_set"),
        F.count_if(col == 0).alias("good"),
        F.count_if(col == 1).alias("bad"),
        *([F.count_if(col == 2).alias("grey")] if grey else []),
        F.count(F.lit(1)).alias("total"),
        F.try_divide(F.count_if(col == 1), F.count(F.lit(1))).alias("bad_ratio"),
    )
    # The grand total has every bit of the grouping id set.
    total_row = F.col("_set") == 2 ** len(dims) - 1
    shown = [F.when(total_row, F.lit("All")).otherwise(F.col(d).cast("string")).alias(d) for d in dims]
    return stats.select(*shown, *[c for c in stats.columns if c not in (*dims, "_set")])

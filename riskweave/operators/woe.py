"""Weight of evidence and information value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.scores import woe_capped, woe_or_zero
from riskweave.operators.binning import EQUAL_FREQUENCY, bin_counts, edges_table, iv_edges, iv_value

MISSING_TEXT = "-9999"


def binary_rows(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isin(0, 1))


def _total_bad(label: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_count"),
        F.sum(F.col(label).cast("bigint")).alias("bad_count"),
    ]


def iv_numeric_bins(
    df: DataFrame, features: Sequence[str], label: str = "label", n_bins: int = 10, method: int = EQUAL_FREQUENCY
) -> DataFrame:
    """Bin table of numeric features, with empty bins at zero."""
    rows = binary_rows(df, label)
    edges = iv_edges(rows, features, n_bins, method)
    counts = bin_counts(rows, {f: iv_value(rows, f) for f in features}, edges, _total_bad(label), [label])
    table = edges_table(df.sparkSession, edges).join(counts.filter("bin_idx IS NOT NULL"), ["feature", "bin_idx"], "left")
    return table.na.fill(0, ["total_count", "bad_count"])


def iv_category_bins(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """One bin per value of each text feature, NULL as a value of its own."""
    rows = binary_rows(df, label).select(
        label, *[F.coalesce(F.col(f"`{f}`").cast("string"), F.lit(MISSING_TEXT)).alias(f) for f in features]
    )
    flat = rows.unpivot([label], [F.col(f"`{f}`") for f in features], "feature", "category")
    return flat.groupBy("feature", "category").agg(*_total_bad(label))


def with_iv(bins: DataFrame) -> DataFrame:
    """Shares, bad rate, WOE and IV part per bin (ln of good share over bad share)."""
    per_feature = Window.partitionBy("feature")
    total, bad = F.col("total_count"), F.col("bad_count")
    good_share = F.try_divide(total - bad, F.sum(total - bad).over(per_feature))
    bad_share = F.try_divide(bad, F.sum(bad).over(per_feature))
    shared = bins.select(
        "*",
        F.try_divide(total, F.sum(total).over(per_feature)).alias("total_pcnt"),
        F.coalesce(F.try_divide(bad, total), F.lit(0.0)).alias("bad_rate"),
        F.coalesce(good_share, F.lit(0.0)).alias("good_share"),
        F.coalesce(bad_share, F.lit(0.0)).alias("bad_share"),
    )
    woe = woe_or_zero(F.col("good_share"), F.col("bad_share"))
    part = F.when(
        (F.col("good_share") > 0) & (F.col("bad_share") > 0), (F.col("good_share") - F.col("bad_share")) * F.col("woe")
    ).otherwise(F.lit(0.0))
    return shared.withColumn("woe", woe).withColumn("iv_part", part).drop("good_share", "bad_share")


def total_iv(binned: DataFrame) -> DataFrame:
    """IV per feature. The bins of one feature combine before the shuffle."""
    return binned.groupBy("feature").agg(F.sum("iv_part").alias("iv"))


def iv_numeric(df: DataFrame, features: Sequence[str], label: str = "label", n_bins: int = 10,
               method: int = EQUAL_FREQUENCY) -> DataFrame:
    return total_iv(with_iv(iv_numeric_bins(df, features, label, n_bins, method)))


def iv_categorical(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    return total_iv(iv_category_rows(df, features, label))


def iv_category_rows(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Bin rows of text features without a per-feature window.

    A text column may hold very many values, so its totals come from a second
    aggregation instead of a window that would gather the feature in one task.
    """
    bins = iv_category_bins(df, features, label)
    return _join_totals(bins).select(
        "feature", "category", "total_count", "bad_count",
        F.try_divide("total_count", F.col("f_total")).alias("total_pcnt"),
        F.try_divide("bad_count", F.col("total_count")).alias("bad_rate"),
        woe_or_zero(F.col("good_share"), F.col("bad_share")).alias("woe"),
        F.when(
            (F.col("good_share") > 0) & (F.col("bad_share") > 0),
            (F.col("good_share") - F.col("bad_share"))
            * woe_or_zero(F.col("good_share"), F.col("bad_share")),
        ).otherwise(F.lit(0.0)).alias("iv_part"),
    )


def _join_totals(bins: DataFrame) -> DataFrame:
    totals = bins.groupBy("feature").agg(F.sum("total_count").alias("f_total"), F.sum("bad_count").alias("f_bad"))
    joined = bins.join(totals, "feature")
    return joined.select(
        "*",
        F.coalesce(F.try_divide(F.col("total_count") - F.col("bad_count"), F.col("f_total") - F.col("f_bad")), F.lit(0.0)).alias("good_share"),
        F.coalesce(F.try_divide("bad_count", F.col("f_bad")), F.lit(0.0)).alias("bad_share"),
    )


def check_binary(df: DataFrame, label: str, event=1) -> None:
    """Raise unless the label takes exactly two values, the event among them."""
    other = F.col(label) != event
    row = df.agg(
        F.count_if(F.col(label) == event).alias("events"),
        F.min(F.when(other, F.col(label))).alias("a"),
        F.max(F.when(other, F.col(label))).alias("b"),
    ).first()
    if not row.events or row.a is None or row.a != row.b:
        raise ValueError("label must be binary")


def capped_woe(df: DataFrame, columns: Mapping[str, Column], label: str = "label", event=1) -> DataFrame:
    """WOE per feature and discrete value with fixed values for empty sides."""
    flag = (F.col(label) == event).cast("int").alias("_event")
    rows = df.filter(F.col(label).isNotNull()).select(
        flag, *[c.cast("string").alias(n) for n, c in columns.items()]
    )
    flat = rows.unpivot(["_event"], [F.col(f"`{n}`") for n in columns], "feature", "category")
    counts = flat.filter("category IS NOT NULL").groupBy("feature", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_event").cast("bigint")).alias("events")
    )
    # Shares are taken over all labelled rows, also those where a feature is NULL.
    totals = df.agg(
        F.count_if(F.col(label) == event).alias("events"), F.count_if(F.col(label) != event).alias("others")
    ).first()
    if not totals.events or not totals.others:
        raise ValueError("label must take two values")
    return (
        counts.select(
            "feature", "category", "n", "events",
            (F.col("events") / F.lit(totals.events)).alias("event_share"),
            ((F.col("n") - F.col("events")) / F.lit(totals.others)).alias("other_share"),
        )
        .withColumn("woe", woe_capped(F.col("event_share"), F.col("other_share")))
        .withColumn("iv_part", (F.col("event_share") - F.col("other_share")) * F.col("woe"))
        .drop("event_share", "other_share")
    )


def replace_by_woe(df: DataFrame, woe: DataFrame, features: Sequence[str]) -> DataFrame:
    """Each feature replaced by its WOE; values without one stay NULL.

    The mapping is joined per feature; it is not hinted, so Spark broadcasts it
    only while it is small and shuffles it for features with many values.
    """
    out = df
    for f in features:
        mapping = woe.filter(F.col("feature") == f).select(
            F.col("category").alias(f"_k_{f}"), F.col("woe").alias(f"_w_{f}")
        )
        out = out.join(mapping, F.col(f"`{f}`").cast("string") == F.col(f"_k_{f}"), "left")
    return out.select(*[F.col(f"_w_{c}").alias(c) if c in features else F.col(f"`{c}`") for c in df.columns])


def combined_iv(df: DataFrame, features: Sequence[str], label: str = "label", event=1, sep: str = "|") -> DataFrame:
    """WOE table of several discrete features taken together as one."""
    joined = F.concat_ws(sep, *[F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in features])
    return capped_woe(df, {sep.join(features): joined}, label, event)

"""Row filters and the cleaning stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.cleaning import as_double, fill_missing, identify_types
from riskweave.spec import SENTINELS, VALID_ABOVE, SampleSpec

MIN_ROWS = 500


def keep_channels(df: DataFrame, channel_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Only the named channels; an empty list keeps all."""
    return df.filter(F.col(channel_col).isin(list(keep))) if keep else df


def keep_labels(df: DataFrame, label: str, keep: Sequence[int] = ()) -> DataFrame:
    """Only the named labels; an empty list means good and bad. NULL labels drop out."""
    return df.filter(F.col(label).isin(list(keep) or [0, 1]))


def clean_samples(
    df: DataFrame,
    spec: SampleSpec = SampleSpec(),
    product_list_keep: Sequence[str] = (),
    label_list_keep: Sequence[int] = (),
) -> DataFrame:
    """Filters channels and labels, then fills missing features."""
    numeric, categorical = identify_types(df, spec.base_fea)
    rows = keep_labels(keep_channels(df, spec.channel_col, product_list_keep), spec.label, label_list_keep)
    return fill_missing(rows, numeric, categorical, spec.fill_val)


def row_check(cleaned: DataFrame, min_sample_size: int = MIN_ROWS) -> DataFrame:
    """Rows left after cleaning and whether they are too few."""
    return cleaned.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("too_few", F.col("n_rows") < min_sample_size)


def sentinels_to_null(df: DataFrame, features: Sequence[str]) -> DataFrame:
    codes = [float(s) for s in SENTINELS]
    return df.withColumns(
        {f: F.when(~as_double(df, f).isin(codes), as_double(df, f)) for f in features}
    )


def valid_value(df: DataFrame, name: str) -> Column:
    """Value when it is a real measurement, else NULL."""
    return F.when(as_double(df, name) > VALID_ABOVE, as_double(df, name))


def check_range(*ranges: Sequence[int]) -> None:
    for r in ranges:
        if len(r) != 2:
            raise ValueError(f"a date range needs two ends, got {list(r)}")
        if r[0] > r[1]:
            raise ValueError(f"date range {list(r)} is reversed")


def in_range(col: Column, bounds: Sequence[int]) -> Column:
    return col.cast("bigint").between(int(bounds[0]), int(bounds[1]))

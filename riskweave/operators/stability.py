"""Population stability. Four definitions differ in smoothing and rounding and stay apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.bins import with_bin
from riskweave.functions.cleaning import as_double, double_sql, known_sql
from riskweave.operators.binning import EQUAL_FREQUENCY, bin_counts, edges_table, finish_edges, psi_edges, quantile_edges, widened_edges
from riskweave.operators.quantiles import exact_quantiles
from riskweave.spec import PSI_FIRST_EDGE, PSI_REAL_ABOVE, SENTINELS, STABLE_PSI

DIGITS_SHARE = 8
DIGITS_LOG = 4
SMOOTH = 0.0001
LOG_LIMIT = 10.0


def _share(count: Column, total: Column) -> Column:
    """Share of a bin, where an empty bin counts as one row."""
    return F.bround(F.greatest(F.coalesce(count, F.lit(0)), F.lit(1)) / total, DIGITS_SHARE)


def _term(p: Column, q: Column) -> Column:
    return (p - q) * F.bround(F.ln(p / q), DIGITS_LOG)


def _sample_counts(expected: Column) -> list[Column]:
    return [F.count_if(expected).alias("n_expected"), F.count_if(~expected).alias("n_actual")]


def psi_numeric(
    df: DataFrame,
    features: Sequence[str],
    expected: Column,
    n_bins: int = 10,
    method: int = EQUAL_FREQUENCY,
) -> DataFrame:
    """PSI per numeric feature between expected rows and the others, with and without sentinels.

    Shares are taken over all rows of a sample, NULLs included. Both variants
    use the same bins, so they come from one pass.
    """
    rows = df.select(expected.alias("_expected"), *features)
    edges = psi_edges(rows, features, "_expected", n_bins, method)
    both = {f"{f}\0all": double_sql(rows, f) for f in features}
    both.update({f"{f}\0valid": known_sql(rows, f, SENTINELS) for f in features})
    totals = rows.agg(*_sample_counts(F.col("_expected"))).first()
    counts = bin_counts(
        rows,
        both,
        {k: edges[k.split("\0")[0]] for k in both},
        [F.count_if("_expected").alias("p"), F.count_if(~F.col("_expected")).alias("q")],
        ["_expected"],
        closed="left",
    )
    variant = F.substring_index("feature", "\0", -1)
    named = counts.filter("bin_idx IS NOT NULL").select(
        F.substring_index("feature", "\0", 1).alias("feature"), "bin_idx",
        *[F.when(variant == v, F.col(c)).alias(f"{c}_{v}") for v in ("all", "valid") for c in ("p", "q")],
    )
    per_bin = named.groupBy("feature", "bin_idx").agg(
        *[F.sum(f"{c}_{v}").alias(f"{c}_{v}") for v in ("all", "valid") for c in ("p", "q")]
    )
    bins = edges_table(df.sparkSession, edges).join(per_bin, ["feature", "bin_idx"], "left")
    n_p, n_q = F.lit(float(totals.n_expected)), F.lit(float(totals.n_actual))
    return bins.groupBy("feature").agg(
        *[
            F.sum(_term(_share(F.col(f"p_{v}"), n_p), _share(F.col(f"q_{v}"), n_q))).alias(name)
            for v, name in (("all", "psi"), ("valid", "psi_valid"))
        ]
    )


def psi_categorical(df: DataFrame, features: Sequence[str], expected: Column, missing: str = "-9999") -> DataFrame:
    """PSI per text feature over the values of both samples."""
    rows = df.select(expected.alias("_expected"), *[F.coalesce(F.col(f"`{f}`").cast("string"), F.lit(missing)).alias(f) for f in features])
    totals = rows.agg(*_sample_counts(F.col("_expected"))).first()
    counts = (
        rows.unpivot(["_expected"], [F.col(f"`{f}`") for f in features], "feature", "category")
        .groupBy("feature", "category")
        .agg(F.count_if("_expected").alias("p"), F.count_if(~F.col("_expected")).alias("q"))
    )
    n_p, n_q = F.lit(float(totals.n_expected)), F.lit(float(totals.n_actual))
    psi = F.sum(_term(_share(F.col("p"), n_p), _share(F.col("q"), n_q)))
    return counts.groupBy("feature").agg(psi.alias("psi")).withColumn("psi_valid", F.col("psi"))


@dataclass(frozen=True)
class ScoreBins:
    """Expected distribution of a score: bin edges and counts."""

    edges: tuple[float, ...]
    counts: tuple[int, ...]


def psi_fit(expected: DataFrame, column: str, q: int = 10, range_ratio: float = 0.2) -> ScoreBins:
    """Decile edges of the expected score, widened at both ends, and the counts between them."""
    edges = widened_edges(quantile_edges(expected, {"x": double_sql(expected, column)}, q)["x"], range_ratio)
    binned = with_bin(expected.select(column), column, edges, "b", include_lowest=True)
    rows = binned.groupBy("b").count().collect()
    found = {r.b: r["count"] for r in rows}
    return ScoreBins(tuple(edges), tuple(found.get(i, 0) for i in range(len(edges) - 1)))


def psi_bins(fitted: ScoreBins, actual: DataFrame, column: str, smooth: float = SMOOTH, limit: float = LOG_LIMIT) -> DataFrame:
    """Bin rows of the score PSI; ``out_of_range`` counts actual rows outside all bins."""
    spark = actual.sparkSession
    rows = [
        (i, float(a), float(b), float(c))
        for i, (a, b, c) in enumerate(zip(fitted.edges, fitted.edges[1:], fitted.counts))
    ]
    bins = spark.createDataFrame(rows, "bin_idx int, lo double, hi double, expected double")
    counts = (
        with_bin(actual.select(column), column, fitted.edges, "bin_idx", include_lowest=True)
        .groupBy("bin_idx")
        .agg(F.count(F.lit(1)).alias("actual"))
    )
    total = float(sum(fitted.counts))
    joined = bins.join(counts, "bin_idx", "left").withColumn("actual", F.coalesce("actual", F.lit(0)) + smooth)
    # At most a dozen bins.
    n_actual = joined.agg(F.sum("actual").alias("t")).first().t
    shares = joined.select(
        "bin_idx", "lo", "hi", "expected", "actual",
        (F.col("expected") / total).alias("p"), (F.col("actual") / n_actual).alias("q"),
    )
    log = F.when(F.col("p") == 0, F.lit(limit)).otherwise(
        F.greatest(F.least(F.ln(F.try_divide("q", F.col("p"))), F.lit(limit)), F.lit(-limit))
    )
    return shares.withColumn("psi_part", (F.col("q") - F.col("p")) * log)


def psi_transform(fitted: ScoreBins, actual: DataFrame, column: str) -> DataFrame:
    """One row: PSI of the score and the share of actual rows outside the bins."""
    binned = with_bin(actual.select(column), column, fitted.edges, "b", include_lowest=True)
    flags = binned.agg(F.avg(F.col("b").isNull().cast("int")).alias("extreme_ratio")).first()
    return psi_bins(fitted, actual, column).agg(F.sum("psi_part").alias("psi")).withColumn(
        "extreme_ratio", F.lit(flags.extreme_ratio)
    )


def score_psi(expected: DataFrame, actual: DataFrame, column: str, q: int = 10, range_ratio: float = 0.2) -> DataFrame:
    return psi_transform(psi_fit(expected, column, q, range_ratio), actual, column)


def retrain_psi(
    df: DataFrame, feature: str, expected: Column, bin_step: float = 0.05, method: int = EQUAL_FREQUENCY, group: int = 20
) -> DataFrame:
    """Bin table of the retrain check: shares over binned rows, product rounded."""
    value = as_double(df, feature)
    rows = df.select(expected.alias("_expected"), value.alias("x"))
    real = f"CASE WHEN x > {PSI_REAL_ABOVE!r}D THEN x END"
    steps = round(1 / bin_step)
    probs = [k / steps for k in range(1, steps)] if method == EQUAL_FREQUENCY else []
    nodes, row = exact_quantiles(
        rows, {"x": (f"CASE WHEN _expected THEN {real} END", probs)}, ["max(x) AS top", f"min({real}) AS low"]
    )
    top = row.top + 0.1
    hi = top + 1 if method == EQUAL_FREQUENCY else top
    edges = finish_edges((PSI_FIRST_EDGE, row.low), row.low, hi, group, method, nodes["x"])
    counts = bin_counts(
        rows, {feature: "x"}, {feature: edges},
        [F.count_if("_expected").alias("n_expected"), F.count_if(~F.col("_expected")).alias("n_actual")],
        ["_expected"], closed="left",
    ).filter("bin_idx IS NOT NULL").drop("feature")
    bins = edges_table(df.sparkSession, {feature: edges}).join(counts, "bin_idx", "left").na.fill(0, ["n_expected", "n_actual"])
    totals = counts.agg(F.sum("n_expected").alias("p"), F.sum("n_actual").alias("q")).first()
    p = _share(F.col("n_expected"), F.lit(float(totals.p)))
    q = _share(F.col("n_actual"), F.lit(float(totals.q)))
    return bins.select(
        "feature", "bin_idx", "lo", "hi", "n_expected", "n_actual", p.alias("p"), q.alias("q")
    ).withColumn("psi_part", F.bround((F.col("p") - F.col("q")) * F.ln(F.col("p") / F.col("q")), 4))


def verdict(psi: Column) -> Column:
    return F.when(psi < STABLE_PSI, F.lit("stable")).otherwise(F.lit("unstable"))

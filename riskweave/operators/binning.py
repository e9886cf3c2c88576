"""Bin edges and bin counts.

Edges are short arrays (about a dozen numbers per feature) and live on the
driver as literals; every pass over the rows is a Spark aggregation shared by
all features.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.bins import add_bins, with_bin, with_infinite_ends
from riskweave.functions.cleaning import double_sql, sql_list, sql_name
from riskweave.operators.quantiles import exact_quantiles
from riskweave.spec import FIRST_REAL, IV_FIRST_EDGES, MISSING_CODE, PSI_FIRST_EDGE, PSI_REAL_ABOVE, SENTINELS

EQUAL_FREQUENCY = 1
EQUAL_WIDTH = 2


def finish_edges(first: Sequence, lo, hi, n: int, method: int, nodes: Sequence) -> list[float]:
    """Sorted distinct edges from fixed first edges and quantile or equal-width nodes."""
    if method == EQUAL_FREQUENCY:
        inner = [*nodes, hi]
    elif method == EQUAL_WIDTH:
        inner = []
        if lo is not None and hi is not None:
            step = (hi - lo) / n
            inner = [lo + i * step for i in range(n)] + [max(lo + n * step, hi)]
    else:
        raise ValueError(f"unknown binning method {method}")
    return sorted({float(e) for e in (*first, *inner) if e is not None})


def iv_value(df: DataFrame, name: str) -> str:
    """SQL of the feature with every sentinel and NULL folded into one missing code."""
    col = double_sql(df, name)
    return f"CASE WHEN {col} NOT IN ({sql_list(SENTINELS)}) THEN {col} ELSE {MISSING_CODE!r}D END"


def small_distinct_counts(df: DataFrame, columns: Mapping[str, str], cap: int) -> dict[str, int]:
    """Distinct values per column (SQL text), exact below ``cap`` and at least ``cap`` above.

    A sketch sorts out the clearly larger columns; only the rest is counted
    exactly, where the values that reach the shuffle are few.
    """
    if not columns:
        return {}
    names = list(columns)
    rough = df.selectExpr(*[f"approx_count_distinct({columns[n]}) AS c{i}" for i, n in enumerate(names)]).first()
    near = [i for i in range(len(names)) if rough[i] <= 2 * cap + 20]
    counts = {n: max(cap, rough[i]) for i, n in enumerate(names) if i not in near}
    if near:
        parts = ", ".join(f"{i}, CAST({columns[names[i]]} AS STRING)" for i in near)
        flat = df.selectExpr(f"stack({len(near)}, {parts}) AS (i, v)").filter("v IS NOT NULL").distinct()
        exact = {r["i"]: r["count"] for r in flat.groupBy("i").count().collect()}
        counts.update({names[i]: exact.get(i, 0) for i in near})
    return counts


def iv_edges(df: DataFrame, features: Sequence[str], n_bins: int = 10, method: int = EQUAL_FREQUENCY) -> dict[str, list[float]]:
    """Edges for the information value: the first bin holds the missing rows."""
    value = {f: iv_value(df, f) for f in features}
    distinct = small_distinct_counts(df, value, n_bins)
    n_of = {f: max(1, min(n_bins, distinct[f])) for f in features}
    wanted = {}
    for f in features:
        probs = [k / n_of[f] for k in range(1, n_of[f])] if method == EQUAL_FREQUENCY else []
        wanted[f] = (f"CASE WHEN {value[f]} > {FIRST_REAL!r}D THEN {value[f]} END", probs)
    extra = [f"max({value[f]}) AS top_{i}" for i, f in enumerate(features)]
    extra += [f"min({wanted[f][0]}) AS low_{i}" for i, f in enumerate(features)]
    nodes, row = exact_quantiles(df, wanted, extra)
    return {
        f: finish_edges(IV_FIRST_EDGES, row[f"low_{i}"], row[f"top_{i}"], n_of[f], method, nodes[f])
        for i, f in enumerate(features)
    }


def psi_edges(
    df: DataFrame, features: Sequence[str], expected: str, n_bins: int = 10, method: int = EQUAL_FREQUENCY
) -> dict[str, list[float]]:
    """Edges for feature stability: range over all rows, quantiles of the ``expected`` rows (SQL test)."""
    value = {f: double_sql(df, f) for f in features}
    real = {f: f"{value[f]} > {PSI_REAL_ABOVE!r}D" for f in features}
    extra = [f"max({value[f]}) AS top_{i}" for i, f in enumerate(features)]
    extra += [f"min(CASE WHEN {real[f]} THEN {value[f]} END) AS low_{i}" for i, f in enumerate(features)]
    probs = [k / n_bins for k in range(1, n_bins)] if method == EQUAL_FREQUENCY else []
    # No value lies strictly between the bound and the smallest value above it,
    # so "above the bound" and "from the smallest value on" are the same rows.
    wanted = {f: (f"CASE WHEN {expected} AND {real[f]} THEN {value[f]} END", probs) for f in features}
    nodes, row = exact_quantiles(df, wanted, extra)
    edges = {}
    for i, f in enumerate(features):
        top = row[f"top_{i}"]
        hi = None if top is None else top + 0.1
        edges[f] = finish_edges((PSI_FIRST_EDGE, row[f"low_{i}"]), row[f"low_{i}"], hi, n_bins, method, nodes[f])
    return edges


def quantile_edges(df: DataFrame, columns: Mapping[str, str], n_bins: int = 10) -> dict[str, list[float]]:
    """Distinct quantiles 0, 1/n .. 1 of each column (SQL text)."""
    probs = [k / n_bins for k in range(n_bins + 1)]
    found, _ = exact_quantiles(df, {n: (c, probs) for n, c in columns.items()})
    return {n: sorted({v for v in found[n] if v is not None}) for n in columns}


def level_edges(df: DataFrame, column: str, n_bins: int = 10) -> list[float]:
    """Quantile edges for level tables, with the input checks a level table needs."""
    distinct = small_distinct_counts(df, {column: sql_name(column)}, n_bins + 1)[column]
    if distinct <= 1:
        raise ValueError(f"{column} has {distinct} distinct value(s); levels need more")
    if distinct < n_bins:
        raise ValueError(f"{column} has {distinct} distinct values, fewer than {n_bins} levels")
    return quantile_edges(df, {column: double_sql(df, column)}, n_bins)[column]


def widened_edges(edges: Sequence[float], ratio: float = 0.2) -> list[float]:
    """Both end edges moved outwards by a share of the whole span."""
    span = edges[-1] - edges[0]
    return [edges[0] - span * ratio, *edges[1:-1], edges[-1] + span * ratio]


def equal_width_bands(df: DataFrame, column: str, group: int = 11, first: float = 0.0, last: float = 1000.0) -> list[float]:
    """Equal-width score bands between the smallest score above -1 and the largest."""
    col = F.col(column)
    row = df.agg(F.max(col).alias("hi"), F.min(F.when(col > PSI_REAL_ABOVE, col)).alias("lo")).first()
    step = (row.hi - row.lo) / group
    edges = {round(row.lo - 0.0001, 4)} | {round(row.lo + step + i * step, 4) for i in range(group)}
    edges = sorted(edges)
    edges[0], edges[-1] = first, last
    return edges


def bin_by_points(df: DataFrame, column: str, points: Sequence[float], out: str = "bin_idx") -> DataFrame:
    """Right-closed bins between cut points with open ends."""
    return with_bin(df, column, with_infinite_ends(points), out, include_lowest=True)


def bin_by_edges(df: DataFrame, column: str, edges: Sequence[float], out: str = "bin_idx") -> DataFrame:
    """Right-closed bins between given edges, lowest edge included, no open ends."""
    return with_bin(df, column, edges, out, include_lowest=True)


def five_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Levels 1..5 by quintiles; a value on a quintile belongs to the higher level."""
    probs = [0.0, 0.2, 0.4, 0.6, 0.8]
    value = {c: double_sql(df, c) for c in columns}
    found, _ = exact_quantiles(df, {c: (value[c], probs) for c in columns})
    changes = {}
    for c in columns:
        steps = " + ".join(f"CAST({value[c]} >= {e!r}D AS INT)" for e in found[c] if e is not None) or "0"
        changes[c] = F.expr(f"CASE WHEN {value[c]} IS NOT NULL THEN {steps} END")
    return df.withColumns(changes) if changes else df


def discretise_continuous(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Five levels for columns with fractional values; text and whole numbers stay as they are."""
    kinds = dict(df.dtypes)
    maybe = [c for c in columns if kinds[c] in ("double", "float") or kinds[c].startswith("decimal")]
    if not maybe:
        return df
    tests = [f"coalesce(max({double_sql(df, c)} <> floor({double_sql(df, c)})), false) AS c{i}" for i, c in enumerate(maybe)]
    row = df.selectExpr(*tests).first()
    return five_levels(df, [c for i, c in enumerate(maybe) if row[i]])


def edges_table(spark, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    rows = [
        (f, i, float(lo), float(hi)) for f, es in edges.items() for i, (lo, hi) in enumerate(zip(es, es[1:]))
    ]
    return spark.createDataFrame(rows, "feature string, bin_idx int, lo double, hi double")


def bin_counts(
    df: DataFrame,
    values: Mapping[str, str],
    edges: Mapping[str, Sequence[float]],
    aggs: Sequence[Column],
    keep: Sequence[str],
    closed: str = "right",
    include_lowest: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per feature and non-empty bin with the given aggregates.

    The bin number is computed before the rows are unpivoted, and the counts
    combine before the shuffle, so what moves is features x bins per task.
    """
    binned = add_bins(
        df.selectExpr(*[sql_name(k) for k in keep], *[f"{v} AS {sql_name(f)}" for f, v in values.items()]),
        {f: sql_name(f) for f in values},
        edges,
        closed,
        include_lowest,
    )
    return (
        binned.unpivot(list(keep), [sql_name(f) for f in values], "feature", "bin_idx")
        .groupBy("feature", *by, "bin_idx")
        .agg(*aggs)
    )

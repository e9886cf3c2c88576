"""Bin search.

Scorecards need right-closed bins with values outside the edges dropped, while
``Bucketizer`` is left-closed. A right-closed edge ``e`` is the left-closed edge
at the next larger double, so one ``Bucketizer`` (a binary search on the JVM)
serves both. ``bin_index`` is the same search as a plain CASE column, for single
columns and for expressions that must not touch the DataFrame.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.cleaning import sql_name


def sql_double(value: float) -> str:
    if math.isinf(value):
        return "double('Infinity')" if value > 0 else "double('-Infinity')"
    return f"{float(value)!r}D"


def passed_tests(tests: Sequence[str]) -> str:
    """SQL for how many of the ordered tests hold (a true test implies all earlier ones)."""

    def node(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {tests[mid]} THEN {node(mid + 1, hi)} ELSE {node(lo, mid)} END"

    return node(0, len(tests))


def bin_index(name: str, edges: Sequence[float], closed: str = "right", include_lowest: bool = False) -> Column:
    """Zero-based bin of column ``name``; NULL for NULL input or outside the edges."""
    if len(edges) < 2:
        return F.lit(None).cast("int")
    col = f"`{name}`"
    op = ">" if closed == "right" else ">="
    tests = [f"{col} {op} {sql_double(e)}" for e in edges]
    if include_lowest and closed == "right":
        tests[0] = f"{col} >= {sql_double(edges[0])}"
    count = passed_tests(tests)
    return F.expr(
        f"CASE WHEN {col} IS NOT NULL THEN nullif(nullif({count}, 0), {len(edges)}) - 1 END"
    ).cast("int")


def with_infinite_ends(points: Sequence[float]) -> list[float]:
    """Cut points with open ends, unless the caller already gave an infinite one."""
    points = [float(p) for p in points]
    if math.inf in points:
        return points
    return [-math.inf, *points, math.inf]


def interval_label(edges: Sequence[float], closed: str = "right") -> list[str]:
    left, right = ("(", "]") if closed == "right" else ("[", ")")
    return [f"{left}{a:g}, {b:g}{right}" for a, b in zip(edges, edges[1:])]


def after(value: float) -> float:
    """Smallest double above ``value``, so ``x >= after(v)`` means ``x > v``."""
    return math.nextafter(float(value), math.inf) + 0.0


def _search(
    df: DataFrame, columns: Mapping[str, str], thresholds: Mapping[str, Sequence[float]], shown: Mapping[str, Sequence]
) -> DataFrame:
    """Replaces each named column by an entry of its ``shown`` list.

    The entry is chosen by how many thresholds the value reaches; the last entry
    stands for NULL. Looking the number up in a constant list keeps the whole
    result one short expression, which matters when filters on it are pushed down.
    """
    names = [n for n in columns if thresholds[n]]
    kept = [sql_name(c) for c in df.columns if c not in columns]
    source = df.selectExpr(
        *kept, *[f"coalesce({columns[n]}, double('NaN')) + 0.0D AS _x{i}" for i, n in enumerate(names)]
    )
    if names:
        splits = [[-math.inf, *[float(t) + 0.0 for t in thresholds[n]], math.inf] for n in names]
        source = Bucketizer(
            splitsArray=splits,
            inputCols=[f"_x{i}" for i in range(len(names))],
            outputCols=[f"_b{i}" for i in range(len(names))],
            handleInvalid="keep",
        ).transform(source)
    found = {}
    for i, n in enumerate(names):
        entries = ", ".join("CAST(NULL AS INT)" if v is None else str(v) for v in shown[n])
        found[n] = f"element_at(array({entries}), CAST(_b{i} AS INT) + 1)"
    return source.selectExpr(*kept, *[f"{found.get(n, 'CAST(NULL AS INT)')} AS {sql_name(n)}" for n in columns])


def count_reached(df: DataFrame, columns: Mapping[str, str], thresholds: Mapping[str, Sequence[float]]) -> DataFrame:
    """Replaces each named column by how many of its increasing thresholds it reaches.

    ``columns`` are SQL texts of doubles; NULL stays NULL. Columns of ``df`` that
    are not named are kept.
    """
    return _search(df, columns, thresholds, {n: [*range(len(thresholds[n]) + 1), None] for n in columns})


def add_bins(
    df: DataFrame,
    columns: Mapping[str, str],
    edges: Mapping[str, Sequence[float]],
    closed: str = "right",
    include_lowest: bool = False,
) -> DataFrame:
    """Replaces each named column (SQL text) by its zero-based bin, NULL outside the edges."""
    thresholds, shown = {}, {}
    for n in columns:
        cut = [after(e) if closed == "right" and not math.isinf(e) else float(e) for e in edges[n]]
        if include_lowest and cut:
            cut[0] = float(edges[n][0])
        # Bucketizer brings its own infinite ends.
        thresholds[n] = [c for c in cut if not math.isinf(c)]
        bins = max(len(cut) - 1, 0)
        below = [] if cut and math.isinf(cut[0]) else [None]
        above = [] if cut and math.isinf(cut[-1]) else [None]
        shown[n] = [*below, *range(bins), *above, None]
    return _search(df, columns, thresholds, shown)


def with_bin(
    df: DataFrame, column: str, edges: Sequence[float], out: str, closed: str = "right", include_lowest: bool = False
) -> DataFrame:
    """Adds the zero-based bin of one column, NULL outside the edges."""
    return add_bins(df, {out: f"CAST({sql_name(column)} AS DOUBLE)"}, {out: edges}, closed, include_lowest)

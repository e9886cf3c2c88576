"""Supervised bins: a small entropy tree per feature, exact whatever the number of values.

Spark ML trees cannot limit the number of leaves, so Spark builds a histogram of
each feature and the split search runs per feature on its cells. A feature with few
values has a cell per value; others begin with about a thousand cells of many values
each. The gain of a split is a convex function of the good and bad rows left of it, so
inside a cell it is nowhere above its value at the corners "all bad rows first" and "all
good rows first". Cells whose corner beats the best split between cells are opened: counted
again by finer cuts or by value. When no cell can hold a better split, the tree is
the one that a search over all distinct values finds, gains and ties included.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.bins import after, count_reached
from riskweave.functions.cleaning import sql_name
from riskweave.operators.binning import small_distinct_counts
from riskweave.session import write_stage

#: Cells a feature begins with, and pieces that an opened cell is cut into where a feature has more rows in its open cells than ``BY_VALUE_ROWS``. None changes a result.
MAX_CELLS = 1000
PIECES = 64
BY_VALUE_ROWS = 50_000
#: Thresholds that one pass over the rows searches.
PASS_THRESHOLDS = 50_000
#: No split gains less, and gains closer than this are taken for ties until the cells are open.
LEAST_GAIN, NEAR = 1e-12, 1e-12
#: Smallest distance of two values between which a tree splits (fixed value).
LEAST_STEP = 1e-7

_CELL = ("lo", "hi", "n", "bad", "sx")


def value_cells(df: DataFrame, values: Mapping[str, str], event: str, max_cells: int = MAX_CELLS) -> DataFrame:
    """Cells per feature in value order: range, rows, events and sum of values.

    A feature with at most ``max_cells`` distinct values gets one cell per
    value; others are cut at sketched quantiles.
    """
    names = list(values)
    distinct = small_distinct_counts(df, values, max_cells + 1)
    fine = [n for n in names if distinct[n] <= max_cells]
    coarse = [n for n in names if distinct[n] > max_cells]
    parts = []
    if fine:
        long = df.selectExpr(f"{event} AS _e", *[f"CAST({values[n]} AS DOUBLE) AS {sql_name(n)}" for n in fine])
        long = long.unpivot(["_e"], [sql_name(n) for n in fine], "feature", "x").filter("x IS NOT NULL")
        parts.append(_by_value(long))
    if coarse:
        probs = ", ".join(f"{k / max_cells!r}D" for k in range(1, max_cells))
        cuts = df.selectExpr(
            *[f"percentile_approx(CAST({values[n]} AS DOUBLE), array({probs}), {10 * max_cells}) AS c{i}" for i, n in enumerate(coarse)]
        ).first()
        thresholds = {n: sorted({after(c) for c in cuts[i]}) for i, n in enumerate(coarse)}
        parts += [_between(_placed(df, {n: values[n] for n in own}, event, thresholds)) for own in _batches(thresholds)]
    return functools.reduce(DataFrame.unionByName, parts)


def _batches(thresholds: Mapping[str, Sequence[float]]) -> list[list[str]]:
    """Features for one pass each, by how many thresholds a pass searches."""
    out, size = [[]], 0
    for f, points in thresholds.items():
        if out[-1] and size + len(points) > PASS_THRESHOLDS:
            out.append([])
            size = 0
        out[-1].append(f)
        size += len(points)
    return out


def _placed(df: DataFrame, values: Mapping[str, str], event: str, thresholds: Mapping[str, Sequence[float]]) -> DataFrame:
    """_e, feature, cell (thresholds reached), x of all known values."""
    names = list(values)
    base = df.selectExpr(f"{event} AS _e", *[f"CAST({values[n]} AS DOUBLE) AS v{i}" for i, n in enumerate(names)])
    placed = count_reached(base, {f"b{i}": f"v{i}" for i in range(len(names))}, {f"b{i}": thresholds[n] for i, n in enumerate(names)})
    quoted = [n.replace("\\", "\\\\").replace("'", "\\'") for n in names]
    rows = ", ".join(f"'{n}', b{i}, v{i}" for i, n in enumerate(quoted))
    return placed.selectExpr("_e", f"stack({len(names)}, {rows}) AS (feature, cell, x)").filter("x IS NOT NULL")


def _between(placed: DataFrame) -> DataFrame:
    return placed.groupBy("feature", "cell").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_e").cast("bigint")).alias("bad"), F.sum("x").alias("sx"),
    ).drop("cell")


def _by_value(long: DataFrame) -> DataFrame:
    return (
        long.groupBy("feature", "x").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_e").cast("bigint")).alias("bad"))
        .selectExpr("feature", "x AS lo", "x AS hi", "n", "bad", "x * n AS sx")
    )


def _weighted_entropy(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Entropy times weight."""
    total = good + bad
    with np.errstate(divide="ignore", invalid="ignore"):
        return -np.where(bad > 0, bad * np.log2(bad / total), 0.0) - np.where(good > 0, good * np.log2(good / total), 0.0)


class _Node:
    """A run of cells a..b-1: its best split between cells, and what a split inside each cell could gain at most."""

    def __init__(self, tree: _Search, a: int, b: int) -> None:
        self.a, self.b = a, b
        at = np.arange(a + 1, b)
        gain = tree.gains(a, b, tree.bad[at], tree.good[at])
        left, right = tree.rows[at] - tree.rows[a], tree.rows[b] - tree.rows[at]
        gain[(left < tree.min_leaf) | (right < tree.min_leaf) | (tree.lo[at] - tree.hi[at - 1] <= LEAST_STEP)] = -np.inf
        k = int(np.argmax(gain)) if len(gain) else 0
        self.gain, self.at = (float(gain[k]), int(at[k])) if len(gain) and gain[k] > LEAST_GAIN else (-np.inf, -1)
        cells = np.arange(a, b)
        inside = cells[tree.hi[cells] - tree.lo[cells] > LEAST_STEP]
        # Some row of the cell must be a possible place for a border.
        inside = inside[(tree.rows[inside + 1] - 1 - tree.rows[a] >= tree.min_leaf) & (tree.rows[b] - tree.rows[inside] - 1 >= tree.min_leaf)]
        self.inside = inside
        self.most = np.maximum(
            tree.gains(a, b, tree.bad[inside + 1], tree.good[inside]), tree.gains(a, b, tree.bad[inside], tree.good[inside + 1])
        )

    def may_beat(self, gain: float) -> np.ndarray:
        return self.inside[self.most >= max(gain - NEAR, LEAST_GAIN)]


class _Search:
    """Best-first search over cells. Sums are of whole numbers, so a split has the same gain however the cells around it are cut."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray, bad: np.ndarray, min_leaf: int, balanced: bool) -> None:
        self.lo, self.hi, self.min_leaf = lo, hi, min_leaf
        self.rows = np.concatenate(([0], np.cumsum(n.astype(np.int64))))
        events = np.concatenate(([0], np.cumsum(bad.astype(np.int64))))
        total, all_bad = int(self.rows[-1]), int(events[-1])
        self.splits = 0 < all_bad < total
        weigh = balanced and self.splits
        w_bad, w_good = (total / (2 * all_bad), total / (2 * (total - all_bad))) if weigh else (1.0, 1.0)
        self.bad, self.good = events * w_bad, (self.rows - events) * w_good
        self.weight = self.bad[-1] + self.good[-1]

    def gains(self, a: int, b: int, bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        """Gain of cutting a..b where so much bad and good weight lies before the cut, counted from the first cell."""
        whole = _weighted_entropy(np.array([self.good[b] - self.good[a]]), np.array([self.bad[b] - self.bad[a]]))[0]
        left = _weighted_entropy(good - self.good[a], bad - self.bad[a])
        right = _weighted_entropy(self.good[b] - good, self.bad[b] - bad)
        return (whole - left - right) / self.weight

    def grow(self, max_leaves: int) -> tuple[list[float], list[int]]:
        """(splits in the order in which they are made, cells to open before that is certain).

        Where a cell must be opened the search goes on with what is known, so that the
        cells near all later splits are asked for at the same time.
        """
        cuts: list[float] = []
        ask: set[int] = set()
        if max_leaves < 2 or not self.splits:
            return [], []
        nodes = [_Node(self, 0, len(self.lo))]
        while len(cuts) + 1 < max_leaves:
            best = min(nodes, key=lambda x: (-x.gain, x.a))
            for node in nodes:
                ask.update(node.may_beat(best.gain).tolist())
            if best.at < 0:
                break
            cuts.append(float((self.hi[best.at - 1] + self.lo[best.at]) / 2))
            nodes.remove(best)
            nodes += [_Node(self, best.a, best.at), _Node(self, best.at, best.b)]
        return cuts, sorted(ask)


def tree_cuts(
    lo: np.ndarray, hi: np.ndarray, n: np.ndarray, bad: np.ndarray, max_leaves: int, min_leaf: int, balanced: bool = True
) -> list[float]:
    """Split points, in order, of a best-first entropy tree over ordered cells, split between cells only."""
    return sorted(_Search(lo, hi, n, bad, min_leaf, balanced).grow(max_leaves)[0])


def rank_correlation(x: np.ndarray, y: np.ndarray) -> float:
    """Spearman correlation of a few points; NaN when a side is constant."""
    rx, ry = pd.Series(x).rank().to_numpy(), pd.Series(y).rank().to_numpy()
    if len(rx) < 2 or rx.std() == 0 or ry.std() == 0:
        return float("nan")
    return float(np.corrcoef(rx, ry)[0, 1])


def bin_means(edges: Sequence[float], x: np.ndarray, n: np.ndarray, bad: np.ndarray, sx: np.ndarray):
    """Mean value and bad rate of the non-empty right-closed bins over ordered cells."""
    place = np.searchsorted(np.asarray(edges[1:-1]), x, side="left")
    rows = np.bincount(place, weights=n, minlength=len(edges) - 1)
    full = rows > 0
    mean_x = np.bincount(place, weights=sx, minlength=len(edges) - 1)[full] / rows[full]
    mean_y = np.bincount(place, weights=bad, minlength=len(edges) - 1)[full] / rows[full]
    return mean_x, mean_y


def monotone_edges(edges_for, max_bins: int, monotonic: bool, threshold: float, cells) -> list[float]:
    """Edges with one bin fewer each time until bin means and bad rates rank alike."""
    if not monotonic:
        return edges_for(max_bins)
    edges, r, k = [], 0.0, max_bins
    while abs(r) < threshold and k > 1:
        edges = edges_for(k)
        r = rank_correlation(*bin_means(edges, *cells)) if len(edges) > 1 else float("nan")
        k -= 1
    return edges


def _opened(rows: DataFrame, names: Sequence[str], asked: Mapping[str, Sequence[tuple[float, float, int]]]) -> DataFrame:
    """The asked cells (lo, hi, rows; in order) of each feature, by value or in pieces cut at sketched quantiles."""
    spark = rows.sparkSession

    def within(points: Mapping[str, list[float]]) -> DataFrame:
        """_e, feature, cell, x of the values inside asked cells; cells are those between the points."""
        held = []
        for f, own in points.items():
            lows, highs = (np.array([c[k] for c in asked[f]]) for k in (0, 1))
            at = np.searchsorted(lows, own, side="right") - 1
            held += [(f, k + 1) for k, (p, i) in enumerate(zip(own, at, strict=True)) if i >= 0 and p <= highs[i]]
        cells = F.broadcast(spark.createDataFrame(held, "feature string, cell int"))  # the points of one pass, at most
        parts = [_placed(rows, {f: sql_name(f"x{names.index(f)}") for f in own}, "_e", points).join(cells, ["feature", "cell"]) for own in _batches(points)]
        return functools.reduce(DataFrame.unionByName, parts)

    ends = {f: sorted({p for lo, hi, _ in cells for p in (lo, after(hi))}) for f, cells in asked.items()}
    by_value = {f: p for f, p in ends.items() if sum(c[2] for c in asked[f]) <= BY_VALUE_ROWS}
    in_pieces = {f: p for f, p in ends.items() if f not in by_value}
    parts = []
    if by_value:
        parts.append(_by_value(within(by_value)))
    if in_pieces:
        probs = F.array(*[F.lit(k / PIECES) for k in range(1, PIECES)])
        cuts = within(in_pieces).groupBy("feature", "cell").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.percentile_approx("x", probs, 10 * PIECES).alias("cuts"))
        points = {f: set(p) for f, p in in_pieces.items()}
        for r in cuts.collect():  # asked cells x pieces
            # Below and above a value at a quantile, so that one which fills a cell comes to stand alone.
            points[r.feature].update(p for c in r.cuts for p in (c, after(c)) if r.lo < p <= r.hi)
        parts.append(_between(within({f: sorted(p) for f, p in points.items()})))
    return functools.reduce(DataFrame.unionByName, parts)


def tree_edges(
    df: DataFrame, values: Mapping[str, str], event: str, n_rows: int, max_bins: int = 10, min_share: float = 0.05, balanced: bool = True,
    monotonic: bool = True, threshold_cor: float = 0.1, max_cells: int = MAX_CELLS,
) -> dict[str, list[float]]:
    """Edges per feature (SQL text of a double): tree splits plus the smallest and largest value."""
    min_leaf = max(int(n_rows * min_share), 1)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lo")
        lo, hi, sx = (pdf[c].to_numpy(dtype=float) for c in ("lo", "hi", "sx"))
        n, bad = pdf["n"].to_numpy(), pdf["bad"].to_numpy()
        # A smaller tree is the beginning of a larger one.
        cuts, ask = _Search(lo, hi, n, bad, min_leaf, balanced).grow(max_bins)
        if ask:
            return pd.DataFrame({"feature": pdf["feature"].iloc[0], "edge": np.nan, "lo": lo[ask], "hi": hi[ask], "n": n[ask]})

        def edges_for(k):
            return sorted({lo[0], hi[-1], *cuts[: k - 1]})

        edges = monotone_edges(edges_for, max_bins, monotonic, threshold_cor, (hi, n.astype(float), bad.astype(float), sx))
        return pd.DataFrame({"feature": pdf["feature"].iloc[0], "edge": edges, "lo": np.nan, "hi": np.nan, "n": 0})

    names, found = list(values), {}
    rows, cells = None, write_stage(value_cells(df, values, event, max_cells).select("feature", *_CELL), "tree-cells")
    while True:
        asked: dict[str, list[tuple[float, float, int]]] = {}
        for r in cells.groupBy("feature").applyInPandas(search, "feature string, edge double, lo double, hi double, n long").collect():
            if r.n:
                asked.setdefault(r.feature, []).append((r.lo, r.hi, r.n))
            else:
                found.setdefault(r.feature, []).append(r.edge)
        if not asked:
            return {f: sorted(e) for f, e in found.items()}
        if rows is None:
            rows = write_stage(df.selectExpr(f"{event} AS _e", *[f"CAST({values[n]} AS DOUBLE) AS x{i}" for i, n in enumerate(names)]), "tree-rows")
        asked = {f: sorted(c) for f, c in asked.items()}
        gone = rows.sparkSession.createDataFrame([(f, lo) for f, c in asked.items() for lo, _, _ in c], "feature string, lo double")
        kept = cells.where(F.col("feature").isin(list(asked))).join(gone, ["feature", "lo"], "left_anti")
        cells = write_stage(kept.select("feature", *_CELL).unionByName(_opened(rows, names, asked).select("feature", *_CELL)), "tree-cells")


def thresholds_table(spark, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Inner split points per feature."""
    rows = [(f, i, float(e)) for f, es in edges.items() for i, e in enumerate(es[1:-1])]
    return spark.createDataFrame(rows, "feature string, idx int, threshold double")

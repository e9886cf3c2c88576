from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from riskweave.functions.bins import add_bins, bin_index, with_bin, with_infinite_ends
from riskweave.operators import binning, treebins

VALUES = [-10000.0, -9999.5, -9999.0, -1.0, -0.0, 0.0, 0.5, 100.0, 100.1, None]
EDGES = [-10000.0, -9999.0, 0.0, 100.0]


def frame(spark, values, name="x"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} double")


def cut(values, edges, **kw):
    codes = pd.cut(pd.Series(values, dtype=float), edges, labels=False, **kw)
    return [None if pd.isna(c) else int(c) for c in codes]


@pytest.mark.parametrize("closed,lowest", [("right", False), ("right", True), ("left", False)])
def test_bins_close_like_pandas(spark, closed, lowest):
    df = frame(spark, VALUES)
    want = cut(VALUES, EDGES, right=closed == "right", include_lowest=lowest)
    by_search = [r.b for r in with_bin(df, "x", EDGES, "b", closed, lowest).orderBy("i").collect()]
    by_case = [r.b for r in df.select("i", bin_index("x", EDGES, closed, lowest).alias("b")).orderBy("i").collect()]
    assert by_search == want
    assert by_case == want


def test_infinite_ends(spark):
    edges = with_infinite_ends([0.0, 10.0])
    got = [r.b for r in with_bin(frame(spark, [-5.0, 0.0, 0.1, 10.0, 11.0, None]), "x", edges, "b", include_lowest=True).orderBy("i").collect()]
    assert got == [0, 0, 1, 1, 2, None]
    assert with_infinite_ends([0.0, math.inf]) == [0.0, math.inf]


def test_several_columns_and_empty_edges(spark):
    df = frame(spark, [1.0, 5.0, None]).selectExpr("i", "x", "x * 2 AS y")
    got = add_bins(df, {"x": "x", "y": "y"}, {"x": [0.0, 2.0, 6.0], "y": []}).orderBy("i").collect()
    assert [(r.i, r.x, r.y) for r in got] == [(0, 0, None), (1, 1, None), (2, None, None)]


def test_level_edges_check_their_input(spark):
    with pytest.raises(ValueError):
        binning.level_edges(frame(spark, [1.0] * 30), "x")
    with pytest.raises(ValueError):
        binning.level_edges(frame(spark, [1.0, 2.0, 3.0] * 10), "x")


def test_quintile_levels_later_bin_wins(spark):
    values = [float(v) for v in range(1, 11)] + [None]
    got = [r.x for r in binning.five_levels(frame(spark, values), ["x"]).orderBy("i").collect()]
    points = np.percentile(values[:-1], [0, 20, 40, 60, 80])
    assert got == [int((v >= points).sum()) for v in values[:-1]] + [None]


def best_tree_gain(x, y, cut_at):
    def entropy(v):
        if len(v) == 0 or v.min() == v.max():
            return 0.0
        p = v.mean()
        return -(p * math.log2(p) + (1 - p) * math.log2(1 - p))

    left, right = y[x <= cut_at], y[x > cut_at]
    return entropy(y) - (len(left) * entropy(left) + len(right) * entropy(right)) / len(y)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.booleans()), min_size=20, max_size=60))
def test_first_tree_split_is_the_best_one(pairs):
    x = np.array([p[0] for p in pairs], dtype=float)
    y = np.array([int(p[1]) for p in pairs])
    table = pd.DataFrame({"x": x, "y": y}).groupby("x").y.agg(["size", "sum"]).reset_index()
    values = table.x.to_numpy()
    cuts = treebins.tree_cuts(values, values, table["size"].to_numpy(), table["sum"].to_numpy(), 2, 3, balanced=False)
    allowed = [(a + b) / 2 for a, b in zip(values, values[1:]) if min((x <= a).sum(), (x > a).sum()) >= 3]
    gains = {c: best_tree_gain(x, y, c) for c in allowed}
    if not cuts:
        assert not gains or max(gains.values()) < 1e-9
    else:
        assert gains[cuts[0]] == pytest.approx(max(gains.values()))


def test_tree_edges_respect_leaf_count_and_size(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=3000)
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "_event": y}))
    edges = treebins.tree_edges(df, {"x": "x"}, "_event", 3000, max_bins=6, min_share=0.05)["x"]
    assert 2 < len(edges) <= 7
    counts = np.histogram(x, edges)[0]
    assert counts.min() >= 150
    assert edges[0] == x.min() and edges[-1] == x.max()


def plain_tree(x, y, leaves, min_leaf, balanced):
    """A best-first tree over all distinct values, from counts of whole numbers; ties go to the smaller value."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    values, first = np.unique(x, return_index=True)
    upto = np.append(first, len(x))
    events = np.concatenate(([0], np.cumsum(y)))[upto]
    n, bad = len(x), int(y.sum())
    wb, wg = (n / (2 * bad), n / (2 * (n - bad))) if balanced else (1.0, 1.0)
    b, g = events * wb, (upto - events) * wg

    def h(good, evil):
        total = good + evil
        with np.errstate(divide="ignore", invalid="ignore"):
            return -np.where(evil > 0, evil * np.log2(evil / total), 0.0) - np.where(good > 0, good * np.log2(good / total), 0.0)

    def best(lo, hi):
        at = np.arange(lo + 1, hi)
        at = at[(upto[at] - upto[lo] >= min_leaf) & (upto[hi] - upto[at] >= min_leaf) & (values[at] - values[at - 1] > 1e-7)]
        if not len(at):
            return None
        whole = h(np.array([g[hi] - g[lo]]), np.array([b[hi] - b[lo]]))[0]
        gain = (whole - h(g[at] - g[lo], b[at] - b[lo]) - h(g[hi] - g[at], b[hi] - b[at])) / (b[-1] + g[-1])
        k = int(np.argmax(gain))
        return (gain[k], int(at[k])) if gain[k] > 1e-12 else None

    nodes, cuts = {(0, len(values)): best(0, len(values))}, []
    while len(cuts) + 1 < leaves:
        open_ = {k: v for k, v in nodes.items() if v}
        if not open_:
            break
        (lo, hi), (_, at) = min(open_.items(), key=lambda kv: (-kv[1][0], kv[0][0]))
        cuts.append((values[at - 1] + values[at]) / 2)
        del nodes[lo, hi]
        nodes[lo, at], nodes[at, hi] = best(lo, at), best(at, hi)
    return sorted({values[0], values[-1], *cuts})


@pytest.mark.parametrize("n, distinct, balanced, by_value", [(4000, 1001, True, 50_000), (30000, 20000, False, 300), (120000, 100000, True, 2000), (60000, 60000, True, 0)])
def test_tree_is_exact_beyond_the_first_cells(spark, monkeypatch, n, distinct, balanced, by_value):
    monkeypatch.setattr(treebins, "BY_VALUE_ROWS", by_value)
    monkeypatch.setattr(treebins, "PASS_THRESHOLDS", 2500)
    rng = np.random.default_rng(n)
    x = np.round(rng.integers(0, distinct, n) / 7, 4)
    p = 0.1 + 0.3 * (np.sin(x / distinct * 40) > 0.3) + 0.2 * (x > distinct / 12)
    y = (rng.random(n) < p).astype(int)
    z = np.where(rng.random(n) < 0.6, 5.0, rng.normal(size=n) * 10)  # one value fills many cells
    flat = rng.normal(size=n)  # nothing to find but noise
    gaps = rng.integers(0, 3000, n) * 4e-8 + (rng.random(n) < 0.5)  # steps too small to split
    df = spark.createDataFrame(pd.DataFrame({"x": x, "z": z, "flat": flat, "gaps": gaps, "_event": y})).repartition(6)
    got = treebins.tree_edges(df, {c: c for c in ("x", "z", "flat", "gaps")}, "_event", n, max_bins=8, min_share=0.03, balanced=balanced, monotonic=False)
    for name, values in (("x", x), ("z", z), ("flat", flat), ("gaps", gaps)):
        assert got[name] == plain_tree(values, y, 8, int(n * 0.03), balanced), name


@pytest.mark.parametrize("cells", [3, 20, 1000])
def test_tree_does_not_depend_on_the_first_cells(spark, cells):
    rng = np.random.default_rng(8)
    x, y = rng.integers(0, 400, 3000).astype(float), rng.integers(0, 2, 3000)
    df = spark.createDataFrame(pd.DataFrame({"x": np.where(x < 20, np.nan, x), "e": y, "none": np.nan, "same": 1.0})).selectExpr("nanvl(x, NULL) AS x", "e", "CAST(NULL AS DOUBLE) AS none", "same")
    got = treebins.tree_edges(df, {"x": "x", "none": "none", "same": "same"}, "e", 3000, max_bins=6, min_share=0.02, monotonic=False, max_cells=cells)
    assert got == {"x": plain_tree(x[x >= 20], y[x >= 20], 6, 60, True), "same": [1.0]}


def test_monotone_loop_drops_bins_until_ranks_agree():
    x = np.arange(6, dtype=float)
    n = np.full(6, 10.0)
    bad = np.array([5.0, 1.0, 1.0, 1.0, 1.0, 5.0])
    tried = []

    def edges_for(k):
        tried.append(k)
        return [0.0, 1.0, 2.0, 3.0, 4.0, 5.0] if k > 2 else [0.0, 2.0, 5.0]

    treebins.monotone_edges(edges_for, 4, True, 0.9, (x, n, bad, x * n))
    assert tried == [4, 3, 2]

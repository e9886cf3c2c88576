"""Profiles of features against the target, and the columns recoded from them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.bins import add_bins, sql_double
from riskweave.functions.cleaning import double_sql, sql_name
from riskweave.functions.scores import woe_capped
from riskweave.operators.binning import small_distinct_counts
from riskweave.operators.profile import _per_feature, rate_sql
from riskweave.operators.quantiles import exact_quantiles
from riskweave.operators.treebins import bin_means, monotone_edges, tree_cuts, tree_edges

MISSING_GROUP = "_MISSING_"
TOTAL_GROUP = "TOTAL"
MAX_MISSING = 0.99
MAX_CATEGORIES = 200
# Names of the transforms in the order ties are decided.
TRANSFORMS = ("origin", "square", "sqrt", "log")
TRANSFORM_PREFIX = {"square": "sq_", "sqrt": "sr_", "log": "log_"}


@dataclass
class ContinuousProfile:
    """Edges, bin rows, statistics and settings of profiled numeric features."""

    table: DataFrame
    statistics: DataFrame
    edges: dict[str, list[float]]
    woe: dict[str, dict[int | None, float]] = field(default_factory=dict)
    bounds: dict[str, dict] = field(default_factory=dict)


def transform_sql(value: str, name: str) -> str:
    return {
        "origin": value,
        "square": f"({value}) * ({value})",
        "sqrt": f"sqrt(greatest({value}, 0.0D))",
        "log": f"ln(greatest({value}, 0.00001D))",
    }[name]


def event_column(df: DataFrame, label: str, event=1) -> tuple[DataFrame, bool]:
    """Adds a 0/1 ``_event``; a target with more than two values is cut at its median.

    Returns the rows with a known target and whether the target was binary.
    """
    rows = df.filter(F.col(label).isNotNull())
    ends = rows.agg(F.min(label).alias("lo"), F.max(label).alias("hi")).first()
    between = rows.filter((F.col(label) != ends.lo) & (F.col(label) != ends.hi)).limit(1).count()
    if not between:
        return rows.withColumn("_event", (F.col(label) == event).cast("int")), True
    median = exact_quantiles(rows, {"y": (double_sql(rows, label), [0.5])})[0]["y"][0]
    return rows.withColumn("_event", (F.col(label) >= median).cast("int")), False


def usable_numeric(df: DataFrame, features: Sequence[str], max_missing_rate: float = MAX_MISSING) -> list[str]:
    """Features that are not nearly all missing and have more than one value."""
    value = {f: double_sql(df, f) for f in features}
    row = df.selectExpr(
        *[f"{rate_sql(f'{value[f]} IS NULL')} AS m{i}" for i, f in enumerate(features)],
        *[f"min({value[f]}) < max({value[f]}) AS d{i}" for i, f in enumerate(features)],
    ).first()
    return [f for i, f in enumerate(features) if row[f"m{i}"] <= max_missing_rate and row[f"d{i}"]]


def _quantile_profile_edges(rows, features, max_bins, monotonic, threshold_cor) -> dict[str, list[float]]:
    value = {f: double_sql(rows, f) for f in features}
    sizes = range(max_bins, 1, -1) if monotonic else (max_bins,)
    probs = sorted({i / k for k in sizes for i in range(k + 1)})
    found, _ = exact_quantiles(rows, {f: (value[f], probs) for f in features})
    at = {f: dict(zip(probs, found[f])) for f in features}

    def edges_of(f, k):
        return sorted({at[f][i / k] for i in range(k + 1)})

    if not monotonic:
        return {f: edges_of(f, max_bins) for f in features}
    # All candidate edges together cut a feature into fine cells; every
    # candidate bin is a union of such cells, so one pass serves the whole loop.
    union_edges = {f: sorted(set(found[f])) for f in features}
    binned = add_bins(
        rows.selectExpr("_event", *[f"{value[f]} AS {sql_name(f)}" for f in features], *[f"{value[f]} AS _v{i}" for i, f in enumerate(features)]),
        {f: sql_name(f) for f in features}, union_edges, include_lowest=True,
    )
    parts = ", ".join(f"'{f}', {sql_name(f)}, _v{i}" for i, f in enumerate(features))
    cells = (
        binned.selectExpr("_event", f"stack({len(features)}, {parts}) AS (feature, cell, x)")
        .filter("cell IS NOT NULL").groupBy("feature", "cell")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_event").cast("bigint")).alias("bad"), F.sum("x").alias("sx"), F.max("x").alias("hi"))
        .toPandas()
    )
    out = {}
    for f in features:
        mine = cells[cells.feature == f].sort_values("cell")
        arrays = tuple(mine[c].to_numpy(dtype=float) for c in ("hi", "n", "bad", "sx"))
        out[f] = monotone_edges(lambda k, f=f: edges_of(f, k), max_bins, True, threshold_cor, arrays)
    return out


def profile_edges(
    rows: DataFrame, features: Sequence[str], max_bins: int = 10, tree: bool = True, monotonic: bool = True,
    min_share: float = 0.05, threshold_cor: float = 0.1, balanced: bool = True,
) -> dict[str, list[float]]:
    if not tree:
        return _quantile_profile_edges(rows, features, max_bins, monotonic, threshold_cor)
    return tree_edges(rows, {f: double_sql(rows, f) for f in features}, "_event", rows.count(), max_bins, min_share, balanced, monotonic, threshold_cor)


def _profile_rows(rows: DataFrame, features: Sequence[str], edges: dict) -> DataFrame:
    """Bin rows with a missing group, and a TOTAL row per feature."""
    value = {f: double_sql(rows, f) for f in features}
    binned = add_bins(
        rows.selectExpr("_event", *[f"{value[f]} AS {sql_name(f)}" for f in features], *[f"{value[f]} AS _v{i}" for i, f in enumerate(features)]),
        {f: sql_name(f) for f in features}, edges, include_lowest=True,
    )
    parts = ", ".join(f"'{f}', {sql_name(f)}, _v{i}" for i, f in enumerate(features))
    long = binned.selectExpr("_event", f"stack({len(features)}, {parts}) AS (variable, bin_idx, x)")
    # Bins and totals combine in the same pass.
    sets = long.groupingSets([["variable", "bin_idx"], ["variable"]], "variable", "bin_idx").agg(
        F.grouping("bin_idx").alias("_total"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.count(F.lit(1)).alias("count"), F.sum(F.col("_event").cast("bigint")).alias("depvar_n"),
    )
    return sets


def _with_rates(bins: DataFrame, totals) -> DataFrame:
    """Shares, rates, lift, WOE and IV from bin rows (a dozen per feature)."""
    n, events = float(totals.n), float(totals.events)
    share = (F.col("depvar_n") / F.lit(events), (F.col("count") - F.col("depvar_n")) / F.lit(n - events))
    total = F.col("_total") == 1
    rated = bins.select(
        "*",
        (F.col("count") / F.lit(n)).alias("proportion"),
        (F.col("depvar_n") / F.col("count")).alias("depvar_rate"),
        (F.col("depvar_n") / F.col("count") * 100 / F.lit(events / n)).alias("lift"),
        F.when(~total, woe_capped(*share)).alias("woe"),
        F.when(~total, (share[0] - share[1]) * woe_capped(*share)).alias("_part"),
    )
    iv = rated.groupBy("variable").agg(F.sum("_part").alias("iv"))
    return rated.join(iv, "variable").drop("_part")


def robust_bounds(df: DataFrame, features: Sequence[str]) -> dict[str, dict]:
    """Cap and floor per feature from five percentiles and the range."""
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    found, _ = exact_quantiles(df, {f: (double_sql(df, f), probs) for f in features})
    out = {}
    for f in features:
        lo, p1, p25, median, p75, p99, hi = found[f]
        iqr = max(p75 - p25, p99 - p75, p25 - p1)
        upper = max(min(p75 + 1.5 * iqr, hi), p99)
        lower = min(max(p25 - 1.5 * iqr, lo), p1)
        if upper == lower:
            upper, lower = hi, lo
        out[f] = {"min": lo, "max": hi, "median": median, "upperbound": upper, "lowerbound": lower, "midrange": (hi + lo) / 2}
    return out


def bounds_table(spark: SparkSession, bounds: dict[str, dict]) -> DataFrame:
    rows = [(f, b["median"], b["min"], b["max"], b["upperbound"], b["lowerbound"], b["midrange"]) for f, b in bounds.items()]
    return spark.createDataFrame(
        rows, "variable string, median double, min double, max double, upperbound double, lowerbound double, midrange double"
    )


def best_transforms(rows: DataFrame, features: Sequence[str], target: str = "_event") -> dict[str, dict]:
    """Transform with the strongest linear relation to the target, with its moments.

    The smallest F-test p-value belongs to the largest absolute correlation, so
    one aggregate over all features and transforms decides.
    """
    # One long row per feature value keeps the number of aggregates independent
    # of the number of features.
    parts = ", ".join(f"{i}, {double_sql(rows, f)}" for i, f in enumerate(features))
    long = rows.selectExpr(f"CAST({target} AS DOUBLE) AS y", f"stack({len(features)}, {parts}) AS (i, x)")
    known = long.selectExpr(
        "i", "y", "x", *[f"CASE WHEN x IS NOT NULL THEN {transform_sql('x', t)} END AS t{j}" for j, t in enumerate(TRANSFORMS)]
    )
    aggs = [
        F.expr("avg(CASE WHEN x IS NULL THEN 1.0D ELSE 0.0D END) AS miss"), F.expr("avg(x) AS mean"),
        F.expr("avg(CASE WHEN x IS NULL THEN y END) AS rate"), F.expr("avg(CASE WHEN x IS NOT NULL THEN y END) AS my"),
        F.expr("count(x) AS n"),
    ]
    for j in range(len(TRANSFORMS)):
        aggs += [F.expr(f"{fn}(y, t{j}) AS {fn[5:]}{j}") for fn in ("regr_sxy", "regr_sxx", "regr_syy")]
        aggs.append(F.expr(f"avg(t{j}) AS mx{j}"))
    out = {}
    for row in known.groupBy("i").agg(*aggs).collect():
        def strength(j):
            sxx, syy, sxy = (row[f"{k}{j}"] for k in ("sxx", "syy", "sxy"))
            return abs(sxy) / math.sqrt(sxx * syy) if sxx and syy and sxx > 0 and syy > 0 else -1.0

        best = max(range(len(TRANSFORMS)), key=lambda j: (round(strength(j), 12), -j))
        out[features[row.i]] = {
            "missingrate": row.miss, "mean": row.mean, "missing_target": row.rate, "besttrans": TRANSFORMS[best],
            "sxy": row[f"sxy{best}"], "sxx": row[f"sxx{best}"], "mean_x": row[f"mx{best}"], "mean_y": row.my, "n": row.n,
        }
    return out


def univariate_logits(rows: DataFrame, chosen: dict[str, dict], max_iter: int = 25, tol: float = 1e-10) -> dict[str, tuple[float, float]]:
    """Intercept and slope of one small logistic model per feature, fitted together.

    Newton steps share one aggregate per iteration over all features. The slope
    carries a unit ridge penalty, the intercept none.
    """
    state = {}
    for f, c in chosen.items():
        sd = math.sqrt(c["sxx"] / c["n"]) if c["n"] and c["sxx"] and c["sxx"] > 0 else 1.0
        rate = min(max(c["mean_y"], 1e-6), 1 - 1e-6)
        state[f] = {"a": math.log(rate / (1 - rate)), "b": 0.0, "mean": c["mean_x"], "sd": sd, "done": False}
    for _ in range(max_iter):
        todo = [f for f in state if not state[f]["done"]]
        if not todo:
            break
        aggs = []
        for i, f in enumerate(todo):
            s, v = state[f], double_sql(rows, f)
            z = f"(({transform_sql(v, chosen[f]['besttrans'])}) - {sql_double(s['mean'])}) / {sql_double(s['sd'])}"
            z = f"CASE WHEN {v} IS NOT NULL THEN {z} END"
            p = f"1.0D / (1.0D + exp(-({sql_double(s['a'])} + {sql_double(s['b'])} * ({z}))))"
            w = f"({p}) * (1.0D - ({p}))"
            aggs += [
                f"sum(_event - ({p})) AS g0_{i}", f"sum((_event - ({p})) * ({z})) AS g1_{i}", f"sum({w}) AS h00_{i}",
                f"sum({w} * ({z})) AS h01_{i}", f"sum({w} * ({z}) * ({z})) AS h11_{i}",
            ]
        row = rows.selectExpr(*aggs).first()
        for i, f in enumerate(todo):
            s = state[f]
            ridge = 1.0 / s["sd"] ** 2
            g = np.array([row[f"g0_{i}"], row[f"g1_{i}"] - ridge * s["b"]])
            h = np.array([[row[f"h00_{i}"], row[f"h01_{i}"]], [row[f"h01_{i}"], row[f"h11_{i}"] + ridge]])
            step = np.linalg.lstsq(h, g, rcond=None)[0]
            step = np.clip(step, -5.0, 5.0)
            s["a"] += float(step[0])
            s["b"] += float(step[1])
            s["done"] = bool(np.abs(step).max() < tol)
    return {f: (s["a"] - s["b"] * s["mean"] / s["sd"], s["b"] / s["sd"]) for f, s in state.items()}


def _solve_for_value(target: float, a: float, b: float, transform: str) -> float | None:
    if b == 0 or not math.isfinite(a) or not math.isfinite(b):
        return None
    t = (target - a) / b
    if transform == "square":
        return math.sqrt(max(t, 0.0))
    if transform == "sqrt":
        return t * t
    if transform == "log":
        return math.exp(min(t, 700.0))
    return t


def imputed_values(rows: DataFrame, features: Sequence[str], bounds: dict, chosen: dict, binary: bool, target: str) -> dict[str, float]:
    """Value at which the one-feature model reaches the missing group's event rate."""
    missing = [f for f in features if chosen[f]["missingrate"] > 0]
    out = {f: bounds[f]["median"] for f in features}
    logits = univariate_logits(rows, {f: chosen[f] for f in missing}) if binary and missing else {}
    for f in missing:
        c = chosen[f]
        if binary:
            rate = max(min(c["missing_target"], 0.99999), 0.00001)
            value = _solve_for_value(math.log(rate / (1 - rate)), *logits[f], c["besttrans"])
        else:
            slope = c["sxy"] / c["sxx"] if c["sxx"] else 0.0
            value = _solve_for_value(c["missing_target"], c["mean_y"] - slope * c["mean_x"], slope, c["besttrans"])
        out[f] = bounds[f]["median"] if value is None or value != value else value
    return {f: min(max(out[f], bounds[f]["lowerbound"]), bounds[f]["upperbound"]) for f in features}


def continuous_profile(
    df: DataFrame, features: Sequence[str], label: str = "label", event=1, max_missing_rate: float = MAX_MISSING,
    max_bins: int = 10, tree: bool = True, monotonic: bool = True, min_share: float = 0.05, threshold_cor: float = 0.1,
    balanced: bool = True,
) -> ContinuousProfile:
    """Bin table, statistics and recoding settings of all usable numeric features.

    Every step handles all features in one pass over the rows.
    """
    rows, binary = event_column(df, label, event)
    rows = rows.select("_event", label, *features)
    used = usable_numeric(rows, features, max_missing_rate)
    if not used:
        raise ValueError("no usable numeric feature")
    edges = profile_edges(rows, used, max_bins, tree, monotonic, min_share, threshold_cor, balanced)
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_event").alias("events")).first()
    spark = df.sparkSession
    bins = _with_rates(_profile_rows(rows, used, edges), totals)
    bounds_rows = [
        (f, i, f"{'[' if i == 0 else '('}{a:g}, {b:g}]") for f in used for i, (a, b) in enumerate(zip(edges[f], edges[f][1:]))
    ]
    labels = spark.createDataFrame(bounds_rows, "variable string, bin_idx int, _group string")
    group = F.when(F.col("_total") == 1, TOTAL_GROUP).when(F.col("bin_idx").isNull(), MISSING_GROUP).otherwise(F.col("_group"))
    # At most a dozen label rows per feature.
    table = bins.join(F.broadcast(labels), ["variable", "bin_idx"], "left").select(
        "iv", "variable", group.alias("group"), "bin_idx",
        F.when(F.col("_total") == 0, F.col("min")).alias("min"), F.when(F.col("_total") == 0, F.col("max")).alias("max"),
        "count", "proportion", "depvar_n", "depvar_rate", "lift", "woe",
    )
    # The finished table is short; keeping its rows spares a second pass over the samples.
    collected = table.collect()
    table = spark.createDataFrame(collected, table.schema)
    woe: dict[str, dict] = {f: {} for f in used}
    iv = {}
    for r in collected:
        iv[r.variable] = r.iv
        if r.group != TOTAL_GROUP:
            woe[r.variable][r.bin_idx] = r.woe
    bounds = robust_bounds(rows, used)
    chosen = best_transforms(rows, used, "_event" if binary else sql_name(label))
    imputed = imputed_values(rows, used, bounds, chosen, binary, label)
    for f in used:
        bounds[f].update(chosen[f], erimpute=imputed[f], iv=iv.get(f))
    stats = [
        (f, b["missingrate"], b["mean"], b["median"], b["min"], b["max"], b["upperbound"], b["lowerbound"], b["midrange"],
         b["besttrans"], b["erimpute"], b["iv"]) for f, b in bounds.items()
    ]
    statistics = spark.createDataFrame(
        stats,
        "variable string, missingrate double, mean double, median double, min double, max double, upperbound double, "
        "lowerbound double, midrange double, besttrans string, erimpute double, iv double",
    ).orderBy(F.desc("iv"), "variable")
    order = [F.desc("iv"), F.col("variable"), (F.col("group") != TOTAL_GROUP), F.col("min").asc_nulls_last()]
    return ContinuousProfile(table.drop("bin_idx").orderBy(*order), statistics, edges, woe, bounds)


def continuous_recoding(profile: ContinuousProfile, prefix: str = "r_", standard: bool = True, woe: bool = True) -> list[list[tuple[str, Column]]]:
    """Recoding steps as lists of (name, column); later steps use columns of earlier ones."""
    first, second, third = [], [], []
    for f, b in profile.bounds.items():
        low, high = b["lowerbound"], b["upperbound"]
        lower = f.lower()
        base = prefix + lower
        value = F.coalesce(_number(f), F.lit(float(b["erimpute"])))
        first.append((base, F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))))
        if standard and high != low:
            second.append((f"{prefix}std_{lower}", (F.col(base) - low) / (high - low)))
        kind = b["besttrans"]
        if kind in TRANSFORM_PREFIX:
            name = f"{prefix}{TRANSFORM_PREFIX[kind]}{lower}"
            second.append((name, F.expr(transform_sql(sql_name(base), kind))))
            # Range of the transformed raw values.
            ends = [_transformed(b["min"], kind), _transformed(b["max"], kind)]
            if kind == "square":
                ends = [0.0 if b["min"] <= 0 <= b["max"] else min(ends), max(ends)]
            if standard and ends[0] != ends[1]:
                third.append((f"{prefix}{TRANSFORM_PREFIX[kind]}std_{lower}", (F.col(name) - ends[0]) / (ends[1] - ends[0])))
        if woe:
            second.append((f"{prefix}woe_{lower}", _woe_column(f, base, profile.edges[f], profile.woe[f])))
    return [step for step in (first, second, third) if step]


def _number(feature: str) -> Column:
    return F.expr(f"nanvl(CAST({sql_name(feature)} AS DOUBLE), CAST(NULL AS DOUBLE))")


def _transformed(value: float, kind: str) -> float:
    return {"square": value * value, "sqrt": math.sqrt(max(value, 0.0)), "log": math.log(max(value, 0.00001))}[kind]


def _woe_column(feature: str, base: str, edges: Sequence[float], woe: dict) -> Column:
    """WOE by interval, first one closed, others open on the left; missing rows get their own."""
    col = F.col(sql_name(base))
    out = F.when(_number(feature).isNull(), F.lit(float(woe.get(None) or 0.0)))
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        inside = (col >= a if i == 0 else col > a) & (col <= b)
        out = out.when(inside, F.lit(float(woe.get(i) or 0.0)))
    return out.otherwise(F.lit(0.0))


def apply_recoding(df: DataFrame, steps: Sequence[Sequence[tuple[str, Column]]]) -> DataFrame:
    """Adds recoded columns; plain column expressions, so streaming tables work too."""
    for step in steps:
        df = df.withColumns(dict(step))
    return df


@dataclass
class NominalProfile:
    table: DataFrame
    statistics: DataFrame
    groups: dict[str, list[dict]] = field(default_factory=dict)


def usable_nominal(df: DataFrame, features: Sequence[str], max_missing_rate: float = MAX_MISSING, max_values: int = MAX_CATEGORIES) -> list[str]:
    row = df.selectExpr(*[f"{rate_sql(f'{sql_name(f)} IS NULL')} AS m{i}" for i, f in enumerate(features)]).first()
    distinct = small_distinct_counts(df, {f: sql_name(f) for f in features}, max_values + 1)
    return [f for i, f in enumerate(features) if row[f"m{i}"] <= max_missing_rate and 1 <= distinct[f] <= max_values]


def _weighted_quantile(x: np.ndarray, n: np.ndarray, p: float) -> float:
    """Linear quantile of values repeated ``n`` times, in value order."""
    upto = np.cumsum(n)
    pos = p * (upto[-1] - 1)
    low = x[np.searchsorted(upto, math.floor(pos), side="right")]
    high = x[np.searchsorted(upto, math.ceil(pos), side="right")]
    return float(low + (high - low) * (pos - math.floor(pos)))


def nominal_profile(
    df: DataFrame, features: Sequence[str], label: str = "label", event=1, max_missing_rate: float = MAX_MISSING,
    max_bins: int = 10, tree: bool = True, monotonic: bool = True, min_share: float = 0.05, threshold_cor: float = 0.1,
    balanced: bool = True,
) -> NominalProfile:
    """Groups of categories with a similar WOE, profiled like numeric bins.

    Categories are ordered by their WOE and binned on that axis. Features with
    more than 200 values are left out, so a feature is a short list here.
    """
    rows, _ = event_column(df, label, event)
    used = usable_nominal(rows, features, max_missing_rate)
    if not used:
        raise ValueError("no usable nominal feature")
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_event").alias("events")).first()
    n, events = float(totals.n), float(totals.events)
    flat = rows.selectExpr("_event", *[f"coalesce(CAST({sql_name(f)} AS STRING), '{MISSING_GROUP}') AS {sql_name(f)}" for f in used])
    counts = flat.unpivot(["_event"], [sql_name(f) for f in used], "variable", "category").groupBy("variable", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_event").cast("bigint")).alias("bad")
    )
    shares = (F.col("bad") / F.lit(events), (F.col("n") - F.col("bad")) / F.lit(n - events))
    rated = counts.withColumn("cat_woe", woe_capped(*shares))
    min_leaf = max(int(n * min_share), 1)

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["cat_woe", "category"])
        # Categories with one WOE form one cell.
        cells = pdf.groupby("cat_woe", sort=True).agg(n=("n", "sum"), bad=("bad", "sum")).reset_index()
        x, cn, cb = (cells[c].to_numpy(dtype=float) for c in ("cat_woe", "n", "bad"))

        def edges_for(k):
            if tree:
                return sorted({x[0], x[-1], *tree_cuts(x, x, cn, cb, k, min_leaf, balanced)})
            return sorted({_weighted_quantile(x, cn, i / k) for i in range(k + 1)})

        edges = monotone_edges(edges_for, max_bins, monotonic, threshold_cor, (x, cn, cb, x * cn))
        place = np.searchsorted(np.asarray(edges[1:-1]), pdf["cat_woe"].to_numpy(), side="left")
        return pdf.assign(bin_idx=place.astype("int32"))[["variable", "category", "n", "bad", "cat_woe", "bin_idx"]]

    grouped = rated.groupBy("variable").applyInPandas(
        group, "variable string, category string, n bigint, bad bigint, cat_woe double, bin_idx int"
    )
    bins = grouped.groupBy("variable", "bin_idx").agg(
        F.array_sort(F.collect_list("category")).alias("categories"), F.min("cat_woe").alias("min"), F.max("cat_woe").alias("max"),
        F.sum("n").alias("count"), F.sum("bad").alias("depvar_n"),
    ).withColumn("_total", F.lit(0))
    spark = df.sparkSession
    total_rows = spark.createDataFrame([(f, int(n), int(events), 1) for f in used], "variable string, count bigint, depvar_n bigint, _total int")
    table = _with_rates(bins.unionByName(total_rows, allowMissingColumns=True), totals)
    shown = F.when(F.col("_total") == 1, F.lit(TOTAL_GROUP)).otherwise(F.concat_ws("|", "categories"))
    table = table.select(
        "iv", "variable", shown.alias("group"), "bin_idx", "categories", "min", "max", "count", "proportion", "depvar_n", "depvar_rate", "lift", "woe"
    )
    groups: dict[str, list[dict]] = {f: [] for f in used}
    iv = {}
    collected = table.orderBy("variable", "bin_idx").collect()
    table = spark.createDataFrame(collected, table.schema)
    for r in collected:
        iv[r.variable] = r.iv
        if r.group != TOTAL_GROUP:
            groups[r.variable].append({"bin": r.bin_idx, "categories": list(r.categories), "woe": r.woe, "lift": r.lift})
    missing = rows.selectExpr(*[f"{rate_sql(f'{sql_name(f)} IS NULL')} AS m{i}" for i, f in enumerate(used)]).first()
    statistics = spark.createDataFrame([(f, missing[i], iv.get(f)) for i, f in enumerate(used)], "variable string, missingrate double, iv double")
    order = [F.desc("iv"), F.col("variable"), F.col("group") != TOTAL_GROUP, F.col("min").asc_nulls_last()]
    return NominalProfile(table.drop("bin_idx", "categories").orderBy(*order), statistics.orderBy(F.desc("iv"), "variable"), groups)


def nominal_recoding(profile: NominalProfile, prefix: str = "r_", low: float = 80.0, high: float = 120.0) -> list[list[tuple[str, Column]]]:
    """WOE per group, and a 0/1 column for each group far from the average rate."""
    out = []
    for f, groups in profile.groups.items():
        value = F.coalesce(F.col(sql_name(f)).cast("string"), F.lit(MISSING_GROUP))
        woe = None
        for i, g in enumerate(groups, start=1):
            member = value.isin(g["categories"])
            woe = F.when(member, F.lit(float(g["woe"]))) if woe is None else woe.when(member, F.lit(float(g["woe"])))
            if g["lift"] < low or g["lift"] > high:
                out.append((f"{prefix}{f.lower()}_x{i}", F.when(member, 1).otherwise(0)))
        out.append((f"{prefix}woe_{f.lower()}", woe.otherwise(F.lit(0.0))))
    return [out]


def all_profiles(df: DataFrame, numeric: Sequence[str], nominal: Sequence[str], label: str = "label", **options):
    """Numeric and nominal profiles in one bin table and one statistics table, with all recoding steps."""
    cont = continuous_profile(df, numeric, label, **options)
    nomi = nominal_profile(df, nominal, label, **options)
    table = cont.table.unionByName(nomi.table)
    statistics = cont.statistics.unionByName(nomi.statistics, allowMissingColumns=True)
    return table, statistics, [*continuous_recoding(cont), *nominal_recoding(nomi)]

"""Exact quantiles and running totals that never put a whole column into one task.

The built-in ``percentile`` keeps one entry per distinct value in a single
aggregation buffer. Here a bounded sketch brackets every wanted order statistic,
a second pass counts what lies between the brackets and keeps distinct values
only inside them, and the answer is read off those counts. The sketch only
decides where to look; ranks come from counts, so the result is exact, and a
bracket that missed is widened and looked at again.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from riskweave.functions.bins import after, count_reached
from riskweave.functions.cleaning import sql_name
from riskweave.session import shuffle_width, write_stage

SKETCH_ACCURACY = 10_000
FEATURES_PER_PASS = 50
BUCKET_ROWS = 200_000


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, tuple[str, Sequence[float]]],
    extra: Sequence[str] = (),
    accuracy: int = SKETCH_ACCURACY,
) -> tuple[dict[str, list[float | None]], Row]:
    """Linear-interpolated quantiles per name, plus one row of extra aggregates.

    ``wanted`` maps a name to (SQL text of a double, probabilities); NULLs are
    ignored. Only the quantile values and the extra row reach the driver.
    """
    names = list(wanted)
    results: dict[str, list[float | None]] = {}
    extra_values: dict = {}
    for at in range(0, max(len(names), 1), FEATURES_PER_PASS):
        batch = {n: wanted[n] for n in names[at : at + FEATURES_PER_PASS]}
        found, row = _quantile_batch(df, batch, extra if at == 0 else (), accuracy)
        results.update(found)
        if at == 0:
            extra_values = row
    return results, Row(**extra_values)


def _quantile_batch(df, wanted, extra, accuracy):
    names = list(wanted)
    margin = 2.0 / accuracy
    aggs, asked = [], []
    for i, n in enumerate(names):
        sql = wanted[n][0]
        probs = sorted(set(wanted[n][1]))
        asked.append(probs)
        aggs += [f"count({sql}) AS n{i}", f"min({sql}) AS lo{i}", f"max({sql}) AS hi{i}"]
        if probs:
            ends = ", ".join(f"{min(max(p + d, 0.0), 1.0)!r}D" for p in probs for d in (-margin, margin))
            aggs.append(f"percentile_approx({sql}, array({ends}), {accuracy}) AS s{i}")
    # Extra aggregates share the sketch pass.
    row = df.selectExpr(*aggs, *extra).first().asDict() if aggs or extra else {}
    values = df.selectExpr(*[f"CAST({wanted[n][0]} AS DOUBLE) AS q{i}" for i, n in enumerate(names)])
    extra_row = {k: v for k, v in row.items() if not _internal(k, len(names))}

    ranks: dict[int, dict[int, tuple[int, float]]] = {}
    brackets: dict[int, list[tuple[float, float]]] = {}
    for i, n in enumerate(names):
        count = row[f"n{i}"]
        if not count:
            continue
        lo, hi, sketch = row[f"lo{i}"], row[f"hi{i}"], row.get(f"s{i}") or []
        pairs = []
        for j, p in enumerate(asked[i]):
            left, right = sketch[2 * j], sketch[2 * j + 1]
            if p - margin <= 0 or count <= 4 * accuracy:
                left = lo
            if p + margin >= 1 or count <= 4 * accuracy:
                right = hi
            pairs.append((left, right))
        brackets[i] = _disjoint(pairs)
        need = set()
        for p in asked[i]:
            pos = p * (count - 1)
            need.update((math.floor(pos), math.ceil(pos)))
        ranks[i] = {k: None for k in need}

    found: dict[tuple[int, int], float] = {}
    for i in list(ranks):
        for k in list(ranks[i]):
            if k == 0:
                found[i, k] = row[f"lo{i}"]
            elif k == row[f"n{i}"] - 1:
                found[i, k] = row[f"hi{i}"]
    todo = {i: [k for k in ranks[i] if (i, k) not in found] for i in ranks}
    todo = {i: ks for i, ks in todo.items() if ks}
    while todo:
        hits, brackets = _look_up(values, {i: brackets[i] for i in todo}, todo, row)
        found.update(hits)
        todo = {i: [k for k in ks if (i, k) not in found] for i, ks in todo.items()}
        todo = {i: ks for i, ks in todo.items() if ks}

    results = {}
    for i, n in enumerate(names):
        count = row[f"n{i}"]
        out = []
        for p in wanted[n][1]:
            if not count:
                out.append(None)
                continue
            pos = p * (count - 1)
            low, high = found[i, math.floor(pos)], found[i, math.ceil(pos)]
            out.append(low + (high - low) * (pos - math.floor(pos)))
        results[n] = out
    return results, extra_row


def _internal(key: str, n: int) -> bool:
    for prefix in ("lo", "hi", "n", "s"):
        rest = key[len(prefix) :]
        if key.startswith(prefix) and rest.isdigit() and int(rest) < n:
            return True
    return False


def _disjoint(pairs):
    merged: list[list[float]] = []
    for lo, hi in sorted(pairs):
        if merged and lo <= after(merged[-1][1]):
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return [tuple(p) for p in merged]


def _look_up(values, brackets, todo, row):
    """Values at the wanted ranks that fall into a bracket, and brackets for the rest."""
    thresholds = {f"c{i}": [t for lo, hi in pairs for t in (lo, after(hi))] for i, pairs in brackets.items()}
    sources = {f"c{i}": f"q{i}" for i in brackets}
    flat = count_reached(values, sources, thresholds)
    parts = ", ".join(f"{i}, c{i}, q{i}" for i in brackets)
    cand = (
        flat.selectExpr(f"stack({len(brackets)}, {parts}) AS (f, cell, x)")
        .filter("cell IS NOT NULL")
        .selectExpr("f", "cell", "CASE WHEN cell % 2 = 1 THEN x END AS v")
        .groupBy("f", "cell", "v")
        .agg(F.count(F.lit(1)).alias("c"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        cells: dict[int, dict[int, int]] = {}
        for r in cand.groupBy("f", "cell").agg(F.sum("c").alias("c")).collect():
            cells.setdefault(r.f, {})[r.cell] = r.c
        needs, wider = [], {}
        for i, ks in todo.items():
            again = []
            for k in ks:
                below = 0
                for cell in sorted(cells[i]):
                    if k < below + cells[i][cell]:
                        break
                    below += cells[i][cell]
                if cell % 2:
                    needs.append((i, cell, k - below, k))
                else:
                    pairs = brackets[i]
                    lo = pairs[cell // 2 - 1][1] if cell else row[f"lo{i}"]
                    hi = pairs[cell // 2][0] if cell // 2 < len(pairs) else row[f"hi{i}"]
                    again.append((lo, hi))
            if again:
                wider[i] = _disjoint(again)
        hits = {}
        if needs:
            spark = values.sparkSession
            want = spark.createDataFrame(needs, "f int, cell int, local bigint, k bigint")
            upto = F.sum("c").over(
                Window.partitionBy("f", "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
            )
            ranked = cand.filter("cell % 2 = 1").withColumn("upto", upto)
            # ``want`` holds two rows per quantile, so it is small by construction.
            picked = ranked.join(F.broadcast(want), ["f", "cell"]).filter(
                "local < upto AND local >= upto - c"
            )
            hits = {(r.f, r.k): r.v for r in picked.select("f", "k", "v").collect()}
        return hits, wider
    finally:
        cand.unpersist()


def with_range_bucket(df: DataFrame, name: str, out: str = "_bucket") -> DataFrame:
    """Adds the ordered bucket number of a double column, cut where the data is dense.

    The cut points are fixed numbers taken from one sketch pass, so a recomputed
    task puts every row into the same bucket again. There are as many buckets as
    the shuffle is wide, more where a bucket would exceed ``BUCKET_ROWS``.
    """
    buckets = max(2, shuffle_width(df.sparkSession), math.ceil(df.count() / BUCKET_ROWS))
    value = f"CAST({sql_name(name)} AS DOUBLE)"
    probs = ", ".join(f"{k / buckets!r}D" for k in range(1, buckets))
    cuts = df.selectExpr(f"percentile_approx({value}, array({probs}), {10 * buckets})").first()[0]
    thresholds = sorted({after(c) for c in cuts or []})
    if not thresholds:
        return df.withColumn(out, F.lit(0))
    return count_reached(df, {out: value}, {out: thresholds})


def running_totals(
    df: DataFrame, order: str, measures: Sequence[str], keys: Sequence[str] = (), before: str = "below_", written: bool = False
) -> DataFrame:
    """Adds the sum of each measure over all rows ordered before the current one.

    Works on rows that are unique in (keys, order). Each ordered bucket is
    summed on its own and shifted by the total of the buckets below it, so no
    task sees more than a bucket even when one key holds most rows. The rows are
    written once (unless they already are), because count, sketch, totals and windows all read them.
    """
    keys = list(keys)
    df = df if written else write_stage(df, "running_totals")
    cut = with_range_bucket(df, order)
    totals = cut.groupBy(*keys, "_bucket").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    # One row per key and bucket here; the window stays as small as the bucket count.
    over_buckets = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{m}").over(over_buckets), F.lit(0)).alias(f"_o_{m}") for m in measures],
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.select("*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_l_{m}") for m in measures])
    joined = _null_safe_join(local, offsets, [*keys, "_bucket"])
    out = [c for c in df.columns]
    return joined.select(*out, *[(F.col(f"_l_{m}") + F.col(f"_o_{m}")).alias(f"{before}{m}") for m in measures])


def _null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = None
    for c in on:
        test = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        condition = test if condition is None else condition & test
    return left.join(renamed, condition).drop(*[f"_r_{c}" for c in on])

"""Rules of a few conditions that single out risky rows.

Two ways: ``lift_rules`` lists all rules of one or two conditions with enough
coverage and lift, ``rule_learner`` covers resamples of the table with the best
rule found by a beam search, one after the other. Both read rows as small codes
(one per feature, the number of its condition) from a table written once, count
inside the tasks and shuffle nothing but sums per rule.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import write_stage

#: Conditions of a pair of tiles that one pass counts against each other.
TILE = 2048
#: Cells of the one-hot matrix a task makes at once.
CELLS = 1 << 22
#: A row's full weight in the covering; weights are whole numbers, so sums don't depend on their order.
FULL = 1 << 20
#: Chi-square of one degree of freedom at its upper 5 % (fixed value).
SIGNIFICANT = 3.841458820694124


@dataclass(frozen=True)
class Selectors:
    """Conditions feature = value, in the order of features and values; ``of[s]`` is the place of its feature."""

    features: tuple[str, ...]
    pairs: tuple[tuple[str, str], ...]

    @property
    def of(self) -> np.ndarray:
        place = {f: i for i, f in enumerate(self.features)}
        return np.array([place[f] for f, _ in self.pairs], dtype=np.int64)


def _coded(rows: DataFrame, names: Sequence[str], keep: Sequence[str], least: float) -> tuple[Selectors, DataFrame]:
    """The conditions that hold for ``least`` rows at least, and the rows as ``keep`` and codes c0.. (-1: none of them)."""
    single = rows.unpivot([], list(names), "feature", "value").where("value IS NOT NULL").groupBy("feature", "value").count()
    found = single.where(F.col("count") >= least).collect()  # rows / least for each feature, at most
    order = {n: i for i, n in enumerate(names)}
    pairs = sorted(((r.feature, r.value) for r in found), key=lambda p: (order[p[0]], p[1]))
    of: dict[str, list[Column]] = {n: [] for n in names}
    for s, (f, v) in enumerate(pairs):
        of[f] += [F.lit(v), F.lit(s)]
    codes = [(F.coalesce(F.try_element_at(F.create_map(*of[n]), F.col(n)), F.lit(-1)) if of[n] else F.lit(-1)).alias(f"c{i}") for i, n in enumerate(names)]
    return Selectors(tuple(names), tuple(pairs)), rows.select(*keep, *codes)


def _pair_sums(coded: DataFrame, chosen: Selectors, first: Sequence[int], second: Sequence[int]) -> DataFrame:
    """i, j, n, bad of the conditions ``first`` against ``second`` (i before j of another feature) and of each alone (i = j), added up per task."""
    of, tiles = chosen.of, [np.array(t, dtype=np.int64) for t in (first, second)]
    columns = [sorted(set(of[t].tolist())) for t in tiles]
    used = sorted(set(columns[0]) | set(columns[1]))
    size = len(chosen.pairs)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, len(first), len(second)), dtype=np.int64)
        places = [np.full(size + 1, len(t)) for t in tiles]
        for place, t in zip(places, tiles, strict=True):
            place[t] = np.arange(len(t))
        step = max(1, CELLS // max(len(first), len(second), 1))
        for batch in batches:
            for low in range(0, len(batch), step):
                part = batch.iloc[low : low + step]
                hot = []
                for place, t, cs in zip(places, tiles, columns, strict=True):
                    x = np.zeros((len(part), len(t) + 1), dtype=np.float32)
                    for c in cs:
                        x[np.arange(len(part)), place[part[f"c{c}"].to_numpy()]] = 1
                    hot.append(x[:, :-1])
                bad = part["_y"].to_numpy() == 1
                sums[0] += np.rint(hot[0].T @ hot[1]).astype(np.int64)
                sums[1] += np.rint(hot[0][bad].T @ hot[1][bad]).astype(np.int64)
        i, j = np.nonzero(sums[0])
        own = (tiles[0][i] == tiles[1][j]) | (of[tiles[0][i]] < of[tiles[1][j]])
        i, j = i[own], j[own]
        yield pd.DataFrame({"i": tiles[0][i], "j": tiles[1][j], "n": sums[0][i, j], "bad": sums[1][i, j]})

    parts = coded.select("_y", *[f"c{c}" for c in used]).mapInPandas(partial, "i long, j long, n long, bad long")
    return parts.groupBy("i", "j").agg(F.sum("n").alias("covered"), F.sum("bad").alias("bad"))


def lift_rules(
    df: DataFrame,
    conditions: Mapping[str, Column],
    label: str = "label",
    threshold_lift: float = 2.0,
    min_covered_rate: float = 0.01,
    max_feature_num: int = 2,
) -> DataFrame:
    """All rules of binned features with enough coverage and lift.

    ``conditions`` maps a feature to its discrete value. No pair covers more than
    either of its parts, so values under the coverage are dropped before pairs
    are counted; a feature keeps 1 / ``min_covered_rate`` values at most. Tasks add
    up cross products of the conditions, ``TILE`` against ``TILE`` of them in a pass.
    """
    names = list(conditions)
    rows = df.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("_y"), *[c.cast("string").alias(n) for n, c in conditions.items()])
    base = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("bad")).first()
    n, rate = float(base.n or 0), (base.bad or 0) / (base.n or 1)
    chosen, coded = _coded(rows, names, ["_y"], min_covered_rate * n)
    places = list(range(len(chosen.pairs)))
    tiles = [places[a : a + TILE] for a in range(0, max(1, len(places)), TILE)]
    both = list(itertools.combinations_with_replacement(tiles, 2))
    if len(both) > 1:
        coded = write_stage(coded, "rules")
    sums = None
    for first, second in both:
        part = _pair_sums(coded, chosen, first, second)
        sums = part if sums is None else sums.unionByName(part)
    spark = df.sparkSession
    # One row for each condition: features / ``min_covered_rate`` at most.
    named = spark.createDataFrame([(s, f, v) for s, (f, v) in enumerate(chosen.pairs)], "s long, feature string, value string")
    left, right = (named.select(F.col("s").alias(k), F.col("feature").alias(f"feature_{m}"), F.col("value").alias(f"value_{m}")) for k, m in (("i", 1), ("j", 2)))
    ruled = sums.join(left, "i").join(right, "j").where("i = j" if max_feature_num < 2 else "true")
    alone = F.col("i") == F.col("j")
    return ruled.select(
        "feature_1", "value_1", F.when(~alone, F.col("feature_2")).alias("feature_2"), F.when(~alone, F.col("value_2")).alias("value_2"), "covered", "bad",
        (F.col("covered") / n).alias("coverage"),
        (F.col("bad") / F.col("covered")).alias("score"),
        F.try_divide(F.col("bad") / F.col("covered"), F.lit(rate)).alias("lift"),
        F.lit(rate).alias("overall_rate"),
    ).filter((F.col("coverage") >= min_covered_rate) & (F.col("score") > threshold_lift * rate))


# Weighted covering.

Rule = tuple[int, ...]


def resample_hash(id_col: str, seed: int, loop: int) -> Column:
    """A number below 2^32 for each id, another one in each resample."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{loop}:"), F.col(id_col).cast("string"))), 1, 8), 16, 10).cast("long")


def weight_units(gamma: float, covered: int) -> int:
    """Weight of a row that so many accepted rules cover."""
    return round(FULL * gamma**covered)


def _level_sums(
    coded: DataFrame, chosen: Selectors, bases: Mapping[int, Sequence[Rule]], accepted: Mapping[int, Sequence[Rule]], gamma: float
) -> dict[tuple[int, int, int], tuple[int, int, int, int]]:
    """(resample, base, condition) -> weight, weight of bad rows, rows, bad rows of a base with one more condition; condition -1 is the base alone."""
    of, size, p = chosen.of, len(chosen.pairs), len(chosen.features)
    most = max((len(a) for a in accepted.values()), default=0)
    units = np.array([weight_units(gamma, k) for k in range(most + 1)], dtype=np.int64)

    def holds(codes: np.ndarray, rule: Rule) -> np.ndarray:
        out = np.ones(len(codes), dtype=bool)
        for s in rule:
            out &= codes[:, of[s]] == s
        return out

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {loop: np.zeros((len(own), size + 2, 4), dtype=np.int64) for loop, own in bases.items()}
        for batch in batches:
            codes, y, bits = batch[[f"c{i}" for i in range(p)]].to_numpy(), batch["_y"].to_numpy() == 1, batch["_in"].to_numpy()
            for loop, own in bases.items():
                inside = (bits >> loop) & 1 == 1
                mine, bad = codes[inside], y[inside]
                covered = np.zeros(len(mine), dtype=np.int64)
                for rule in accepted[loop]:
                    covered += holds(mine, rule)
                weight = units[covered]
                for b, base in enumerate(own):
                    at = np.flatnonzero(holds(mine, base))
                    for k, rows in enumerate((at, at[bad[at]])):
                        cells = mine[rows].ravel() + 1
                        sums[loop][b, :-1, k] += np.rint(np.bincount(cells, weights=np.repeat(weight[rows], p), minlength=size + 1)).astype(np.int64)
                        sums[loop][b, :-1, 2 + k] += np.bincount(cells, minlength=size + 1)
                        sums[loop][b, -1, k] += weight[rows].sum()
                        sums[loop][b, -1, 2 + k] += len(rows)
        for loop, table in sums.items():
            table[:, 0] = table[:, -1]  # cell 0 counted rows without a condition, which nobody needs
            b, s = np.nonzero(table[:, :-1, 2])
            yield pd.DataFrame({"loop": loop, "base": b, "s": s - 1, **{c: table[b, s, k] for k, c in enumerate(("wn", "wb", "n", "b"))}})

    parts = coded.mapInPandas(partial, "loop int, base long, s long, wn long, wb long, n long, b long")
    total = parts.groupBy("loop", "base", "s").agg(*[F.sum(c).alias(c) for c in ("wn", "wb", "n", "b")])
    return {(r["loop"], r["base"], r["s"]): (r["wn"], r["wb"], r["n"], r["b"]) for r in total.collect()}  # resamples x beam x conditions


def likelihood_ratio(good: float, bad: float, parent_good: float, parent_bad: float) -> float:
    """How far the classes of a rule's rows are from its parent's, as a chi-square."""
    share = parent_bad / (parent_good + parent_bad)
    return 2 * sum(o * math.log(o / ((good + bad) * e)) for o, e in ((good, 1 - share), (bad, share)) if o > 0 and e > 0)


def _better(rules: dict[Rule, tuple], total: tuple, most: int) -> list[Rule]:
    """The best rules by weighted relative accuracy, which for whole-number weights is compared without rounding; ties: fewer, then earlier conditions."""
    return sorted(rules, key=lambda r: (rules[r][0] * total[1] - rules[r][1] * total[0], len(r), r))[:most]


def rule_learner(
    df: DataFrame,
    conditions: Mapping[str, Column],
    label: str = "label",
    id_col: str = "id",
    threshold_lift: float = 2.0,
    loop_num: int = 5,
    min_covered_rate: float = 0.01,
    max_feature_num: int = 2,
    oversampled_dep_rate: float = 0.5,
    gamma: float = 0.7,
    beam: int = 10,
    max_rules: int = 10,
    seed: int = 817,
) -> DataFrame:
    """Rules by weighted covering of ``loop_num`` resamples, with their score at the table's own rate of bad rows.

    A resample holds all bad rows and as many good ones, by a seeded hash of the
    id, as make the share ``oversampled_dep_rate``. In each, the best rule is
    accepted and the weight of its rows falls to ``gamma`` times, until no rule is better
    than the resample as a whole or ``max_rules`` searches are done; a rule that is best again
    lowers its rows' weights again and is listed once. With ``gamma`` of 1 nothing changes after the
    first rule, so each resample gives that one. A rule is found by a beam search: of the
    rules that cover ``min_covered_rate`` of the resample and differ from the
    resample and from the rule they refine (chi-square at 5 %), the ``beam`` best by weighted
    relative accuracy are refined by one more condition, up to ``max_feature_num``.

    The score takes the Laplace estimate of a rule's bad share back to the table's
    rate by the offset of the resampling; rules count whose score is above
    ``threshold_lift`` times that rate. Every level of a search is one pass for all resamples.

    A table without bad or without good rows has no rules. Rows without an id are good rows of no resample.
    """
    if loop_num > 31:
        raise ValueError("at most 31 resamples")
    names = list(conditions)
    rows = df.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("_y"), F.col(id_col).alias("_id"), *[c.cast("string").alias(n) for n, c in conditions.items()])
    base = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("bad")).first()
    n_bad, n_good = base.bad or 0, base.n - (base.bad or 0)
    out = "loop int, step int, rule string, feature_1 string, value_1 string, feature_2 string, value_2 string, n_conditions int, n_good long, n_bad long, p_bad double, score double, lift double, overall_rate double"
    if not n_bad or not n_good:
        return df.sparkSession.createDataFrame([], out)
    share = n_bad * (1 - oversampled_dep_rate) / oversampled_dep_rate / n_good
    limit = min(1 << 32, round(share * (1 << 32)))
    bits = sum((F.when((F.col("_y") == 1) | F.coalesce(resample_hash("_id", seed, loop) < limit, F.lit(False)), F.lit(1 << loop)).otherwise(0) for loop in range(loop_num)), F.lit(0))
    # A resample has all bad rows, so a condition with a smaller share of these in the whole table can't cover enough of it.
    chosen, coded = _coded(rows.withColumn("_in", bits), names, ["_y", "_in"], min_covered_rate * n_bad)
    coded = write_stage(coded, "rule-rows")
    of, accepted = chosen.of, {loop: [] for loop in range(loop_num)}
    sizes: dict[int, tuple[int, int]] = {}
    found: dict[Rule, dict] = {}
    active, step = set(range(loop_num)), 0
    while active and step < max_rules:
        bases: dict[int, list[Rule]] = {loop: [()] for loop in active}
        parents: dict[int, dict[Rule, tuple]] = {loop: {} for loop in active}
        valid: dict[int, dict[Rule, tuple]] = {loop: {} for loop in active}
        totals: dict[int, tuple] = {}
        for level in range(1, max_feature_num + 1):
            sums = _level_sums(coded, chosen, {k: b for k, b in bases.items() if b}, accepted, gamma)
            fresh: dict[int, dict[Rule, tuple]] = {loop: {} for loop in active}
            for (loop, b, s), own in sums.items():
                if level == 1 and s < 0:
                    totals[loop] = own
                    sizes.setdefault(loop, own[2:])
                    parents[loop][()] = own
            for (loop, b, s), own in sums.items():
                base_rule = bases[loop][b]
                if s < 0 or of[s] in of[list(base_rule)]:
                    continue
                wn, wb, n, _ = own
                root, parent = totals[loop], parents[loop][base_rule]
                far = all(likelihood_ratio(wn - wb, wb, x[0] - x[1], x[1]) > SIGNIFICANT for x in (root, parent))
                if n >= min_covered_rate * root[2] and far:
                    fresh[loop][tuple(sorted((*base_rule, s)))] = own
            for loop in active:
                valid[loop] |= fresh[loop]
                parents[loop] = fresh[loop]
                bases[loop] = _better(fresh[loop], totals.get(loop, (0, 0)), beam)
            if not any(bases.values()):
                break
        for loop in sorted(active):
            best = _better(valid[loop], totals.get(loop, (0, 0)), 1)
            if not best or (gamma == 1 and best[0] in accepted[loop]) or valid[loop][best[0]][1] * totals[loop][0] <= valid[loop][best[0]][0] * totals[loop][1]:
                active.discard(loop)
                continue
            accepted[loop].append(best[0])
            found.setdefault(best[0], {"loop": loop, "step": step, "own": valid[loop][best[0]]})
        step += 1
    rate, result = n_bad / (n_bad + n_good), []
    for rule, at in found.items():
        wn, wb, n, b = at["own"]
        size, size_bad = sizes[at["loop"]]
        over = size_bad / size
        p = (wb / FULL + 1) / (wn / FULL + 2)
        if over < 1:
            offset = math.log(1 - rate) + math.log(over) - math.log(rate) - math.log(1 - over)
            score = 1 / (1 + math.exp(offset - math.log(p / (1 - p))))
        else:
            score = p
        if score > threshold_lift * rate:
            parts = [chosen.pairs[s] for s in rule]
            text = " AND ".join(f"{f}={v}" for f, v in parts)
            pair = [*parts, (None, None)][:2]
            result.append((at["loop"], at["step"], text, *pair[0], *pair[1], len(rule), n - b, b, p, score, score / rate, rate))
    return df.sparkSession.createDataFrame(sorted(result), out)

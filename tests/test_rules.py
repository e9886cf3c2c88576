from __future__ import annotations

import hashlib
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import rules

FULL = 1 << 20


def table(n=1500, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.choice("uvw"), rng.choice(["p", "q", "r", "s"]), rng.choice(["x", "y", None])
        p = 0.05 + 0.3 * (a == "u" and b == "p") + 0.2 * (c == "y" and b != "q") + 0.1 * (a == "w")
        rows.append((i, int(rng.random() < p) if i % 50 else None, a, b, c, rng.choice([None, *"123456789"])))
    return rows


COLUMNS = ("a", "b", "c", "d")


def brute(rows, lift, loops, rate, length, share, gamma, beam, most, seed=817):
    """The learner on plain lists."""
    rows = [(r[0], r[1], dict(zip(COLUMNS, r[2:], strict=True))) for r in rows if r[1] in (0, 1)]
    n_bad = sum(y for _, y, _ in rows)
    base = n_bad / len(rows)
    keep = min(1 << 32, round(n_bad * (1 - share) / share / (len(rows) - n_bad) * (1 << 32)))
    selectors = sorted({(COLUMNS.index(f), v) for _, _, x in rows for f, v in x.items() if v is not None})
    covers = lambda x, rule: all(x[COLUMNS[f]] == v for f, v in rule)

    def ratio(own, parent):
        g, b = own[0] - own[1], own[1]
        e = parent[1] / parent[0]
        return 2 * sum(o * math.log(o / (own[0] * q)) for o, q in ((g, 1 - e), (b, e)) if o and q)

    found = {}
    for loop in range(loops):
        mine = [r for r in rows if r[1] or int(hashlib.md5(f"{seed}:{loop}:{r[0]}".encode()).hexdigest()[:8], 16) < keep]
        accepted = []
        for step in range(most):
            weight = [round(FULL * gamma ** sum(covers(x, a) for a in accepted)) for _, _, x in mine]

            def sums(rule):
                at = [i for i, (_, _, x) in enumerate(mine) if covers(x, rule)]
                return sum(weight[i] for i in at), sum(weight[i] for i in at if mine[i][1]), len(at), sum(mine[i][1] for i in at)

            total = sums(())
            gain = lambda own: own[1] * total[0] - own[0] * total[1]
            valid, bases = {}, {(): total}
            for _ in range(length):
                fresh = {}
                for rule, parent in bases.items():
                    for s in selectors:
                        if s[0] in [f for f, _ in rule]:
                            continue
                        new = tuple(sorted((*rule, s)))
                        own = sums(new)
                        if own[2] and own[2] >= rate * total[2] and ratio(own, total) > 3.841458820694124 and ratio(own, parent) > 3.841458820694124:
                            fresh[new] = own
                valid |= fresh
                bases = {r: fresh[r] for r in sorted(fresh, key=lambda r: (-gain(fresh[r]), len(r), r))[:beam]}
            best = sorted(valid, key=lambda r: (-gain(valid[r]), len(r), r))[:1]
            if not best or gain(valid[best[0]]) <= 0 or (gamma == 1 and best[0] in accepted):
                break
            accepted.append(best[0])
            found.setdefault(best[0], (loop, step, valid[best[0]], len(mine)))
    out = []
    for rule, (loop, step, own, size) in found.items():
        p, over = (own[1] / FULL + 1) / (own[0] / FULL + 2), n_bad / size
        offset = math.log(1 - base) + math.log(over) - math.log(base) - math.log(1 - over)
        score = 1 / (1 + math.exp(offset - math.log(p / (1 - p))))
        if score > lift * base:
            out.append((loop, step, " AND ".join(f"{COLUMNS[f]}={v}" for f, v in rule), len(rule), own[2] - own[3], own[3], round(p, 9), round(score, 9), round(score / base, 9)))
    return sorted(out)


def learned(spark, rows, **settings):
    df = spark.createDataFrame(rows, "id long, label int, a string, b string, c string, d string").repartition(4)
    out = rules.rule_learner(df, {c: F.col(c) for c in COLUMNS}, **settings).collect()
    return sorted((r.loop, r.step, r.rule, r.n_conditions, r.n_good, r.n_bad, round(r.p_bad, 9), round(r.score, 9), round(r.lift, 9)) for r in out)


@pytest.mark.parametrize("length, gamma, share", [(2, 0.7, 0.5), (1, 0.5, 0.6), (3, 0.8, 0.5), (2, 1.0, 0.5)])
def test_learner_equals_brute_force(spark, length, gamma, share):
    rows = table()
    got = learned(spark, rows, threshold_lift=1.1, loop_num=3, max_feature_num=length, gamma=gamma, oversampled_dep_rate=share, beam=4, max_rules=4)
    assert got == brute(rows, 1.1, 3, 0.01, length, share, gamma, 4, 4)
    assert got and (gamma < 1 or max(r[1] for r in got) == 0)


def test_resamples_don_t_depend_on_partitions_and_scores_return_to_the_base_rate(spark):
    rows = table()
    once = learned(spark, rows, threshold_lift=1.0, loop_num=5)
    assert once == learned(spark, rows[::-1], threshold_lift=1.0, loop_num=5)
    truth = {}
    for _, label, a, b, c, d in rows:
        if label is not None:
            truth.setdefault((a, b), []).append(label)
    strong = [r for r in once if r[2] == "a=u AND b=p"]
    assert strong and abs(strong[0][7] - sum(truth["u", "p"]) / len(truth["u", "p"])) < 0.1


def test_tables_without_rules(spark):
    rows = table()
    assert learned(spark, [(r[0], 0, *r[2:]) for r in rows]) == [] == learned(spark, []) == learned(spark, [(r[0], 1, *r[2:]) for r in rows])
    assert learned(spark, [(r[0], r[1], None, None, None, None) for r in rows]) == []
    with pytest.raises(ValueError):
        learned(spark, rows, loop_num=40)
    without_ids = learned(spark, [(None if not r[1] and r[0] % 3 else r[0], *r[1:]) for r in rows], threshold_lift=1.0, loop_num=1)
    assert all(r[4] + r[5] > 0 for r in without_ids)


@pytest.mark.parametrize("tile", [rules.TILE, 3])
def test_all_pairs_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(rules, "TILE", tile)
    rows = table(600)
    df = spark.createDataFrame(rows, "id long, label int, a string, b string, c string, d string")
    got = {(r.feature_1, r.value_1, r.feature_2, r.value_2): (r.covered, r.bad) for r in rules.lift_rules(df, {c: F.col(c) for c in COLUMNS}, threshold_lift=0.0, min_covered_rate=0.02).collect()}
    mine = [(r[1], dict(zip(COLUMNS, r[2:], strict=True))) for r in rows if r[1] in (0, 1)]
    want = {}
    for label, x in mine:
        known = [(f, v) for f, v in x.items() if v is not None]
        for rule in [*((k, (None, None)) for k in known), *itertools.combinations(known, 2)]:
            n, bad = want.get((*rule[0], *rule[1]), (0, 0))
            want[(*rule[0], *rule[1])] = (n + 1, bad + label)
    assert got == {k: v for k, v in want.items() if v[0] >= 0.02 * len(mine) and v[1] > 0}

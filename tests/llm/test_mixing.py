from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
from tests.llm.conftest import SF
from tools.compare import rows_of

from riskweave.llm import mixing, queries_corpus

LEVELS = (("domain", "CASE WHEN source IN ('a', 'b') THEN 'web' ELSE 'books' END"), ("lang", "lang"), ("source", "source"))
PLAN = mixing.Plan(levels=LEVELS, weights={"domain": {"web": 3, "books": 1}, "lang": {"en": 2}, "source": {"z": 0}}, budget_share=600, max_epochs=2, seed=3)


def shared(budget, children):
    """Whole-token water filling, child by child; children: name -> (weight, room)."""
    out, left, open_ = {}, budget, dict(children)
    while True:
        weight = sum(w for w, _ in open_.values())
        full = [n for n, (w, room) in open_.items() if not w or Fraction(left * w, weight) >= room]
        if not full:
            break
        for n in full:
            out[n] = children[n][1]
            left -= children[n][1]
            del open_[n]
    return out | {n: left * w // sum(x for x, _ in open_.values()) for n, (w, _) in open_.items()}


def brute(rows, plan):
    """(doc_id, source, epoch) counts by handing budgets down a nested tree."""
    leaves = defaultdict(list)
    for i, text, lang, source in rows:
        leaves["web" if source in ("a", "b") else "books", lang, source].append((i, len((text or "").split())))
    tokens = {p: sum(n for _, n in v) for p, v in leaves.items()}

    def weight(level, name):
        return plan.weights.get(level, {}).get(name, 1)

    room = {p: 0 if any(weight(l, x) <= 0 for l, x in zip(plan.names, p, strict=True)) else plan.max_epochs * t for p, t in tokens.items()}
    budgets = {(): min(sum(tokens.values()) * plan.budget_share // 1000, sum(room.values()))}
    for depth, level in enumerate(plan.names):
        nexts = {}
        for path, budget in budgets.items():
            own = {p[: depth + 1] for p in leaves if p[:depth] == path}
            nexts |= shared(budget, {c: (weight(level, c[-1]), sum(r for p, r in room.items() if p[: depth + 1] == c)) for c in own})
        budgets = nexts
    out = Counter()
    for path, docs in leaves.items():
        epochs = budgets[path] // tokens[path] if tokens[path] else 0
        rest, upto = budgets[path] - epochs * tokens[path], 0
        keyed = sorted((hashlib.md5(f"{plan.seed}:{epochs}:{'' if i is None else i}".encode()).hexdigest(), i, n) for i, n in docs)
        for _, i, n in keyed:
            upto += n
            for e in range(min(epochs + (upto <= rest), plan.max_epochs)):
                out[i, path[2], e] += 1
    return out


def corpus(seed, n=400):
    rng = random.Random(seed)
    return [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 200])), rng.choice(["en", "en", "de", None]), "a" if rng.random() < 0.4 else rng.choice(["b", "c", "d", "z", None])) for i in range(n)]


def test_equals_brute_force(documents_of):
    for seed in (1, 2):
        rows = corpus(seed)
        got = mixing.selected(documents_of(rows), PLAN).collect()
        assert Counter((r.doc_id, r.source, r.epoch) for r in got) == brute(rows, PLAN)


def test_rows_equal_the_selection(documents_of):
    rows = corpus(3)
    docs = documents_of(rows)
    whole = mixing.mixed(docs, PLAN)
    assert whole.columns == docs.columns
    want = Counter()
    for (i, _, _), n in brute(rows, PLAN).items():
        want[i] += n
    assert Counter(r.doc_id for r in whole.collect()) == want


def test_sql_on_other_plans(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for share, epochs in ((50, 1), (1000, 1), (1700, 3)):
        plan = mixing.Plan(levels=(("lang", "lang"), ("source", "source")), weights={"lang": {"en": 1, "fr": 7}}, budget_share=share, max_epochs=epochs, seed=share)
        df = mixing.selected(docs, plan)
        cur = con.execute(queries_corpus.mixing_sql(plan, "documents", "SELECT * FROM taken"))
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_budget_beyond_all_takes_every_epoch(documents_of):
    docs = documents_of([(1, "a b"), (2, "c"), (3, None), (4, "")])
    plan = mixing.Plan(budget=1000, max_epochs=3)
    got = Counter(r.doc_id for r in mixing.selected(docs, plan).collect())
    assert got[1] == got[2] == 3 and max(got.values()) == 3  # rows without tokens come along, no more often than others
    assert got == Counter(r.doc_id for r in mixing.mixed(docs, plan).collect())


def test_leaf_without_tokens_goes_along_once(documents_of):
    rows = [(1, "a b", "en", "a"), (2, None, "en", "c"), (3, "", "en", "c"), (4, None, "de", "d"), (5, None, None, None)]
    got = Counter((r.doc_id, r.source, r.epoch) for r in mixing.selected(documents_of(rows), PLAN).collect())
    assert got == brute(rows, PLAN) and {i for i, _, _ in got} >= {2, 3, 4, 5} and max(got.values()) == 1
    assert Counter(r.doc_id for r in mixing.mixed(documents_of(rows), PLAN).collect()) == Counter(i for i, _, _ in got)


def test_edges(documents_of, clashing):
    assert mixing.selected(documents_of([]), PLAN).count() == 0
    assert mixing.mixed(documents_of([]), PLAN).count() == 0
    twice = mixing.selected(documents_of([(1, "a"), (1, "a"), (None, "b"), (None, "b")]), mixing.Plan(budget_share=1000)).collect()
    assert Counter(r.doc_id for r in twice) == {1: 2, None: 2}
    docs = clashing(["a b", "c"])
    assert mixing.mixed(docs, mixing.Plan()).columns == docs.columns and mixing.mixed(docs, mixing.Plan()).count() == 2

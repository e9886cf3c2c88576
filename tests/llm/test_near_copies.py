from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import WORD

from riskweave.llm import near_copies as nc
from riskweave.llm.components import components
from riskweave.llm.staging import Staged
from riskweave.llm.textkit import texts_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = re.findall(WORD, (text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent=80):
    """id -> (set size, smallest id reachable), comparing every pair."""
    sets = {}
    for i, text in rows:
        sets.setdefault(i, shingles(text, size))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def found(docs, settings):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in nc.groups(docs, settings).collect()}


def edited(words, share, rng):
    return [w if rng.random() > share else f"x{rng.randint(0, 10**9)}" for w in words]


def corpus(seed):
    """Families of edited texts of many lengths, chains, copies, boilerplate and a frequent pair of words."""
    rng = random.Random(seed)
    rows, boiler = [], [f"b{i}" for i in range(60)]
    for family in range(14):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([1, 2, 3, 5, 8, 20, 60, 150, 600]))]
        for _ in range(rng.choice([1, 2, 4, 9])):
            share = rng.choice([0, 0.01, 0.03, 0.06, 0.1, 0.15])
            text = edited(base, share, rng)
            if rng.random() < 0.3:
                text = boiler + text
            rows.append(" ".join(["of the", *text] if rng.random() < 0.7 else text))
        base = base[1:] + [f"tail{family}"]
    chain = [f"c{i}" for i in range(120)]
    for step in range(12):  # each like its neighbour only
        rows.append(" ".join(chain[step * 4 :] + [f"d{i}" for i in range(step * 4)]))
    rows += [rows[0], rows[0].upper(), rows[3], "", " \n", "A", "a", "a b", "A  b"]
    rng.shuffle(rows)
    return [(i * 7 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("seed", "size", "keep"), [(1, 2, 64), (2, 5, 64), (3, 2, 64)])
def test_groups_equal_brute_force(documents_of, seed, size, keep):
    rows = corpus(seed)
    assert found(documents_of(rows), nc.Settings(words=size, keep=keep)) == brute(rows, size)


def test_lists_alone_find_every_link(documents_of, monkeypatch):
    """Without hubs the inverted lists have to find all."""
    monkeypatch.setattr(nc, "hub_pairs", lambda nodes: nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false"))
    rows = corpus(4)
    assert found(documents_of(rows), nc.Settings(words=2)) == brute(rows, 2)


@pytest.mark.parametrize("short", [0, 10**9])
def test_either_way_through_the_lists_finds_every_link(documents_of, monkeypatch, short):
    """All lists as long ones, by whole sets; all as short ones, by their pairs."""
    monkeypatch.setattr(nc, "hub_pairs", lambda nodes: nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false"))
    monkeypatch.setattr(nc, "SHORT_LIST", short)
    rows = corpus(8)
    assert found(documents_of(rows), nc.Settings(words=2)) == brute(rows, 2)


def test_beyond_the_broadcast_limit(documents_of, monkeypatch):
    monkeypatch.setattr(nc, "BROADCAST_ROWS", 0)
    rows = corpus(5)
    assert found(documents_of(rows), nc.Settings(words=2)) == brute(rows, 2)


def test_shingle_sets_are_exact():
    texts = ["a b a b a", "one", "", "X y", "x Y", "a\x0bb"]
    doc, value = nc.shingle_sets(texts_of(pa.array(texts)), 2)
    assert np.bincount(doc, minlength=6).tolist() == [len(shingles(t, 2)) for t in texts]
    assert value[doc == 3] == value[doc == 4] != value[doc == 5]


def test_edges(documents_of, clashing):
    docs = documents_of([(None, "a b c"), (None, "a b c"), (3, "a b c"), (3, "a b c"), (5, None), (6, "")])
    got = sorted(map(str, nc.groups(docs, nc.Settings(words=2)).collect()))
    want = [(None, 2, None, True)] * 2 + [(3, 2, 3, True)] * 2 + [(5, 0, 5, True), (6, 0, 6, True)]
    assert [g[g.index("(") :] for g in got] == sorted(f"(doc_id={a}, n_shingles={b}, component_id={c}, kept={d})" for a, b, c, d in want)
    assert nc.groups(documents_of([])).count() == 0
    long = " ".join(f"w{i}" for i in range(60000))
    assert found(documents_of([(1, long), (2, long + " end")]), nc.Settings()) == {1: (59996, 1), 2: (59997, 1)}
    assert nc.groups(clashing(["a b", "a b"])).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_one_of_each_group_stays(documents_of, clashing):
    rows = corpus(6)
    want = {i for i, (_, first) in brute(rows, 5).items() if i == first}
    kept = nc.keep_one(documents_of(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want) and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [r.doc_id for r in nc.keep_one(documents_of([(1, "a b"), (1, "a b"), (2, "a b")])).collect()] == [1]
    assert nc.keep_one(documents_of([(None, "a"), (None, "a")])).count() == 2
    assert nc.keep_one(clashing(["a b", "a b"])).count() == 1


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, 5000 + i) for i in range(1, 200)] + [(3, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    table = spark.createDataFrame([(min(a, b), max(a, b)) for a, b in links], "a long, b long")
    got = {r.node: r.root for r in components(table, Staged(spark, "test"), "c").collect()}
    assert got == {x: find(x) for x in parent if x in got} and all(find(x) == x for x in set(parent) - set(got))
    assert components(table.where("false"), Staged(spark, "test"), "none").count() == 0


def test_large_sets_are_broadcast_and_others_joined(spark, documents_of):
    """Copies are named alike however many sets are broadcast."""

    rows = spark.range(200).select(F.col("id"), (F.col("id") % 7).alias("n_shingles"), F.when(F.col("id") % 50 != 3, F.pmod("id", F.lit(13))).alias("set_a"), F.lit(1).cast("long").alias("set_b"))
    copies = rows.where("set_a IS NOT NULL").groupBy("set_a", "set_b").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
    want = None
    for large in (100, 13, 4, 1):
        got = sorted(((r.id, r.first) for r in nc.with_first(rows, copies, Staged(spark, "test"), large).collect()))
        want = want or got
        assert got == want and len(got) == 200
    assert dict(want)[3] is None and dict(want)[15] == 2

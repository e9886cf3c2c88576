from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from riskweave.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enter(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(r, text):
    return H(*map(enter, (r.doc_id, r.source, r.lang, r.n_chars, text)))


def way(digests):
    """(root, per leaf the (left, right) siblings of each level) of a plain level-by-level tree."""
    paths, member = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        up, owners = [], []
        for low in range(0, len(digests), 3):
            run = digests[low : low + 3]
            for k in range(len(run)):
                for i in member[low + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(H(*run))
            owners.append([i for m in member[low : low + 3] for i in m])
        digests, member = up, owners
    return (digests[0] if digests else None), paths


def brute(rows):
    """Every row of the manifest, one plain tree after the other."""
    groups = {}
    for r in rows:
        groups.setdefault((r.source is not None, (r.source or "").encode()), []).append(r)
    names = sorted(groups)
    trees = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[name] = (own, *way([leaf_of(r, r.text) for r in own]))
    root, tops = way([trees[n][1] for n in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        own, subroot, paths = trees[name]
        for r, path in zip(own, paths, strict=True):
            full = path + top
            even = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            now = leaf_of(r, r.text.replace("\n", "") if even and r.text is not None else r.text)
            for left, right in full:
                now = H(left, now, right)
            out.append((r.doc_id, leaf_of(r, r.text), subroot, root, H(*(a + b for a, b in full)), now, now == root))
    return sorted(out, key=repr)


def made(docs, levels=merkle.LEVELS):
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    return sorted(map(tuple, merkle.manifest(docs, altered={"text": text}, where=merkle.altered_rows("doc_id"), levels=levels).collect()), key=repr)


@pytest.mark.parametrize("n", [*range(1, 31), 80, 81, 82, 243, 700])
def test_closed_positions_address_the_log(n):
    leaves = [H(str(i)) for i in range(n)]
    for height in {merkle.height_of(n), merkle.height_of(n) + 2}:
        log = merkle.append_all(leaves, height)
        row = leaves
        for level in range(height + 1):
            assert [log[p] for p in merkle.positions(level, n)] == row
            row = [H(*row[i : i + 3]) for i in range(0, len(row), 3)]
        assert len(log) == merkle.subtree(height, n)
        for one, path in zip(leaves, merkle.walk(log, n, height, ()), strict=True):
            assert merkle.folded(one, path) == log[-1]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_equals_plain_trees_over_any_builder_size(sample, levels):
    assert made(sample, levels) == brute(sample.collect())


def test_defined_cases(documents_of, clashing):
    rows = [(3, None, None, None), (1, "", "en", None), (None, "a\nb", "en", "ä"), (2, "x" * 200000 + "\n", "de", "z"), (5, "same\n", "en", "z"), (5, "same\n", "en", "z"), (None, "c", "en", "ä"), (7, "a\nb", None, "Z"), (8, "\n\n", "fr", "")]
    docs = documents_of(rows)
    for levels in (1, 7):
        assert made(docs, levels) == brute(docs.collect())
    one = documents_of([(4, "only\none", "en", "s")])
    assert made(one) == brute(one.collect()) and made(one)[0][4] == H("")
    assert made(documents_of([])) == []
    extra = clashing(["a\nb", "c"]).withColumns({"place": F.lit(1), "total": F.lit(2), "digest": F.lit("x"), "leaf": F.lit(1), "_source": F.lit(1)})
    assert made(extra) == brute(extra.collect())


def test_many_sources_need_tiers_too(documents_of):
    docs = documents_of([(i, f"text\n{i}", "en", f"s{i % 40:03d}") for i in range(120)])
    assert made(docs, 1) == made(docs) == brute(docs.collect())


def test_tampering_is_seen(sample):
    rows = {r.doc_id: r for r in sample.collect()}
    for doc_id, _, _, root, _, end, verified in made(sample):
        changed = zlib.crc32(str(doc_id).encode()) % 2 == 0 and "\n" in (rows[doc_id].text or "")
        assert verified == (not changed) == (end == root)

from __future__ import annotations

import hashlib

from riskweave.llm import fingerprints as fp


def brute(rows):
    """(id, n_chars, sha of the edited text) by sorting everything."""
    ordered = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -(1 << 63)))
    out = []
    for (i, own), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        own, after = own or "", after or ""
        edited = own[: len(own) - len(own) // 2] + after[: len(own) // 2]
        out.append((i, len(own), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def test_edited_texts_equal_brute_force(spark, documents_of):
    rows = [(i * 3 % 101, " ".join(f"w{(i * k) % 37}é" for k in range(i % 13))) for i in range(101)] + [(500, None), (501, ""), (None, "no id here")]
    for width in ("1", "8", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        got = fp.compare_edited(documents_of(rows, 5)).collect()
        assert sorted(map(str, [(r.doc_id, r.n_chars, r.edited_sha256) for r in got])) == sorted(map(str, brute(rows)))
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_equal_texts_and_likeness(documents_of):
    words = [f"term{i}" for i in range(400)]
    base = " ".join(words[:200])
    rows = [(1, base), (2, base), (3, base + " more"), (4, " ".join(words[200:])), (5, ""), (6, None)]
    got = {r.doc_id: r for r in fp.compare_edited(documents_of(rows)).collect()}
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint
    assert got[5].fingerprint == got[6].fingerprint
    assert got[2].near_next == 1.0 and 0.5 < got[3].near_next < 1.0 and got[4].near_next == 0.0
    assert got[6].near_next == 1.0 and all(0 <= r.near_edited <= 1 for r in got.values())
    assert {r.doc_id: r.fingerprint for r in fp.fingerprint(documents_of(rows)).collect()} == {i: r.fingerprint for i, r in got.items()}


def test_document_frequencies(documents_of):
    docs = documents_of(["A b b", "a\tc", None, ""], 1)
    assert sorted(r.df for r in fp.document_frequencies(docs).collect()) == [1, 1, 2]


def test_frequencies_don_t_depend_on_flushing(documents_of, sample, monkeypatch):
    want = sorted(map(tuple, fp.document_frequencies(sample).collect()))
    monkeypatch.setattr(fp, "FLUSH_TERMS", 500)
    assert sorted(map(tuple, fp.document_frequencies(sample).collect())) == want


def test_one_row_repeated_ids_and_clashing_columns(documents_of, clashing):
    (only,) = fp.compare_edited(documents_of([(9, "abcd")])).collect()
    assert only.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    twice = fp.compare_edited(documents_of([(1, "x y"), (1, "x y"), (0, "z")])).collect()
    assert sorted(r.doc_id for r in twice) == [0, 1, 1]
    assert fp.compare_edited(documents_of([])).count() == 0
    assert fp.compare_edited(clashing(["a b", "c d"])).count() == 2


def test_halves_are_told_from_strangers(sample):
    got = fp.compare_edited(sample).collect()
    assert sum(r.near_edited > r.near_next for r in got) > 10 * sum(r.near_edited < r.near_next for r in got)

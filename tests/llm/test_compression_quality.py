from __future__ import annotations

import zlib

import numpy as np
import pytest
import zstandard

from riskweave.llm import compression_quality as cq

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def scored(labelled):
    docs, labels = labelled
    return {r.doc_id: r for r in cq.classify(docs, labels).collect()}


def test_held_out_accuracy(scored, labelled):
    label = {r.doc_id: r.quality for r in labelled[1].collect()}
    own = [(scored[i], q) for i, q in label.items() if i in scored and scored[i].held_out]
    good, bad = [r for r, q in own if q == 1], [r for r, q in own if q == 0]
    assert len(bad) > 50 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored.values())
    assert np.mean([r.predicted for r in good]) > 0.985 and np.mean([1 - r.predicted for r in bad]) > 0.85
    assert np.mean([(r.score - q) ** 2 for r, q in own]) < 0.02  # calibrated
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored.values())
    ranks = np.argsort(np.argsort([r.score for r, _ in own]))
    at = np.array([q for _, q in own], dtype=bool)
    assert (ranks[at].sum() - at.sum() * (at.sum() - 1) / 2) / (at.sum() * (~at).sum()) > 0.985


def test_labels_of_held_out_documents_are_not_seen(spark, labelled, scored):
    from pyspark.sql import functions as F

    docs, labels = labelled
    flipped = labels.withColumn("quality", F.when(cq.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    some = docs.where("doc_id < 300")
    again = {r.doc_id: r.score for r in some.select("doc_id", cq.scorer(spark, cq.learn(docs, flipped.where(~cq.held_out())))("text").alias("score")).collect()}
    assert again == {i: scored[i].score for i in again}


def test_measure_is_the_compressed_difference():
    made = (cq.dictionary([b"zzz qqq %d" % i for i in range(500)]), cq.dictionary([b"once upon a time %d" % (i * i) for i in range(500)]))
    text = ("once upon a time, é " * 120).encode()
    row = cq.Measure(made)([text, b"", b"once upon a time 7"])
    sizes = []
    for content, trained in made:
        assert trained
        of = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=False, write_dict_id=False)
        back = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
        parts = [of.compress(text[i : i + 384]) for i in range(0, len(text), 384)]
        assert b"".join(back.decompress(p, max_output_size=384) for p in parts) == text
        sizes.append(sum(map(len, parts)))
    weight = len(text) / (len(text) + 200)
    assert row[0].tolist() == [1, weight * np.tanh((sizes[0] - sizes[1]) / len(text) / 0.06), weight]
    assert row[1].tolist() == [1, 0, 0] and row[2, 1] > 0


def test_curve_finds_the_weights_that_made_the_labels():
    rng = np.random.default_rng(5)
    m = np.stack([np.ones(40000), rng.normal(0, 0.05, 40000), rng.uniform(0, 1, 40000)], axis=1)
    true = np.array([1.0, 40.0, -2.0])
    label = (rng.uniform(size=40000) < 1 / (1 + np.exp(-m @ true))).astype(float)
    assert np.abs(np.array(cq.fit_curve(m, label)) - true).max() < 1.5
    assert np.isfinite(cq.fit_curve(np.array([[1, 1.0, 1], [1, -1.0, 1]]), np.array([1.0, 0.0]))).all()


def test_defined_cases(spark, documents_of, clashing):
    rows = [(i, f"a good text number {i} about something " * (i % 7 + 1)) for i in range(60)] + [(100 + i, f"### $$$ {i} %%% " * 9) for i in range(60)]
    rows += [(300, None), (301, ""), (302, "x" * 300000), (302, "x"), (None, "a good text"), (303, "same"), (303, "same")]
    label = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(60)] + [(5, 0, 0), (302, 1, 0), (999, 1, 0), (None, 0, 0)]
    docs, labels = documents_of(rows), spark.createDataFrame(label, "doc_id long, quality int, toxic int")
    got = cq.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    of = {}
    for r in got:
        of.setdefault(r.doc_id, []).append(r.score)
    assert of[300] == of[301] and len(set(of[303])) == 1 and not [r for r in got if r.doc_id is None][0].held_out
    assert np.mean([of[i][0] for i in range(60)]) > np.mean([of[100 + i][0] for i in range(60)]) + 0.3
    assert cq.classify(documents_of([]), labels).count() == 0
    assert [r.score for r in cq.classify(documents_of(["a"]), labels.where("false")).collect()] == [pytest.approx(0.5)]
    only_good = cq.classify(docs, labels.where("quality = 1")).collect()
    assert all(r.score > 0.999 for r in only_good)
    assert cq.classify(clashing(["a", "b"]), labels).count() == 2

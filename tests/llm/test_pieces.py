from __future__ import annotations

import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model

from riskweave.llm import language_id as li
from riskweave.llm import pieces as pc
from riskweave.llm import sentence_pieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
MARK = pc.MARKER


@pytest.fixture(scope="module")
def pieces():
    return pc.load_pieces(PATH)


@pytest.fixture(scope="module")
def library(pieces):
    """The same pieces and scores in the reference library, declared as a unigram model."""
    proto = model.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = model.TrainerSpec.UNIGRAM
    for p, s in zip(proto.pieces, pieces.scores, strict=True):
        if np.isfinite(s):
            p.score = float(s)
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def texts(seed, n):
    rng = random.Random(seed)
    chars = f"the of and tion é日本🎉 \n\t  xyz0123.,'{MARK}"
    return ["", " ", "a", "  a  b ", "🎉", "\x00"] + ["".join(rng.choice(chars) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def split(ids, counts):
    ends = np.concatenate(([0], np.cumsum(counts)))
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def test_double_array_holds_the_words_and_nothing_else():
    rng = random.Random(1)
    words = {bytes(rng.choice(b"abc\xff\x00") for _ in range(rng.randint(1, 5))): i for i, _ in enumerate(range(300))}
    base, check, value = pc.double_array(words)

    def look(word):
        state = 0
        for byte in word:
            onward = base[state] + byte
            if check[onward] != state:
                return -1
            state = onward
        return value[state]

    assert all(look(w) == i for w, i in words.items())
    assert all(look(w) == words.get(w, -1) for w in (bytes(rng.choice(b"abc\xff\x00d") for _ in range(rng.randint(1, 6))) for _ in range(2000)))


def test_paths_equal_the_library(pieces, library):
    own = texts(2, 1500)
    ids, counts = sp.encode_block(own, pieces)
    score = np.append(pieces.scores, 0).astype(np.float64)
    differ = 0
    for text, got in zip(own, split(ids, counts), strict=True):
        want = library.encode(text)
        if got != want:  # only where single precision ranks equal sums differently
            differ += 1
            total = lambda x: sum(score[i] for i in x if np.isfinite(score[i]))
            assert math.isclose(total(got), total(want), rel_tol=1e-5)
    assert differ < 10


def test_decoding(pieces, library):
    own = texts(3, 400)
    ids, counts = sp.encode_block(own, pieces)
    decoded = sp.Decoder(pieces)(ids, counts)
    assert decoded == [t.replace(MARK, " ") for t in own]
    assert decoded == [library.decode(x) for x in split(ids, counts)]
    rng = random.Random(4)
    some = [[rng.randrange(259, 32000) for _ in range(12)] for _ in range(50)]
    got = sp.Decoder(pieces)(np.array(sum(some, [])), np.full(50, 12))
    assert got == [library.decode(x) for x in some]


def test_blocks_don_t_matter(pieces):
    own = texts(5, 100)
    whole = split(*sp.encode_block(own, pieces))
    assert whole == [split(*sp.encode_block([t], pieces))[0] for t in own]


def test_encoded_documents(spark, documents_of, clashing, sample):
    docs = documents_of([(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "🎉" * 3000), (5, "a" * 50000)])
    rows = sp.encode(docs, PATH)
    got = {r.doc_id: r for r in rows.collect()}
    assert got[2].ids is None and got[2].round_trip is None and got[3].ids == [] and got[3].round_trip and got[None].round_trip and got[5].round_trip and rows.count() == 6
    back = {r.doc_id: r.text for r in sp.decode(rows, PATH).collect()}
    assert back == {1: "a b", 2: None, 3: "", None: "🎉" * 3000, 5: "a" * 50000}
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in sp.encode(sample, PATH).collect())
    assert sp.encode(documents_of([]), PATH).count() == 0 and sp.encode(clashing(["a"]), PATH).count() == 1


def every_segmentation(text, chance, vocabulary, unknown):
    """Sum over all segmentations, by recursion on characters."""
    if not text:
        return 1.0
    total = 0.0
    for k in range(1, len(text) + 1):
        if text[:k] in vocabulary:
            total += chance[vocabulary[text[:k]]] * every_segmentation(text[k:], chance, vocabulary, unknown)
    if text[0] not in vocabulary:
        total += unknown * every_segmentation(text[1:], chance, vocabulary, unknown)
    return total


def test_forward_sums_all_segmentations(pieces):
    chance = li.prior(pieces)
    vocabulary = {t.decode().replace(" ", MARK): i for i, t in enumerate(pieces.texts) if np.isfinite(pieces.scores[i])}
    rng = random.Random(6)
    for text in ["the", "tion", "é🎉a", "  b"] + ["".join(rng.choice("theoniré") for _ in range(8)) for _ in range(20)]:
        runs = pc.runs_of([text], pieces)
        got = li.forward(runs, pc.lattice_of(runs, pieces), np.stack([chance, chance[::1]], axis=1))[runs.order].sum(axis=0)
        want = math.log(every_segmentation(MARK + text.replace(" ", MARK), chance, vocabulary, chance[-1]))
        assert np.allclose(got, want)


def test_long_runs_don_t_vanish(pieces):
    chance = li.prior(pieces)[:, None]
    logs = []
    for n in (1000, 2000, 4000):
        runs = pc.runs_of(["ab" * n], pieces)
        logs.append(li.forward(runs, pc.lattice_of(runs, pieces), chance)[runs.order].sum())
    assert np.isfinite(logs).all() and abs((logs[2] - logs[1]) / (logs[1] - logs[0]) - 2) < 0.01


def test_expected_pieces_add_up(pieces):
    """Expected pieces cover every byte of the runs once."""
    runs = pc.runs_of(["the nation of tion", "tion"], pieces)
    weight = np.bincount(runs.order, minlength=len(runs.start) - 1).astype(float)[:, None]
    got = li.expected_pieces(runs, pc.lattice_of(runs, pieces), li.prior(pieces), weight)[:, 0]
    length = np.array([len(t.decode().replace(" ", MARK).encode()) if not t or t[0] < 0x80 or len(t) > 1 else 1 for t in pieces.texts] + [1])
    assert math.isclose((got * length).sum(), (np.diff(runs.start) * weight[:, 0]).sum(), rel_tol=1e-9)


def piece_bytes(pieces):
    return np.array([len(t.decode().replace(" ", MARK).encode()) if not t or t[0] < 0x80 or len(t) > 1 else 1 for t in pieces.texts])


def test_expected_pieces_of_long_and_unknown_runs(pieces):
    """Lines of figures, blank lines, tabs, unknown characters and long runs are covered once, byte for byte, and stay finite."""
    chance = li.prior(pieces)
    unknown = "".join(chr(c) for c in range(0x12000, 0x12080))  # four bytes each, no pieces
    for text in ["\n".join(str(i * i) for i in range(300)), "\n" * 300, "a\tb\t" * 200, "the" + "\n" * 64 + "of" + "\t" * 64, "ab" * 20000]:
        runs = pc.runs_of([text], pieces)
        got = li.expected_pieces(runs, pc.lattice_of(runs, pieces), chance, np.bincount(runs.order, minlength=len(runs.start) - 1).astype(float)[:, None])[:, 0]
        gone = sum(c in "\n\t" for c in text)  # no pieces: one byte each, unknown
        assert np.isfinite(got).all() and (got >= 0).all() and math.isclose((got[:-1] * piece_bytes(pieces)).sum() + got[-1], len((MARK + text).encode()), rel_tol=1e-6), text[:20]
        assert math.isclose(got[-1], gone, abs_tol=1e-6)
    runs = pc.runs_of([unknown], pieces)
    got = li.expected_pieces(runs, pc.lattice_of(runs, pieces), chance, np.ones((len(runs.start) - 1, 1)))[:, 0]
    assert math.isclose(got[-1], len(unknown), rel_tol=1e-6)


def test_learning_survives_blank_lines_and_unknown_characters(pieces):
    """Such a document adds to its own language only; predictions of it and of others are numbers."""
    odd = "\n" * 300 + "\t".join("12345") + "".join(chr(c) for c in range(0x12000, 0x12060))
    learner = li.Learner(pieces)
    counts = learner.counts(["the nation of the", odd, "les nations des"], np.array([0, 0, 1]), 2)
    assert (counts >= 0).all() and (counts[:, 1] == learner.counts(["les nations des"], np.array([0]), 1)[:, 0]).all()
    model = li.Model(("en", "fr"), (counts / li.UNIT + 0.01) / (counts / li.UNIT + 0.01).sum(axis=0))
    names, scores = li.Predictor((pieces, model))([odd + "a", "les nations", "the nation of"])
    assert np.isfinite(scores).all() and names[1:] == ["fr", "en"]


def test_number_signs_are_no_letters(pieces):
    model = li.Model(("en",), np.full((len(pieces.texts) + 1, 1), 1e-5))
    texts = ["½", "²", "Ⅷ", "①", "½ ² Ⅷ ① 12 _", "½a", "é", "字"]
    assert li.Predictor((pieces, model))(texts)[0] == ["und"] * 5 + ["en"] * 3
    assert [li.has_letter(t) for t in texts] == [any(c.isalpha() for c in t) for t in texts]


def test_remembered_runs_don_t_change_a_result(pieces, sample, monkeypatch):
    texts = [r.text for r in sample.limit(120).collect()] + ["x" * 3000, "ab" * 2000, ""]
    which = np.arange(len(texts)) % 3
    learner = li.Learner(pieces)
    counts = learner.counts(texts, which, 3)
    model = li.Model(("a", "b", "c"), (counts / li.UNIT + 0.01) / (counts / li.UNIT + 0.01).sum(axis=0))
    whole = li.Predictor((pieces, model))(texts)
    monkeypatch.setattr(li, "GATHER_BYTES", 500)
    monkeypatch.setattr(li, "SLICE", 300)
    monkeypatch.setattr(li, "KNOWN_BYTES", 24 * 150)  # 150 runs
    for i in range(0, len(texts), 7):
        learner.see(texts[i : i + 7], which[i : i + 7], 3)
    assert np.abs(learner.take() - counts).max() <= 1000 < li.UNIT / 60 and learner.take() is None  # half a unit of rounding for each portion
    small, names, scores = li.Predictor((pieces, model)), [], []
    for _ in range(2):
        names, scores = [], []
        for i in range(0, len(texts), 7):
            own = small(texts[i : i + 7])
            names += own[0]
            scores += own[1].tolist()
        assert names == whole[0] and np.allclose(scores, whole[1], rtol=1e-9)


def test_languages_are_told_apart(documents_of, sample, spark):
    rows = li.identify(sample, PATH).collect()
    lang = {r.doc_id: r.lang for r in sample.collect()}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held) > 0
    from zlib import crc32

    assert {r.doc_id for r in held} == {i for i in lang if crc32(str(i).encode()) % 4 == 2}


def test_language_edges(documents_of, clashing):
    words = {"en": "the and of with", "fr": "les des pour avec"}
    docs = documents_of([(i, words[k] * 3, k, "s") for i in range(12) for k in words] + [(50, None, "en", "s"), (51, "", "fr", "s"), (52, "123 !!", None, "s"), (None, "the and of with", None, "s"), (53, "les des pour " * 20000, None, "s")])
    got = {r.doc_id: r for r in li.identify(docs, PATH).collect()}
    assert [(got[i].lang_pred, got[i].score) for i in (50, 51, 52)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "en" and got[53].lang_pred == "fr" and all(0 <= r.score <= 1 for r in got.values())
    none = li.identify(documents_of([(1, "text", None, "s")]), PATH).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert li.identify(documents_of([]), PATH).count() == 0 and li.identify(clashing(["the"]), PATH).count() == 1

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskweave.llm import token_alignment as ta

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")

HARD = [
    "plain words", " two  spaces ", "\n\nlines\n \n", "tab\there", "a▁b ▁", "naïve Straße 東京 🙂‍🙂", "<|endoftext|> <s> </s> <unk> <0x41>", "x" * 5000, " " * 3000, "\n" * 2000, "   a   b",
    "can't won't I'll", "1234567890 3.14", "\x00\x01 \x7f", " nbsp　wide line", "é é ﬁ Ⅷ ½", "ab" * 40000, ".", " ", "\r\n\r\n", "e" + "́" * 200,
]


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    from riskweave.llm.token_counts import _byte_of_char

    of = _byte_of_char()

    def tokens(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        return ids_a, ids_b, bytes_a, bytes_b

    return tokens


def ends_of(parts):
    at, out = 0, []
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def brute(rows, library):
    per, pairs = [], Counter()
    for r in rows:
        groups, links = [], []
        ids_a, ids_b, bytes_a, bytes_b = library(r.text) if r.text else ([], [], [], [])
        want = (" " + (r.text or "")).encode()
        if not r.text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            per.append((r.doc_id, 0, 0, [], []))
            continue
        at_a, at_b = dict(zip(ends_of(bytes_a), range(len(ids_a)), strict=True)), dict(zip(ends_of(bytes_b), range(len(ids_b)), strict=True))
        low_a = low_b = 0
        for end in sorted(at_a.keys() & at_b.keys()):
            i, j = at_a[end], at_b[end]
            groups.append(",".join(map(str, ids_a[low_a : i + 1])) + "|" + ",".join(map(str, ids_b[low_b : j + 1])))
            links.append((ids_a[i], ids_b[j]))
            low_a, low_b = i + 1, j + 1
        pairs.update(links)
        per.append((r.doc_id, len(ids_a), len(ids_b), groups, links))
    most = {}
    for (_, b), n in pairs.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(
        ((d, na, nb, len(g), len(k), sum(pairs[x] == most[x[1]] for x in k), sum(pairs[x] for x in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, na, nb, g, k in per), key=repr
    )


def made(docs, **settings):
    return sorted(map(tuple, ta.align(docs, A_PATH, B_PATH, **settings).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


def test_tokens_equal_the_libraries(library):
    merges, pieces = ta.Merges(open(A_PATH, encoding="utf-8").read()), ta.PieceModel(open(B_PATH, "rb").read())
    assert pieces.by_runs
    for text in HARD:
        ids_a, ids_b, _, _ = library(text)
        assert merges.encode([text])[0].tolist() == ids_a, text[:40]
        assert pieces.encode([text])[0].tolist() == ids_b, text[:40]


def test_runs_are_forgotten_but_not_lost(library, monkeypatch, sample):
    monkeypatch.setattr(ta, "KNOWN_RUNS", 5)
    pieces = ta.PieceModel(open(B_PATH, "rb").read())
    for r in sample.limit(20).collect():
        assert pieces.encode([r.text])[0].tolist() == library(r.text)[1]


@pytest.mark.parametrize("hot_pairs", [ta.HOT_PAIRS, 50, 1])
def test_equals_brute_force_whatever_is_broadcast(sample, library, hot_pairs):
    assert made(sample, hot_pairs=hot_pairs) == brute(sample.collect(), library)


@pytest.mark.parametrize("hot_pairs", [ta.HOT_PAIRS, 3])
def test_defined_cases(documents_of, clashing, library, hot_pairs, monkeypatch):
    monkeypatch.setattr(ta, "FLUSH_PAIRS", 4)
    docs = documents_of([None, "", *HARD, "plain words", "plain words", (None, "words plain")])
    assert made(docs, hot_pairs=hot_pairs) == brute(docs.collect(), library)
    assert made(documents_of([]), hot_pairs=hot_pairs) == []
    docs = clashing(["a b", "c"])
    assert made(docs, hot_pairs=hot_pairs) == brute(docs.collect(), library)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        ta.Merges(open(P.path("word_bpe_49k.json"), encoding="utf-8").read())

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskweave.llm import token_counts as tc
from riskweave.llm.textkit import blocks

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    "", " ", "  ", "\n", "'s it's 'tis don't we'll 'l 'le 're 'r a'", "a\n\nb  \n c   ", "\t\tx", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b'r<|endoftext|>e",
    "<|endoftext", "'r", "'re'ref", "!!'s x", " 's", "日本語 テスト 12３", "é́ x 　y", "a'LL", "'v e", "x\u0085y", "🎉🎉 ok", "abc" * 3000, " \n a", "\x00\x01",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return tc.compile_vocabulary(PATH)


def counted(texts, counter, limit):
    return np.concatenate([tc.count_block(t, counter) for _, _, t in blocks(pa.array(texts), limit)])


@pytest.mark.parametrize("limit", [1, 200, 1 << 20])
def test_counts_equal_the_library(vocabulary, library, limit):
    rng = random.Random(3)
    texts = HARD + ["".join(rng.choice(" \n\t'srtvlemdaXé1½²!. ") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counted(texts, tc.Counter(vocabulary), limit).tolist() == want


def test_starting_afresh_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(tc, "MAX_STATES", 50)
    texts = [f"some words number {i} nothing repeated quite like zyx{i * 7919}" for i in range(200)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counted(texts, tc.Counter(vocabulary), 300).tolist() == want


def test_scan_equals_one_chunk():
    rng = np.random.default_rng(5)
    kinds = rng.integers(0, tc.FIRST, 5000).astype(np.uint8)
    assert (tc.split_marks(kinds, 7) == tc.split_marks(kinds, 8192)).all()


def test_rows(documents_of, clashing, library):
    docs = documents_of([(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "x" * 50000)])
    got = sorted(((r.doc_id or -1), r.n_bytes, r.n_tokens, r.over_limit) for r in tc.count_tokens(docs, PATH).collect())
    long = len(library.encode("x" * 50000).ids)
    assert got == [(-1, 50000, long, True), (1, 5, 3, False), (1, 5, 3, False), (2, 0, 0, False), (3, 0, 0, False)]
    assert tc.count_tokens(documents_of([]), PATH).count() == 0
    assert tc.count_tokens(clashing(["a b"]), PATH).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_other_vocabularies_raise():
    with pytest.raises(ValueError, match="not a plain byte-level"):
        tc.compile_vocabulary(public_tokenizers.path("word_bpe_49k.json"))

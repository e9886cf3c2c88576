"""Quality rules from repetition inside a document.

Every word gets a 64-bit hash; the hash of an n-gram rolls along the words
(drop the word that leaves, add the one that enters). For each n-gram length
the windows that equal an earlier window of the text mark their words, and the
characters of all marked words, counted once, are the length's coverage; the first
occurrence is the text's own and not counted, so a sentence said twice counts once. Lines
that equal an earlier line are measured in the same way. A document is rejected
if any coverage is beyond its limit. Only ``n_repeat_words``, of the base rule, counts first occurrences too.

Defined cases: null and empty texts have no words and fail the base rule, as
every text under ``min_words`` words does; texts of any length are read whole;
repeated rows are judged each by itself; an empty table gives an empty result.
Only the id and the text column are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.textkit import Texts, Words, blocks, edges, mix64, span_hashes, words_of

SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9FB21C651E98DF25)
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True


@dataclass(frozen=True)
class Limits:
    """Shares of a text's word characters, in hundredths, beyond which it is rejected."""

    min_words: int = 50
    repeat_words: int = 50
    line_chars: int = 20
    gram_chars: Mapping[int, int] = field(default_factory=lambda: {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10})


def marked_words(hashes: np.ndarray, words: Words, n: int, first: bool) -> np.ndarray:
    """Words in an n-word window that occurs earlier in its document, or also later (``first``)."""
    count = len(hashes)
    out = np.zeros(count, dtype=bool)
    if count < n:
        return out
    # The rolling hash h[i+1] = (h[i] - w[i] * B^(n-1)) * B + w[i+n], written with running sums over B^-i, all modulo 2^64.
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    falling = np.cumprod(np.full(count, inverse, dtype=np.uint64))
    rising = np.cumprod(np.full(count, _BASE, dtype=np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * falling)))
    grams = mix64((sums[n:] - sums[:-n]) * rising[: count - n + 1])
    whole = np.flatnonzero(words.doc[: count - n + 1] == words.doc[n - 1 :])
    keyed = mix64(grams[whole] ^ mix64(words.doc[whole].astype(np.uint64)))
    order = np.argsort(keyed, kind="stable")
    same = keyed[order][1:] == keyed[order][:-1]
    twice = np.zeros(len(whole), dtype=bool)
    twice[order[1:][same]] = True
    if first:
        twice[order[:-1][same]] = True
    starts = whole[twice]
    reach = np.zeros(count + 1, dtype=np.int64)
    np.add.at(reach, starts, 1)
    np.add.at(reach, starts + n, -1)
    return np.cumsum(reach)[:count] > 0


@dataclass
class Measures:
    """Per document of a block: base counts, characters in repeated lines and in repeated n-grams."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_chars: np.ndarray
    gram_chars: dict[int, np.ndarray]


def measure(texts: Texts, lengths: tuple[int, ...]) -> Measures:
    n = len(texts)
    words = words_of(texts)
    hashes = span_hashes(texts.data, words.start, words.end)
    heads = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
    chars = heads[words.end] - heads[words.start]

    def per_doc(doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(doc, weights=weights, minlength=n).astype(np.int64)

    symbols = np.flatnonzero(_IS_SYMBOL[texts.data])
    # Lines: they end with \n or with the document.
    first, last = edges(texts)
    newline = texts.data == 0x0A
    stop = np.flatnonzero(newline | last)
    line_end = stop + ~newline[stop]
    begin = np.concatenate(([0], stop[:-1] + 1)).astype(np.int64) if len(stop) else stop
    line_of = np.searchsorted(stop, words.start)
    word_chars_of = np.bincount(line_of, weights=chars, minlength=len(stop)).astype(np.int64)
    filled = np.flatnonzero(word_chars_of > 0)
    doc = np.searchsorted(texts.offsets, begin[filled], "right") - 1
    keyed = mix64(span_hashes(texts.data, begin[filled], line_end[filled]) ^ mix64(doc.astype(np.uint64)))
    order = np.argsort(keyed, kind="stable")
    later = np.zeros(len(filled), dtype=bool)
    later[order[1:]] = keyed[order][1:] == keyed[order][:-1]
    marked = {k: marked_words(hashes, words, k, False) for k in lengths}
    return Measures(
        per_doc(words.doc),
        per_doc(words.doc, chars),
        per_doc(np.searchsorted(texts.offsets, symbols, "right") - 1),
        per_doc(doc[later]),
        per_doc(words.doc[marked_words(hashes, words, 3, True)]),
        per_doc(doc[later], word_chars_of[filled[later]]),
        {k: per_doc(words.doc[marked[k]], chars[marked[k]]) for k in lengths},
    )


BASE_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars")


def quality_columns(limits: Limits = Limits()):
    """A column function text -> struct of counts, ``dup_chars_<n>``, ``base_failed`` and ``kept``."""
    lengths = tuple(limits.gram_chars)
    fields = [*BASE_FIELDS, *(f"dup_chars_{k}" for k in lengths)]
    kind = T.StructType([T.StructField(f, T.LongType()) for f in fields] + [T.StructField(f, T.BooleanType()) for f in ("base_failed", "kept")])

    def rows(text: pa.Array) -> Iterator[dict[str, np.ndarray]]:
        for _, _, texts in blocks(text):
            m = measure(texts, lengths)
            base_failed = (m.n_words < limits.min_words) | (100 * m.n_repeat_words > limits.repeat_words * m.n_words)
            rejected = 100 * m.line_chars > limits.line_chars * m.word_chars
            for k, most in limits.gram_chars.items():
                rejected |= 100 * m.gram_chars[k] > most * m.word_chars
            yield {f: getattr(m, f) for f in BASE_FIELDS} | {f"dup_chars_{k}": m.gram_chars[k] for k in lengths} | {"base_failed": base_failed, "kept": ~(base_failed | rejected)}

    @F.arrow_udf(kind)
    def judged(text: pa.Array) -> pa.Array:
        parts = list(rows(text))
        names = [f.name for f in kind]
        arrays = [pa.array(np.concatenate([p[f] for p in parts]) if parts else [], type=pa.int64() if f in fields else pa.bool_()) for f in names]
        return pa.StructArray.from_arrays(arrays, names=names)

    return judged


def judge(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, the counts, ``base_failed`` and ``kept``."""
    return docs.select(F.col(id_col), quality_columns(limits)(F.col(text_col)).alias("judged")).select(id_col, "judged.*")


def keep(text: Column, limits: Limits = Limits()) -> Column:
    """Whether a text passes, as a column to filter by."""
    return quality_columns(limits)(text)["kept"]

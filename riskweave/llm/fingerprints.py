"""I-Match fingerprints: hashes of a document's mid-frequency terms under randomised lexicons.

The lexicon holds the terms whose share of documents lies in a band
(``low`` <= df / N <= ``high``, that is an inverse document frequency between
-ln ``high`` and -ln ``low``), counted over all documents. A document's terms in
the lexicon, distinct and sorted, are hashed once for the whole lexicon and once
for each of several random sub-lexicons, which keep every term with probability
1/2, 1/4, ... The sparse ones survive edits that change many terms, so the share
of equal hashes, among sub-lexicons that hold a term of either document, tells
how alike two documents are.

The lexicon's size is bounded whatever the corpus: a document brings each of
its distinct terms once, so at most (mean distinct terms of a document) / ``low``
terms reach the band. The bound is checked before the lexicon is broadcast.

Defined cases: null counts as empty. A text with fewer than ``least`` lexicon
terms uses all its terms instead, so it still has a fingerprint of its own;
texts without any term share the fingerprint of the empty set and are wholly
alike (1.0). Equal texts have equal fingerprints; ties and repeated rows follow
from that. An empty table gives an empty result. Only the id and the text
column are read, so other columns may have any name.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.textkit import ASCII_LOWER, PerWorker, Texts, blocks, mix64, span_hashes, words_of

#: Distinct terms counted by a task before it hands its counts on.
FLUSH_TERMS = 1 << 20


@dataclass(frozen=True)
class Band:
    """Shares of documents between which a term belongs to the lexicon."""

    low: float = 0.001
    high: float = 0.2
    least: int = 4


@dataclass(frozen=True)
class Lexicons:
    """``copies`` random sub-lexicons for each rate 1/2, 1/4, ... 1/2**``rates``."""

    rates: int = 8
    copies: int = 4
    seed: int = 20


def terms_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, term hash) of a block, sorted by both; terms are lower-cased (A-Z) words."""
    data = ASCII_LOWER[texts.data]
    words = words_of(texts)
    term = span_hashes(data, words.start, words.end)
    order = np.lexsort((term, words.doc))
    doc, term = words.doc[order], term[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    return doc[new], term[new]


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, df): documents that hold each term, summed in each task before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged() -> pa.RecordBatch:
            terms = np.concatenate([h[0] for h in held])
            counts = np.concatenate([h[1] for h in held])
            terms, place = np.unique(terms, return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(np.bincount(place, weights=counts).astype(np.int64))], names=["term", "df"])

        for batch in batches:
            for _, _, texts in blocks(batch.column(0)):
                terms, counts = np.unique(terms_of(texts)[1], return_counts=True)
                held.append((terms, counts))
                size += len(terms)
                if size > FLUSH_TERMS:
                    part = merged()
                    if 2 * len(part) > FLUSH_TERMS:
                        yield part
                        held, size = [], 0
                    else:
                        held, size = [(part.column(0).to_numpy().view(np.uint64), part.column(1).to_numpy())], len(part)
        if held:
            yield merged()

    return docs.select(text_col).mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def learn_lexicon(docs: DataFrame, band: Band = Band(), text_col: str = "text") -> np.ndarray:
    """Sorted term hashes of the band, from all documents."""
    n = docs.count()
    if not n:
        return np.zeros(0, dtype=np.uint64)
    counted = document_frequencies(docs, text_col).agg(
        F.sum("df").alias("mentions"),
        F.collect_list(F.when((F.col("df") >= band.low * n) & (F.col("df") <= band.high * n), F.col("term"))).alias("terms"),
    )
    found = counted.first()
    terms = np.sort(np.array(found["terms"], dtype=np.int64).view(np.uint64))
    if len(terms) * band.low * n > (found["mentions"] or 0):
        raise AssertionError("more lexicon terms than the counted mentions allow")
    return terms


class Fingerprinter:
    """Fingerprints of blocks of texts under one lexicon."""

    def __init__(self, lexicon: np.ndarray, band: Band, lexicons: Lexicons) -> None:
        self.lexicon, self.band = lexicon, band
        self.rates = np.repeat(np.arange(1, lexicons.rates + 1, dtype=np.uint64), lexicons.copies)
        self.salts = mix64(np.arange(len(self.rates), dtype=np.uint64) + np.uint64(lexicons.seed << 32))
        self.words = 1 + len(self.rates)

    def __call__(self, texts: Texts) -> np.ndarray:
        """A row of 32-bit hashes per document: whole lexicon first; 0 where a sub-lexicon holds none of its terms."""
        n = len(texts)
        doc, term = terms_of(texts)
        place = np.searchsorted(self.lexicon, term)
        known = np.zeros(len(term), dtype=bool)
        if len(self.lexicon):
            known = self.lexicon[np.minimum(place, len(self.lexicon) - 1)] == term
        few = np.bincount(doc[known], minlength=n) < self.band.least
        used = known | few[doc]
        doc, term = doc[used], term[used]
        out = np.zeros((n, self.words), dtype=np.uint32)
        out[:, 0] = self._hashes(doc, term, n, np.uint64(0))
        for k, (rate, salt) in enumerate(zip(self.rates, self.salts, strict=True)):
            inside = mix64(term ^ salt) >> (np.uint64(64) - rate) == 0
            out[:, k + 1] = self._hashes(doc[inside], term[inside], n, salt)
        return out

    @staticmethod
    def _hashes(doc: np.ndarray, term: np.ndarray, n: int, salt: np.uint64) -> np.ndarray:
        """Hash of each document's sorted terms; 0 for none."""
        out = np.zeros(n, dtype=np.uint32)
        if not len(doc):
            return out
        starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        length = np.diff(np.concatenate((starts, [len(doc)])))
        within = np.arange(len(doc)) - np.repeat(starts, length)
        powers = np.cumprod(np.full(int(length.max()), 0xD6E8FEB86659FD93, dtype=np.uint64))
        sums = mix64(np.add.reduceat(mix64(term) * powers[within], starts) ^ salt)
        out[doc[starts]] = np.maximum(sums >> np.uint64(32), 1).astype(np.uint32)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal hashes among the lexicons that hold a term of either document; 1 if none does."""
    held = (a != 0) | (b != 0)
    count = held.sum(axis=1)
    return np.where(count, ((a == b) & held).sum(axis=1) / np.maximum(count, 1), 1.0)


def hex_rows(hashes: np.ndarray) -> pa.Array:
    """Each row as one lowercase hex string."""
    width = hashes.shape[1] * 8
    raw = hashes.astype(">u4").tobytes().hex().encode()
    offsets = np.arange(len(hashes) + 1, dtype=np.int32) * width
    return pa.StringArray.from_buffers(len(hashes), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw))


def _fingerprinter(docs: DataFrame, band: Band, lexicons: Lexicons, text_col: str) -> PerWorker:
    lexicon = learn_lexicon(docs, band, text_col)
    return PerWorker(docs.sparkSession, lexicon, functools.partial(Fingerprinter, band=band, lexicons=lexicons))


def fingerprint(docs: DataFrame, band: Band = Band(), lexicons: Lexicons = Lexicons(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``fingerprint``."""
    maker = _fingerprinter(docs, band, lexicons, text_col)

    @F.arrow_udf("string")
    def made(text: pa.Array) -> pa.Array:
        parts = [hex_rows(maker.get()(texts)) for _, _, texts in blocks(text)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return docs.select(id_col, made(F.col(text_col)).alias("fingerprint"))


def edited_text(own: str, other: str) -> str:
    """``own`` with its last half (rounded down) replaced by the first as many characters of ``other``."""
    half = len(own) // 2
    return own[: len(own) - half] + other[:half]


def _cuts(docs: DataFrame, id_col: str, parts: int) -> np.ndarray:
    """Ids that cut the rows into at most ``parts`` ranges of about the same size; a range ends with its cut."""
    if parts < 2:
        return np.zeros(0, dtype=np.int64)
    found = docs.agg(F.percentile_approx(id_col, [i / parts for i in range(1, parts)], 20 * parts)).first()[0]
    return np.array(sorted(set(found or [])), dtype=np.int64)


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, guest): a partition for each id range, by descending id; last comes, as guest, the row after it.

    There are as many ranges as shuffle partitions. The driver knows the cuts
    and the largest id of each range, nothing more; the texts are shuffled once.
    """
    spark = docs.sparkSession
    cuts = _cuts(docs, id_col, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    lowest = -(1 << 63)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, ids.fill_null(lowest).to_numpy(zero_copy_only=False)).astype(np.int32))

    id_of = F.col(id_col).cast("long")
    heads = docs.select(id_of.alias("id")).groupBy(range_of("id").alias("at")).agg(F.max(F.coalesce("id", F.lit(lowest))).alias("head")).orderBy(F.desc("at")).collect()
    head = {r["at"]: r["head"] for r in heads}
    part = {r["at"]: i for i, r in enumerate(heads)}

    @F.arrow_udf("array<int>")
    def sent_to(ids: pa.Array) -> pa.Array:
        ids = ids.fill_null(lowest).to_numpy(zero_copy_only=False)
        out = []
        for i, at in zip(ids.tolist(), np.searchsorted(cuts, ids).tolist(), strict=True):
            own = part[at]
            out.append([2 * own, 2 * ((own - 1) % len(part)) + 1] if i == head[at] else [2 * own])
        return pa.array(out, pa.list_(pa.int32()))

    rows = docs.select(id_of.alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).select("id", "text", F.explode(sent_to("id")).alias("to"))
    return (
        rows.select("id", "text", (F.col("to") % 2 == 1).alias("guest"), F.expr("to div 2").cast("int").alias("part"))
        .repartitionById(max(1, len(part)), F.col("part"))
        .select("id", "text", "guest")
        .sortWithinPartitions("guest", F.desc_nulls_last("id"), F.xxhash64("text"))
    )


def compare_edited(docs: DataFrame, band: Band = Band(), lexicons: Lexicons = Lexicons(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its edited text and its next document in descending id order (after the last: the first).

    Rows of one id follow each other by a hash of their text; null ids come
    last; a single row is its own next. Each partition is read as a stream that
    holds one block and the row before it.
    """
    maker = _fingerprinter(docs, band, lexicons, text_col)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = maker.get()
        held: tuple[list, list, np.ndarray] | None = None  # the row whose next hasn't come yet
        for batch in batches:
            for low, high, texts in blocks(batch.column(1)):
                ids, own, guests = (batch.column(k).slice(low, high - low).to_pylist() for k in range(3))
                prints = make(texts)
                if True in guests:  # the first of the guests is the row after this range
                    stop = guests.index(True) + 1
                    ids, own, prints = ids[:stop], own[:stop], prints[:stop]
                if held:
                    ids, own, prints = held[0] + ids, held[1] + own, np.concatenate((held[2], prints))
                if len(ids) > 1:
                    edited = pa.array([edited_text(a, b) for a, b in zip(own, own[1:], strict=False)], pa.string())
                    other = np.concatenate([make(t) for _, _, t in blocks(edited)])
                    columns = {
                        id_col: pa.array(ids[:-1], pa.int64()),
                        "n_chars": pa.array([len(t) for t in own[:-1]], pa.int64()),
                        "edited_sha256": pa.array([hashlib.sha256(t.as_py().encode()).hexdigest() for t in edited], pa.string()),
                        "fingerprint": hex_rows(prints[:-1]),
                        "edited_fingerprint": hex_rows(other),
                        "near_edited": pa.array(likeness(prints[:-1], other)),
                        "near_next": pa.array(likeness(prints[:-1], prints[1:])),
                    }
                    yield pa.RecordBatch.from_pydict(columns)
                if True in guests:
                    return
                held = (ids[-1:], own[-1:], prints[-1:])

    schema = f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _in_order(docs, id_col, text_col).mapInArrow(compared, schema)

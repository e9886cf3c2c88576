"""Encoding into unigram pieces by Viterbi search, and decoding.

The best path is the one with the largest sum of log probabilities over the
lattice of all pieces that match; of equal paths the one found first from the
left stays, as in the reference library for such models. Characters without a
piece are spelled with byte pieces. Distances are kept for all distinct runs of a
block together: step i settles every run's border i bytes in.

Defined cases: a null text has null pieces; the empty text has none; U+2581 in
a text counts as a space, so it decodes to one. Texts of any length are encoded
whole; repeated rows are encoded each by itself; an empty table gives an empty
result. Other columns are untouched and may have any name. Decoding drops the
one space before the text and shows invalid UTF-8 as U+FFFD.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.pieces import MARKER, Lattice, Pieces, Runs, lattice_of, load_pieces, runs_of
from riskweave.llm.textkit import PerWorker, blocks

BLOCK = 1 << 19


def best_paths(runs: Runs, lattice: Lattice, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(edge ids run by run in text order, number of edges of each run)."""
    n = len(runs.start) - 1
    score = np.where(lattice.piece >= 0, pieces.scores[lattice.piece], pieces.unknown_score).astype(np.float32)
    best = np.full(len(runs.data) + n, -np.inf, dtype=np.float32)
    back = np.full(len(best), -1, dtype=np.int64)
    begin = runs.start[:-1] + np.arange(n)
    best[begin] = 0
    for low, high in zip(lattice.steps[:-1], lattice.steps[1:], strict=True):
        target = lattice.target[low:high]
        reached = best[lattice.source[low:high]] + score[low:high]
        # An unreachable source stays at -inf, which beats nothing.
        better = np.flatnonzero(reached > best[target])
        best[target[better]] = reached[better]
        back[target[better]] = low + better
    node, active, steps = runs.start[1:] + np.arange(n), np.arange(n), []
    while len(active):
        edge = back[node]
        steps.append((active, edge))
        node = lattice.source[edge]
        more = node != begin[active]
        node, active = node[more], active[more]
    if not steps:
        return np.zeros(0, np.int64), np.zeros(n, np.int64)
    run = np.concatenate([s[0] for s in steps])[::-1]
    edge = np.concatenate([s[1] for s in steps])[::-1]
    order = np.argsort(run, kind="stable")
    return edge[order], np.bincount(run, minlength=n)


def spans_joined(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... for each span, one after the other."""
    place = np.concatenate(([0], np.cumsum(length)))
    return np.repeat(first - place[:-1], length) + np.arange(place[-1])


def encode_block(texts: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, ids of each text)."""
    runs = runs_of(texts, pieces)
    n = len(runs.start) - 1
    if not n:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    lattice = lattice_of(runs, pieces)
    edge, per_run = best_paths(runs, lattice, pieces)
    piece, run = lattice.piece[edge], lattice.run[edge]
    begin, width = lattice.source[edge] - run, lattice.target[edge] - lattice.source[edge]
    unknown = piece < 0
    fallback = bool((pieces.byte_ids >= 0).all())
    count = np.where(unknown & fallback, width, 1)
    ids = np.repeat(piece, count)
    spelled = np.repeat(unknown, count)
    if fallback:
        ids[spelled] = pieces.byte_ids[runs.data[spans_joined(begin[unknown], width[unknown])]]
    else:
        ids[spelled] = pieces.unknown_id
    ids_per_run = np.bincount(run, weights=count, minlength=n).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(ids_per_run)))[:-1]
    every = ids[spans_joined(first[runs.order], ids_per_run[runs.order])]
    return every.astype(np.int32), np.bincount(runs.doc, weights=ids_per_run[runs.order], minlength=len(texts)).astype(np.int64)


class Decoder:
    """Turns ids back into text."""

    def __init__(self, pieces: Pieces) -> None:
        self.blob = np.frombuffer(b"".join(pieces.texts), dtype=np.uint8)
        self.length = np.array([len(t) for t in pieces.texts], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.length)))[:-1]

    def __call__(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        width = self.length[ids]
        data = self.blob[spans_joined(self.first[ids], width)].tobytes()
        ends = np.concatenate(([0], np.cumsum(width)))[np.concatenate(([0], np.cumsum(counts)))]
        out = []
        for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            own = data[low:high].decode("utf-8", "replace")
            out.append(own[1:] if own.startswith(" ") else own)
        return out


class Codec:
    def __init__(self, pieces: Pieces) -> None:
        self.pieces, self.decode = pieces, Decoder(pieces)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return encode_block(texts, self.pieces)


ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_byte_pieces", T.LongType()), T.StructField("round_trip", T.BooleanType())])


def _list_array(ids: np.ndarray, counts: np.ndarray, valid: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32), mask=np.concatenate((~valid, [False])))
    return pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))


def encoder(spark: SparkSession, path: str):
    """A column function text -> (ids, n_byte_pieces, round_trip: whether the ids decode to the text)."""
    codec = PerWorker(spark, load_pieces(path), Codec)

    @F.arrow_udf(ENCODED)
    def column(text: pa.Array) -> pa.Array:
        c, parts = codec.get(), []
        byte = np.zeros(len(c.pieces.texts), dtype=bool)
        byte[c.pieces.byte_ids[c.pieces.byte_ids >= 0]] = True
        for low, high, _ in blocks(text, BLOCK):
            own = text.slice(low, high - low).to_pylist()
            ids, counts = c.encode([t or "" for t in own])
            back = c.decode(ids, counts)
            same = [None if t is None else t.replace(MARKER, " ") == b for t, b in zip(own, back, strict=True)]
            doc = np.repeat(np.arange(len(own)), counts)
            spelled = np.bincount(doc[byte[ids]], minlength=len(own)).astype(np.int64)
            parts.append([_list_array(ids, counts, np.array([t is not None for t in own])), pa.array(spelled), pa.array(same, pa.bool_())])
        if not parts:
            parts = [[pa.array([], f) for f in (pa.list_(pa.int32()), pa.int64(), pa.bool_())]]
        return pa.StructArray.from_arrays([pa.concat_arrays(x) for x in zip(*parts, strict=True)], names=[f.name for f in ENCODED])

    return column


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ids, n_pieces, n_byte_pieces, round_trip."""
    made = docs.select(F.col(id_col), encoder(docs.sparkSession, path)(F.col(text_col)).alias("made"))
    return made.select(id_col, "made.ids", F.coalesce(F.size("made.ids"), F.lit(0)).cast("long").alias("n_pieces"), "made.n_byte_pieces", "made.round_trip")


def decode(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` with ``text_col`` decoded from ``ids_col``; null ids give a null text."""
    codec = PerWorker(rows.sparkSession, load_pieces(path), Codec)

    @F.arrow_udf("string")
    def column(ids: pa.Array) -> pa.Array:
        counts = np.array([len(x) if x.is_valid else 0 for x in ids], dtype=np.int64)
        texts = codec.get().decode(ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
        return pa.array([t if x.is_valid else None for t, x in zip(texts, ids, strict=True)], pa.string())

    return rows.withColumn(text_col, column(F.col(ids_col)))

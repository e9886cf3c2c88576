"""Whole texts of an Arrow batch as byte arrays: blocks, words and word hashes.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which is the
same as ``[^\\x20\\x09-\\x0D]+`` on the characters of UTF-8 text. Words never
reach across documents. All functions take any number of documents, also none.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

BLOCK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[ord("A") : ord("Z") + 1] += 32

_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix64(np.arange(256, dtype=np.uint64))


class Texts(NamedTuple):
    """``data`` holds the UTF-8 bytes of all documents, document i in ``offsets[i]:offsets[i + 1]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


_made: dict[str, Any] = {}


class PerWorker:
    """An object that each Python worker makes from a broadcast value when it first needs it."""

    def __init__(self, spark: SparkSession, value: Any, make: Callable[[Any], Any]) -> None:
        self.key, self.shared, self.make = uuid.uuid4().hex, spark.sparkContext.broadcast(value), make

    def get(self) -> Any:
        if self.key not in _made:
            if len(_made) > 3:  # workers live on from job to job
                _made.clear()
            _made[self.key] = self.make(self.shared.value)
        return _made[self.key]


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a text column; a null counts as the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, row after the last, texts) of runs of rows with about ``limit`` bytes, one row at least."""
    whole = texts_of(column)
    first, n = 0, len(whole)
    while first < n:
        last = int(np.searchsorted(whole.offsets, whole.offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        low, high = whole.offsets[first], whole.offsets[last]
        yield first, last, Texts(whole.data[low:high], whole.offsets[first : last + 1] - low)
        first = last


def edges(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the first and the last byte of every non-empty document."""
    first = np.zeros(len(texts.data), dtype=bool)
    last = np.zeros(len(texts.data), dtype=bool)
    filled = texts.offsets[1:] > texts.offsets[:-1]
    first[texts.offsets[:-1][filled]] = True
    last[texts.offsets[1:][filled] - 1] = True
    return first, last


def words_of(texts: Texts) -> Words:
    solid = ~IS_SPACE[texts.data]
    first, last = edges(texts)
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    start = np.flatnonzero(solid & (first | ~before))
    end = np.flatnonzero(solid & (last | ~after)) + 1
    return Words(start, end, np.searchsorted(texts.offsets, start, "right") - 1)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each span of bytes; spans follow each other and don't overlap, none is empty."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    length = end - start
    place = np.concatenate(([0], np.cumsum(length)[:-1]))
    within = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(place, length)
    powers = np.cumprod(np.full(int(length.max()), _POWER, dtype=np.uint64))
    codes = _BYTE_CODES[data[np.repeat(start, length) + within]] * powers[within]
    return mix64(np.add.reduceat(codes, place) + length.astype(np.uint64))


def code_points(texts: Texts) -> np.ndarray:
    """Code points in each document."""
    heads = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
    return heads[texts.offsets[1:]] - heads[texts.offsets[:-1]]

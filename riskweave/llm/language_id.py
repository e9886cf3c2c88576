"""Language identification by piece unigrams, summed over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary.
A text's probability in a language is the sum over all ways to cut it into
pieces, found by the forward algorithm on the lattice of matching pieces: the
sum reaching a border is the sum over the pieces that end there. Runs that no
piece reaches across are independent, so their logarithms add up. Each worker
remembers the logarithms of up to ``KNOWN_BYTES`` of distinct runs, so a run's
lattice is built when it is first met, in portions that fit a processor's cache.

Learning is one step of expectation maximisation from the vocabulary's own
scores: forward and backward sums give how often each piece is expected in each
language's texts, over all labelled documents given, in whole units of 2^-16 so
that sums don't depend on their order; ``smoothing`` counts are added per piece. A task
counts its distinct runs by language first and takes the sums once for each run.
The model's size is languages x vocabulary; more than ``MAX_LANGUAGES`` raise.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as
every text is where nothing could be learned; ties go to the first language in
alphabetical order. Texts and runs of any length are read whole, in learning
too. Repeated rows are each predicted and each learned from. Only the named
columns are read, so others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.pieces import Lattice, Pieces, Runs, bytes_at, lattice_of, load_pieces, runs_of, slices
from riskweave.llm.textkit import PerWorker, blocks

UND = "und"
MAX_LANGUAGES = 512
UNIT = 1 << 16
#: Bytes of a run after which sums are brought back to a middle size (an unknown character costs up to e^33).
RESCALE = 16
#: Bytes of text taken at once, and of runs whose sums are taken at once.
BLOCK, SLICE = 1 << 20, 1 << 17
#: Bytes of logarithms a worker remembers, and of distinct runs that learning gathers before it takes their sums.
KNOWN_BYTES, GATHER_BYTES = 1 << 25, 1 << 22
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    """``chances[p, l]``: probability of piece p in language l; the last row is that of an unknown character."""

    languages: tuple[str, ...]
    chances: np.ndarray


def prior(pieces: Pieces) -> np.ndarray:
    """The vocabulary's own probabilities, with that of an unknown character at the end."""
    return np.exp(np.append(pieces.scores, pieces.unknown_score).astype(np.float64))


def forward(runs: Runs, lattice: Lattice, chances: np.ndarray) -> np.ndarray:
    """Log probability of each run (rows) under each column of ``chances``."""
    n, languages = len(runs.start) - 1, chances.shape[1]
    begin, end = runs.start[:-1] + np.arange(n), runs.start[1:] + np.arange(n)
    length = end - begin
    sums = np.zeros((len(runs.data) + n, languages))
    sums[begin] = 1
    scale = np.zeros((n, languages))
    longest = _longest(lattice)
    for step, (low, high) in enumerate(zip(lattice.steps[:-1], lattice.steps[1:], strict=True)):
        if step and step % RESCALE == 0:
            _rescale(sums, scale, begin, length, step, longest)
        # Edges of one step end at different borders, so no two add to the same place.
        target = lattice.target[low:high]
        sums[target] += sums[lattice.source[low:high]] * chances[lattice.piece[low:high]]
    with np.errstate(divide="ignore"):
        return np.log(sums[end]) + scale


def _longest(lattice: Lattice) -> int:
    return int((lattice.target - lattice.source).max(initial=1))


def _borders(begin: np.ndarray, length: np.ndarray, run: np.ndarray, step: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the runs' borders from ``step`` to ``step + reach`` or the end, and how many each run has."""
    count = np.minimum(length[run], step + reach) - step + 1
    first = np.cumsum(count) - count
    return np.repeat(begin[run] + step - first, count) + np.arange(count.sum()), count


def _rescale(sums: np.ndarray, scale: np.ndarray, begin: np.ndarray, length: np.ndarray, step: int, longest: int) -> np.ndarray:
    """Divides the borders from ``step`` on, as far as a piece reaches, by their largest sum; those before have done their part. Returns the runs."""
    run = np.flatnonzero(length > step)
    node, count = _borders(begin, length, run, step, longest)
    most = np.maximum.reduceat(sums[node], np.cumsum(count) - count, axis=0)
    most[most == 0] = 1
    sums[node] /= np.repeat(most, count, axis=0)
    scale[run] += np.log(most)
    return run


def expected_pieces(runs: Runs, lattice: Lattice, chance: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected count of each piece per column of ``weight`` (run x language: how often a run occurs)."""
    n = len(runs.start) - 1
    begin, end = runs.start[:-1] + np.arange(n), runs.start[1:] + np.arange(n)
    length, longest = end - begin, _longest(lattice)
    p = chance[lattice.piece] * 16.0 ** (lattice.target - lattice.source)  # keeps products of short runs in range
    ahead, behind = np.zeros(len(runs.data) + n), np.zeros(len(runs.data) + n)
    scale, node_scale = np.zeros(n), np.zeros(len(ahead))
    ahead[begin] = 1
    steps = list(zip(lattice.steps[:-1], lattice.steps[1:], strict=True))
    for step, (low, high) in enumerate(steps):
        if step and step % RESCALE == 0:
            run = _rescale(ahead, scale, begin, length, step, longest)
            node, count = _borders(begin, length, run, step, RESCALE + longest)
            node_scale[node] = np.repeat(scale[run], count)
        ahead[lattice.target[low:high]] += ahead[lattice.source[low:high]] * p[low:high]
    # With a piece's chance in the scales of its two borders, the way back needs no scales of its own: ahead * behind is the chance of a border.
    across = np.flatnonzero(node_scale[lattice.source] != node_scale[lattice.target])
    source, target = lattice.source[across], lattice.target[across]
    p[across] = np.where(ahead[source] > 0, np.exp(np.log(p[across]) + node_scale[source] - node_scale[target]), 0)
    behind[end] = 1 / ahead[end]
    for low, high in reversed(steps):
        np.add.at(behind, lattice.source[low:high], behind[lattice.target[low:high]] * p[low:high])
    share = ahead[lattice.source] * p * behind[lattice.target]
    return np.stack([np.bincount(lattice.piece % len(chance), weights=share * w[lattice.run], minlength=len(chance)) for w in weight.T], axis=1)


class Slots:
    """Places of 64-bit keys, in the order in which they were added."""

    def __init__(self) -> None:
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 for a new one."""
        at = np.searchsorted(self.keys, keys)
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] == keys[hit]
        out = np.full(len(keys), -1, np.int64)
        out[hit] = self.places[at[hit]]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Adds new keys, which ascend."""
        at = np.searchsorted(self.keys, keys)
        self.keys, self.places = np.insert(self.keys, at, keys), np.insert(self.places, at, np.arange(len(keys)) + len(self.places))


class Learner:
    """Expected pieces of the texts seen since the last ``take``."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces, self.chance = pieces, prior(pieces)
        self._begin()

    def _begin(self) -> None:
        self.slots, self.seen, self.weights, self.size, self.total = Slots(), [], [], 0, None

    def see(self, texts: list[str], language: np.ndarray, languages: int) -> None:
        runs = runs_of([t.lower() for t in texts], self.pieces)
        n = len(runs.key)
        weight = np.bincount(runs.order * languages + language[runs.doc], minlength=n * languages).reshape(n, languages)
        place = self.slots.find(runs.key)
        new, old = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
        if len(old):
            held = np.concatenate(self.weights) if len(self.weights) > 1 else self.weights[0]
            held[place[old]] += weight[old]
            self.weights = [held]
        data, start = bytes_at(runs.data, runs.start[new], np.diff(runs.start)[new])
        self.slots.add(runs.key[new])
        self.seen.append((data, np.diff(start), runs.key[new]))
        self.weights.append(weight[new])
        self.size += len(data)
        if self.size > GATHER_BYTES:
            self.total = self._summed()
            self.slots, self.seen, self.weights, self.size = Slots(), [], [], 0

    def _summed(self) -> np.ndarray | None:
        if not self.seen:
            return self.total
        data, length, key = (np.concatenate(x) for x in zip(*self.seen, strict=True))
        weight = np.concatenate(self.weights).astype(np.float64)
        none = np.zeros(0, np.int64)
        runs, total = Runs(data, np.concatenate(([0], np.cumsum(length))), none, none, key), self.total
        for first, last, own in slices(runs, np.arange(len(key)), SLICE):
            counts = np.rint(expected_pieces(own, lattice_of(own, self.pieces), self.chance, weight[first:last]) * UNIT).astype(np.int64)
            total = counts if total is None else total + counts
        return total

    def take(self) -> np.ndarray | None:
        total = self._summed()
        self._begin()
        return total

    def counts(self, texts: list[str], language: np.ndarray, languages: int) -> np.ndarray:
        """Units of each piece per language in these texts alone."""
        self._begin()
        self.see(texts, language, languages)
        total = self.take()
        return np.zeros((len(self.chance), languages), np.int64) if total is None else total


def learn(docs: DataFrame, path: str, smoothing: float = 0.01, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits the model on all rows with a text and a language."""
    spark = docs.sparkSession
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    languages = sorted(r[0] for r in labelled.select(lang_col).distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    pieces = load_pieces(path)
    learner = PerWorker(spark, pieces, Learner)
    place = {name: i for i, name in enumerate(languages)}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = learner.get()
        own.take()  # what a task that failed has left
        for batch in batches:
            for low, high, _ in blocks(batch.column(0), BLOCK):
                which = np.array([place[x] for x in batch.column(1).slice(low, high - low).to_pylist()])
                own.see(batch.column(0).slice(low, high - low).to_pylist(), which, len(languages))
        total = own.take()
        if total is not None:
            piece, language = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(language), pa.array(total[piece, language])], names=["piece", "language", "units"])

    rows = labelled.select(text_col, lang_col).mapInArrow(counted, "piece long, language long, units long").groupBy("piece", "language").agg(F.sum("units").alias("units"))
    table = rows.toArrow()  # vocabulary x languages at most
    counts = np.full((len(pieces.texts) + 1, len(languages)), smoothing)
    counts[table["piece"].to_numpy(), table["language"].to_numpy()] += table["units"].to_numpy() / UNIT
    return Model(tuple(languages), counts / counts.sum(axis=0))


def has_letter(text: str) -> bool:
    """Number signs such as a half or a Roman eight are no letters."""
    return any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text))


class Predictor:
    def __init__(self, made: tuple[Pieces, Model]) -> None:
        self.pieces, self.model = made
        self.most = KNOWN_BYTES // (8 * max(1, len(self.model.languages)))
        self._forget()

    def _forget(self) -> None:
        self.slots, self.known = Slots(), np.zeros((self.most, len(self.model.languages)))

    def _per_run(self, runs: Runs) -> np.ndarray:
        """Log probability of each distinct run in every language."""
        place = self.slots.find(runs.key)
        new, old = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
        out = np.empty((len(runs.key), len(self.model.languages)))
        out[old] = self.known[place[old]]
        for first, last, own in slices(runs, new, SLICE):
            out[new[first:last]] = forward(own, lattice_of(own, self.pieces), self.model.chances)
        if len(self.slots) + len(new) > self.most:
            self._forget()
        if len(new) <= self.most:
            self.known[len(self.slots) : len(self.slots) + len(new)] = out[new]
            self.slots.add(runs.key[new])
        return out

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        wanted = np.array([t is not None and has_letter(t) for t in texts], dtype=bool) & bool(self.model.languages)
        names, scores = [UND] * len(texts), np.zeros(len(texts))
        runs = runs_of([t.lower() if w else "" for t, w in zip(texts, wanted, strict=True)], self.pieces)
        if not len(runs.order):
            return names, scores
        per_run = self._per_run(runs)[runs.order]
        total = np.stack([np.bincount(runs.doc, weights=c, minlength=len(texts)) for c in per_run.T], axis=1)
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for i in np.flatnonzero(wanted):
            names[i], scores[i] = self.model.languages[best[i]], share[i]
        return names, scores


PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predictor(spark: SparkSession, path: str, model: Model):
    """A column function text -> (lang_pred, score: the language's share of the summed probabilities)."""
    shared = PerWorker(spark, (load_pieces(path), model), Predictor)

    @F.arrow_udf(PREDICTED)
    def column(text: pa.Array) -> pa.Array:
        names, scores = [], [np.zeros(0)]
        for low, high, _ in blocks(text, BLOCK):
            own, share = shared.get()(text.slice(low, high - low).to_pylist())
            names += own
            scores.append(share)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores))], names=["lang_pred", "score"])

    return column


def held_out(id_col: str = "doc_id"):
    """A quarter of the documents by a checksum of their id; a null id is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: ``id_col``, held_out, lang_pred, score; learned from the labelled documents not held out."""
    model = learn(docs.where(~held_out(id_col)), path, text_col=text_col, lang_col=lang_col)
    guess = predictor(docs.sparkSession, path, model)(F.col(text_col)).alias("guess")
    return docs.select(F.col(id_col), held_out(id_col).alias("held_out"), guess).select(id_col, "held_out", "guess.*")

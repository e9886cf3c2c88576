"""Quality by compression: which of two dictionaries, of good and of bad texts, makes a text shorter.

A zstandard dictionary is built from pieces of good labelled texts and one from
bad ones. A text is cut into pieces of ``PIECE`` bytes, so that the dictionary counts
all through it and not at its beginning only, and all pieces are compressed with
both. The difference of the two sums over the text's bytes, bent so that large
differences count alike (tanh, ``BEND``) and brought to its evidence n / (n + ``HALF``)
for a text of n bytes, becomes the probability of a good label by a logistic curve,
fitted on labelled texts that no dictionary has seen. Few bytes say little, so the
shorter a text the closer it is to the curve's middle.

Learning takes bounded samples, the same on every run: the ``texts`` labelled
documents of each kind with the smallest hashes of their ids for the dictionaries, of each
``PIECES_PER_TEXT`` pieces spread evenly over the whole text, and ``calibration`` others for the
curve. Scoring reads all texts whole.

Defined cases: a null text counts as an empty one, which gets the curve's value
for no evidence; a document with labels that differ is not learned from, neither
is one without an id; a document that occurs more than once is learned from once
(its smallest text); without labelled texts of both kinds every score is the share of good labels, or 0.5
without labels; repeated rows get the same score; an empty table gives an empty
result. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.staging import Staged
from riskweave.llm.textkit import PerWorker, blocks

PIECE = 384
#: Bytes at which a text's difference has half its weight.
HALF = 200
#: Difference per byte beyond which more says little more.
BEND = 0.06
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
PIECES_PER_TEXT = 64


def pieces_of(data: bytes) -> list[bytes]:
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


def spread(pieces: list[bytes]) -> list[bytes]:
    """At most ``PIECES_PER_TEXT`` of them, evenly over the text."""
    n = len(pieces)
    return pieces if n <= PIECES_PER_TEXT else [pieces[i * n // PIECES_PER_TEXT] for i in range(PIECES_PER_TEXT)]


def dictionary(samples: list[bytes]) -> tuple[bytes, bool]:
    """(content, whether it is a trained dictionary): too few samples are taken as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, threads=0).as_bytes(), True
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:], False


@dataclass(frozen=True)
class Model:
    """``bad`` and ``good``: dictionaries, None where nothing could be learned; ``curve``: weights of 1, weighed difference and evidence."""

    bad: tuple[bytes, bool] | None
    good: tuple[bytes, bool] | None
    curve: tuple[float, float, float]

    def scores(self, measures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(measures @ np.array(self.curve), -700, 700)))


class Measure:
    """Rows (1, weighed difference, evidence) of texts: positive differences are shorter with the good dictionary."""

    def __init__(self, made: tuple) -> None:
        self.sides = []
        for content, trained in made:
            kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
            held = zstandard.ZstdCompressionDict(content, dict_type=kind)
            self.sides.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        rows = np.zeros((len(texts), 3))
        rows[:, 0] = 1
        for i, data in enumerate(texts):
            if data:
                pieces = pieces_of(data)
                bad, good = (sum(len(side.compress(p)) for p in pieces) for side in self.sides)
                evidence = len(data) / (len(data) + HALF)
                rows[i, 1:] = evidence * np.tanh((bad - good) / len(data) / BEND), evidence
        return rows


def fit_curve(measures: np.ndarray, label: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, with a small ridge so that it ends also where the labels can be told apart wholly."""
    weights = np.zeros(3)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(measures @ weights, -700, 700)))
        slope = measures.T @ (label - p) - ridge * weights
        step = np.linalg.solve((measures * (p * (1 - p))[:, None]).T @ measures + ridge * np.eye(3), slope)
        weights += step
        if np.abs(step).max() < 1e-10:
            break
    return tuple(weights.tolist())


def held_out(id_col: str = "doc_id") -> Column:
    """A fifth of the documents by a checksum of their id; a null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _bytes_of(column: pa.Array, low: int, high: int) -> list[bytes]:
    return [t or b"" for t in column.slice(low, high - low).cast(pa.binary()).to_pylist()]


def sample(docs: DataFrame, labels: DataFrame, texts: int, calibration: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """_label, _role (0, 1: dictionary of that label, 2: curve), _hash, _text of the documents that are learned from."""
    one = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull())
    one = one.groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other")).where("_label = _other").drop("_other")
    one = one.join(docs.select(F.col(id_col).alias("_id")), "_id", "left_semi").withColumn("_hash", F.xxhash64(F.col("_id").cast("string")))
    curve = F.pmod(F.xxhash64(F.lit("curve"), F.col("_id").cast("string")), F.lit(4)) == 0
    kinds = [(one.where(~curve & (F.col("_label") == k)), k, texts) for k in (0, 1)] + [(one.where(curve), 2, calibration)]
    picked = [rows.orderBy("_hash", "_id").limit(most).withColumn("_role", F.lit(role)) for rows, role, most in kinds]
    chosen = picked[0].unionByName(picked[1]).unionByName(picked[2])
    found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")  # 2 * texts + calibration rows at most
    return found.groupBy("_id", "_role", "_label", "_hash").agg(F.min("_text").alias("_text")).drop("_id")


def learn(
    docs: DataFrame, labels: DataFrame, texts: int = 800, calibration: int = 2000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Model:
    """Fits the model on ``docs``; ``texts`` documents per dictionary and ``calibration`` for the curve are learned from at most."""
    rows = Staged(docs.sparkSession, "compression").write(sample(docs, labels, texts, calibration, id_col, text_col, label_col), "sample")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, _ in blocks(batch.column(2)):
                parts = [spread(pieces_of(t)) for t in _bytes_of(batch.column(2), low, high)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), pa.array(parts, pa.list_(pa.binary()))], names=["_role", "_hash", "pieces"])

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by("_hash")
        content, trained = dictionary([p for parts in table["pieces"].to_pylist() for p in parts])
        return pa.table({"_role": table["_role"][:1], "content": pa.array([content]), "trained": pa.array([trained])})

    pieces = rows.where("_role < 2").select("_role", "_hash", "_text").mapInArrow(cut, "_role int, _hash long, pieces array<binary>")
    made = {r["_role"]: (bytes(r["content"]), r["trained"]) for r in pieces.groupBy("_role").applyInArrow(train, "_role int, content binary, trained boolean").collect()}
    good = rows.where("_role = 2").select("_label", "_text")
    if len(made) < 2 or not all(content for content, _ in made.values()):
        share = rows.agg(F.avg("_label")).first()[0]
        share = min(max(0.5 if share is None else share, 1e-9), 1 - 1e-9)
        return Model(None, None, (float(np.log(share / (1 - share))), 0.0, 0.0))
    shared = PerWorker(docs.sparkSession, (made[0], made[1]), Measure)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, _ in blocks(batch.column(1)):
                m = shared.get()(_bytes_of(batch.column(1), low, high))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(m[:, 1]), pa.array(m[:, 2])], names=["_label", "difference", "evidence"])

    table = good.mapInArrow(measured, "_label int, difference double, evidence double").toArrow()  # ``calibration`` rows at most
    table = table.sort_by([(c, "ascending") for c in table.column_names])
    measures = np.stack([np.ones(len(table)), table["difference"].to_numpy(), table["evidence"].to_numpy()], axis=1)
    return Model(made[0], made[1], fit_curve(measures, table["_label"].to_numpy().astype(float)))


def scorer(spark: SparkSession, model: Model):
    """A column function text -> probability of a good label."""
    shared = PerWorker(spark, model, lambda m: (m, Measure((m.bad, m.good)) if m.good else None))

    @F.arrow_udf("double")
    def column(text: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for low, high, _ in blocks(text):
            held, measure = shared.get()
            texts = _bytes_of(text, low, high)
            out.append(held.scores(measure(texts) if measure else np.tile([1.0, 0.0, 0.0], (len(texts), 1))))
        return pa.array(np.concatenate(out))

    return column


def classify(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, texts: int = 800, calibration: int = 2000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """One row per document: ``id_col``, held_out, score, predicted; learned from the labelled documents not held out."""
    model = learn(docs, labels.where(~held_out(id_col)), texts, calibration, id_col, text_col, label_col)
    scored = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), scorer(docs.sparkSession, model)(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

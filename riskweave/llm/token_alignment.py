"""Alignment of two tokenizers: where their tokens end together, and how often which pairs do.

A byte-level merge vocabulary (A) and a piece vocabulary (B) encode the same
text, with one space before it, so the bytes of both token rows are the same and
byte offsets are comparable. All steps inside a task run on Arrow columns: token
lists are flattened with their parents' indices, byte lengths are looked up and
summed up within each document, and a hash join on (document, end) finds the
tokens that end together. Each such link closes a group of tokens of both sides.

Links of a document are kept as counted pairs in a table in the shared folder.
Tasks group them by pair and Spark adds the partial counts up; the corpus-wide
counts then go back to the documents in two ways that together are exact: the
``HOT_PAIRS`` most frequent pairs as a broadcast array of that size at most, all
others by a join on the pair. The pair table grows with the vocabularies, not with
the documents; a pair that stands in every document is among the hot ones.

B's tokens never reach across a space that follows another character, so the
pieces of a run are looked up in a table of runs met before in that worker; a
model for which this doesn't hold encodes whole texts.

Defined cases: a text that is null, empty, or for which the joined bytes of either
side differ from the text's has no tokens: zeros and '' for the groups; texts of any length
are read whole; repeated rows each count; a tie for a piece's best partner counts
for all that share it; an empty table gives an empty result. Only the named
columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.staging import Staged
from riskweave.llm.textkit import PerWorker, blocks
from riskweave.llm.token_counts import _byte_of_char

#: Pairs whose counts are broadcast.
HOT_PAIRS = 1 << 17
#: Runs a worker remembers, and the characters of one up to which it is worth remembering.
KNOWN_RUNS, KNOWN_CHARS = 1 << 18, 64
#: Pairs a task gathers before it hands partial counts on.
FLUSH_PAIRS = 1 << 20
#: What byte-level merges are confined to (fixed value of the vocabulary's kind).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_RUN = re.compile(" +[^ ]*|[^ ]+")
_MARKER = "▁"


class Merges:
    """Vocabulary A: ids and bytes of the tokens of " " + text; special tokens' strings are plain text."""

    def __init__(self, content: str) -> None:
        import tiktoken

        model = json.loads(content)
        vocab, of_char = model["model"]["vocab"], _byte_of_char()
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["model"]["merges"]]
        if made != sorted(made) or model.get("normalizer") or model["pre_tokenizer"]["type"] != "ByteLevel" or model["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a byte-level vocabulary whose ids are in the order of its merges")
        special = {t["content"] for t in model.get("added_tokens", []) if t.get("special")}
        self.bytes_of = {i: bytes(of_char[c] for c in token) for token, i in vocab.items() if token not in special}
        self.encoding = tiktoken.Encoding("merges", pat_str=SPLIT, mergeable_ranks={b: i for i, b in self.bytes_of.items()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.encoding.encode_ordinary(" " + t), dtype=np.int32) for t in texts]


class PieceModel:
    """Vocabulary B: ids and bytes of a text's pieces; the model puts the space before it."""

    def __init__(self, content: bytes) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        model.ParseFromString(content)
        kind = proto.ModelProto.SentencePiece
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.bytes_of = {i: bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else p.piece.replace(_MARKER, " ").encode() if p.type in (kind.NORMAL, kind.USER_DEFINED) else b"" for i, p in enumerate(model.pieces)}
        spec = model.normalizer_spec
        self.by_runs = spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap and not any(
            p.type == kind.USER_DEFINED or (p.type == kind.NORMAL and re.search(f"[^{_MARKER}]{_MARKER}", p.piece)) for p in model.pieces
        )
        self.lone = self.processor.piece_to_id(_MARKER)
        self.known: dict[str, list[int]] = {}

    def _run(self, run: str) -> list[int]:
        ids = self.processor.encode(run[1:]) if len(run) > 1 else [self.lone]
        if len(run) <= KNOWN_CHARS:
            if len(self.known) >= KNOWN_RUNS:
                self.known.clear()
            self.known[run] = ids
        return ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_runs:
            return [np.array(ids, dtype=np.int32) for ids in self.processor.encode(texts, num_threads=1)]
        out, known = [], self.known
        for text in texts:
            if _MARKER in text:  # a marker in the text is a space to the model
                out.append(np.array(self.processor.encode(text), dtype=np.int32))
                continue
            ids: list[int] = []
            for run in _RUN.findall(" " + text):
                ids += known.get(run) or self._run(run)
            out.append(np.array(ids, dtype=np.int32))
        return out


class Side(NamedTuple):
    ids: pa.Array
    parents: pa.Array
    ends: pa.Array


class Aligner:
    def __init__(self, content: tuple[str, bytes]) -> None:
        self.sides = (Merges(content[0]), PieceModel(content[1]))
        self.tables = []
        for side in self.sides:
            size = max(side.bytes_of) + 1
            of = pa.array([side.bytes_of.get(i, b"") for i in range(size)], pa.large_binary())
            self.tables.append((of, pc.binary_length(of).cast(pa.int64()), pa.array([str(i) for i in range(size)])))

    def _encoded(self, texts: list[str]) -> tuple[list[pa.ListArray], np.ndarray]:
        """Token lists of both sides, and which texts have the bytes of " " + text on both."""
        wanted = [b" " + t.encode() for t in texts]
        lists, same = [], np.ones(len(texts), dtype=bool)
        for side, (of, _, _) in zip(self.sides, self.tables, strict=True):
            rows = side.encode(texts)
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
            ids = pa.array(np.concatenate([np.zeros(0, np.int32), *rows]))
            taken = of.take(ids)
            _, starts, data = taken.buffers()
            at = np.frombuffer(starts, np.int64)[offsets]
            raw = data.to_pybytes() if data is not None else b""
            same &= np.array([raw[at[i] : at[i + 1]] == w for i, w in enumerate(wanted)], dtype=bool)
            lists.append(pa.ListArray.from_arrays(pa.array(offsets), ids))
        return lists, same

    def _side(self, lists: pa.ListArray, lengths: pa.Array) -> Side:
        ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
        # Segmented sum: the running total less what it was where the document began.
        total = pc.cumulative_sum(lengths.take(ids))
        upto = np.concatenate(([0], total.to_numpy()))[lists.offsets.to_numpy()[:-1]]
        return Side(ids, parents, pc.subtract(total, pa.array(upto).take(parents)))

    def __call__(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray], list[str], pa.Table]:
        """Per text: counts and the digest of its groups; and the table (doc, a, b, n) of its linked pairs."""
        counts = {c: np.zeros(len(texts), dtype=np.int64) for c in ("n_a", "n_b", "n_groups")}
        digests = [""] * len(texts)
        some = np.array([i for i, t in enumerate(texts) if t], dtype=np.int64)
        lists, same = self._encoded([texts[i] for i in some])
        some, lists = some[same], [x.filter(pa.array(same)) for x in lists]
        a, b = (self._side(x, table[1]) for x, table in zip(lists, self.tables, strict=True))
        # One key per document and end. Both sides end every document at the same byte, so ends stay below the stride.
        stride = (pc.max(a.ends).as_py() or 0) + 1

        def keyed(side: Side, name: str) -> pa.Table:
            key = pc.add(pc.multiply(side.parents.cast(pa.int64()), stride), side.ends)
            return pa.table({"key": key, name: side.ids, f"at_{name}": pa.array(np.arange(len(key)))})

        links = keyed(a, "a").join(keyed(b, "b"), "key", join_type="inner", use_threads=False).sort_by("key")
        doc = pc.divide(links["key"], stride)
        pairs = pa.table({"doc": pa.chunked_array([pa.array(some)]).take(doc), "a": links["a"], "b": links["b"]}).group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")])
        counts["n_a"][some], counts["n_b"][some] = (pc.list_value_length(x).to_numpy() for x in lists)
        counts["n_groups"][some] = np.bincount(doc.to_numpy(), minlength=len(some))
        sides = []
        for side, name, (_, _, names) in ((a, "a", self.tables[0]), (b, "b", self.tables[1])):
            offsets = pa.array(np.concatenate(([0], links[f"at_{name}"].to_numpy() + 1)).astype(np.int32))
            sides.append(pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(side.ids)), ","))
        groups = pc.binary_join_element_wise(*sides, "|")
        ends = np.concatenate(([0], np.cumsum(counts["n_groups"][some]))).astype(np.int32)
        for i, text in zip(some, pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), groups), ";").to_pylist(), strict=True):
            digests[i] = hashlib.sha256(text.encode()).hexdigest()
        return counts, digests, pairs


_LISTS = "a array<int>, b array<int>, n array<int>"


def _pair_lists(pairs: pa.Table, n_docs: int) -> list[pa.Array]:
    """The table's pairs as one list per document, in the order of pairs."""
    pairs = pairs.sort_by([("doc", "ascending"), ("a", "ascending"), ("b", "ascending")])
    ends = np.concatenate(([0], np.cumsum(np.bincount(pairs["doc"].to_numpy(), minlength=n_docs)))).astype(np.int32)
    columns = (pairs["a"], pairs["b"], pairs["count_all"].cast(pa.int32()))
    return [pa.ListArray.from_arrays(pa.array(ends), c.combine_chunks()) for c in columns]


def encoded(docs: DataFrame, merges_path: str, pieces_path: str, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``_id``, counts, groups_sha256 and its linked pairs as lists a, b, n."""
    shared = PerWorker(docs.sparkSession, (Path(merges_path).read_text(encoding="utf-8"), Path(pieces_path).read_bytes()), Aligner)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, _ in blocks(batch.column(1)):
                counts, digests, pairs = shared.get()(batch.column(1).slice(low, high - low).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), *map(pa.array, counts.values()), pa.array(digests, pa.string()), *_pair_lists(pairs, high - low)],
                    names=["_id", *counts, "groups_sha256", "a", "b", "n"],
                )

    return rows.mapInArrow(align, f"_id {dict(rows.dtypes)['_id']}, n_a long, n_b long, n_groups long, groups_sha256 string, {_LISTS}")


def _flat(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Table]:
    """(row of each pair in the batch, table a, b, n)."""
    lists = batch.column("a")
    return pc.list_parent_indices(lists), pa.table({c: pc.list_flatten(batch.column(c)) for c in "abn"})


def _merged(held: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(held).group_by(["a", "b"], use_threads=False).aggregate([("n_sum", "sum")]).rename_columns(["a", "b", "n_sum"])


def pair_counts(rows: DataFrame) -> DataFrame:
    """a, b, count: occurrences of each linked pair in all documents; and whether it is its b's highest."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(_flat(batch)[1].group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]))
            if sum(map(len, held)) > FLUSH_PAIRS:
                held = [_merged(held)]
                if len(held[0]) > FLUSH_PAIRS // 2:
                    yield from held[0].rename_columns(["a", "b", "n"]).to_batches()
                    held = []
        if held:
            yield from _merged(held).rename_columns(["a", "b", "n"]).to_batches()

    summed = rows.select("a", "b", "n").mapInArrow(partial, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("count"))
    # As many rows per b as A has tokens, at most.
    return summed.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def align(
    docs: DataFrame, merges_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """One row per document: ``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    staged = Staged(docs.sparkSession, "alignment")
    rows = encoded(docs, merges_path, pieces_path, id_col, text_col).withColumn("_row", F.monotonically_increasing_id())
    rows = staged.write(rows, "documents")
    pairs = staged.write(pair_counts(rows), "pairs")
    hot = pairs.orderBy(F.desc("count"), "a", "b").limit(hot_pairs).toArrow()
    all_hot = len(hot) < hot_pairs or pairs.count() == hot_pairs
    shared = PerWorker(docs.sparkSession, hot, _Hot)
    schema = f"_row long, _id {dict(rows.dtypes)['_id']}, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long, {_LISTS}"
    made = rows.mapInArrow(_looked_up(shared), schema)
    if not all_hot:
        made = staged.write(made, "partly")
        rare = made.where(F.size("a") > 0).select("_row", F.inline(F.arrays_zip("a", "b", "n")))
        rare = rare.join(pairs, ["a", "b"]).groupBy("_row").agg(
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("rare_best"), F.sum(F.col("n") * F.col("count")).alias("rare_sum")
        )
        made = made.join(rare, "_row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("rare_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("rare_sum", F.lit(0)),
        })
    return made.select(F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")


class _Hot:
    """Counts of the most frequent pairs, found by hash lookup."""

    def __init__(self, table: pa.Table) -> None:
        self.keys = pc.add(pc.multiply(table["a"].cast(pa.int64()), 1 << 32), table["b"].cast(pa.int64())).combine_chunks()
        # The last entry is what place -1 finds.
        self.count, self.best = (np.append(table[c].to_numpy().astype(np.int64), 0) for c in ("count", "best"))

    def find(self, pairs: pa.Table) -> np.ndarray:
        """Place of each pair, -1 for one that isn't here."""
        keys = pc.add(pc.multiply(pairs["a"].cast(pa.int64()), 1 << 32), pairs["b"].cast(pa.int64()))
        return pc.fill_null(pc.index_in(keys, value_set=self.keys), -1).to_numpy()


def _per_row(values: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Sums of values whose rows ascend."""
    upto, ends = np.concatenate(([0], np.cumsum(values))), np.cumsum(np.bincount(row, minlength=n_rows))
    return np.diff(upto[np.concatenate(([0], ends))])


def _looked_up(shared: PerWorker):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hot, (parent, pairs) = shared.get(), _flat(batch)
            place, row, n = hot.find(pairs), parent.to_numpy(), pairs["n"].to_numpy().astype(np.int64)
            known = place >= 0
            best, total = (_per_row(np.where(known, n * values[place], 0), row, batch.num_rows) for values in (hot.best, hot.count))
            rest = pairs.filter(pa.array(~known))
            ends = np.concatenate(([0], np.cumsum(np.bincount(row[~known], minlength=batch.num_rows)))).astype(np.int32)
            kept = [batch.column(c) for c in ("_row", "_id", "n_a", "n_b", "n_groups", "groups_sha256")]
            lists = [pa.ListArray.from_arrays(pa.array(ends), rest[c].combine_chunks()) for c in "abn"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(best), pa.array(total), *lists], names=["_row", "_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_best", "count_sum", "a", "b", "n"])

    return run

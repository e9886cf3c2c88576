"""A Merkle manifest of a table: a tree of three-fold hashes per source, and one over the sources' roots.

Rows are numbered within their source by a range sort whose counts per range
are added up, so no source has to fit one task. Aligned builders then take
3^``LEVELS`` consecutive nodes each and append digests to a log in the order in
which nodes are completed: a run of three closes into its parent at once. A
builder's log is a row of its own; the roots of the builders of one source are
the leaves of the next tier, until one builder holds them all.

In such a log a node's position needs no search: it is the sum of the sizes of
the subtrees before it (a subtree of height k has (3^(k+1) - 1) / 2 nodes), plus
its own size, less one. Proofs are read off the logs from the top tier down: the
siblings of a node stand at closed-form positions, and what lies above a builder
is the same for all its leaves.

Hashes are SHA-256 in lowercase hex; a parent is the hash of its children's hex
texts, one after the other.

Defined cases: a null value enters its leaf as ``-``; rows without an order value
come first in their source, rows without a source are the first source; rows that
are wholly equal get neighbouring places in any order, which gives the same table;
texts of any length are hashed whole; an only leaf is its source's root and an
only source's root is the root of all; an empty table gives an empty result. Only
the named columns are read, so others may have any name.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.staging import Staged
from riskweave.session import shuffle_width

FAN = 3
#: Levels that one builder makes: 2187 leaves.
LEVELS = 7
#: Rows of (range, source) counts up to which they are broadcast; counted first, joined otherwise.
SPAN_ROWS = 1 << 17


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


# Positions in a builder's log.


def subtree(height: int, leaves: int) -> int:
    """Nodes of a subtree of that height over so many leaves, of which the last run may be short at every level."""
    return sum(-(-leaves // FAN**k) for k in range(height + 1))


def before(leaves: np.ndarray) -> np.ndarray:
    """Nodes that are complete when so many leaves (an array) have been appended: one full subtree for each unit of each base-3 digit."""
    left, total, size = np.asarray(leaves, dtype=np.int64), np.zeros(np.shape(leaves), dtype=np.int64), 1
    while left.any():
        total += left % FAN * size
        left, size = left // FAN, size * FAN + 1
    return total


def positions(level: int, n: int) -> np.ndarray:
    """Places in the log of all nodes of a level, over n leaves."""
    first = np.arange(-(-n // FAN**level), dtype=np.int64) * FAN**level
    sizes = np.full(len(first), subtree(level, FAN**level), dtype=np.int64)
    sizes[-1:] = subtree(level, n - int(first[-1])) if len(first) else 0
    return before(first) + sizes - 1


def height_of(n: int) -> int:
    """Levels above n leaves until one node remains."""
    height = 0
    while n > 1:
        n, height = -(-n // FAN), height + 1
    return height


def append_all(leaves: Sequence[str], height: int) -> list[str]:
    """The log of a builder: digests in the order of completion, up to ``height``."""
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(height + 1)]

    def close(level: int) -> None:
        node = digest_of("".join(open_runs[level]))
        open_runs[level].clear()
        log.append(node)
        open_runs[level + 1].append(node)

    for one in leaves:
        log.append(one)
        open_runs[0].append(one)
        level = 0
        while level < height and len(open_runs[level]) == FAN:
            close(level)
            level += 1
    for level in range(height):
        if open_runs[level]:
            close(level)
    return log


Path = tuple[tuple[str, str], ...]


def walk(log: Sequence[str], n: int, height: int, above: Path) -> list[Path]:
    """For each leaf of a log the siblings left and right of its way up, level by level, and then ``above``."""
    paths = [above]
    for level in range(height - 1, -1, -1):
        row = [log[p] for p in positions(level, n)]
        lower: list[Path] = []
        for j in range(len(row)):
            run = j - j % FAN
            lower.append((("".join(row[run:j]), "".join(row[j + 1 : run + FAN])), *paths[j // FAN]))
        paths = lower
    return paths


def folded(digest: str, path: Path) -> str:
    for left, right in path:
        digest = digest_of(left + digest + right)
    return digest


# The tables.


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str], staged: Staged, name: str) -> DataFrame:
    """``rows`` with ``place`` (0.. within ``keys``, by ``order``, nulls first) and ``total``, without gathering a key's rows in one task."""
    ranged = rows.repartitionByRange(shuffle_width(rows.sparkSession), *keys, *order).sortWithinPartitions(*keys, *order)
    ranged = staged.write(ranged.withColumns({"part": F.spark_partition_id(), "serial": F.monotonically_increasing_id()}), name)
    counted = ranged.groupBy("part", *keys).agg(F.min("serial").alias("first"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*keys)
    ahead = F.coalesce(F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = staged.write(counted.withColumns({"ahead": ahead, "total": F.sum("n").over(group)}), f"{name}-spans")
    small = spans.limit(SPAN_ROWS + 1).count() <= SPAN_ROWS
    other = spans.select(F.col("part").alias("_part"), *[F.col(k).alias(f"_{k}") for k in keys], "first", "ahead", "total")
    same = F.col("part") == F.col("_part")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = ranged.join(F.broadcast(other) if small else other, same)
    return joined.withColumn("place", F.col("serial") - F.col("first") + F.col("ahead")).select(*rows.columns, "place", "total")


def _pack(digests: Sequence[str]) -> bytes:
    return bytes.fromhex("".join(digests))


def _unpack(log: bytes) -> list[str]:
    text = log.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _height(total: int, n: int, levels: int) -> int:
    """An only builder stops at one node; one of several is filled up to its level."""
    return height_of(n) if total <= FAN**levels else levels


def build(rows: DataFrame, key: str, id_col: str, staged: Staged, name: str, levels: int) -> list[DataFrame]:
    """Logs of all builders, one table per tier: ``key``, block, total, n, ids, log, altered, root.

    ``rows`` has ``key``, place, total, ``id_col``, digest and altered (null where the digest is to be proven as it is).
    """
    reach = FAN**levels
    kind, own = dict(rows.dtypes)[key], dict(rows.dtypes)[id_col]
    schema = f"`{key}` {kind}, block long, total long, n long, ids array<{own}>, log binary, altered array<binary>, root string"

    def builder(group: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        leaves, total = [d.hex() for d in table["digest"].to_pylist()], table["total"][0].as_py()
        log = append_all(leaves, _height(total, len(leaves), levels))
        head, block = (g.as_py() for g in group)
        made = {key: [head], "block": [block], "total": [total], "n": [len(leaves)], "ids": [table[id_col].to_pylist()], "log": [_pack(log)], "altered": [table["altered"].to_pylist()], "root": [log[-1]]}
        types = {key: table[key].type, "block": pa.int64(), "total": pa.int64(), "n": pa.int64(), "ids": pa.list_(table[id_col].type), "log": pa.binary(), "altered": pa.list_(pa.binary()), "root": pa.string()}
        return pa.table({c: pa.array(v, types[c]) for c, v in made.items()})

    tiers = []
    while True:
        blocks = rows.select(key, id_col, "place", "total", "digest", "altered").withColumn("block", F.floor(F.col("place") / reach))
        tiers.append(staged.write(blocks.groupBy(key, "block").applyInArrow(builder, schema), f"{name}-log{len(tiers)}"))
        more = tiers[-1].where(F.col("total") > reach)
        if more.isEmpty():
            return tiers
        rows = more.select(
            key, F.lit(None).cast(own).alias(id_col), F.col("block").alias("place"), F.ceil(F.col("total") / reach).alias("total"),
            F.unhex("root").alias("digest"), F.lit(None).cast("binary").alias("altered"),
        )


def tree_roots(tiers: Sequence[DataFrame], key: str, levels: int) -> DataFrame:
    """``key``, root of its tree."""
    return functools.reduce(DataFrame.unionByName, [t.where(F.col("total") <= FAN**levels).select(key, "root") for t in tiers])


def _with_way(logs: DataFrame, above: DataFrame, key: str) -> DataFrame:
    other = above.select(F.col(key).alias("_key"), F.col("place").alias("_place"), "way_left", "way_right", "subroot", "top")
    return logs.drop("root").join(other, F.col(key).eqNullSafe(F.col("_key")) & (F.col("block") == F.col("_place"))).drop("_key", "_place")


def _opened(batch: pa.RecordBatch, levels: int) -> Iterator[tuple[dict, list[str], list[Path]]]:
    for row in batch.to_pylist():
        log = _unpack(row["log"])
        leaves = [log[p] for p in positions(0, row["n"])]
        yield row, leaves, walk(log, row["n"], _height(row["total"], row["n"], levels), tuple(zip(row["way_left"], row["way_right"], strict=True)))


def _id_type(logs: DataFrame) -> str:
    return dict(logs.dtypes)["ids"].removeprefix("array<").removesuffix(">")


def ways(logs: DataFrame, key: str, levels: int) -> DataFrame:
    """The way up from every leaf of logs that know the way up from their roots: ``key``, place, id, digest, way_left, way_right, subroot, top."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, leaves, paths in _opened(batch, levels):
                n = len(leaves)
                sides = [pa.array([[step[side] for step in p] for p in paths], pa.list_(pa.string())) for side in (0, 1)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row[key]] * n, batch.schema.field(key).type), pa.array(np.arange(n) + row["block"] * FAN**levels),
                    pa.array(row["ids"], batch.schema.field("ids").type.value_type), pa.array(leaves, pa.string()), *sides,
                    pa.array([row["subroot"]] * n, pa.string()), pa.array([row["top"]] * n, pa.string()),
                ], names=[key, "place", "id", "digest", "way_left", "way_right", "subroot", "top"])

    schema = f"`{key}` {dict(logs.dtypes)[key]}, place long, id {_id_type(logs)}, digest string, way_left array<string>, way_right array<string>, subroot string, top string"
    return logs.mapInArrow(extract, schema)


def descend(tiers: Sequence[DataFrame], start: DataFrame, key: str, staged: Staged, name: str, levels: int) -> DataFrame:
    """Logs of the lowest tier with the way up from their roots. ``start``: the way up from each tree's root, as place 0."""
    reach = FAN**levels
    logs = _with_way(tiers[-1], start, key)
    for tier in range(len(tiers) - 2, -1, -1):
        upper = staged.write(ways(logs, key, levels), f"{name}-ways{tier}")
        logs = _with_way(tiers[tier].where(F.col("total") <= reach), start, key).unionByName(_with_way(tiers[tier].where(F.col("total") > reach), upper, key))
    return logs


def prove(logs: DataFrame, id_col: str, levels: int) -> DataFrame:
    """One row per leaf: ``id_col``, leaf, subroot, root, proof_sha256, folded_root, verified."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, leaves, paths in _opened(batch, levels):
                proofs = [digest_of("".join(left + right for left, right in p)) for p in paths]
                ends = [folded(a.hex() if a is not None else d, p) for d, a, p in zip(leaves, row["altered"], paths, strict=True)]
                n, top = len(leaves), row["top"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["ids"], batch.schema.field("ids").type.value_type), pa.array(leaves, pa.string()), pa.array([row["subroot"]] * n, pa.string()),
                    pa.array([top] * n, pa.string()), pa.array(proofs, pa.string()), pa.array(ends, pa.string()), pa.array([e == top for e in ends]),
                ], names=[id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return logs.mapInArrow(extract, f"`{id_col}` {_id_type(logs)}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def altered_rows(id_col: str) -> Column:
    """Every row whose id's checksum is even; a null id is left alone."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))


def manifest(
    docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), source: str = "source", id_col: str = "doc_id",
    altered: dict[str, Column] | None = None, where: Column | None = None, levels: int = LEVELS,
) -> DataFrame:
    """Leaf, roots and proof of every row, and the root that the row's altered form folds to.

    ``altered`` has the columns that tampering changes, ``where`` the rows that it changes; without them rows are folded as they are.
    """
    staged = Staged(docs.sparkSession, "manifest")
    changed = {c: (altered or {}).get(c, F.col(c)) for c in columns}
    other = F.when(where, F.unhex(leaf(list(changed.values())))) if altered and where is not None else F.lit(None).cast("binary")
    rows = docs.select(
        F.col(source).alias("_source"), F.col(id_col).alias("_id"), F.unhex(leaf([F.col(c) for c in columns])).alias("digest"), other.alias("altered"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = staged.write(rows, "leaves")
    placed = numbered(rows, ["_source"], ["_id", "digest", "_row"], staged, "places")
    tiers = build(placed, "_source", "_id", staged, "source", levels)
    tops = tree_roots(tiers, "_source", levels).select("_source", F.unhex("root").alias("digest"), F.lit(0).alias("_all"), F.lit(None).cast("binary").alias("altered"))
    heads = build(numbered(tops, ["_all"], ["_source"], staged, "sources"), "_all", "_source", staged, "all", levels)
    none = F.array().cast("array<string>")
    root = tree_roots(heads, "_all", levels).select(
        "_all", F.lit(0).cast("long").alias("place"), none.alias("way_left"), none.alias("way_right"), F.lit(None).cast("string").alias("subroot"), F.col("root").alias("top")
    )
    logs = descend(heads, root, "_all", staged, "all", levels)
    sources = staged.write(ways(logs, "_all", levels).select(F.col("id").alias("_source"), F.lit(0).cast("long").alias("place"), "way_left", "way_right", F.col("digest").alias("subroot"), "top"), "source-ways")
    return prove(descend(tiers, sources, "_source", staged, "source", levels), id_col, levels)

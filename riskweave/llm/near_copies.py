"""Near-duplicate groups from bottom-k sketches of word shingles.

One hash function gives every shingle a 64-bit value; a document's sketch keeps
the ``keep`` smallest. Documents of equal shingle sets form a class at once,
and one document of each class goes on:

1. *Hubs.* Among the documents that retain one of their first values in common,
   the smallest and the largest id are hubs. Documents that share at least half
   of these values with a hub are compared with it. That ties large groups
   together with a number of pairs in proportion to the documents.
2. *Inverted lists.* Linked documents (similarity s) share s * keep retained
   values on average, and fewer than ``need`` (half of ``keep`` and one) with a
   chance under 1e-7 at s = 0.8 and keep = 64 (never where the sets are small
   enough to be kept whole). So of a document's values, ordered by how many
   documents retain them, rarest first, it is enough to look up the first
   ``size - need + 1``: a partner that shares ``need`` values shares one of those.
   Values that only one group retains need no lookup at all, and a list yields
   only pairs across groups. Lists of up to ``SHORT_LIST`` askers yield their
   pairs; whoever asks in a longer one is looked up once more by the whole set,
   where the same order gives exact bounds: at place i of n a pair can still
   share n - i values, and has to share percent / (100 + percent) of both sets.
   No list is cut and no partner dropped.
3. *Estimate.* A short list's rows carry the union sketch in brief: two bits of
   the smallest value in each of 128 ranges of the same hash. A range differs only
   if its smallest value in the union is in one set alone, so the number of ranges that
   differ tells the similarity; pairs beyond ``SIGMAS`` deviations of what the
   least similarity gives never leave the list. For those that do, the ``keep``
   smallest values of the union of both sketches are a random sample of the
   union of the sets; pairs under ``need`` common values in it go.
4. *Proof.* The full sets of the remaining pairs are built from the texts and
   compared exactly; only these links count.

Groups are the connected components of the links. Documents whose id is null
can't be named as anyone's copy: they link with nothing, have a null component
and are kept. Rows that repeat an id are one document and share a component.
Texts without words (null, empty, white space) have no shingles and link with
nothing; texts with fewer words than a shingle are one shingle; long texts are
read whole; an empty table gives an empty result. Only the id and the text
column are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.components import components
from riskweave.llm.staging import BROADCAST_ROWS, Staged
from riskweave.llm.textkit import ASCII_LOWER, Texts, blocks, mix64, span_hashes, words_of

#: Values of a sketch that are looked at for hubs.
HUB_VALUES = 8
#: Hash ranges of the brief sketch, and deviations beyond which a pair is none.
RANGES, SIGMAS = 128, 5.5
#: Askers of a list up to which its pairs are compared as they are.
SHORT_LIST = 16
#: Sets of most rows whose first document is broadcast.
LARGE_SETS = 1 << 17


@dataclass(frozen=True)
class Settings:
    """Words of a shingle, least similarity in hundredths, values kept in a sketch."""

    words: int = 5
    percent: int = 80
    keep: int = 64


def shingle_sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of each distinct shingle of a block, sorted by both; hashes as signed integers."""
    words = words_of(texts)
    hashes = span_hashes(ASCII_LOWER[texts.data], words.start, words.end)
    count = np.bincount(words.doc, minlength=len(texts))
    factors = mix64(np.arange(1, size + 1, dtype=np.uint64) << np.uint64(32)) | np.uint64(1)
    n = max(0, len(hashes) - size + 1)
    whole = np.flatnonzero(words.doc[:n] == words.doc[size - 1 :]) if n else np.zeros(0, np.int64)
    sums = np.zeros(len(whole), dtype=np.uint64)
    for k in range(size):
        sums += mix64(hashes[whole + k]) * factors[k]
    docs, values = [words.doc[whole]], [mix64(sums)]
    first = np.concatenate(([0], np.cumsum(count)))
    for doc in np.flatnonzero((count > 0) & (count < size)):  # the whole sequence is one shingle
        own = mix64(hashes[first[doc] : first[doc + 1]]) * factors[: count[doc]]
        docs.append(np.array([doc]))
        values.append(mix64(own.sum(keepdims=True) + np.uint64(count[doc])))
    doc, value = np.concatenate(docs), np.concatenate(values).view(np.int64)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def _lists(doc: np.ndarray, value: np.ndarray, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))).astype(np.int32)), pa.array(value))


def range_bits(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the smallest value in each hash range of each set, as two planes of 64-bit words; 0 for an empty range."""
    bucket = value & (RANGES - 1)
    _, first = np.unique(doc * RANGES + bucket, return_index=True)
    planes = []
    for bit in (9, 10):
        plane = np.zeros((n, RANGES), dtype=bool)
        plane[doc[first], bucket[first]] = (value[first] >> bit) & 1
        planes.append(np.packbits(plane, axis=1).view(np.int64))
    return planes[0], planes[1]


def differing_ranges(size: Column, settings: Settings) -> Column:
    """Ranges in which two sets with ``size`` values together can differ at the least similarity.

    With u values in the union, b ranges are filled; the smallest value of one
    is in one set alone with chance 1 - s (b drawn out of u), and then its two bits differ
    in three of four cases.
    """
    apart = 1 - settings.percent / 100
    union = size / (2 - apart)
    filled = RANGES * (1 - F.exp(-union / RANGES))
    drawn = filled * (apart * (1 - apart)) * F.greatest(F.lit(0.0), 1 - filled / union)
    return filled * (0.75 * apart) + SIGMAS * F.sqrt(0.5625 * drawn + filled * (0.1875 * apart)) + 1


SKETCH = T.StructType([
    T.StructField("n_shingles", T.LongType()), T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
    T.StructField("sketch", T.ArrayType(T.LongType())), T.StructField("bits_a", T.ArrayType(T.LongType())), T.StructField("bits_b", T.ArrayType(T.LongType())),
])


def sketch_column(settings: Settings):
    """A column function text -> (set size, 128-bit digest of the set, sketch in ascending order)."""

    def sketched(texts: Texts) -> list[pa.Array]:
        n = len(texts)
        doc, value = shingle_sets(texts, settings.words)
        sizes = np.bincount(doc, minlength=n)
        first = np.concatenate(([0], np.cumsum(sizes)))
        digests = np.zeros((n, 2), dtype=np.int64)
        for i in range(n):
            digests[i] = np.frombuffer(hashlib.blake2b(value[first[i] : first[i + 1]].tobytes(), digest_size=16).digest(), dtype=np.int64)
        low = np.arange(len(doc)) - first[doc] < settings.keep
        words = np.arange(n + 1, dtype=np.int32) * (RANGES // 64)
        planes = [pa.ListArray.from_arrays(pa.array(words), pa.array(p.reshape(-1))) for p in range_bits(doc, value, n)]
        return [pa.array(sizes.astype(np.int64)), pa.array(digests[:, 0]), pa.array(digests[:, 1]), _lists(doc[low], value[low], n), *planes]

    @F.arrow_udf(SKETCH)
    def column(text: pa.Array) -> pa.Array:
        parts = [sketched(texts) for _, _, texts in blocks(text)] or [sketched(Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64)))]
        return pa.StructArray.from_arrays([pa.concat_arrays(x) for x in zip(*parts, strict=True)], names=[f.name for f in SKETCH])

    return column


def set_column(settings: Settings):
    """A column function text -> its whole shingle set."""

    def made(text: pa.Array) -> Iterator[pa.Array]:
        for _, _, texts in blocks(text):
            yield _lists(*shingle_sets(texts, settings.words), len(texts))

    @F.arrow_udf("array<long>")
    def column(text: pa.Array) -> pa.Array:
        return pa.concat_arrays([*made(text), pa.array([], pa.list_(pa.int64()))])

    return column


def need(size: Column, settings: Settings) -> Column:
    """Retained values that a partner of a set of this size shares at least.

    Up to percent * keep values, the set and every partner's are within ``keep``
    together, so the overlap is that of the sets.
    """
    small = F.ceil(size * settings.percent / 100)
    return F.when(size * 100 <= settings.keep * settings.percent, small).otherwise(F.lit(settings.keep // 2 + 1)).cast("int")


def _listed(nodes: DataFrame, values: Column) -> DataFrame:
    return nodes.withColumn("value", F.explode(values))


def hub_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): for each document the smallest-id and the largest-id hub that shares most of its first values, half at least."""
    rows = _listed(nodes.select("node", F.least(F.size("sketch"), F.lit(HUB_VALUES)).alias("looked"), "sketch"), F.slice("sketch", 1, HUB_VALUES)).drop("sketch")
    hubs = rows.groupBy("value").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    met = rows.join(hubs, "value").select("node", "looked", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("low").alias("hub")), F.struct(F.lit(1).alias("side"), F.col("high").alias("hub")))).alias("h"))
    shared = met.where("node <> h.hub").groupBy("node", "h.side", "h.hub", "looked").count().where("2 * count >= looked")
    best = shared.groupBy("node", "side").agg(F.max(F.struct("count", "hub")).alias("best"))
    return best.select(F.col("node").alias("a"), F.col("best.hub").alias("b")).distinct()


def _asked(rows: DataFrame, need_of: Column) -> DataFrame:
    """What each node has to look up: (node, n_shingles, root, value, main, place).

    rows: (node, n_shingles, kept, root, members, value), a row per value of a
    node's sketch or set of ``kept`` values. Values of one group alone are the
    rarest of all and take the first places; ``main`` is the largest group that holds the value.
    """
    values = rows.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("holders"), F.max(F.struct("members", "root")).alias("main"))
    shared = values.where("low <> high").select("value", "holders", F.col("main.root").alias("main"))
    by_node = (
        rows.join(shared, "value")
        .groupBy("node", "n_shingles", "root", "kept")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "value", "main"))).alias("common"))
    )
    alone = F.col("kept") - F.size("common")
    looked = F.col("kept") - need_of + 1 - alone
    listed = by_node.where(looked > 0).select("node", "n_shingles", "root", alone.alias("alone"), F.posexplode(F.slice("common", 1, looked)).alias("at", "c"))
    return listed.select("node", "n_shingles", "root", "c.value", "c.main", (F.col("alone") + F.col("at")).alias("place"))


def _across(asked: DataFrame, own: tuple[str, ...], near: Column) -> DataFrame:
    """(a, b): pairs of different groups that ask for the same value, of sizes that allow the similarity."""
    left = asked.where("root <> main").select("value", *(F.col(c).alias(f"{c}_a") for c in own))
    right = asked.select("value", "main", *(F.col(c).alias(f"{c}_b") for c in own))
    once = (F.col("root_b") == F.col("main")) | (F.col("node_a") < F.col("node_b"))
    pairs = left.join(right, "value").where((F.col("root_a") != F.col("root_b")) & once & near)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _sizes_allow(settings: Settings) -> Column:
    return (F.col("n_shingles_a") * 100 >= F.col("n_shingles_b") * settings.percent) & (F.col("n_shingles_b") * 100 >= F.col("n_shingles_a") * settings.percent)


def short_list_pairs(asked: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs from short lists whose brief sketches are alike enough. nodes: (node, bits_a, bits_b)."""
    differing = F.lit(0)
    for k in range(RANGES // 64):
        first, second = (F.get(F.col(f"{p}_a"), F.lit(k)).bitwiseXOR(F.get(F.col(f"{p}_b"), F.lit(k))) for p in ("bits_a", "bits_b"))
        differing = differing + F.bit_count(first.bitwiseOR(second))
    near = _sizes_allow(settings) & (differing <= differing_ranges((F.col("n_shingles_a") + F.col("n_shingles_b")).cast("double"), settings))
    own = ("node", "n_shingles", "root", "bits_a", "bits_b")
    return _across(asked.join(nodes.select("node", "bits_a", "bits_b"), "node").select(*own, "value", "main"), own, near)


def whole_set_pairs(members: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Pairs among ``members`` (node, n_shingles, root, members) whose whole sets can be similar enough."""
    rows = _only(texts, members).select("node", F.explode(set_column(settings)("text")).alias("value"))
    rows = rows.join(members, "node").withColumn("kept", F.col("n_shingles"))
    asked = _asked(rows, F.ceil(F.col("n_shingles") * settings.percent / 100))
    still = F.least(F.col("n_shingles_a") - F.col("place_a"), F.col("n_shingles_b") - F.col("place_b"))
    enough = still * (100 + settings.percent) >= (F.col("n_shingles_a") + F.col("n_shingles_b")) * settings.percent
    return _across(asked, ("node", "n_shingles", "root", "place"), _sizes_allow(settings) & enough)


def _only(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of some nodes; ``nodes`` is a written table, counted before it may be broadcast."""
    nodes = nodes.select("node").distinct()
    return texts.join(F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes, "node", "left_semi")


def estimated(pairs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs with enough common values among the ``keep`` smallest of the union of their sketches."""
    one = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("x"), F.col("n_shingles").alias("n_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("y"), F.col("n_shingles").alias("n_b"))
    union = F.slice(F.sort_array(F.array_union("x", "y")), 1, settings.keep)
    common = F.size(F.array_intersect(union, F.array_intersect("x", "y")))
    return pairs.join(one, "a").join(two, "b").where(common >= F.greatest(need(F.col("n_a"), settings), need(F.col("n_b"), settings))).select("a", "b")


def proven(pairs: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Pairs whose whole shingle sets are similar enough. docs: (node, text). ``pairs`` is a written table."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    sets = _only(docs, wanted).select("node", set_column(settings)("text").alias("shingles"))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common * 100 >= (F.size("x") + F.size("y") - common) * settings.percent).select("a", "b").distinct()


def with_first(rows: DataFrame, copies: DataFrame, staged: Staged, large_sets: int = LARGE_SETS) -> DataFrame:
    """``rows`` with the first document of their set (null for a set of one row), without bringing a set's rows together.

    The ``large_sets`` sets with most rows are broadcast. Others have 1 / ``large_sets`` of all rows at most, so they are joined by their key.
    """
    keys = ["set_a", "set_b"]
    large = staged.write(copies.orderBy(F.desc("rows"), *keys).limit(large_sets), "large-sets").drop("rows")
    named = rows.join(F.broadcast(large), keys, "left")
    if large.count() < large_sets:
        return named
    others = copies.join(F.broadcast(large), keys, "left_anti").drop("rows")
    rest = named.where("first IS NULL").drop("first").join(others, keys, "left")
    return named.where("first IS NOT NULL").unionByName(rest)


def groups(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id (smallest id of its group), kept."""
    spark = docs.sparkSession
    staged = Staged(spark, "near-copies")
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    sketches = staged.write(docs.select(F.col(id_col).cast("long").alias("id"), sketch_column(settings)(F.col(text_col)).alias("s")).select("id", "s.*"), "sketches")

    # One document for each shingle set: the smallest id. Each task hands on one row of a set.
    ranked = sketches.where("id IS NOT NULL AND n_shingles > 0").withColumn("place", F.row_number().over(Window.partitionBy("set_a", "set_b").orderBy("id")))
    nodes = staged.write(ranked.where("place = 1").select(F.col("id").alias("node"), "n_shingles", "sketch", "bits_a", "bits_b"), "nodes")

    tied = staged.write(proven(staged.write(hub_pairs(nodes), "hub-pairs"), texts, settings), "tied")
    staged.drop("hub-pairs")
    roots = components(tied, staged, "hubs")
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    grouped = nodes.join(roots.join(sizes, "root"), "node", "left").select(
        "node", "n_shingles", "sketch", "bits_a", "bits_b", F.coalesce("root", "node").alias("root"), F.coalesce("members", F.lit(1)).alias("members")
    )
    rows = _listed(grouped.select("node", "n_shingles", "root", "members", F.size("sketch").alias("kept"), "sketch"), F.col("sketch")).drop("sketch")
    asked = staged.write(_asked(rows, need(F.col("n_shingles"), settings)), "asked")
    askers = asked.groupBy("value").agg(F.count(F.lit(1)).alias("askers"))
    short = asked.join(askers.where(F.col("askers").between(2, SHORT_LIST)).select("value"), "value")
    pairs = staged.write(short_list_pairs(short, nodes, settings), "pairs")
    crowded = asked.join(askers.where(F.col("askers") > SHORT_LIST).select("value"), "value", "left_semi").select("node").distinct()
    crowded = staged.write(crowded.join(grouped.select("node", "n_shingles", "root", "members"), "node"), "crowded")
    more = staged.write(whole_set_pairs(crowded, texts, settings), "more-pairs")
    staged.drop("asked")
    staged.drop("crowded")
    likely = staged.write(estimated(pairs.union(more).distinct(), nodes, settings), "likely")
    staged.drop("pairs")
    staged.drop("more-pairs")
    links = staged.write(proven(likely, texts, settings), "links")
    staged.drop("likely")
    staged.drop("nodes")
    roots = components(tied.union(links), staged, "groups")

    copies = sketches.where("id IS NOT NULL AND n_shingles > 0").groupBy("set_a", "set_b").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    named = with_first(sketches.select("id", "n_shingles", "set_a", "set_b"), staged.write(copies, "copies"), staged)
    node = F.when(F.col("id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("first", "id")).otherwise(F.col("id"))
    found = named.select("id", "n_shingles", node.alias("node")).join(roots, "node", "left")
    component = F.coalesce("root", "node")
    return found.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group, the smallest id; rows that agree in every column stay once."""
    staged = Staged(docs.sparkSession, "near-copies-kept")
    kept = staged.write(groups(docs, settings, id_col, text_col).where(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__kept_id")).distinct(), "kept")
    named = docs.join(kept, docs[id_col].cast("long") == kept["__kept_id"], "left_semi").dropDuplicates()
    return named.union(docs.where(F.col(id_col).isNull()))

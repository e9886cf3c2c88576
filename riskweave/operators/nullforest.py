"""Forests on many permutations of one label, all grown together.

A permuted label is a random subset of as many rows as are bad: those with the
smallest hashes of their number and the run, up to an order statistic that is
found for all runs at once. A row carries its labels of all runs as bits. All
trees of all runs then grow level by level: each task counts rows and bad rows per run, tree,
node, feature and bin, the counts are added up per tree, and the best splits of the whole
level go back to the tasks. There is one job for each level, however many runs and trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.bins import after, count_reached
from riskweave.functions.cleaning import identify_types, sql_name
from riskweave.operators.binning import quantile_edges
from riskweave.operators.quantiles import exact_quantiles
from riskweave.session import write_stage

#: Bins of a numeric feature, and categories a text feature may have.
BINS, MAX_CATEGORIES = 32, 1000
#: Labels in one number.
WORD = 60
#: Bytes of counts a task holds, and rows it looks at together where all runs' counts don't fit at once.
COUNT_BYTES, BUFFER_ROWS = 1 << 28, 200_000
#: Groups that the tasks' counts are added up in before those of a tree come together.
PARTS = 32


@dataclass(frozen=True)
class Design:
    """Features with their number of bins; ``ordered`` tells numeric from text features."""

    features: tuple[str, ...]
    sizes: tuple[int, ...]
    ordered: tuple[bool, ...]
    runs: int
    trees: int
    row_share: float
    column_share: float
    seed: int

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.sizes)))[:-1]

    @property
    def bins(self) -> int:
        return sum(self.sizes)


def scrambled(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers spread evenly (a bijection)."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def in_bag(serial: np.ndarray, tree: int, design: Design) -> np.ndarray:
    """Rows that a tree sees; the same in all runs, since the runs' labels differ anyway."""
    key = scrambled(np.array([design.seed * 1000003 + tree], dtype=np.uint64))[0]
    return scrambled(serial.astype(np.uint64) ^ key) < np.uint64(int(design.row_share * float(1 << 53)) << 11)


def columns_of(run: int, tree: int, node: int, level: int, design: Design) -> np.ndarray:
    """Features that a node may split by."""
    p = len(design.features)
    rng = np.random.default_rng([design.seed, run, tree, level, node])
    return np.sort(rng.permutation(p)[: max(1, math.ceil(design.column_share * p))])


def prepared(df: DataFrame, features: Sequence[str], label: str, runs: int, trees: int, row_share: float, column_share: float, seed: int) -> tuple[DataFrame, Design]:
    """(rows: serial, b0.. (bins), w0.. (label bits of all runs), design). ``df`` has no missing numbers; labels are 0 or 1."""
    numeric, text = identify_types(df.select(*features))
    sizes, ordered = [], []
    if text:
        indexed = StringIndexer(inputCols=text, outputCols=[f"_i{features.index(f)}" for f in text], handleInvalid="keep").fit(df)
        df = indexed.transform(df)
        categories = dict(zip(text, (len(names) + 1 for names in indexed.labelsArray), strict=True))
        if any(n > MAX_CATEGORIES for n in categories.values()):
            raise ValueError(f"text features of more than {MAX_CATEGORIES} categories")
    edges = quantile_edges(df, {f: sql_name(f) for f in numeric}, BINS)
    columns, thresholds = {}, {}
    for i, f in enumerate(features):
        ordered.append(f in numeric)
        if f in numeric:
            thresholds[f"b{i}"] = [after(e) for e in edges[f][:-1]]
            columns[f"b{i}"] = f"CAST({sql_name(f)} AS DOUBLE)"
            sizes.append(len(thresholds[f"b{i}"]) + 1)
        else:
            sizes.append(categories[f])
    base = df.withColumns({f"b{i}": F.col(f"_i{i}").cast("int") for i, f in enumerate(features) if f in text}) if text else df
    base = count_reached(base, columns, thresholds) if columns else base
    rows = base.select(F.col(label).cast("int").alias("_y"), *[F.col(f"b{i}").cast("smallint").alias(f"b{i}") for i in range(len(features))])
    rows = write_stage(rows.withColumn("serial", F.monotonically_increasing_id()), "null-rows")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("bad")).first()
    design = Design(tuple(features), tuple(sizes), tuple(ordered), runs, trees, row_share, column_share, seed)
    return _labelled(rows, counts.n, counts.bad or 0, design), design


def _labelled(rows: DataFrame, n: int, bad: int, design: Design) -> DataFrame:
    """Rows with the label bits of all runs, each with as many bad rows as the real label."""
    hashed = {f"h{r}": f"CAST(shiftrightunsigned(xxhash64(serial, {design.seed}L, {r}), 12) AS DOUBLE)" for r in range(design.runs)}
    if 0 < bad < n:
        # The value half way between the last bad row's hash and the next one's.
        cuts, _ = exact_quantiles(rows, {h: (sql, [(bad - 0.5) / (n - 1)]) for h, sql in hashed.items()})
        tests = {h: f"{sql} <= {cuts[h][0]!r}D" for h, sql in hashed.items()}
    else:
        tests = dict.fromkeys(hashed, str(bad > 0).lower())
    words = []
    for at in range(0, design.runs, WORD):
        bits = " + ".join(f"CASE WHEN {tests[f'h{r}']} THEN {1 << (r - at)}L ELSE 0L END" for r in range(at, min(at + WORD, design.runs)))
        words.append(F.expr(bits).alias(f"w{at // WORD}"))
    return write_stage(rows.select("serial", *[f"b{i}" for i in range(len(design.features))], *words), "null-labels")


#: Splits of a tree by (level, node): feature and whether each of its bins goes left.
Splits = dict[tuple[int, int], tuple[int, np.ndarray]]


def nodes_at(level: int, bins: np.ndarray, splits: Splits) -> np.ndarray:
    """Node of each row at a level (-1: in a leaf above). bins: rows x features."""
    node = np.zeros(len(bins), dtype=np.int64)
    for at in range(level):
        below = np.full(len(bins), -1, dtype=np.int64)
        for k in range(1 << at):
            if (at, k) in splits:
                feature, left = splits[at, k]
                mine = np.flatnonzero(node == k)
                below[mine] = 2 * k + ~left[bins[mine, feature]]
        node = below
    return node


def best_split(counts: np.ndarray, columns: np.ndarray, design: Design) -> tuple[float, int, np.ndarray] | None:
    """(gain in Gini impurity, feature, bins that go left) from counts (2 x bins: rows, bad rows); ties: the first feature, fewest bins left."""
    best = None
    for f in columns:
        n, bad = (c[design.starts[f] : design.starts[f] + design.sizes[f]].astype(float) for c in counts)
        full = np.flatnonzero(n)
        if len(full) < 2:
            continue
        # The best cut of categories is one in the order of their bad rates.
        order = full if design.ordered[f] else full[np.lexsort((full, bad[full] / n[full]))]
        left_n, left_bad = np.cumsum(n[order])[:-1], np.cumsum(bad[order])[:-1]
        all_n, all_bad = n.sum(), bad.sum()
        right_n, right_bad = all_n - left_n, all_bad - left_bad
        impurity = lambda b, m: 2 * (b / m) * (1 - b / m)
        gain = impurity(all_bad, all_n) - left_n / all_n * impurity(left_bad, left_n) - right_n / all_n * impurity(right_bad, right_n)
        k = int(np.argmax(gain))
        if gain[k] > 1e-12 and (best is None or gain[k] > best[0]):
            left = np.zeros(design.sizes[f], dtype=bool)
            left[order[: k + 1]] = True
            if design.ordered[f]:  # values that this sample lacks go where their neighbours go
                left[: order[k] + 1] = True
            best = (float(gain[k]), int(f), left)
    return best


_BLOBS = "run int, tree int, part int, counts binary"
_SPLITS = "run int, tree int, node int, feature int, go_left array<boolean>, gain double"


def _level_counts(design: Design, splits: dict[tuple[int, int], Splits], level: int):
    """Counts of one task: nodes x (rows, bad rows) x bins for every run and tree."""
    p, nodes = len(design.features), 1 << level
    shape = (nodes, 2, design.bins)
    alive = [(r, t) for r in range(design.runs) for t in range(design.trees) if level == 0 or any(at == level - 1 for at, _ in splits.get((r, t), ()))]
    at_once = max(1, COUNT_BYTES // (int(np.prod(shape)) * 8))
    groups = [alive[i : i + at_once] for i in range(0, len(alive), at_once)]

    def add(held: dict, pairs: Sequence[tuple[int, int]], bins: np.ndarray, serial: np.ndarray, words: np.ndarray) -> None:
        flat = bins + design.starts
        bags: dict[int, np.ndarray] = {}
        for run, tree in pairs:
            if tree not in bags:
                bags[tree] = np.flatnonzero(in_bag(serial, tree, design))
            rows = bags[tree]
            node = nodes_at(level, bins[rows], splits.get((run, tree), {}))
            rows, node = rows[node >= 0], node[node >= 0]
            bad = (words[rows, run // WORD] >> (run % WORD)) & 1 == 1
            cells = flat[rows] + node[:, None] * design.bins
            n = np.bincount(cells.ravel(), minlength=nodes * design.bins).reshape(nodes, design.bins)
            b = np.bincount(cells[bad].ravel(), minlength=nodes * design.bins).reshape(nodes, design.bins)
            if (run, tree) not in held:
                held[run, tree] = np.zeros(shape, np.int64)
            held[run, tree][:, 0] += n
            held[run, tree][:, 1] += b

    def rows_of(held: dict) -> pd.DataFrame:
        part = TaskContext.get().partitionId() % PARTS
        return pd.DataFrame([(r, t, part, c.tobytes()) for (r, t), c in held.items()], columns=["run", "tree", "part", "counts"])

    def buffered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= BUFFER_ROWS:
                yield pd.concat(held)
                held, size = [], 0
        if held:
            yield pd.concat(held)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole: dict = {}
        for batch in buffered(batches):
            bins = batch[[f"b{i}" for i in range(p)]].to_numpy().astype(np.int64)
            words = batch[[c for c in batch.columns if c.startswith("w")]].to_numpy()
            for pairs in groups:
                held = whole if len(groups) == 1 else {}
                add(held, pairs, bins, batch["serial"].to_numpy(), words)
                if len(groups) > 1:
                    yield rows_of(held)
        yield rows_of(whole)

    return count


def _summed(pdf: pd.DataFrame) -> np.ndarray:
    return np.sum([np.frombuffer(c, np.int64) for c in pdf["counts"]], axis=0)


def _grown(rows: DataFrame, design: Design, splits: dict[tuple[int, int], Splits], level: int) -> list:
    """The best splits of a level."""

    def partly(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, _summed(pdf).tobytes())], columns=["run", "tree", "part", "counts"])

    def split(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        run, tree = (int(k) for k in key)
        counts = _summed(pdf).reshape(1 << level, 2, design.bins)
        out = []
        for node in range(1 << level):
            found = best_split(counts[node], columns_of(run, tree, node, level, design), design)
            if found:
                out.append((run, tree, node, found[1], found[2].tolist(), found[0]))
        return pd.DataFrame(out, columns=["run", "tree", "node", "feature", "go_left", "gain"])

    blobs = rows.mapInPandas(_level_counts(design, splits, level), _BLOBS)
    added = blobs.groupBy("run", "tree", "part").applyInPandas(partly, _BLOBS)
    return added.groupBy("run", "tree").applyInPandas(split, _SPLITS).collect()  # runs x trees x nodes of a level


def grow(rows: DataFrame, design: Design, depth: int) -> list[tuple[int, int, int, int, int, float]]:
    """(run, tree, level, node, feature, gain) of every split of all forests."""
    splits: dict[tuple[int, int], Splits] = {}
    out = []
    for level in range(depth):
        found = _grown(rows, design, splits, level)
        for r in found:
            splits.setdefault((r["run"], r["tree"]), {})[level, r["node"]] = (r["feature"], np.array(r["go_left"]))
            out.append((r["run"], r["tree"], level, r["node"], r["feature"], r["gain"]))
        if not found:
            break
    return sorted(out)


def importances(spark, splits: Sequence[tuple], design: Design) -> DataFrame:
    """run (from 1), feature, importance_split (splits), importance_gain (sum of their gains)."""
    n, gain = np.zeros((design.runs, len(design.features)), np.int64), np.zeros((design.runs, len(design.features)))
    for run, _, _, _, feature, own in splits:
        n[run, feature] += 1
        gain[run, feature] += own
    rows = [(r + 1, f, int(n[r, i]), float(gain[r, i])) for r in range(design.runs) for i, f in enumerate(design.features)]
    return spark.createDataFrame(rows, "run int, feature string, importance_split long, importance_gain double")

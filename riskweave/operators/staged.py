"""KS of many scores a row at once, without shuffling rows.

A boosted model has a score after every round. Each task adds up the rounds'
margins of its rows and counts good and bad rows in cells of every round's range; what leaves a
task is one row of counts per round. The gap between the two running shares is
known at the borders of cells. Inside a cell with g good and b bad rows it can rise by
b / bad at most and fall by g / good at most, so only cells that could hold a wider gap than the
widest known one are counted again, in finer cells or, once they hold few rows, by value.
When none is left the widest gap is the KS over all distinct scores.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Cells of a round at first, cells that all open ones of a round are cut into later, and rows in a round's open cells up to which these are counted by value.
CELLS, PIECES, BY_VALUE_ROWS = 256, 2048, 20_000
#: Rows whose scores are added up at once.
SLICE = 2048

_COUNTS = "round int, slot array<int>, lo array<double>, hi array<double>, good array<long>, bad array<long>, loss double"


@dataclass(frozen=True)
class Look:
    """What one pass counts of a round: slot i holds scores from ``borders[i - 1]`` to below ``borders[i]``, ``wanted`` those that are counted."""

    borders: np.ndarray
    wanted: np.ndarray
    by_value: bool = False


@dataclass
class Cells:
    """Ordered cells of a round."""

    lo: np.ndarray
    hi: np.ndarray
    good: np.ndarray
    bad: np.ndarray

    def gaps(self, goods: int, bads: int) -> tuple[float, np.ndarray]:
        """(widest gap at a border, cells that could hold a wider one)."""
        tpr, fpr = np.cumsum(self.bad) / bads, np.cumsum(self.good) / goods
        at_end = tpr - fpr
        best = float(np.abs(at_end).max())
        before = np.concatenate(([0.0], at_end[:-1]))
        reach = np.maximum(before + self.bad / bads, self.good / goods - before)
        return best, np.flatnonzero((self.hi > self.lo) & (reach > best - 1e-15))

    def wins(self) -> tuple[float, float]:
        """Pairs of a bad row above a good one: at least and at most; equal scores count half."""
        below = np.cumsum(self.good) - self.good
        whole = float((self.bad.astype(float) * below).sum())
        inside = self.bad.astype(float) * self.good
        single = self.hi == self.lo
        least = whole + float(inside[single].sum()) / 2
        return least, least + float(inside[~single].sum())


def _own_counts(looks: dict[int, Look], label: str, totals: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Counts of one task, a row for each round."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = {k: (np.full(len(w.borders) + 1, np.inf), np.full(len(w.borders) + 1, -np.inf), np.zeros((2, len(w.borders) + 1), np.int64)) for k, w in looks.items()}
        values: dict[int, list[np.ndarray]] = {k: [] for k, w in looks.items() if w.by_value}
        loss = dict.fromkeys(looks, 0.0)
        for batch in batches:
            for low in range(0, len(batch), SLICE):
                part = batch.iloc[low : low + SLICE]
                if not len(part):
                    continue
                margins = np.cumsum(np.stack(part["parts"].to_numpy()), axis=1)
                bad = part[label].to_numpy() == 1
                for k, look in looks.items():
                    x = margins[:, k] + 0.0
                    if totals:
                        loss[k] += float(np.logaddexp(0, np.where(bad, -2 * x, 2 * x)).sum())
                    slot = np.searchsorted(look.borders, x, side="right")
                    inside = look.wanted[slot]
                    if look.by_value:
                        values[k].append(np.stack([x[inside], bad[inside]]))
                        continue
                    lo, hi, counts = tables[k]
                    slot, mine, evil = slot[inside], x[inside], bad[inside]
                    np.minimum.at(lo, slot, mine)
                    np.maximum.at(hi, slot, mine)
                    counts[0] += np.bincount(slot[~evil], minlength=counts.shape[1])
                    counts[1] += np.bincount(slot[evil], minlength=counts.shape[1])
        out = []
        for k, look in looks.items():
            if look.by_value:
                both = np.concatenate(values[k], axis=1) if values[k] else np.zeros((2, 0))
                x, place = np.unique(both[0], return_inverse=True)
                good, bad_ = np.bincount(place[both[1] == 0], minlength=len(x)), np.bincount(place[both[1] == 1], minlength=len(x))
                out.append((k, np.zeros(len(x), np.int32), x, x, good, bad_, loss[k]))
            else:
                lo, hi, counts = tables[k]
                full = np.flatnonzero(counts.sum(axis=0))
                out.append((k, full.astype(np.int32), lo[full], hi[full], counts[0][full], counts[1][full], loss[k]))
        yield pd.DataFrame(out, columns=["round", "slot", "lo", "hi", "good", "bad", "loss"])

    return count


def _merge(looks: dict[int, Look]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["round"].iloc[0])
        slot, lo, hi, good, bad = (np.concatenate(pdf[c].to_numpy()) for c in ("slot", "lo", "hi", "good", "bad"))
        keys, place = np.unique(lo if looks[k].by_value else slot, return_inverse=True)
        low, high = np.full(len(keys), np.inf), np.full(len(keys), -np.inf)
        np.minimum.at(low, place, lo)
        np.maximum.at(high, place, hi)
        sums = [np.zeros(len(keys), np.int64) for _ in range(2)]
        for total, own in zip(sums, (good, bad), strict=True):
            np.add.at(total, place, own)
        return pd.DataFrame([(k, np.zeros(len(keys), np.int32), low, high, *sums, math.fsum(pdf["loss"]))], columns=["round", "slot", "lo", "hi", "good", "bad", "loss"])

    return merge


def _counted(rows: DataFrame, looks: dict[int, Look], label: str, totals: bool) -> dict[int, tuple[Cells, float]]:
    parts = rows.mapInPandas(_own_counts(looks, label, totals), _COUNTS)
    merged = parts.groupBy("round").applyInPandas(_merge(looks), _COUNTS)
    return {r["round"]: (Cells(*(np.array(r[c]) for c in ("lo", "hi", "good", "bad"))), r["loss"]) for r in merged.collect()}  # rounds x cells


def _finer(cells: Cells, asked: np.ndarray) -> Look:
    """The asked cells in finer ones, or by value."""
    few = int((cells.good + cells.bad)[asked].sum()) <= BY_VALUE_ROWS
    pieces = max(2, PIECES // len(asked))
    borders, wanted = [], [False]
    for i in asked:
        lo, hi = cells.lo[i], cells.hi[i]
        inner = [] if few else [b for b in np.unique(np.linspace(lo, hi, pieces + 1)[1:-1]) if lo < b <= hi]
        if not few and not inner:
            inner = [hi]  # neighbouring numbers
        for start in (lo, *inner):
            borders.append(start)
            wanted.append(True)
        borders.append(math.nextafter(hi, math.inf))
        wanted.append(False)
    keep = np.ones(len(borders), dtype=bool)
    for j in range(len(borders) - 1):  # a cell may begin where the one before ends
        keep[j] = borders[j] < borders[j + 1]
    return Look(np.array(borders)[keep], np.array([wanted[0], *np.array(wanted[1:])[keep]]), few)


def ks_by_round(rows: DataFrame, ranges: Sequence[tuple[float, float]], label: str = "label") -> DataFrame:
    """round (from 1), ks, auc_low, auc_high, log_loss of rows (``label``, parts: what each round adds to the score).

    ``ranges`` are guesses of each round's lowest and highest score; they only
    decide where to look first. The KS is exact; the AUC is known to lie between
    its two bounds. KS and AUC are null where a class is missing.
    """
    looks = {}
    for k, (low, high) in enumerate(ranges):
        borders = np.unique(np.linspace(low, high, CELLS + 1)[1:-1]) if high > low else np.array([low])
        looks[k] = Look(borders, np.ones(len(borders) + 1, dtype=bool))
    first = _counted(rows, looks, label, True)
    cells = {k: c for k, (c, _) in first.items()}
    loss = {k: own for k, (_, own) in first.items()}
    totals = {k: (int(c.good.sum()), int(c.bad.sum())) for k, c in cells.items()}
    ks: dict[int, float] = {}
    while True:
        looks = {}
        for k, own in cells.items():
            if k in ks or not all(totals[k]):
                continue
            best, asked = own.gaps(*totals[k])
            if len(asked):
                looks[k] = _finer(own, asked)
            else:
                ks[k] = best
        if not looks:
            break
        for k, (opened, _) in _counted(rows, looks, label, False).items():
            own = cells[k]
            kept = np.ones(len(own.lo), dtype=bool)
            kept[own.gaps(*totals[k])[1]] = False
            lo = np.concatenate((own.lo[kept], opened.lo))
            order = np.argsort(lo, kind="stable")
            both = (np.concatenate((getattr(own, c)[kept], getattr(opened, c)))[order] for c in ("lo", "hi", "good", "bad"))
            cells[k] = Cells(*both)
    out = []
    for k in range(len(ranges)):
        goods, bads = totals.get(k, (0, 0))
        pairs = float(goods) * bads
        low, high = (w / pairs for w in cells[k].wins()) if pairs else (None, None)
        out.append((k + 1, ks.get(k), low, high, loss[k] / (goods + bads) if goods + bads else None))
    return rows.sparkSession.createDataFrame(out, "round int, ks double, auc_low double, auc_high double, log_loss double")

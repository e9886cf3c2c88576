"""Stepwise selection by p-value."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.cleaning import as_double
from riskweave.session import write_stage


def _walk(features: Sequence[str], p_values: Callable, alpha: float, stepwise: bool) -> list[tuple]:
    """Forward steps: the smallest p-value enters while it is at most alpha.

    With ``stepwise`` features that lost their significance leave and stay out.
    ``p_values(lists)`` fits several feature lists and gives a dict per list.
    """
    remaining, selected, log = list(features), [], []
    while remaining:
        fits = p_values([[*selected, f] for f in remaining])
        scored = sorted((fit[f], f) for f, fit in zip(remaining, fits) if fit is not None and fit[f] == fit[f])
        if not scored or scored[0][0] > alpha:
            break
        p, best = scored[0]
        remaining.remove(best)
        selected.append(best)
        log.append((len(log) + 1, best, "enters", float(p)))
        if stepwise and len(selected) > 1:
            fit = p_values([selected])[0] or {}
            for f in [f for f in selected if fit.get(f, 0.0) > alpha]:
                selected.remove(f)
                log.append((len(log) + 1, f, "leaves", float(fit[f])))
    return log


def _log_table(spark, log) -> DataFrame:
    return spark.createDataFrame(log, "step int, feature string, action string, p_value double")


def selected_features(log: DataFrame) -> list[str]:
    state: dict[str, int] = {}
    for r in log.orderBy("step").collect():
        if r.action == "enters":
            state[r.feature] = r.step
        else:
            state.pop(r.feature, None)
    return list(state)


#: Steps of Fisher scoring, and the change of all standardised coefficients below which it ends.
FISHER_STEPS, FISHER_DONE = 25, 1e-9
#: Share of a column that the others leave unexplained, below which it is taken for a combination of them.
LEAST_OWN = 1e-10


class LogisticFits:
    """Logistic fits of many feature lists at once: every step of Fisher scoring is one pass that adds up the information matrices of all lists.

    Columns are centred and scaled, which changes no z value. ``rows`` is a written table of ``_y`` and the features, without nulls.
    """

    def __init__(self, rows: DataFrame, features: Sequence[str]) -> None:
        self.rows, self.names = rows, list(features)
        first = rows.agg(F.count(F.lit(1)).alias("_n"), *[f(c).alias(f"{k}{i}") for i, c in enumerate(self.names) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        self.n = first["_n"]
        self.centre = np.array([first[f"m{i}"] or 0.0 for i in range(len(self.names))])
        self.scale = np.array([first[f"s{i}"] or 1.0 for i in range(len(self.names))])
        self.known: dict[tuple[str, ...], np.ndarray] = {}

    def sums(self, lists: Sequence[Sequence[str]], betas: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(information matrix, score vector) of each list at its coefficients, the intercept first; one job."""
        where = {f: i for i, f in enumerate(self.names)}
        chosen = [np.array([where[f] for f in x], dtype=int) for x in lists]
        used = sorted({i for c in chosen for i in c.tolist()})
        columns, place = [self.names[i] for i in used], {i: k for k, i in enumerate(used)}
        centre, scale = self.centre[used], self.scale[used]
        chosen = [np.array([place[i] for i in c], dtype=int) for c in chosen]

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            info = [np.zeros((len(c) + 1, len(c) + 1)) for c in chosen]
            score = [np.zeros(len(c) + 1) for c in chosen]
            for batch in batches:
                x, y = (batch[columns].to_numpy(dtype=float) - centre) / scale, batch["_y"].to_numpy(dtype=float)
                for k, (c, beta) in enumerate(zip(chosen, betas, strict=True)):
                    own = np.concatenate((np.ones((len(y), 1)), x[:, c]), axis=1)
                    mu = 1 / (1 + np.exp(-np.clip(own @ beta, -500, 500)))
                    info[k] += (own * (mu * (1 - mu))[:, None]).T @ own
                    score[k] += own.T @ (y - mu)
            for k in range(len(chosen)):
                flat = np.concatenate((info[k].ravel(), score[k]))
                yield pd.DataFrame({"k": np.int32(k), "j": np.arange(len(flat), dtype=np.int32), "v": flat})

        added = self.rows.select("_y", *columns).mapInPandas(partial, "k int, j int, v double").groupBy("k", "j").agg(F.sum("v").alias("v")).collect()
        out = [np.zeros((len(c) + 1) * (len(c) + 2)) for c in chosen]
        for r in added:
            out[r.k][r.j] = r.v
        return [(v[: (m := len(c) + 1) ** 2].reshape(m, m), v[m**2 :]) for v, c in zip(out, chosen, strict=True)]

    def start(self, names: Sequence[str]) -> np.ndarray:
        """Coefficients of the longest beginning that has been fitted, zero for the others."""
        for size in range(len(names), -1, -1):
            if tuple(names[:size]) in self.known:
                return np.concatenate((self.known[tuple(names[:size])], np.zeros(len(names) - size)))
        return np.zeros(len(names) + 1)

    def score_tests(self, selected: Sequence[str], candidates: Sequence[str]) -> dict[str, float | None]:
        """Chi-square of each candidate given the fitted model of ``selected``, from one pass; None for a combination of these."""
        lists = [[*selected, f] for f in candidates]
        out = {}
        for f, (info, score) in zip(candidates, self.sums(lists, [self.start(x) for x in lists]), strict=True):
            own = info[-1, -1] - info[-1, :-1] @ np.linalg.lstsq(info[:-1, :-1], info[:-1, -1], rcond=None)[0]
            out[f] = float(score[-1] ** 2 / own) if own > LEAST_OWN * info[0, 0] else None
        return out

    def fit(self, lists: Sequence[Sequence[str]]) -> list[dict[str, float] | None]:
        """Two-sided p-value of every feature in each list; None where the list is collinear."""
        betas = [self.start(x) for x in lists]
        result: list[dict[str, float] | None] = [None] * len(lists)
        open_ = list(range(len(lists)))
        for step in range(FISHER_STEPS):
            going = []
            for k, (info, score) in zip(open_, self.sums([lists[k] for k in open_], [betas[k] for k in open_]), strict=True):
                d = np.sqrt(np.diag(info))
                if not (d > 0).all() or np.linalg.eigvalsh(info / np.outer(d, d))[0] < LEAST_OWN:
                    continue
                move = np.linalg.solve(info, score)
                z = np.abs(betas[k] + move) / np.sqrt(np.diag(np.linalg.inv(info)))
                betas[k] = betas[k] + move
                result[k] = {f: math.erfc(v / math.sqrt(2)) for f, v in zip(lists[k], z[1:].tolist(), strict=True)}
                if np.abs(move).max() > FISHER_DONE:
                    going.append(k)
            open_ = going
            if not open_:
                break
        for x, beta, found in zip(lists, betas, result, strict=True):
            if found is not None:
                self.known[tuple(x)] = beta
        return result


def _logistic_rows(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    rows = df.select(F.col(label).cast("double").alias("_y"), *[as_double(df, f).alias(f) for f in features])
    return write_stage(rows.filter(F.col("_y").isin(0.0, 1.0)).dropna(), "logistic-rows")


def stepwise_logistic(df: DataFrame, features: Sequence[str], label: str = "label", alpha: float = 0.05, stepwise: bool = True) -> DataFrame:
    """Logistic forward or stepwise selection; rows with a missing feature are left out.

    All candidates of a step are fitted together, so its jobs are as many as Fisher scoring has steps, however many features there are.
    """
    fits = LogisticFits(_logistic_rows(df, features, label), features)
    return _log_table(df.sparkSession, _walk(features, fits.fit, alpha, stepwise))


def entry_tests(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """feature, chi_square, p_value: score tests of every feature against the model without features."""
    fits = LogisticFits(_logistic_rows(df, features, label), features)
    fits.fit([[]])
    found = fits.score_tests([], features)
    rows = [(f, x, None if x is None else math.erfc(math.sqrt(x / 2))) for f, x in found.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, chi_square double, p_value double")


def stepwise_linear(
    df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.05, stepwise: bool = True
) -> DataFrame:
    """Linear forward or stepwise selection from one pass over the rows.

    The pass adds up the cross products of all columns; every candidate fit is
    then a small matrix solve.
    """
    names = list(features)
    rows = df.select(as_double(df, target).alias("_y"), *[as_double(df, f).alias(f) for f in names]).dropna()
    moments, n = cross_products(rows, [*names, "_y"])
    where = {f: i for i, f in enumerate(names)}
    y = len(names)

    def fit(chosen):
        idx = [where[f] for f in chosen]
        xx, xy, yy = moments[np.ix_(idx, idx)], moments[idx, y], moments[y, y]
        if np.linalg.matrix_rank(xx) < len(idx):
            return None
        inverse = np.linalg.inv(xx)
        beta = inverse @ xy
        free = n - len(idx) - 1
        if free <= 0:
            return None
        noise = max(yy - beta @ xy, 0.0) / free
        error = np.sqrt(np.diag(inverse) * noise)
        t = np.divide(np.abs(beta), error, out=np.full(len(idx), np.inf), where=error > 0)
        return {f: two_sided_t(float(v), free) for f, v in zip(chosen, t)}

    log = _walk(names, lambda lists: [fit(x) for x in lists], alpha, stepwise)
    return _log_table(df.sparkSession, log)


def cross_products(rows: DataFrame, names: Sequence[str]) -> tuple[np.ndarray, int]:
    """Centred cross products of columns without NULL, summed over tasks."""
    first = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in names]).first()
    centre = np.array([first[c] if first[c] is not None else 0.0 for c in names])
    p = len(names)

    def partial(batches):
        total = np.zeros((p, p))
        for batch in batches:
            x = batch[list(names)].to_numpy(dtype=float) - centre
            total += x.T @ x
        i, j = np.indices((p, p))
        yield pd.DataFrame({"i": i.ravel().astype("int32"), "j": j.ravel().astype("int32"), "v": total.ravel()})

    sums = rows.mapInPandas(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((p, p))
    for r in sums:
        out[r.i, r.j] = r.v
    return out, first.n


def two_sided_t(t: float, free: int) -> float:
    """Two-sided p-value of Student's t by integrating its density over an angle."""
    if math.isinf(t):
        return 0.0
    # With x = sqrt(free) * tan(a) the density becomes a constant times cos(a)^(free - 1).
    scale = math.exp(math.lgamma((free + 1) / 2) - math.lgamma(free / 2)) / math.sqrt(math.pi)
    start = math.atan(t / math.sqrt(free))
    end = min(math.pi / 2, start + 40 / math.sqrt(free))
    a = np.linspace(start, end, 4001)
    tail = np.trapezoid(np.cos(a) ** (free - 1), a)
    return float(min(1.0, 2 * scale * tail))

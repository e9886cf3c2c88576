"""Score bands of several samples and the retrain check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.bins import with_bin
from riskweave.functions.scores import to_points
from riskweave.operators import train
from riskweave.operators.binning import equal_width_bands
from riskweave.operators.metrics import performance
from riskweave.operators.stability import retrain_psi
from riskweave.session import write_stage

DIGITS = 8


def band_table(samples: DataFrame, score: str = "score", label: str = "label", group: int = 11) -> DataFrame:
    """Score bands over dev, oot and psi with shares and bad rates, from one pass.

    Bands come from the dev scores; ``samples`` has a ``dataset`` column.
    """
    edges = equal_width_bands(samples.filter("dataset = 'dev'"), score, group)
    binned = with_bin(samples.select("dataset", label, score), score, edges, "band").filter("band IS NOT NULL")

    def n(ds, value=None):
        test = F.col("dataset") == ds
        return F.count_if(test if value is None else test & (F.col(label) == value))

    counts = binned.groupBy("band").agg(
        n("dev", 0).alias("dev_0"), n("dev", 1).alias("dev_1"), n("oot", 0).alias("oot_0"),
        n("oot", 1).alias("oot_1"), n("psi").alias("psi"),
    )
    bounds = samples.sparkSession.createDataFrame(
        [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:]))], "band int, lo double, hi double"
    )
    table = bounds.join(counts, "band", "left").na.fill(0, ["dev_0", "dev_1", "oot_0", "oot_1", "psi"])
    dev, oot = F.col("dev_0") + F.col("dev_1"), F.col("oot_0") + F.col("oot_1")
    sums = table.agg(F.sum(dev).alias("d"), F.sum(oot).alias("o"), F.sum("psi").alias("p")).first()

    def share(count, total):
        return F.bround(F.try_divide(count, F.lit(float(total or 0))), DIGITS)

    def rate(bad, total):
        return F.bround(F.coalesce(F.try_divide(bad, total), F.lit(0.0)), DIGITS)

    return table.select(
        "band", "lo", "hi", "dev_0", "dev_1", "oot_0", "oot_1", "psi", (dev + oot + F.col("psi")).alias("all"),
        share(dev, sums.d).alias("total_pcnt_dev"), rate(F.col("dev_1"), dev).alias("bad_rate_dev"),
        share(oot, sums.o).alias("total_pcnt_oot"), rate(F.col("oot_1"), oot).alias("bad_rate_oot"),
        share(F.col("psi"), sums.p).alias("total_pcnt_psi"),
    )


def retrain_check(
    samples: DataFrame, features: Sequence[str], params: Mapping, label: str = "label",
    p0: float = 410.0, pdo: float = 91.0, theta: float = 8.6,
) -> tuple[DataFrame, DataFrame, object]:
    """Refits with the saved parameters and measures the refit on dev, oot and psi.

    Returns the one-row result, the rescored samples and the model. ``samples``
    has a ``dataset`` column with dev, oot and psi. The fit and the measures
    against the label use binary rows, the score distributions all rows.
    """
    model = train.fit_boosting(samples.filter("dataset = 'dev'"), features, params, label)
    scored = train.score(model, samples, features).withColumn("score", to_points(F.col(train.PROB), p0, pdo, theta))
    scored = write_stage(scored.select("dataset", label, train.PROB, "score"), "rescored")
    binary = scored.filter(F.col(label).isin(0, 1))
    by_prob = {r.dataset: r for r in performance(binary, train.PROB, label).collect()}
    by_score = {r.dataset: r for r in performance(binary, "score", label, higher_is_good=True).collect()}
    result = {"n_features": len(features)}
    for ds in ("dev", "oot"):
        result.update({
            f"{ds}_total": by_prob[ds].total, f"{ds}_bad": by_prob[ds].bad, f"{ds}_bad_ratio": by_prob[ds].bad_ratio,
            f"{ds}_auc_prob": by_prob[ds].auc, f"{ds}_ks_prob": by_prob[ds].ks,
            f"{ds}_auc_score": by_score[ds].auc, f"{ds}_ks_score": by_score[ds].ks,
        })
    for other in ("oot", "psi"):
        pair = scored.filter(F.col("dataset").isin("dev", other))
        for column in (train.PROB, "score"):
            bins = retrain_psi(pair, column, F.col("dataset") == "dev", 0.1)
            result[f"psi_dev_{other}_{column.strip('_')}"] = bins.agg(F.sum("psi_part").alias("v")).first().v
    return samples.sparkSession.createDataFrame([result]), scored, model


def nonzero_importances(table: DataFrame) -> DataFrame:
    """Features a model really uses, with their share of the gain."""
    return table.filter("importance_score_split > 0").select("feature", "importance_score_split", "imp_split_ratio", "imp_gain_ratio")


def parity_rows(scored: DataFrame, columns: Sequence[str], id_col: str = "id", n: int = 100) -> DataFrame:
    """First rows by id, for comparing a deployed model with this one."""
    return scored.select(*columns).orderBy(id_col).limit(n)


def parity_sample(scored: DataFrame, columns: Sequence[str], id_col: str = "id", n: int = 5, seed: int = 42) -> DataFrame:
    """A few of those first rows in a random but repeatable order, as JSON records."""
    order = F.md5(F.concat_ws("-", F.col(id_col).cast("string"), F.lit(str(seed))))
    picked = parity_rows(scored, columns, id_col).orderBy(order, id_col).limit(n)
    return picked.select(F.col(id_col), F.to_json(F.struct(*columns)).alias("record"))

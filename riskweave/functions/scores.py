"""Weights of evidence, stability terms and probability-to-points scaling."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave.spec import WOE_CEILING, WOE_FLOOR


def woe_or_zero(good_share: Column, bad_share: Column) -> Column:
    """ln(good/bad), 0 when a side is empty."""
    both = (good_share > 0) & (bad_share > 0)
    return F.when(both, F.ln(good_share) - F.ln(bad_share)).otherwise(F.lit(0.0))


def woe_capped(event_share: Column, non_share: Column) -> Column:
    """ln(event/non-event) with fixed values at empty sides."""
    return (
        F.when(event_share == 0, F.lit(WOE_FLOOR))
        .when(non_share == 0, F.lit(WOE_CEILING))
        .otherwise(F.ln(event_share / F.nullif(non_share, F.lit(0.0))))
    )


def to_points(prob: Column, p0: float = 410.0, pdo: float = 91.0, theta: float = 8.6) -> Column:
    """Scorecard points of a bad probability, clipped to 0..1000.

    Probabilities of exactly 0 and 1 are nudged so that the log odds stay finite.
    """
    b = pdo / math.log(0.5)
    a = p0 + b * math.log(theta)
    low, high = 1e-8, 0.99999999
    good = 1 - prob
    # A probability so small that 1 - prob is 1 counts as 0, so the odds never divide by zero.
    odds = (
        F.when(good == 0, F.lit(low / (1 - low)))
        .when(good == 1, F.lit(high / (1 - high)))
        .otherwise(good / (1 - good))
    )
    raw = F.rint(F.lit(a) - F.lit(b) * F.ln(odds))
    return F.when(prob.isNotNull(), F.least(F.greatest(raw, F.lit(0.0)), F.lit(1000.0)) + F.lit(0.0))

"""Names and fixed values shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

# Special codes that stand for "missing" in numeric features,
# the bound above which a value counts as a real measurement, and the edges
# that hold the missing rows in the information-value bins.
SENTINELS = (-99999, -9999, -9998, -9997, -9996)
VALID_ABOVE = -9990.0
FIRST_REAL = -9996.0
MISSING_CODE = -9999.0
IV_FIRST_EDGES = (-10000.0, -9999.0)
PSI_FIRST_EDGE = -10000.0
PSI_REAL_ABOVE = -1.0
WOE_FLOOR = -20.0
WOE_CEILING = 20.0
STABLE_PSI = 0.1


@dataclass(frozen=True)
class SampleSpec:
    """Which columns of a sample table play which role."""

    id_col: str = "id"
    date_col: str = "date"
    label: str = "label"
    channel_col: str = "channel"
    base_fea: tuple[str, ...] = ("id", "date", "label", "channel")
    missing_list: tuple = (-9999, "-9998")
    fill_val: int = -9999

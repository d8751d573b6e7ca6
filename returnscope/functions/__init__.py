"""Column-expression helpers (JVM-side, no per-row Python)."""

from .calendar import calendar_columns
from .labels import (
    canonical_channel,
    canonical_device,
    canonical_region,
    channel_group,
    date_lit,
    flag,
    period,
    status_group,
    ts_lit,
)
from .stats import erfc, pct, ratio, two_proportion_ztest

__all__ = [
    "calendar_columns",
    "canonical_channel",
    "canonical_device",
    "canonical_region",
    "channel_group",
    "date_lit",
    "erfc",
    "flag",
    "pct",
    "period",
    "ratio",
    "status_group",
    "ts_lit",
    "two_proportion_ztest",
]

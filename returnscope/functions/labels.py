"""Column expressions for canonical labels, status groups and periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(d: dt.date | dt.datetime) -> Column:
    """A date as a timestamp_ntz literal (midnight), for timestamp comparisons."""
    return F.lit(d).cast("timestamp_ntz")


def date_lit(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def day_range(ts_col, lo: dt.date, hi: dt.date) -> Column:
    """Calendar day of a timestamp within [lo, hi] (inclusive), written as a
    half-open timestamp range so the predicate reaches the parquet scan."""
    c = col_(ts_col)
    return (c >= ts_lit(lo)) & (c < ts_lit(hi + dt.timedelta(days=1)))


def canonical_device(c) -> Column:
    c = col_(c)
    low = F.lower(c)
    return F.when(low == "ios", F.lit("iOS")).when(low == "android", F.lit("Android")).otherwise(c)


def canonical_region(c) -> Column:
    return F.upper(col_(c))


def canonical_channel(c) -> Column:
    c = col_(c)
    low = F.lower(c)
    return F.when(low == "paid", F.lit("Paid")).when(low == "organic", F.lit("Organic")).otherwise(c)


def status_group(label, paid=C.PAID_STATUSES, refund=C.REFUND_STATUSES) -> Column:
    """'paid' / 'refund' / 'other' from a lower-cased status label."""
    label = col_(label)
    return F.when(label.isin(*paid), F.lit("paid")).when(label.isin(*refund), F.lit("refund")).otherwise(F.lit("other"))


def channel_group(c, paid=C.PAID_CHANNELS, organic=C.ORGANIC_CHANNELS) -> Column:
    low = F.lower(col_(c))
    return F.when(low.isin(*paid), F.lit("Paid")).when(low.isin(*organic), F.lit("Organic")).otherwise(F.lit("Other"))


def period(c, release: dt.date, before: str = "before", after: str = "after") -> Column:
    """'before' when the value is earlier than the release (midnight), else 'after'."""
    c = col_(c)
    return F.when(c < ts_lit(release), F.lit(before)).otherwise(F.lit(after))


def flag(cond: Column) -> Column:
    """1 / 0 integer flag (NULL condition counts as 0, as CASE WHEN does)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))

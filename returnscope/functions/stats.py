"""Ratios, percentages and the two-proportion z-test as Column expressions.

Everything here is evaluated inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .labels import col_


def dbl(c) -> Column:
    return col_(c).cast("double")


def ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    return dbl(num) / F.nullif(dbl(den), F.lit(0.0))


def pct(num, den, digits: int = 2) -> Column:
    """ROUND(100 * num / NULLIF(den, 0), digits) on doubles."""
    return F.round(F.lit(100.0) * dbl(num) / F.nullif(dbl(den), F.lit(0.0)), digits)


# Where the series of erf hands over to the continued fraction of erfc, and the
# terms of each that reach double precision there.
ERFC_SWITCH = 2.0
ERF_TERMS = 60
ERFC_LEVELS = 120


def erfc(x) -> Column:
    """Complementary error function of a double Column, to about 1e-13 of its value.

    Below ERFC_SWITCH: 1 - erf with erf(z) = 2 z exp(-z^2) / sqrt(pi) times the
    sum of (2 z^2)^n / (1 * 3 * ... * (2 n + 1)), all of whose terms are
    positive.  Above: exp(-z^2) / sqrt(pi) over the continued fraction
    z + (1/2) / (z + (2/2) / (z + (3/2) / ...)), from its innermost level.
    """
    x = dbl(x)
    z = F.abs(x)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(acc: Column, n: Column) -> Column:
        term = acc["term"] * F.lit(2.0) * z * z / (F.lit(2.0) * n + F.lit(1.0))
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    gauss = F.exp(-z * z)
    series = F.aggregate(F.sequence(F.lit(1), F.lit(ERF_TERMS)), start, add, lambda acc: acc["total"])
    small = F.lit(1.0) - F.lit(2.0 / math.sqrt(math.pi)) * z * gauss * series
    tail = F.aggregate(
        F.sequence(F.lit(ERFC_LEVELS), F.lit(1), F.lit(-1)),
        F.lit(0.0),
        lambda acc, n: n.cast("double") / F.lit(2.0) / (z + acc),
    )
    large = gauss / F.lit(math.sqrt(math.pi)) / (z + tail)
    ans = F.when(z < ERFC_SWITCH, small).otherwise(large)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def two_proportion_ztest(c1, n1, c2, n2, z_crit: float = C.Z_95) -> dict[str, Column]:
    """Pooled two-sided z-test of c1/n1 against c2/n2 and the unpooled Wald
    interval of (c2/n2 - c1/n1).

    z = (p1 - p2) / sqrt(p (1 - p) (1/n1 + 1/n2)), p = (c1 + c2) / (n1 + n2);
    p-value = erfc(|z| / sqrt 2).  Results are NULL
    where a base is 0 or NULL, or a variance is not positive (refunds above
    orders make p exceed 1).
    Rates and bounds are in percentage points.
    """
    c1, n1, c2, n2 = dbl(c1), dbl(n1), dbl(c2), dbl(n2)
    valid = (n1 > 0) & (n2 > 0)
    p1 = F.when(valid, c1 / n1)
    p2 = F.when(valid, c2 / n2)
    pooled = (c1 + c2) / (n1 + n2)
    var = pooled * (F.lit(1.0) - pooled) * (F.lit(1.0) / n1 + F.lit(1.0) / n2)
    std = F.when(valid & (var > 0), F.sqrt(var))
    z = (p1 - p2) / std
    p_value = F.when(z.isNotNull(), erfc(F.abs(z) / F.lit(math.sqrt(2.0))))
    wald_var = p1 * (F.lit(1.0) - p1) / n1 + p2 * (F.lit(1.0) - p2) / n2
    se = F.when(wald_var >= 0, F.sqrt(wald_var))
    diff = p2 - p1
    return {
        "return_rate_before": p1 * F.lit(100.0),
        "return_rate_after": p2 * F.lit(100.0),
        "delta_pp": diff * F.lit(100.0),
        "z_stat": z,
        "p_value": p_value,
        "ci_low_pp": (diff - F.lit(z_crit) * se) * F.lit(100.0),
        "ci_high_pp": (diff + F.lit(z_crit) * se) * F.lit(100.0),
    }

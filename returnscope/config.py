"""Parameters of the library.

Every operator takes these as keyword arguments; the defaults are the values the
original analysis fixes.  ``DRIVER_PARAMS`` holds the values used on the driver's
synthetic tables (FIXTURES.md), where the release falls on 2024-01-16.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must equal the original analysis for equal results).
# ---------------------------------------------------------------------------
# Order statuses counted as paid orders.
PAID_STATUSES = ("paid", "completed", "delivered", "success", "approved")
# Order statuses counted as refunds.
REFUND_STATUSES = ("refund", "refunded", "returned", "chargeback")
# Refund event names used by the quick-refund analysis.
REFUND_EVENT_NAMES = ("refunded", "refund", "returned", "chargeback")
# Funnel steps, in funnel order.
FUNNEL_STEPS = ("add_to_cart", "checkout_start", "payment_success", "refund")
# Channel groups.
PAID_CHANNELS = ("paid", "ads", "cpi", "cpp", "cpa", "sem", "facebook_ads", "google_ads")
ORGANIC_CHANNELS = ("organic", "seo", "direct", "referral")
# Release date of the checkout redesign.
RELEASE_DATE = dt.date(2025, 6, 15)
# Study range of the before/after return rate (inclusive, compared as timestamps).
RR_RANGE = (dt.date(2025, 6, 1), dt.date(2025, 6, 30))
# Half width in days of the segment A/B window.
AB_WINDOW_DAYS = 30
# Window of the quick-refund analysis and 24 h threshold.
QUICK_REFUND_WINDOW_DAYS = 30
QUICK_REFUND_HOURS = 24
# D7 registration cohorts: (label, start inclusive, end exclusive or None).
D7_COHORTS = (
    ("post", dt.date(2025, 6, 1), dt.date(2025, 7, 1)),
    ("pre", dt.date(2025, 5, 1), dt.date(2025, 6, 1)),
)
D7_WINDOW_DAYS = 7
# Refund-rate registration cohorts and the refund window after registration.
RR_COHORT_PRE = (dt.date(2025, 5, 15), dt.date(2025, 6, 1))
RR_COHORT_POST = (RELEASE_DATE, None)
RR_COHORT_WINDOW_DAYS = 30
# Comment date range (inclusive, compared as timestamps).
COMMENT_RANGE = (dt.date(2025, 6, 15), dt.date(2025, 6, 30))
# Text model parameters.
TFIDF_MAX_FEATURES = 5000
KMEANS_K = 3
KMEANS_SEED = 42
KMEANS_K_RANGE = tuple(range(2, 9))
KMEANS_MAX_ITER = 300
KMEANS_TOL = 1e-4
# Ours: seedings per fit, of which the best counts.
KMEANS_RESTARTS = 4
# Ours: comments that a sample of the silhouette has, where a caller asks for one.
SILHOUETTE_SAMPLE_ROWS = 2_000
TOP_TERMS = 10
EXAMPLES_PER_CLUSTER = 3
# Normal quantile of the 95% Wald interval.
Z_95 = 1.96


@dataclass(frozen=True)
class Params:
    """One set of analysis parameters (defaults: the original analysis)."""

    release: dt.date = RELEASE_DATE
    rr_range: tuple = RR_RANGE
    ab_window_days: int = AB_WINDOW_DAYS
    quick_refund_window_days: int = QUICK_REFUND_WINDOW_DAYS
    quick_refund_hours: int = QUICK_REFUND_HOURS
    d7_cohorts: tuple = D7_COHORTS
    d7_window_days: int = D7_WINDOW_DAYS
    rr_cohort_pre: tuple = RR_COHORT_PRE
    rr_cohort_post: tuple = RR_COHORT_POST
    rr_cohort_window_days: int = RR_COHORT_WINDOW_DAYS
    comment_range: tuple = COMMENT_RANGE
    kpi_range: tuple = RR_RANGE
    top_n: int = 10


# Parameters for the driver tables (FIXTURES.md section 2): orders and events are
# folded into January 2024 and the release falls on 2024-01-16.
DRIVER_RELEASE = dt.date(2024, 1, 16)
DRIVER_PARAMS = Params(
    release=DRIVER_RELEASE,
    rr_range=(dt.date(2024, 1, 1), dt.date(2024, 1, 30)),
    d7_cohorts=(
        ("post", DRIVER_RELEASE, None),
        ("pre", dt.date(2023, 12, 25), DRIVER_RELEASE),
    ),
    d7_window_days=7,
    rr_cohort_pre=(dt.date(2023, 12, 25), DRIVER_RELEASE),
    rr_cohort_post=(DRIVER_RELEASE, None),
    rr_cohort_window_days=14,
    comment_range=(DRIVER_RELEASE, dt.date(2024, 1, 30)),
    kpi_range=(dt.date(2024, 1, 1), dt.date(2024, 1, 30)),
)

"""Operators: DataFrame in, DataFrame out (one per analysis step)."""

from .analysis import (
    cart_dropoff,
    checkout_funnel_before_after,
    d7_retention_cohorts,
    first_refunds,
    funnel_by_month,
    quick_refund_share,
    rr_before_after,
    rr_by_dimension,
    rr_by_registration_cohort,
    rr_segment_ab,
    rr_ztest,
    top_rr_growth,
)
from .asof import asof_forward_min
from .dims import dim_date, dim_event_name, dim_order_status, dim_user
from .facts import event_map, fact_events, fact_orders, label_events, label_orders, status_map
from .joins import dense_ids
from .marts import (
    conv_daily,
    d7_purchase_retention,
    daily_orders_refunds,
    date_spine,
    first_purchase,
    funnel_daily,
    marts_kpi_daily,
    marts_kpi_daily_stacked,
    marts_segments,
    step_daily,
)
from .quality import key_violations, kpi_totals, unique_key_check
from .staging import stg_events_clean, stg_orders_clean, stg_users_clean

__all__ = [name for name in dir() if not name.startswith("_")]

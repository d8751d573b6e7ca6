"""Dimension layer (rows 4-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from .joins import dense_ids, extend_ids


def dim_user(users_clean: DataFrame) -> DataFrame:
    """Distinct user attributes."""
    return users_clean.select("user_id", "region", "device", "channel").distinct()


def dim_date(users_clean: DataFrame, events_clean: DataFrame) -> DataFrame:
    """One row per day from the earliest to the latest registration or event
    day, with calendar attributes.  Order dates do not widen the range."""
    days = users_clean.select(F.col("reg_date").cast("date").alias("d")).unionByName(
        events_clean.select(F.to_date("event_date").alias("d"))
    )
    bounds = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    series = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return series.select(*calendar_columns("d"))


def dim_order_status(orders_clean: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Distinct order status with a surrogate id (ids follow the name order); with the ``stored`` dimension of an
    earlier build its ids stay and new statuses are numbered above them."""
    if stored is not None:
        return extend_ids(stored, orders_clean, "status", "status_id", "status_name")
    return dense_ids(orders_clean, "status", "status_id").select(
        "status_id", F.col("status").alias("status_name")
    )


def dim_event_name(events_clean: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Distinct event name with a surrogate id (ids follow the name order); ``stored`` as for ``dim_order_status``."""
    if stored is not None:
        return extend_ids(stored, events_clean, "event_name", "event_name_id", "event_name")
    return dense_ids(events_clean, "event_name", "event_name_id").select("event_name_id", "event_name")

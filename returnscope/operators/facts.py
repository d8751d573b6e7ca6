"""Fact layer and labelling through the small lookup maps (rows 8-10).

The maps are joined plainly: a written lookup table has an exact size, by which
the planner broadcasts it, or shuffles above its threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.labels import status_group


def fact_orders(orders_clean: DataFrame, order_status: DataFrame) -> DataFrame:
    """Orders with their status id; the inner join drops NULL statuses."""
    return orders_clean.join(order_status, orders_clean.status == order_status.status_name, "inner").select(
        "order_id", "user_id", "order_date", "amount", "status_id"
    )


def fact_events(events_clean: DataFrame, event_name: DataFrame) -> DataFrame:
    """Events with their event name id (the event id is dropped)."""
    return events_clean.join(event_name, "event_name", "inner").select("user_id", "event_date", "event_name_id")


def status_map(order_status: DataFrame) -> DataFrame:
    """status_id -> lower-cased status label (the materialised lookup map)."""
    return order_status.select("status_id", F.lower("status_name").alias("st"))


def event_map(event_name: DataFrame) -> DataFrame:
    """event_name_id -> lower-cased event label (the materialised lookup map)."""
    return event_name.select("event_name_id", F.lower("event_name").alias("ev"))


def label_orders(
    fact: DataFrame, order_status: DataFrame, paid=C.PAID_STATUSES, refund=C.REFUND_STATUSES
) -> DataFrame:
    """Orders with their lower-cased status label and group paid / refund / other."""
    return fact.join(status_map(order_status), "status_id", "inner").withColumn("status_group", status_group("st", paid, refund))


def label_events(fact: DataFrame, event_name: DataFrame) -> DataFrame:
    """Events with their lower-cased event label ``ev``."""
    return fact.join(event_map(event_name), "event_name_id", "inner")

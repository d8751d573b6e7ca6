"""Staging layer: clean and de-duplicate raw users, orders and events (rows 1-3).

De-duplication keeps the earliest row per key with ROW_NUMBER() = 1.  Spark
plans this as a partial WindowGroupLimit before the shuffle, so a key that holds
a large share of all rows is cut to one row per map task before it is moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import canonical_channel, canonical_device, canonical_region


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the first by ``order`` (ascending, NULLs last)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def stg_users_clean(users_raw: DataFrame) -> DataFrame:
    """Canonical device (iOS / Android), upper-case region, canonical channel
    (Paid / Organic); one row per user_id with the earliest reg_date."""
    canon = users_raw.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.col("reg_date").cast("date").alias("reg_date"),
        canonical_device("device").alias("device"),
        canonical_region("region").alias("region"),
        canonical_channel("channel").alias("channel"),
    )
    return keep_first(canon, "user_id", ["reg_date", "device", "region", "channel"])


def stg_orders_clean(orders_raw: DataFrame) -> DataFrame:
    """Orders with amount >= 0 (NULL amounts drop), lower-case status; one row
    per order_id with the earliest order_date."""
    canon = orders_raw.where(F.col("amount") >= 0).select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.col("order_date").cast("timestamp_ntz").alias("order_date"),
        F.col("amount").cast("decimal(8,2)").alias("amount"),
        F.lower("status").alias("status"),
    )
    return keep_first(canon, "order_id", ["order_date", "user_id", "amount", "status"])


def stg_events_clean(events_raw: DataFrame) -> DataFrame:
    """Events with lower-case names; one row per event_id with the earliest
    event_date."""
    canon = events_raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.col("event_date").cast("timestamp_ntz").alias("event_date"),
        F.lower("event_name").alias("event_name"),
    )
    return keep_first(canon, "event_id", ["event_date", "user_id", "event_name"])

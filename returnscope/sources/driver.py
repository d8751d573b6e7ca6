"""Raw users, orders, events and comments built from the driver tables.

This module only shapes rows into the raw schemas (FIXTURES.md section 2); it
does none of the analysis.  Orders (1995-2001) and events (January 2024) do not
overlap in time, so order dates are folded into the event month.  A second copy
of every 50th key, one day later, exercises the de-duplication of staging.
The same expressions are used by the DuckDB oracle (plans/oracle.py).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Fixed values of the mapping (FIXTURES.md section 2).
REG_DATE_BASE = dt.date(2023, 12, 25)
ORDER_DATE_BASE = dt.date(2024, 1, 1)
ORDER_DATE_EPOCH = dt.date(1995, 1, 1)
COMMENT_DATE_BASE = dt.date(2024, 1, 10)
DUPLICATE_EVERY = 50
NEGATIVE_AMOUNT_EVERY = 97
SEGMENT_TO_CHANNEL = {
    "MACHINERY": "paid",
    "BUILDING": "ads",
    "AUTOMOBILE": "seo",
    "HOUSEHOLD": "ORGANIC",
    "FURNITURE": "email",
}
ORDER_STATUS_TO_STATUS = {"F": "Paid", "O": "Refunded", "P": "pending"}


def _case(col, mapping: dict, otherwise=None):
    expr = None
    for key, value in mapping.items():
        expr = F.when(col == key, value) if expr is None else expr.when(col == key, value)
    return expr.otherwise(otherwise if otherwise is not None else F.lit(None))


def _one_day_later(col):
    return col + F.expr("INTERVAL 1 DAY")


def users_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    # two lookups of a few rows each, broadcast by the planner from their file sizes
    located = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").join(
        region, nation.n_regionkey == region.r_regionkey, "left"
    )
    base = located.select(
        F.col("c_custkey").cast("int").alias("user_id"),
        F.date_add(F.lit(REG_DATE_BASE), ((F.col("c_custkey") * 11) % 37).cast("int")).alias("reg_date"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("ANDROID")).otherwise(F.lit("ios")).alias("device"),
        F.lower("r_name").alias("region"),
        _case(F.col("c_mktsegment"), SEGMENT_TO_CHANNEL).alias("channel"),
    )
    copies = base.where(F.col("user_id") % DUPLICATE_EVERY == 0).withColumn(
        "reg_date", F.date_add("reg_date", 1)
    )
    return base.unionByName(copies)


def orders_raw(spark: SparkSession, sf_dir: str, copies: bool = True, negatives: bool = True) -> DataFrame:
    """Raw orders; ``copies`` / ``negatives`` switch off the second copies and
    the negative amounts (FIXTURES.md gives figures measured without them)."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    day = F.datediff(F.to_date("o_orderdate"), F.lit(ORDER_DATE_EPOCH)) % 30
    second = (F.col("o_orderkey") * 7919) % 86400
    order_date = F.date_add(F.lit(ORDER_DATE_BASE), day.cast("int")).cast("timestamp_ntz") + F.make_dt_interval(
        secs=second.cast("decimal(18,6)")
    )
    amount = F.col("o_totalprice").cast("decimal(8,2)")
    base = orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("int").alias("user_id"),
        order_date.alias("order_date"),
        (F.when(F.col("o_orderkey") % NEGATIVE_AMOUNT_EVERY == 0, -amount).otherwise(amount) if negatives else amount).alias(
            "amount"
        ),
        _case(F.col("o_orderstatus"), ORDER_STATUS_TO_STATUS, F.col("o_orderstatus")).alias("status"),
        F.col("o_orderkey").alias("_key"),
    )
    if not copies:
        return base.drop("_key")
    extra = base.where(F.col("_key") % DUPLICATE_EVERY == 0).withColumn("order_date", _one_day_later(F.col("order_date")))
    return base.unionByName(extra).drop("_key")


def events_raw(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """Raw events; ``copies`` switches off the second copies."""
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    t, eid = F.col("event_type"), F.col("event_id")
    name = (
        F.when(t == "view", F.lit("add_to_cart"))
        .when(t == "click", F.lit("checkout_start"))
        .when((t == "purchase") & (eid % 7 == 0), F.lit("payment_success"))
        .when((t == "error") & (eid % 5 == 0), F.lit("refund"))
        .otherwise(t)
    )
    base = events.select(
        eid.cast("string").alias("event_id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.col("ts").cast("timestamp_ntz").alias("event_date"),
        name.alias("event_name"),
        eid.alias("_key"),
    )
    if not copies:
        return base.drop("_key")
    extra = base.where(F.col("_key") % DUPLICATE_EVERY == 0).withColumn("event_date", _one_day_later(F.col("event_date")))
    return base.unionByName(extra).drop("_key")


def over_two_months(events: DataFrame) -> DataFrame:
    """Raw events with odd ids moved 31 days on (all driver events fall in one month)."""
    later = F.col("event_date") + F.expr("INTERVAL 31 DAY")
    return events.withColumn("event_date", F.when(F.col("event_id").cast("long") % 2 == 1, later).otherwise(F.col("event_date")))


def comments_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comments with ``source`` of their document (NULL: empty), a given
    grouping for the cluster reports."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return _as_comments(docs, F.coalesce("source", F.lit("")).alias("source"))


def comments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as customer comments (comment_id, comment_date, comment)."""
    return _as_comments(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def _as_comments(docs: DataFrame, *more) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("comment_id"),
        F.date_add(F.lit(COMMENT_DATE_BASE), (F.col("doc_id") % 25).cast("int")).cast("timestamp_ntz").alias("comment_date"),
        F.col("text").alias("comment"),
        *more,
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "users_raw": users_raw(spark, sf_dir),
        "orders_raw": orders_raw(spark, sf_dir),
        "events_raw": events_raw(spark, sf_dir),
    }

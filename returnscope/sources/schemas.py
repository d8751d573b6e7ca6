"""Schemas of the raw input tables (the DDL of the staging layer)."""

from pyspark.sql import types as T

USERS_RAW = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("reg_date", T.DateType()),
        T.StructField("device", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("channel", T.StringType()),
    ]
)

ORDERS_RAW = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("amount", T.DecimalType(8, 2)),
        T.StructField("status", T.StringType()),
    ]
)

EVENTS_RAW = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("event_date", T.TimestampNTZType()),
        T.StructField("event_name", T.StringType()),
    ]
)

# comment_id is ours, for a stable order of the examples per cluster; the file may lack it.
COMMENTS = T.StructType(
    [
        T.StructField("comment_id", T.LongType()),
        T.StructField("comment_date", T.TimestampNTZType()),
        T.StructField("comment", T.StringType()),
    ]
)

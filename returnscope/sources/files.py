"""File sources and sinks: the comments CSV, and drop-and-create-as writes."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def split_comments_csv(
    spark: SparkSession, path: str, timestamp_format: str | None = None, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """CSV scan of customer comments; columns are found by their header names.

    Returns the comments and the rejected rows (reason, record).  The file has
    ``comment_date`` and ``comment``; a ``comment_id`` column is used if there is one, else it is NULL.
    ``multi_line`` reads quoted line breaks, at the price of one task per file.

    A bad row never ends the job.  Reasons: ``row`` (more or fewer fields than
    the header, or broken quotes; ``record`` is the row as it stands), ``date`` (a date that cannot be
    read) and ``id`` (an id that is no whole number; for both, ``record`` is the row's fields as JSON).  The
    first that applies counts.  An empty date or id is NULL and not rejected.
    """
    # without a schema all columns are strings, under the header's names: only the header is read
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    names = reader.csv(path).columns
    fields = [c.strip().lower() for c in names]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_bad_row"]])
    # whole rows are parsed whatever is selected later, so that field counts are always checked
    raw = reader.schema(schema).option("columnNameOfCorruptRecord", "_bad_row").option("columnPruning", False).csv(path)
    raw = raw.toDF(*fields, "_bad_row")
    given = F.col("comment_date")
    ts = F.try_to_timestamp(given, F.lit(timestamp_format)) if timestamp_format else F.try_to_timestamp(given)
    if "comment_id" in fields:
        number, no_number = F.col("comment_id").try_cast("long"), F.col("comment_id").isNotNull() & F.col("comment_id").try_cast("long").isNull()
    else:
        number, no_number = F.lit(None).cast("long"), F.lit(False)
    reason = F.when(F.col("_bad_row").isNotNull(), "row").when(given.isNotNull() & ts.isNull(), "date").when(no_number, "id")
    record = F.coalesce("_bad_row", F.to_json(F.struct(*fields)))
    rows = raw.select(reason.alias("reason"), record.alias("record"), number.alias("comment_id"), ts.cast("timestamp_ntz").alias("comment_date"), "comment")
    return rows.where("reason IS NULL").select("comment_id", "comment_date", "comment"), rows.where("reason IS NOT NULL").select("reason", "record")


def read_comments_csv(
    spark: SparkSession,
    path: str,
    timestamp_format: str | None = None,
    multi_line: bool = False,
    rejects_path: str | None = None,
    max_rejected: int | None = None,
) -> DataFrame:
    """The readable comments of ``split_comments_csv``.  The rejected rows are written to ``rejects_path`` as JSON, if
    given; more than ``max_rejected`` of them (None: any number) raise an error that counts them by reason."""
    good, rejected = split_comments_csv(spark, path, timestamp_format, multi_line)
    if rejects_path is not None:
        rejected.write.mode("overwrite").json(rejects_path)
        rejected = spark.read.schema("reason string, record string").json(rejects_path)
    if max_rejected is not None:
        counts = {r["reason"]: r["count"] for r in rejected.groupBy("reason").count().collect()}  # three reasons at most
        if sum(counts.values()) > max_rejected:
            raise ValueError(f"{sum(counts.values())} rows of {path} cannot be read: {counts}")
    return good


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """DROP + CREATE TABLE AS: overwrite a parquet table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def materialize(df: DataFrame, name: str, spark: SparkSession | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back (as ``schema``, if given).

    Cuts the lineage with a reliable copy (survives executor loss) and gives the
    planner exact file statistics for later join decisions.
    """
    spark = spark or df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    write_table(df, path)
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)

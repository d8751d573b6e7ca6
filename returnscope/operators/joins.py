"""Distributed dense ids for lookup dimensions, and ids that later builds keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense_ids(values: DataFrame, order_col: str, id_col: str, num_partitions: int | None = None) -> DataFrame:
    """Attach ids 1..n to the distinct values of ``order_col``, in value order
    (NULL last): ROW_NUMBER() OVER (ORDER BY value) over the distinct values.

    The distinct values are range-partitioned (AQE merges small ranges unless
    ``num_partitions`` fixes their number), numbered inside each partition, and
    shifted by the running count of the earlier partitions; only those counts
    (one row per partition) are combined globally.
    """
    from ..sources.files import materialize

    distinct = values.select(order_col).distinct().cache()  # read twice: range sample, then rows
    order = F.col(order_col).asc_nulls_last()
    ranged = distinct.repartitionByRange(num_partitions, order) if num_partitions else distinct.repartitionByRange(order)
    ranged = (
        ranged.sortWithinPartitions(order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id = (partition index << 33) + row index in partition
    ranged = ranged.withColumn("_idx", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    # the counts and the numbered rows must come from one evaluation (range
    # bounds are sampled): write them once to the checkpoint folder
    ranged = materialize(ranged, "dense-ids")
    distinct.unpersist()
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    # one row per partition
    return ranged.join(F.broadcast(offsets), "_pid").select(
        (F.col("_off") + F.col("_idx") + 1).cast("int").alias(id_col), F.col(order_col)
    )


def extend_ids(stored: DataFrame, values: DataFrame, value_col: str, id_col: str, name_col: str) -> DataFrame:
    """The dimension ``stored`` (``id_col``, ``name_col``) with the values of ``value_col`` it lacks, numbered above its
    largest id in value order: INSERT ... SELECT DISTINCT into a table with a serial key.

    Stored rows keep their ids, also of values that no longer occur, so facts stored earlier stay right.  NULL is
    one value.  With nothing stored the ids are ``dense_ids``.
    """
    fresh = values.select(F.col(value_col).alias(name_col)).distinct()
    old = stored.select(F.col(name_col).alias("_old"))
    fresh = fresh.join(old, F.col(name_col).eqNullSafe(F.col("_old")), "left_anti")
    top = stored.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).first()["top"]
    numbered = dense_ids(fresh, name_col, id_col).select((F.col(id_col) + F.lit(int(top))).cast("int").alias(id_col), name_col)
    return stored.select(F.col(id_col).cast("int").alias(id_col), name_col).unionByName(numbered)

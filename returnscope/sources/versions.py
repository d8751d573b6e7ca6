"""Tables and layer sets as versions: a build becomes visible in one step, or not at all.

A root folder holds ``builds/<version>/...`` and ``current/<version>`` (one
empty file per finished build).  A build writes its own folder; creating its
file in ``current`` is the swap, and readers take the greatest one.  A build
that fails leaves no such file, so the old rows stay readable.  Versions are
numbered above those present; builds of one root must not overlap.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path, so that any store works that Spark writes to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, at = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def finished(spark: SparkSession, root: str) -> list[str]:
    """Names of the finished versions, oldest first."""
    return [n for n in _names(spark, os.path.join(root, "current")) if not n.startswith((".", "_"))]


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest finished version; None if there is none."""
    done = finished(spark, root)
    return os.path.join(root, "builds", done[-1]) if done else None


def begin(spark: SparkSession, root: str) -> str:
    """The folder for a new version, above all that were begun."""
    begun = [n for n in _names(spark, os.path.join(root, "builds")) + finished(spark, root) if n[:12].isdigit()]
    number = max((int(n[:12]) for n in begun), default=0) + 1
    return os.path.join(root, "builds", f"{number:012d}-{uuid.uuid4().hex[:8]}")


def commit(spark: SparkSession, build: str, keep: int = 2) -> None:
    """Makes ``build`` the current version and deletes all but the newest ``keep`` (readers of the one before go on)."""
    root, name = os.path.dirname(os.path.dirname(build)), os.path.basename(build)
    fs, at = _fs(spark, os.path.join(root, "current", name))
    fs.create(at, True).close()
    kept = set(finished(spark, root)[-keep:])
    for old in _names(spark, os.path.join(root, "builds")):
        if old not in kept and old < name:  # older finished ones, and failed builds
            marker = _fs(spark, os.path.join(root, "current", old))
            marker[0].delete(marker[1], False)
            folder = _fs(spark, os.path.join(root, "builds", old))
            folder[0].delete(folder[1], True)


def replace_table(df: DataFrame, root: str, partition_by: list[str] | None = None, keep: int = 2) -> None:
    """DROP + CREATE TABLE AS in one step: ``df`` may read the table it replaces."""
    spark = df.sparkSession
    build = begin(spark, root)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(build)
    commit(spark, build, keep)


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest finished version of a table; None if there is none."""
    at = current(spark, root)
    return None if at is None else spark.read.parquet(at)


def replace_partitions(df: DataFrame, path: str, column: str, values: list, columns: list[str] | None = None) -> None:
    """Replaces the partitions ``column`` in ``values`` of the Parquet table at ``path`` by ``df``'s rows (dynamic
    overwrite: the others aren't touched); partitions of ``values`` without rows are deleted.  ``df`` must not read the table."""
    spark = df.sparkSession
    out = df.select(*(columns or df.columns))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    have = {r[0] for r in df.select(column).distinct().collect()}  # at most one row per value
    for value in values:
        if value not in have:
            folder = _fs(spark, os.path.join(path, f"{column}={value}"))
            folder[0].delete(folder[1], True)

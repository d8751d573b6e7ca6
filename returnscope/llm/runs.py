"""Ordered groups without one task per group: places of rows and streamed digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from returnscope.llm.common import written

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def numbered(rows: DataFrame, group: str, order: list[Column], keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """``group`` (a long), ``keep`` and ``place``: 1, 2, ... in ``order`` within each group; and the
    written table that the first one reads.

    Rows are range-partitioned by group, order and a random last key, so a group
    of any size, and equal rows too, spread over tasks.  Each task numbers its
    sorted rows; groups that go on in a further partition then add the rows
    before it (one number per partition, so that table is small).  The numbered
    rows are written once, because range bounds are sampled.  Equal rows get
    their places in any order.
    """
    columns = [group, *keep]
    dealt = rows.withColumn("_any", F.rand(7))
    dealt = dealt.repartitionByRange(F.col(group), *order, "_any").sortWithinPartitions(F.col(group), *order, "_any")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*columns).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column(group).to_numpy()
            place = np.arange(1, len(g) + 1)
            new = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            if last == g[0]:
                place += count  # of the first group; later ones subtract it again
            start = np.zeros(len(g), np.int64)
            start[new] = place[new] - 1
            if last == g[0]:
                start[0] = 0
            place = place - np.maximum.accumulate(start)
            last, count = g[-1], int(place[-1])
            yield pa.record_batch([*batch.columns, pa.array(place), pa.array(np.full(len(g), part, np.int32))], names=[*columns, "place", "_part"])

    local = written(dealt.select(*columns).mapInArrow(run, f"{schema}, place long, _part int"), "numbered")
    sizes = local.groupBy(group, "_part").agg(F.max("place").alias("_size"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per partition: only a partition's first group can have begun before it
    sizes = sizes.select(group, "_part", F.sum("_size").over(earlier).alias("_before")).filter("_before > 0")
    out = local.join(F.broadcast(sizes), [group, "_part"], "left")
    return out.select(*columns, (F.col("place") + F.coalesce("_before", F.lit(0))).alias("place")), local


def sha256_of_ids(rows: DataFrame, keys: list[str], value: str, chunk: int = 1 << 16) -> DataFrame:
    """``keys`` and ``ends_sha256``: SHA-256 of a group's ids, ascending, comma-joined.

    A digest is sequential, so the bytes of one group end in one task; but its
    ids are sorted and made to text in range partitions, and that task streams
    strings of about ``chunk`` characters in bounded memory.
    """
    n = len(keys)
    dealt = rows.select(*keys, value).repartitionByRange(*keys, value).sortWithinPartitions(*keys, value)
    named = ", ".join(f"{k} long" for k in keys)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        key, first, ids, size = None, 0, [], 0

        def out() -> pa.RecordBatch:
            data = [pa.array([d[i] for d in done], pa.int64()) for i in range(n + 1)]
            return pa.record_batch([*data, pa.array([d[n + 1] for d in done], pa.string())], names=[*keys, "first", "part"])

        for batch in batches:
            for *k, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key or size >= chunk:
                    if ids:
                        done.append((*key, first, ",".join(ids)))
                    key, first, ids, size = k, v, [], 0
                ids.append(str(v))
                size += len(ids[-1]) + 1
            if len(done) >= 100:
                yield out()
                done = []
        if ids:
            done.append((*key, first, ",".join(ids)))
        if done:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None

        def out(done: list[tuple]) -> pa.RecordBatch:
            data = [pa.array([d[i] for d in done], pa.int64()) for i in range(n)]
            return pa.record_batch([*data, pa.array([d[n] for d in done], pa.string())], names=[*keys, "ends_sha256"])

        for batch in batches:
            done = []
            for *k, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if running:
                        done.append((*key, running.hexdigest()))
                    key, running = k, hashlib.sha256(part.encode())
                else:
                    running.update(b"," + part.encode())
            yield out(done)
        if running:
            yield out([(*key, running.hexdigest())])

    parts = dealt.mapInArrow(join, f"{named}, first long, part string")
    parts = parts.repartition(*keys).sortWithinPartitions(*keys, "first").select(*keys, "part")
    return parts.mapInArrow(digest, f"{named}, ends_sha256 string")

"""Operator 10: n-gram Jaccard self-join by T-occurrence search.

A document's set holds the distinct k-word shingles of its text (A-Z lowered);
a shorter text counts as one shingle, an empty one has none.  Two documents
link when 100 * |intersection| >= percent * |union|, which is the same as
sharing at least T = ceil(percent * (m + n) / (100 + percent)) shingles of
their m and n: they must occur together on T of their inverted lists.

1. Equal sets collapse into one node (128-bit digest of the set, smallest id).
2. Every node orders its shingles by the size of their inverted lists, short
   ones first.  List sizes are estimated with one count-min row of fixed width
   over all documents (any order gives the same links; this one is fast).
   Partners share one of the first n - ceil(percent * n / 100) + 1 shingles,
   so only those short lists are laid out; the long ones are probed later.
3. On every short list, pairs whose sizes allow T and whose parity bitmaps
   (|xor| never exceeds the symmetric difference) do not rule it out become
   candidates.  The first round keeps each node's closest candidate, so a
   group of n near copies sends n pairs, not n * n.  Lists with very many
   nodes are dealt as pairs of parts to many tasks.  What these bitmaps of a
   fixed width let through meets bitmaps as wide as the sets.
4. DivideSkip decides candidates on the whole sets: per query, the inverted
   lists over its candidates are split into the L longest and the rest; the
   rest are heap-merged, candidates found on at least T - L of them are
   probed in the long lists by binary search, and those reaching T are links.
5. Links are contracted to components; the second round sends every candidate
   pair that lies in two different components, so no link between components
   is lost, while pairs inside one, whose links cannot change it, are not
   sent.

Shingles are 48-bit hashes (a chance of about 1e-9 per candidate pair to count
one too many).  Sets are rebuilt from the texts of candidate documents only;
a Bloom filter of fixed size keeps other texts from being shuffled.

Defined results: rows without doc_id get their n_shingles and a null
component; rows that repeat a doc_id are decided row by row; extra columns
are dropped.
"""

from __future__ import annotations

import heapq
import itertools
import math
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.llm import words as W
from returnscope.llm.common import discard, slices, small_batches, text_buffers, written
from returnscope.llm.graph import components

CELLS = 1 << 21  # cells of the list-size sketch
CHUNK = 1 << 16  # cells per row when sketches are added up
BLOOM_BITS = 1 << 26
BITMAP_BITS = 512
MU = 0.01  # DivideSkip's weight between merging and probing


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit shingles, ascending per text, and their count per text (below 65,536 texts)."""
    buf = W.LOWER[buf]
    starts, ends, first = W.split(buf, off)
    words = W.hashes(buf, starts, ends)
    n = np.diff(first)
    parts = []
    if len(words) >= k:
        at = np.flatnonzero(np.arange(len(words)) + k <= np.repeat(first[1:], n))
        doc = np.searchsorted(first, at, "right") - 1
        parts.append((doc.astype(np.uint64) << np.uint64(48)) | (W.windows(words, k)[at] >> np.uint64(16)))
    for size in range(1, k):
        doc = np.flatnonzero(n == size)
        if len(doc):
            whole = np.full(len(doc), size, np.uint64)
            for j in range(size):
                whole = W.mix(whole * np.uint64(W.BASE) + words[first[doc] + j])
            parts.append((doc.astype(np.uint64) << np.uint64(48)) | (whole >> np.uint64(16)))
    keys = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    count = np.diff(np.searchsorted(keys, np.arange(len(n) + 1).astype(np.uint64) << np.uint64(48)))
    return keys & np.uint64((1 << 48) - 1), count


def _sums(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(count)
    return total[ends] - total[ends - count]


def _pack48(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def needed(m, n, percent: int):
    """Shingles that two sets of m and n must share."""
    return -(-percent * (m + n) // (100 + percent))


def divide_skip(query: list[int], records: list[list[int]], required: list[int], mu: float = MU) -> list[tuple[int, int]]:
    """T-occurrence search over ``records`` (ascending token lists): (record, overlap) of
    those that share at least their own ``required`` number of tokens with ``query``."""
    lists: dict[int, list[int]] = {}
    wanted = set(query)
    for r, tokens in enumerate(records):
        for t in wanted.intersection(tokens):
            lists.setdefault(t, []).append(r)
    least = min(required)
    by_length = sorted(lists.values(), key=len, reverse=True)
    n_long = min(len(by_length), max(0, least - 1), int(least / (mu * math.log2(max(2, len(by_length[0]))) + 1)) if by_length else 0)
    long, short = by_length[:n_long], by_length[n_long:]
    found = []
    for r, same in itertools.groupby(heapq.merge(*short)):
        have = sum(1 for _ in same)
        if have < required[r] - n_long:
            continue
        left = n_long
        for one in long:
            if have + left < required[r]:
                break
            left -= 1
            i = bisect_left(one, r)
            have += i < len(one) and one[i] == r
        if have >= required[r]:
            found.append((r, have))
    return found


# --- passes over the texts -------------------------------------------------

PROFILE = "doc_id long, n int, a long, b long, part int, chunk int, counts binary"
FAN_IN = 64  # sketches added up in one task


def _profiles(docs: DataFrame, k: int) -> DataFrame:
    """Size and digest of every set; at a task's end, its part of the list-size sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "a", "b", "part", "chunk", "counts"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        sketch = np.zeros(CELLS, np.uint32)
        for batch in slices(batches, "text"):
            tokens, count = shingle_sets(*text_buffers(batch.column("text")), k)
            np.add.at(sketch, (tokens & np.uint64(CELLS - 1)).astype(np.int64), np.uint32(1))
            a = _sums(W.mix(tokens + np.uint64(0xA5A5A5A5)), count).view(np.int64)
            b = _sums(W.mix(tokens ^ np.uint64(0x5DEECE66D)), count).view(np.int64)
            m = len(count)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(count, pa.int32()), pa.array(a), pa.array(b), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                names=names,
            )
        parts = sketch.reshape(-1, CHUNK)
        some = np.flatnonzero(parts.any(axis=1))
        m, part = len(some), TaskContext.get().partitionId()
        yield pa.record_batch(
            [pa.nulls(m, t) for t in types] + [pa.array([part] * m, pa.int32()), pa.array(some, pa.int32()), pa.array([parts[i].astype("<u4").tobytes() for i in some], pa.binary())],
            names=names,
        )

    return docs.select("doc_id", "text").mapInArrow(run, PROFILE)


def _list_sizes(profiles: DataFrame) -> np.ndarray:
    """The merged sketch as classes (bit lengths of the counts): CELLS bytes, whatever the input."""

    def add(key, table):
        total = np.zeros(CHUNK, np.uint64)
        for data in table["counts"]:
            total += np.frombuffer(data.as_buffer(), "<u4")
        total = np.minimum(total, (1 << 32) - 1).astype("<u4")
        return pa.table({"part": [key[0].as_py()], "chunk": [key[1].as_py()], "counts": pa.array([total.tobytes()], pa.binary())}).cast(shape)

    shape = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("counts", pa.binary())])
    rows = profiles.filter("chunk IS NOT NULL").select("part", "chunk", "counts")
    parts = (rows.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:  # a tree of sums: no task holds more than FAN_IN pieces of a chunk
        parts = math.ceil(parts / FAN_IN)
        rows = rows.withColumn("part", (F.col("part") / FAN_IN).cast("int")).groupBy("part", "chunk").applyInArrow(add, "part int, chunk int, counts binary")
    out = np.zeros((CELLS // CHUNK, CHUNK), np.uint8)
    for _, chunk, counts in rows.collect():
        total = np.frombuffer(counts, "<u4")
        out[chunk] = np.where(total > 0, np.floor(np.log2(np.maximum(total, 1))) + 1, 0)
    return out.ravel()


def _short_lists(docs: DataFrame, k: int, percent: int, sizes) -> DataFrame:
    """Every document's shingles on its short lists, and the parity bitmap of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            tokens, count = shingle_sets(*text_buffers(batch.column("text")), k)
            m = len(count)
            doc = np.repeat(np.arange(m), count)
            size = sizes.value[(tokens & np.uint64(CELLS - 1)).astype(np.int64)]
            key = (doc.astype(np.uint64) << np.uint64(48)) | (size.astype(np.uint64) << np.uint64(42)) | (tokens >> np.uint64(6))
            place = np.empty(len(tokens), np.int64)
            order = np.argsort(key, kind="stable")
            place[order] = np.arange(len(tokens)) - np.repeat(np.cumsum(count) - count, count)
            prefix = count - -(-percent * count // 100) + 1
            take = order[place[order] < np.repeat(prefix, count)]
            bits = np.bincount(doc * BITMAP_BITS + (tokens & np.uint64(BITMAP_BITS - 1)).astype(np.int64), minlength=m * BITMAP_BITS) & 1
            packed = np.packbits(bits.astype(np.uint8)).tobytes()
            wide = [_parity(tokens[e - c : e]) for e, c in zip(np.cumsum(count), count, strict=True)]
            ends = np.concatenate([[0], np.cumsum(np.minimum(prefix, count))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens[take].astype(np.int64)))
            width = BITMAP_BITS // 8
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(_sums(W.mix(tokens + np.uint64(0xA5A5A5A5)), count).view(np.int64)),
                    lists,
                    pa.array([packed[i * width : (i + 1) * width] for i in range(m)], pa.binary()),
                    pa.array(wide, pa.binary()),
                ],
                names=["id", "a", "tokens", "bits", "wide"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "id long, a long, tokens array<long>, bits binary, wide binary")


def _parity(tokens: np.ndarray) -> bytes:
    """Parity bitmap of one set, of two bits per shingle or a little more."""
    bits = max(64, 1 << int(2 * len(tokens) - 1).bit_length())
    count = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(count.astype(np.uint8)).tobytes()


def _difference(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference: xor of two parity bitmaps, the longer one folded."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    size = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def _sets(docs: DataFrame, k: int, bloom) -> DataFrame:
    """Whole sets of the documents that pass the Bloom filter."""
    rows = docs.select("doc_id", "text", _bloom_place("doc_id").alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy(zero_copy_only=False)
            hit = (bloom.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            batch = batch.filter(pa.array(hit.astype(bool)))
            for part in slices(iter([batch]), "text"):
                tokens, count = shingle_sets(*text_buffers(part.column("text")), k)
                ends = np.cumsum(count)
                packed = [_pack48(tokens[e - c : e]) for e, c in zip(ends, count, strict=True)]
                yield pa.record_batch([part.column("doc_id"), pa.array(packed, pa.binary())], names=["id", "tokens"])

    return rows.mapInArrow(run, "id long, tokens binary")


def _bloom_place(column: str):
    return F.pmod(F.xxhash64(column), F.lit(BLOOM_BITS)).cast("int")


def _bloom(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of BLOOM_BITS bits over the column id."""
    span = 8 * 4096  # bits of one bitmap of bitmap_construct_agg
    place = ids.select(_bloom_place("id").alias("place")).filter("place IS NOT NULL")
    rows = place.groupBy((F.col("place") / span).cast("int").alias("part")).agg(F.bitmap_construct_agg(F.col("place") % span).alias("bits"))
    out = np.zeros((BLOOM_BITS // span, span // 8), np.uint8)
    for part, bits in rows.collect():
        out[part] = np.frombuffer(bits, np.uint8)
    return out.ravel()


# --- candidates and links --------------------------------------------------


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole lists (equal token, i, j) from rows in that order."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in ("token", "i", "j")])
        change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
        cut = int(change[-1]) + 1 if len(change) else 0
        if held:
            before = tuple(held[-1].column(c)[-1].as_py() for c in ("token", "i", "j"))
            if before != tuple(key[:, 0]):
                yield pa.Table.from_batches(held)
                held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _candidates(postings: DataFrame, percent: int, closest: bool) -> DataFrame:
    """Candidate pairs (r, s, xor) on the short lists, of nodes in different components.

    ``closest``: only the best partner of each row instead of all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            key = np.stack([table[c].to_numpy() for c in ("token", "i", "j")])
            node, n, comp, own = (table[c].to_numpy() for c in ("id", "n", "component", "own"))
            bits = np.frombuffer(b"".join(table["bits"].to_pylist()), "<u8").reshape(len(node), -1)
            new = np.ones(len(node), bool)
            new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
            begin = np.maximum.accumulate(np.where(new, np.arange(len(node)), 0))
            cross = key[1] != key[2]
            best = np.full(len(node), 1 << 30)
            partner = np.zeros(len(node), np.int64)
            r = np.arange(len(node))
            out = []
            for lag in itertools.count(1):  # rows stand by size: partners only get smaller
                r = r[r - lag >= begin[r]]
                r = r[100 * n[r - lag].astype(np.int64) >= percent * n[r].astype(np.int64)]
                if not len(r):
                    break
                s = r - lag
                use = (comp[r] != comp[s]) & ~(cross[r] & (own[r] == own[s]))
                x, y = r[use], s[use]
                if not len(x):
                    continue
                xor = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1).astype(np.int64)
                both = n[x].astype(np.int64) + n[y]
                fit = xor <= both - 2 * needed(both, 0, percent)
                x, y, xor = x[fit], y[fit], xor[fit]
                if closest:
                    better = xor < best[x]
                    best[x[better]] = xor[better]
                    partner[x[better]] = y[better]
                else:
                    out.append((x, y, xor))
            if closest:
                x = np.flatnonzero(best < 1 << 30)
                out = [(x, partner[x], best[x])]
            for x, y, xor in out:
                yield pa.record_batch([pa.array(node[x]), pa.array(node[y]), pa.array(xor, pa.int32())], names=["r", "s", "xor"])

    dealt = postings.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "id")
    pairs = dealt.mapInArrow(run, "r long, s long, xor int")
    if closest:
        return pairs.groupBy("r").agg(F.min_by("s", F.struct("xor", "s")).alias("s"))
    return pairs.select("r", "s").distinct()


def _likely(nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs that bitmaps as wide as their sets do not rule out."""
    s = nodes.select(F.col("id").alias("s"), F.col("n").alias("s_n"), F.col("wide").alias("s_wide"))
    r = nodes.select(F.col("id").alias("r"), F.col("n").alias("r_n"), F.col("wide").alias("r_wide"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("r_n").to_numpy().astype(np.int64) + batch.column("s_n").to_numpy()
            most = both - 2 * needed(both, 0, percent)
            wide = zip(batch.column("r_wide").to_pylist(), batch.column("s_wide").to_pylist(), most, strict=True)
            fit = pa.array([_difference(x, y) <= d for x, y, d in wide], pa.bool_())
            yield batch.select(["r", "s"]).filter(fit)

    return pairs.join(s, "s").join(r, "r").mapInArrow(run, "r long, s long")


def _links(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The candidate pairs that link, decided by DivideSkip on the whole sets."""
    spark = docs.sparkSession
    bloom = spark.sparkContext.broadcast(_bloom(pairs.select(F.explode(F.array("r", "s")).alias("id"))))
    sets = _sets(docs, k, bloom)
    s = sets.select(F.col("id").alias("s"), F.col("tokens").alias("s_tokens"))
    r = sets.select(F.col("id").alias("r"), F.col("tokens").alias("r_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("r", "r_tokens", "s", "s_tokens")), strict=True)
            for (node, data), group in itertools.groupby(rows, lambda x: x[:2]):
                query = _unpack48(data).tolist()
                others = [(x[2], _unpack48(x[3]).tolist()) for x in group]
                required = [needed(len(query), len(t), percent) for _, t in others]
                found += [(node, others[i][0]) for i, _ in divide_skip(query, [t for _, t in others], required)]
            yield pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["u", "v"])

    return pairs.join(s, "s").join(r, "r").mapInArrow(run, "u long, v long")


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90, list_part: int = 20_000) -> DataFrame:
    """doc_id, n_shingles, component_id of every row (see the module).

    ``list_part``: inverted lists with more nodes are dealt as pairs of parts
    of about this many.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    small_batches(spark)
    profiles = written(_profiles(docs, k), "profiles")
    known = profiles.filter("chunk IS NULL").select("doc_id", "n", "a", "b")
    sizes = spark.sparkContext.broadcast(_list_sizes(profiles))
    reps = known.filter("n > 0 AND doc_id IS NOT NULL").groupBy("a", "b", "n").agg(F.min("doc_id").alias("id"))
    nodes = written(_short_lists(docs, k, percent, sizes).join(reps.drop("b"), ["id", "a"]).select("id", "n", "tokens", "bits", "wide"), "nodes")

    slim = nodes.select(F.explode("tokens").alias("token"), "id")
    shared = slim.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    parts = F.ceil(F.col("m") / list_part).cast("int")
    on_lists = written(slim.join(shared, "token").select("token", "id", parts.alias("parts")), "postings")

    def postings(labels: DataFrame | None) -> DataFrame:
        own = F.pmod(F.hash("id"), F.col("parts"))
        body = nodes.select("id", "n", "bits")
        if labels is None:
            body = body.withColumn("component", F.col("id"))
        else:
            body = body.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
        rows = on_lists.join(body, "id").withColumn("own", own)
        pair = F.explode(F.expr("transform(sequence(0, parts - 1), x -> struct(least(x, own) AS i, greatest(x, own) AS j))"))
        return rows.withColumn("pair", pair).select("token", "pair.i", "pair.j", "id", "n", "component", "own", "bits")

    def linked(labels: DataFrame | None, closest: bool) -> DataFrame:
        pairs = _candidates(postings(labels), percent, closest)
        pairs = written(_likely(nodes, pairs, percent), "pairs")
        links = written(_links(docs, pairs, k, percent), "links")
        discard(pairs)
        return links

    def label(links: DataFrame) -> DataFrame:
        return components(links).select(F.col("u").alias("id"), F.col("v").alias("component"))

    near = linked(None, True)
    rest = linked(label(near), False)
    labels = label(near.unionByName(rest))
    discard(nodes, on_lists, near, rest)
    named = reps.join(labels, "id", "left").select("a", "b", "n", F.coalesce("component", "id").alias("component_id"))
    own = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    return known.join(named, ["a", "b", "n"], "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))

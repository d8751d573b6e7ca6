"""Operator 9: exact removal of repeated word windows behind a count-min prefilter.

A window is ``k`` consecutive words of one document.  A window is a repeat if
its word sequence starts earlier: in an earlier document (order of doc_id) or
at an earlier place of the same one.  Words under a repeat are removed.

The documents are dealt once into blocks of consecutive doc_ids of about equal
bytes; all three passes below read that one shuffle.

1. Prefilter.  Every block builds its part of a count-min sketch over all
   window hashes.  The sketch is split by hash range into shards whose number
   and width follow the corpus, so its load, and with it the share of false
   alarms, is the same at every size.  A part lists its non-zero cells; a
   shard adds the parts up and answers each block with one bit per listed
   cell: is the merged count two or more?  Counts are only overestimated, so
   no repeated window is lost.
2. Exact grouping.  Every block sends the distinct windows estimated as
   repeated (96-bit hashes) to the shards; a shard finds the first block of
   each window and answers with one bit per window: seen in an earlier block?
3. The block marks its windows seen in an earlier block or earlier in itself,
   removes the words they cover and writes the result.

Nothing depends on how many copies a window has: a block sends it once.  No
window is sent as text, none reaches the driver, and no group is larger than
a block or a shard.

Defined results: a null or empty text has no words; texts shorter than ``k``
words are kept whole; rows that share a doc_id are ordered by text; a null
doc_id comes before all others; extra columns are dropped unless named in
``keep``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from returnscope.llm import words as W
from returnscope.llm.common import strings, text_buffers

ROWS = 2  # hash functions of the sketch
SECOND = 0xC2B2AE3D27D4EB4F  # base of the second window hash
CELL_SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344)


def _pack(cells: np.ndarray, many: np.ndarray) -> bytes:
    """Ascending distinct cells below 2**32 and a flag each, compressed as byte planes."""
    gaps = np.diff(cells, prepend=0).astype("<u4")
    planes = gaps.view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes + np.packbits(many).tobytes())


def _unpack(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    gaps = np.ascontiguousarray(raw[: 4 * n].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.int64), np.unpackbits(raw[4 * n :], count=n).astype(bool)


class _Block:
    """Words and windows of the documents of one block, in order."""

    def __init__(self, table: pa.Table, k: int, shards: int, width: int):
        self.table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        nulls = self.table["doc_id"].null_count
        if nulls:  # sort_by puts nulls last
            self.table = pa.concat_tables([self.table.slice(len(table) - nulls), self.table.slice(0, len(table) - nulls)])
        self.buf, self.off = text_buffers(self.table["text"])
        self.starts, self.ends, self.first = W.split(self.buf, self.off)
        words = W.hashes(self.buf, self.starts, self.ends)
        self.k, self.shards, self.width = k, shards, width
        last = np.repeat(self.first[1:], np.diff(self.first))
        self.at = np.flatnonzero(np.arange(len(words)) + k <= last)  # words at which a window starts
        self.hash = W.windows(words, k)[self.at] if len(self.at) else np.zeros(0, np.uint64)
        self.words = words

    def cells(self, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shard, cell) keys of all windows; the distinct ones, ascending, and whether they occur again here."""
        cell = W.mix(self.hash ^ np.uint64(CELL_SEEDS[row])) & np.uint64(self.width - 1)
        key = self.shard(self.hash) * np.int64(self.width) + cell.astype(np.int64)
        distinct, count = np.unique(key, return_counts=True)
        return key, distinct, count > 1

    def shard(self, h: np.ndarray) -> np.ndarray:
        return (((h >> np.uint64(32)) * np.uint64(self.shards)) >> np.uint64(32)).astype(np.int64)

    def suspects(self, answers: dict) -> np.ndarray:
        """Which windows the merged sketch estimates to occur more than once."""
        out = np.ones(len(self.hash), bool)
        for row in range(ROWS):
            key, distinct, _ = self.cells(row)
            out &= _bits(answers, row)[np.searchsorted(distinct, key)] if len(key) else out
        return out

    def exact(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash pairs of the chosen windows; order by (hash, second, place); which of it starts a new pair."""
        h = self.hash[chosen]
        g = (W.windows(self.words, self.k, SECOND)[self.at][chosen] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((g, h))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
        return h, g, (order, new)


def _bits(answers: dict, kind: int) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(bits, np.uint8), count=n) for _, n, bits in sorted(answers.get(kind, []))]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _answers(table: pa.Table) -> dict:
    out: dict = {}
    for kind, shard, n, bits in zip(*(table[c].to_pylist() for c in ("kind", "shard", "n", "payload")), strict=True):
        out.setdefault(kind, []).append((shard, n, bits))
    return out


MESSAGE = T.StructType(
    [
        T.StructField("block", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
EXACT = ROWS  # kind of the exact grouping's messages; 0 .. ROWS - 1 are the sketch's rows


def _messages(rows: list) -> pa.Table:
    types = [("block", pa.int32()), ("shard", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("payload", pa.binary())]
    return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(types)})


def _sketch_parts(block: _Block, number: int) -> pa.Table:
    rows = []
    for row in range(ROWS):
        _, distinct, many = block.cells(row)
        cuts = np.searchsorted(distinct, np.arange(block.shards + 1) * np.int64(block.width))
        for s in range(block.shards):
            a, b = int(cuts[s]), int(cuts[s + 1])
            if b > a:
                rows.append((number, s, row, b - a, _pack(distinct[a:b] - s * block.width, many[a:b])))
    return _messages(rows)


def _merge_sketch(table: pa.Table, width: int) -> pa.Table:
    """Adds the parts of one shard and answers every part with a bit per cell: two or more?"""
    rows = []
    columns = list(zip(*(table[c].to_pylist() for c in ("block", "shard", "kind", "n", "payload")), strict=True))
    for row in range(ROWS):
        counts = np.zeros(width, np.uint8)  # held at 2, all that is asked
        mine = [c for c in columns if c[2] == row]
        for _, _, _, n, payload in mine:
            cells, many = _unpack(payload, n)
            counts[cells] = np.minimum(counts[cells] + many + np.uint8(1), 2)
        for block, shard, _, n, payload in mine:
            cells, _ = _unpack(payload, n)
            rows.append((block, shard, row, n, np.packbits(counts[cells] >= 2).tobytes()))
    return _messages(rows)


def _candidates(block: _Block, number: int, answers: dict) -> pa.Table:
    h, g, (order, new) = block.exact(block.suspects(answers))
    h, g = h[order][new], g[order][new]
    cuts = np.append(np.searchsorted(block.shard(h), np.arange(block.shards)), len(h))
    rows = []
    for s in range(block.shards):
        a, b = int(cuts[s]), int(cuts[s + 1])
        if b > a:
            rows.append((number, s, EXACT, b - a, h[a:b].astype("<u8").tobytes() + g[a:b].astype("<u4").tobytes()))
    return _messages(rows)


def _first_blocks(table):
    """Answers every block of one shard with a bit per window: seen in an earlier block?"""
    columns = sorted(zip(*(table[c].to_pylist() for c in ("block", "shard", "n", "payload")), strict=True))
    h = np.concatenate([np.frombuffer(p, "<u8", n) for _, _, n, p in columns])
    g = np.concatenate([np.frombuffer(p, "<u4", n, 8 * n) for _, _, n, p in columns])
    order = np.lexsort((g, h))  # stable: earlier blocks first
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    seen = np.empty(len(order), bool)
    seen[order] = ~new
    rows, at = [], 0
    for block, shard, n, _ in columns:
        rows.append((block, shard, EXACT, n, np.packbits(seen[at : at + n]).tobytes()))
        at += n
    return _messages(rows)


def _result(block: _Block, answers: dict, schema: pa.Schema, with_text: bool) -> pa.Table:
    chosen = block.suspects(answers)
    h, _, (order, new) = block.exact(chosen)
    earlier = _bits(answers, EXACT)
    group = np.cumsum(new) - 1
    repeat = np.empty(len(h), bool)
    repeat[order] = ~new | earlier[group] if len(h) else new  # lexsort is stable: new marks the first place
    n_words = len(block.starts)
    edge = np.zeros(n_words + 1, np.int64)
    begin = block.at[chosen][repeat]
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + block.k, -1)
    kept = np.cumsum(edge[:-1]) == 0
    n_kept = np.add.reduceat(np.append(kept, False), block.first[:-1]) if n_words else np.zeros(len(block.off) - 1)
    n_kept = np.where(np.diff(block.first) > 0, n_kept, 0).astype(np.int64)
    out = {
        "doc_id": block.table["doc_id"],
        "n_words": pa.array(np.diff(block.first), pa.int64()),
        "n_removed": pa.array(np.diff(block.first) - n_kept, pa.int64()),
    }
    s, e = block.starts[kept], block.ends[kept]
    owner = np.repeat(np.arange(len(block.off) - 1), n_kept)
    final = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
    buf = np.append(block.buf, np.uint8(32))
    gap = e[~final]  # one space after every kept word but a document's last
    buf[gap[gap < len(block.buf)]] = 32
    mark = np.zeros(len(buf) + 1, np.int8)
    mark[s] += 1
    mark[e] -= 1
    take = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    take[gap] = True
    # a word may end where the next document begins: that byte is then its own
    length = np.bincount(owner, (e - s) + ~final, len(block.off) - 1).astype(np.int64)
    joined, cut = buf[take].tobytes(), np.concatenate([[0], np.cumsum(length)])
    out["kept_sha256"] = pa.array(
        [hashlib.sha256(joined[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.string()
    )
    if with_text:
        lose = np.zeros(len(block.buf) + 1, np.int32)
        to = np.append(block.starts[1:], len(block.buf))
        to = np.minimum(to, np.repeat(block.off[1:], np.diff(block.first)))  # white space after it goes too
        np.add.at(lose, block.starts[~kept], 1)
        np.add.at(lose, to[~kept], -1)
        stay = np.cumsum(lose[:-1]) == 0
        total = np.concatenate([[0], np.cumsum(stay)])
        out["text"] = strings(block.buf[stay], total[block.off])
    for c in block.table.column_names:
        out.setdefault(c, block.table[c])
    return pa.table([out[f.name] for f in schema], names=schema.names).cast(schema)


def blocks(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """``docs`` with a column ``block``: ranges of doc_id of about equal bytes; and all bytes.

    The bounds come from quantiles of doc_id weighted with the bytes between
    them: some numbers per block, whatever the documents hold.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    total, rows = docs.agg(F.sum(size), F.count(F.lit(1))).first()
    number = max(1, math.ceil((total or 0) / block_bytes))
    bounds: list[int] = []
    if number > 1:
        fine = min(8 * number, rows)
        cut = F.percentile_approx("doc_id", [i / fine for i in range(1, fine)], 10 * fine)
        points = np.unique(np.array(docs.agg(cut).first()[0] or [], np.int64))
        bin_of = _place(points)
        sizes = dict(docs.groupBy(bin_of("doc_id")).agg(F.sum(size)).collect())
        held = 0
        for i in range(len(points)):
            held += sizes.get(i, 0)
            if held + sizes.get(i + 1, 0) / 2 >= total / number:
                bounds.append(int(points[i]))
                held = 0
    return docs.withColumn("block", _place(np.array(bounds, np.int64))("doc_id")), total or 0


def _place(points: np.ndarray):
    """The number of points below doc_id, 0 for null."""

    @F.pandas_udf("int")
    def place(doc_id: pd.Series) -> pd.Series:
        known = doc_id.notna().to_numpy()
        ids = doc_id.fillna(0).to_numpy(np.int64)
        return pd.Series(np.where(known, np.searchsorted(points, ids), 0).astype(np.int32))

    return place


def dedup_substrings(
    docs: DataFrame,
    k: int = 20,
    keep: tuple[str, ...] = (),
    with_text: bool = False,
    block_bytes: int = 8 << 20,
    shard_windows: int = 4 << 20,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document (see the module).

    ``keep`` names columns to carry along, whatever their names (one that the result has
    itself comes out as ``<name>_kept``); with_text adds the text without the
    removed words and the white space behind them (unchanged where nothing was
    removed).  ``block_bytes`` bounds the text of a block (one document at
    least) and ``shard_windows`` the windows of a sketch shard on average.
    """
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    keep = tuple(c for c in dict.fromkeys(keep) if c not in ("doc_id", "text"))
    dealt, total = blocks(docs.select(*columns, *(F.col(c).alias(f"_kept{i}") for i, c in enumerate(keep))), block_bytes)
    expected = max(1, total // 5)  # windows: a word and its space take five bytes or more as a rule
    shards = max(1, math.ceil(expected / shard_windows))
    width = 1 << max(10, (4 * expected // shards - 1).bit_length())

    def parts(key, table):
        return _sketch_parts(_Block(table, k, shards, width), key[0].as_py())

    def merged(table):
        return _merge_sketch(table, width)

    def candidates(key, table, heard):
        if not table.num_rows:
            return _messages([])
        return _candidates(_Block(table, k, shards, width), key[0].as_py(), _answers(heard))

    fields = [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        *([T.StructField("text", T.StringType())] if with_text else []),
        *(f for f in dealt.schema if f.name not in ("doc_id", "text", "block")),
    ]
    schema = T.StructType(fields)

    def result(key, table, heard):
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(schema)
        if not table.num_rows:
            return wanted.empty_table()
        return _result(_Block(table, k, shards, width), _answers(heard), wanted, with_text)

    by_block = dealt.groupBy("block")
    sketched = by_block.applyInArrow(parts, MESSAGE).groupBy("shard").applyInArrow(merged, MESSAGE)
    asked = by_block.cogroup(sketched.groupBy("block")).applyInArrow(candidates, MESSAGE)
    first = asked.groupBy("shard").applyInArrow(_first_blocks, MESSAGE)
    out = by_block.cogroup(sketched.unionByName(first).groupBy("block")).applyInArrow(result, schema)
    own = [c for c in out.columns if not c.startswith("_kept")]
    return out.select(*own, *(F.col(f"_kept{i}").alias(f"{c}_kept" if c in own else c) for i, c in enumerate(keep)))

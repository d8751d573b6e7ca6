"""Operator 8: quality scores from histogram gradient-boosted trees.

Every whole text becomes a row of document statistics (numpy over the bytes of
an Arrow batch).  The trees are fitted on a bounded sample of the labelled
rows: at most ``sample_rows`` of them, those with the smallest hash of doc_id;
only their statistics reach the driver.  Fitting bins every statistic by its
quantiles and grows each tree level by level from gradient histograms.  The
model is four flat arrays, so scoring walks all rows down all trees with
numpy indexing, one step per level.

Labels, lang, source and doc_id are never inputs of a score.  Defined results:
null and empty texts are scored from zero statistics; labels that are neither
0 nor 1 are ignored; of repeated labels of one document the larger share wins
(1 on a tie); with no label at all every score is 0.5, with one class every
score is that class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.llm import words as W
from returnscope.llm.common import slices, small_batches, text_buffers

SYMBOLS = b".,!?;:#$%&*|@/\\'\"()<>[]{}=+-_~^"
STATISTICS = [
    "log_words", "mean_word", "longest_word", "upper", "lower", "digit", "space", "line", "wide", "control",
    *(f"symbol_{chr(c)}" for c in SYMBOLS), "distinct_words", "top_word", "next_same", "ends_symbol",
    "capital_words", "distinct_lines", "words_a_line", "short_words", "distinct_bytes",
]


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text."""
    m = len(off) - 1
    size = np.diff(off)
    doc = np.repeat(np.arange(m), size)
    table = np.bincount(doc * 256 + buf, minlength=m * 256).reshape(m, 256).astype(np.float64)
    share = table / np.maximum(size, 1)[:, None]
    starts, ends, first = W.split(buf, off)
    n = np.diff(first)
    length = ends - starts
    owner = np.repeat(np.arange(m), n)
    h = W.hashes(buf, starts, ends)

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, m) / np.maximum(n, 1)

    keys, count = np.unique((owner.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)), return_counts=True)
    holder = (keys >> np.uint64(48)).astype(np.int64)
    top, longest = np.zeros(m), np.zeros(m)
    np.maximum.at(top, holder, count)
    np.maximum.at(longest, owner, length)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    line = np.zeros(len(buf) + 1, bool)
    line[off[:-1]] = True
    line[1:] |= np.append(buf, 0)[:-1] == 10 if len(buf) else False
    begin = np.flatnonzero(line[:-1])
    stop = np.append(begin[1:], len(buf))
    lines_of = np.searchsorted(off, begin, "right") - 1
    lines = np.bincount(lines_of, minlength=m)
    lh = W.hashes(buf, begin, stop)
    kinds = np.unique((lines_of.astype(np.uint64) << np.uint64(48)) | (lh >> np.uint64(16))) >> np.uint64(48)
    columns = [
        np.log1p(n), per_word(length), np.log1p(longest), share[:, 65:91].sum(1), share[:, 97:123].sum(1), share[:, 48:58].sum(1),
        share[:, 32], share[:, 10], share[:, 128:].sum(1), share[:, :32].sum(1) - share[:, 10],
        *(share[:, c] for c in SYMBOLS),
        np.bincount(holder, minlength=m) / np.maximum(n, 1), top / np.maximum(n, 1), per_word(same),
        per_word(symbol[buf[ends - 1]]), per_word((buf[starts] >= 65) & (buf[starts] <= 90)),
        np.bincount(kinds.astype(np.int64), minlength=m) / np.maximum(lines, 1), n / np.maximum(lines, 1),
        per_word(length <= 3), np.log1p((table > 0).sum(1)),
    ]
    return np.stack(columns, axis=1)


@dataclass
class Trees:
    """Perfect binary trees of one depth, node by node: children of i are 2i + 1 and 2i + 2."""

    feature: np.ndarray  # [trees, 2**depth - 1]
    threshold: np.ndarray  # same shape; a row goes right if its value is above
    leaf: np.ndarray  # [trees, 2**depth]
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(trees):
            node = np.zeros(len(x), np.int64)
            while inner and node[:1].size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, self.feature[t, node]] > self.threshold[t, node])
            total += self.leaf[t, node - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -500, 500)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, ridge: float = 1.0
) -> Trees:
    """Boosted trees for the logistic loss, split by gradient histograms."""
    inner = 2**depth - 1
    share = y.mean() if len(y) else 0.5
    if len(y) == 0 or share in (0.0, 1.0):
        base = 0.0 if len(y) == 0 else (500.0 if share else -500.0)
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(d)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(d)], axis=1)
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), float(np.log(share / (1 - share))))
    raw = np.full(n, out.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)  # within its level
        for level in range(depth):
            width = 2**level
            best = np.full(width, 1e-6)
            feature, at = np.zeros(width, np.int64), np.full(width, bins)
            for f in range(d):
                key = node * bins + binned[:, f]
                hg = np.bincount(key, g, width * bins).reshape(width, bins)
                hh = np.bincount(key, h, width * bins).reshape(width, bins)
                gl, hl = np.cumsum(hg, 1), np.cumsum(hh, 1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(hl < 1) | (ht - hl < 1)] = 0
                where = gain.argmax(1)
                value = gain[np.arange(width), where]
                better = value > best
                best[better], feature[better], at[better] = value[better], f, where[better]
            for i in range(width):
                k = width - 1 + i
                out.feature[t, k] = feature[i]
                if at[i] < len(cuts[feature[i]]):
                    out.threshold[t, k] = cuts[feature[i]][at[i]]
            node = 2 * node + (binned[np.arange(n), feature[node]] > at[node])
        total_g, total_h = np.bincount(node, g, inner + 1), np.bincount(node, h, inner + 1)
        out.leaf[t] = rate * total_g / (total_h + ridge)
        raw += out.leaf[t][node]
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> Trees:
    """Trees for P(quality = 1) from at most ``sample_rows`` labelled documents."""
    small_batches(docs.sparkSession)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("quality IN (0, 1)")
    marks = marks.filter(~held_out()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)  # 12 bytes each: fit for broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = statistics(*text_buffers(batch.column("text")))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.record_batch([batch.column("doc_id"), batch.column("quality"), values], names=["doc_id", "quality", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(marks), "doc_id").select("doc_id", "quality", "text")
    got = rows.mapInArrow(run, "doc_id long, quality int, x array<double>").toArrow()
    got = got.sort_by("doc_id")
    x = np.array(got["x"].to_pylist()).reshape(-1, len(STATISTICS))
    return fit(x, got["quality"].to_numpy().astype(np.float64))


def score_quality(docs: DataFrame, model: Trees, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            score = model.score(statistics(*text_buffers(batch.column("text"))))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Trees, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``threshold`` or more."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            score = model.score(statistics(*text_buffers(batch.column("text"))))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)

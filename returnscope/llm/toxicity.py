"""Operator 12: toxicity from averaged subword embeddings and a linear softmax.

A text is cut into windows of about ``words`` words.  A window is the bag of its
character n-grams (3 to 5 code points, lower-cased, within one word, where the
white space on either side counts as a character), hashed to ``2**bits``
embedding rows.  Their mean goes into a linear softmax of two classes;
embeddings and softmax are trained jointly by Adam in numpy.  A misspelling
that was never seen shares most n-grams, so most vectors, with the word it
stands for.  A text's score is a logistic function of the mean logit of its
highest windows, one of every ``per`` (toxic words are a few per cent of a toxic
text, so a mean over all of it would drown them).  Training does likewise: after
one epoch over all windows it goes on with those highest windows.

The model is fitted on a bounded sample of the labelled rows that the contract
lets it learn from: per class at most ``class_rows`` documents of at most
``max_chars`` characters, with ``class_chars`` in all, by hash of doc_id; the
n-grams of those (12 bytes a character) reach the driver.  The score is
corrected to the share of toxic labels among all rows it may learn from.
Scoring covers all windows of every text; as everything up to a window's logit
is linear, each n-gram then carries one number.

Labels, lang, source and doc_id are never inputs of a score.  Defined results:
null and empty texts and texts without a word get the share of toxic labels as
their score; labels that are neither 0 nor 1 are ignored; of repeated labels
of one document the larger share wins (1 on a tie); a doc_id with several texts
lends each of them to the sample; a null doc_id is held out; with no label every
score is 0.5, with one class every score is that class; repeated rows are scored
alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from returnscope.llm.common import slices, small_batches, written
from returnscope.llm.words import mix

SIZES = (3, 4, 5)
# The white-space code points above ASCII (Unicode White_Space).
WIDE_SPACES = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
PIECE = 1 << 20


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, white space as 0, a 0 before and after each; and each text's first 0."""
    texts = pc.utf8_lower(pc.fill_null(column, "")).to_pylist()
    c = np.frombuffer(("\0" + "\0".join(texts) + "\0").encode("utf-32-le", "replace"), np.uint32).copy()
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    c[(c <= 32) & ((c == 32) | ((c >= 9) & (c <= 13)))] = 0
    wide = np.flatnonzero(c > 127)
    c[wide[np.isin(c[wide], WIDE_SPACES)]] = 0
    return c, starts


def ngrams(c: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and hashed rows of the n-grams of ``c``, one pair per size."""
    black = c != 0
    x = c.astype(np.uint64) + np.uint64(1)
    for n in SIZES:
        m = len(c) - n + 1
        if m < 1:
            return
        ok = black[1 : m + 1].copy()
        for i in range(2, n - 1):
            ok &= black[i : m + i]
        at = np.flatnonzero(ok)
        h = np.full(len(at), n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + x[at + i]
        yield at, (mix(h) >> np.uint64(64 - bits)).astype(np.int64)


def windows(c: np.ndarray, starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number before each place, window of each word, text of each window.

    A text of n words has about n / ``words`` windows of equal length, one at least if it has a word.
    """
    black = c != 0
    first = black.copy()
    first[1:] &= ~black[:-1]
    number = np.cumsum(first, dtype=np.int64) - 1
    bounds = np.searchsorted(np.flatnonzero(first), starts)
    n = np.diff(bounds)
    k = np.where(n > 0, np.maximum(1, np.round(n / words)), 0).astype(np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    base = np.concatenate([[0], np.cumsum(k)])
    place = np.arange(len(doc)) - bounds[doc]
    return number, base[doc] + place * k[doc] // np.maximum(n[doc], 1), np.repeat(np.arange(len(n)), k)


@dataclass
class Subwords:
    """One number per hashed n-gram and a bias (the folded embeddings and softmax), and how windows make a text's score."""

    weight: np.ndarray
    bias: float
    bits: int
    words: int = 8
    per: int = 8
    slope: float = 1.0
    offset: float = 0.0
    prior: float = 0.5

    def score(self, column: pa.Array) -> np.ndarray:
        c, starts = code_points(column)
        number, window, doc = windows(c, starts, self.words)
        total, count = np.zeros(len(doc)), np.zeros(len(doc))
        for a in range(0, len(c), PIECE):  # n-grams that begin in a piece
            for at, row in ngrams(c[a : a + PIECE + max(SIZES) - 1], self.bits):
                own = at < PIECE
                of = window[number[at[own] + a + 1]]
                total += np.bincount(of, self.weight[row[own]], len(doc))
                count += np.bincount(of, minlength=len(doc))
        return self.of_windows(total / np.maximum(count, 1), doc, len(starts) - 1)

    def pooled(self, logit: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Mean logit of each text's highest windows."""
        top = top_windows(logit, doc, self.per)
        return self.bias + np.bincount(doc[top], logit[top], n) / np.maximum(np.bincount(doc[top], minlength=n), 1)

    def of_windows(self, logit: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        out = _logistic(self.offset + self.slope * self.pooled(logit, doc, n))
        return np.where(np.bincount(doc, minlength=n) > 0, out, self.prior)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def bags(column: pa.Array, bits: int, words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the rows of its n-grams, window by window, and the n-grams of each window."""
    c, starts = code_points(column)
    number, window, doc = windows(c, starts, words)
    found = [(window[number[at + 1]], row) for at, row in ngrams(c, bits)]
    of = np.concatenate([w for w, _ in found] or [np.zeros(0, np.int64)])
    row = np.concatenate([r for _, r in found] or [np.zeros(0, np.int64)])
    order = np.argsort(of, kind="stable")
    row, n = row[order].astype(np.int32), np.bincount(of, minlength=len(doc)).astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(n)])
    at = np.searchsorted(doc, np.arange(len(starts)))
    return [(row[ends[a] : ends[b]], n[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def top_windows(logit: np.ndarray, doc: np.ndarray, per: int) -> np.ndarray:
    """The highest windows of each text (``doc`` ascending): one of every ``per`` and one at least."""
    order = np.lexsort((-logit, doc))
    n = np.bincount(doc, minlength=doc[-1] + 1 if len(doc) else 0)
    rank = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    return order[rank < np.repeat(-(-n // per), n)]


def fit(
    texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, bits: int, words: int, share: float | None = None,
    per: int = 8, size: int = 2, epochs: int = 10, rate: float = 0.01, least: int = 5, seed: int = 1,
) -> Subwords:
    """Embeddings (``size`` numbers a row) and softmax, trained jointly on windows with their text's label.

    N-grams of fewer than ``least`` texts keep a zero vector.  Every fifth text is
    left out to fit how the highest windows' mean becomes the text's score;
    ``share`` is that of class 1 to correct for.
    """
    n = len(texts)
    if n == 0 or y.min() == y.max():
        return Subwords(np.zeros(1 << bits), 0.0 if n == 0 else (500.0 if y[0] else -500.0), bits, words, per, prior=0.5 if n == 0 else float(y[0]))
    r = np.random.default_rng(seed)
    apart = np.zeros(n, bool)
    for label in (0, 1):
        mine = r.permutation(np.flatnonzero(y == label))
        apart[mine[: len(mine) // 5]] = True
    learned = np.flatnonzero(~apart)
    held = np.zeros(1 << bits, np.int32)
    for i in learned:
        held[np.unique(texts[i][0])] += 1
    used = np.flatnonzero(held >= least)
    new = np.full(1 << bits, -1, np.int32)
    new[used] = np.arange(len(used), dtype=np.int32)
    # all windows of the learned texts: label, first n-gram, n-grams
    rows = new[np.concatenate([texts[i][0] for i in learned])]
    sizes = np.concatenate([texts[i][1] for i in learned]).astype(np.int64)
    label = np.repeat(y[learned], [len(texts[i][1]) for i in learned])
    begin = np.cumsum(sizes) - sizes
    label, begin, sizes = label[sizes > 0], begin[sizes > 0], sizes[sizes > 0]
    embedding = r.normal(0, 0.01, (len(used), size)).astype(np.float32)
    softmax, bias = r.normal(0, 1, (size, 2)).astype(np.float32), np.zeros(2, np.float32)
    batch = int(np.clip(len(label) // 128, 64, 1024))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (embedding, softmax, bias)]
    step = 0

    def adam(p: np.ndarray, g: np.ndarray, s: list[np.ndarray], at: np.ndarray | slice) -> None:
        s[0][at] = 0.9 * s[0][at] + 0.1 * g
        s[1][at] = 0.999 * s[1][at] + 0.001 * g * g
        p[at] -= rate * (s[0][at] / (1 - 0.9**step)) / (np.sqrt(s[1][at] / (1 - 0.999**step)) + 1e-8)

    doc = np.repeat(np.arange(len(learned)), [(texts[i][1] > 0).sum() for i in learned])
    for epoch in range(epochs):
        order = r.permutation(len(label))
        if epoch:
            number = np.zeros(len(used) + 1, np.float32)
            number[:-1] = embedding @ (softmax[:, 1] - softmax[:, 0])
            order = order[np.isin(order, top_windows(np.add.reduceat(number[rows], begin) / sizes, doc, per))]
        for a in range(0, len(order), batch):
            some = order[a : a + batch]
            m, length = len(some), sizes[some]
            owner = np.repeat(np.arange(m), length)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length) + begin[some][owner]
            row = rows[place]
            owner, row = owner[row >= 0], row[row >= 0]
            w = (1 / length).astype(np.float32)
            hidden = np.stack([np.bincount(owner, embedding[row, k], m) for k in range(size)], axis=1).astype(np.float32) * w[:, None]
            z = hidden @ softmax + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(m), label[some]] -= 1
            p /= m
            back = (p @ softmax.T) * w[:, None]
            step += 1
            kinds, place = np.unique(row, return_inverse=True)
            g = np.stack([np.bincount(place, back[owner, k], len(kinds)) for k in range(size)], axis=1).astype(np.float32)
            adam(embedding, g, state[0], kinds)
            adam(softmax, hidden.T @ p, state[1], slice(None))
            adam(bias, p.sum(0), state[2], slice(None))
    weight = np.zeros(1 << bits)
    weight[used] = embedding @ (softmax[:, 1] - softmax[:, 0])
    model = Subwords(weight, float(bias[1] - bias[0]), bits, words, per, prior=float(y.mean() if share is None else share))
    model.slope, model.offset = _calibrate(model, [texts[i] for i in np.flatnonzero(apart)], y[apart], y, share)
    return model


def _calibrate(model: Subwords, texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, all_y: np.ndarray, share: float | None) -> tuple[float, float]:
    """Slope and offset on the log-odds of the mean over windows (logistic regression by Newton steps)."""
    x = []
    for row, n in texts:
        logit = np.bincount(np.repeat(np.arange(len(n)), n), model.weight[row], len(n)) / np.maximum(n, 1)
        x.append(model.pooled(logit, np.zeros(len(n), np.int64), 1)[0])
    if len(np.unique(y)) < 2:
        return 1.0, 0.0
    x = np.stack([np.ones(len(x)), np.array(x)], axis=1)
    beta = np.array([0.0, 1.0])
    for _ in range(50):
        p = _logistic(x @ beta)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1.0])
        beta = beta - np.linalg.solve(h, x.T @ (p - y) + np.array([1e-3, 1.0]) * (beta - np.array([0.0, 1.0])))
    if share is not None and 0 < share < 1:
        have = all_y.mean()
        beta[0] += np.log(share / (1 - share)) - np.log(have / (1 - have))
    return max(float(beta[1]), 0.0), float(beta[0])


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def learn(
    docs: DataFrame, labels: DataFrame, class_rows: int = 2_500, class_chars: int = 4_000_000, max_chars: int = 50_000,
    bits: int = 18, words: int = 8,
) -> Subwords:
    """A model of P(toxic = 1) from the bounded sample that the module's docstring describes."""
    small_batches(docs.sparkSession)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter("toxic IN (0, 1)")
    marks = marks.filter(~held_out()).groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    marks = written(marks, "toxic-marks")
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}  # two rows at most
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    mine = Window.partitionBy("toxic")
    # the hashes up to which about twice the wanted rows lie, so that few rows meet in the window
    near = {c: min((1 << 63) - 1, (2 * class_rows << 64) // n - (1 << 63)) for c, n in sizes.items()}
    some = marks.filter(F.xxhash64("doc_id") <= F.when(F.col("toxic") == 1, near.get(1, 0)).otherwise(near.get(0, 0)))
    some = some.withColumn("_rank", F.row_number().over(mine.orderBy(*by_hash))).filter(F.col("_rank") <= class_rows).drop("_rank")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.filter(F.length("text") <= max_chars).join(F.broadcast(some), "doc_id")  # at most 2 * class_rows rows of 12 bytes
    order = mine.orderBy(*by_hash, F.xxhash64("text"))
    rows = rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= class_rows)
    sample = written(rows, "toxic-sample").withColumn("_sum", F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sample = sample.filter(F.col("_sum") <= class_chars).select("doc_id", "toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = bags(batch.column("text"), bits, words)
            values = [pa.array([f[i] for f in found], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.record_batch([batch.column("doc_id"), batch.column("toxic"), *values], names=["doc_id", "toxic", "row", "n"])

    got = sample.mapInArrow(run, "doc_id long, toxic int, row array<int>, n array<int>").toArrow()
    order = np.lexsort((np.array([len(x) for x in got["row"]], np.int64), got["doc_id"].to_numpy()))
    texts = [tuple(got[c][int(i)].values.to_numpy().astype(np.int32) for c in ("row", "n")) for i in order]
    return fit(texts, got["toxic"].to_numpy()[order].astype(np.int64), bits, words, sizes.get(1, 0) / max(1, sum(sizes.values())))


def score_toxicity(docs: DataFrame, model: Subwords, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            score = model.score(batch.column("text"))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")

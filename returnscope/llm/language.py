"""Operator 4: language of a text from unigram pieces, summed over all segmentations.

Each language has a probability per piece of a fixed public vocabulary.  A
pre-token's probability is the sum over all its segmentations into pieces
(forward algorithm; a single byte is always allowed, at a floor); a text's is
the product over its pre-tokens, times the language's share of the learned
rows.  The text gets the language of the largest posterior.

Piece probabilities come from expectation maximisation (forward-backward) on
all pre-tokens of a bounded sample: at most ``sample_docs`` documents per
language, those with the smallest hash of doc_id among the ones of at most
``sample_chars`` characters.  Only the counts of these pre-tokens reach the
driver.  A task scores each distinct pre-token once while it stays in a cache
of bounded size.

Pre-tokens are runs of ASCII letters and of bytes of other scripts, lowered and
never cut.  Short ones fill a lattice of all places; those over ``WIDE`` bytes
(scripts without spaces, long compounds) advance together, byte by byte, and
carry on the sums of the last places a piece can reach back to.
Defined results: null texts and texts without a letter are ``und`` with score
0; if nothing could be learned, every text is ``und`` with score 0; a language
all of whose labelled documents are longer than ``sample_chars`` is not learned;
ties go to the smaller language name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from returnscope.llm import pieces as P
from returnscope.llm import words as W
from returnscope.llm.common import slices, small_batches, text_buffers
from returnscope.llm.quality import held_out

FLOOR = np.log(1e-7)  # a byte outside the pieces
WIDE = 64  # bytes of a pre-token that the lattice holds
SMOOTHING = 0.1
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
_BLANK = np.where(LETTERS, np.arange(256), 32).astype(np.uint8)
CACHE = 400_000


class Lattice:
    """All pieces at all places of some pre-tokens, by (start, end)."""

    def __init__(self, matrix: np.ndarray, length: np.ndarray, vocabulary: P.Vocabulary):
        self.length, self.width = length, matrix.shape[1]
        hashes = P.Prefixes(matrix, length)
        self.edges: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.rows = [np.flatnonzero(length >= e) for e in range(self.width + 1)]
        for e in range(1, self.width + 1):
            for s in range(max(0, e - vocabulary.longest), e):
                hit, piece = vocabulary.find(hashes.part(self.rows[e], s, e))
                if len(hit):
                    self.edges[s, e] = self.rows[e][hit], piece

    def forward(self, logp: np.ndarray) -> np.ndarray:
        """[place, pre-token, language]: log probability of everything before the place."""
        out = np.full((self.width + 1, len(self.length), logp.shape[1]), -np.inf)
        out[0] = 0
        for e in range(1, self.width + 1):
            rows = self.rows[e]
            out[e, rows] = out[e - 1, rows] + FLOOR
            for s in range(e):
                if (s, e) in self.edges:
                    at, piece = self.edges[s, e]
                    out[e, at] = np.logaddexp(out[e, at], out[s, at] + logp[piece])
        return out

    def total(self, logp: np.ndarray) -> np.ndarray:
        return self.forward(logp)[self.length, np.arange(len(self.length))]

    def expected(self, logp: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected count of every piece under one language; weight: how often each pre-token occurs."""
        before = self.forward(logp[:, None])[:, :, 0]
        whole = before[self.length, np.arange(len(self.length))]
        after = np.full_like(before, -np.inf)
        after[self.length, np.arange(len(self.length))] = 0
        count = np.zeros(len(logp))
        for s in range(self.width - 1, -1, -1):
            rows = self.rows[s + 1]
            after[s, rows] = np.logaddexp(after[s, rows], after[s + 1, rows] + FLOOR)
            for e in range(s + 1, self.width + 1):
                if (s, e) in self.edges:
                    at, piece = self.edges[s, e]
                    after[s, at] = np.logaddexp(after[s, at], after[e, at] + logp[piece])
                    np.add.at(count, piece, weight[at] * np.exp(before[s, at] + logp[piece] + after[e, at] - whole[at]))
        return count


class Stream:
    """Pre-tokens of any length, longest first, in one byte stream each; ``back`` places are carried from chunk to chunk."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: P.Vocabulary):
        self.order = np.argsort(starts - ends, kind="stable")
        self.buf, self.starts, self.size = buf, starts[self.order], (ends - starts)[self.order] + 1  # with the start mark
        self.vocabulary = vocabulary

    def alive(self, place: int) -> int:
        """How many pre-tokens have ``place`` bytes or more."""
        return int(np.searchsorted(-self.size, -place, "right"))

    def edges(self, rows: slice, low: int, high: int, after: int) -> tuple[np.ndarray, ...]:
        """End, row, start and piece of all pieces within the bytes [low, high) that end after ``after``, by end; places count from low."""
        starts, size = self.starts[rows], self.size[rows]
        place = np.arange(low, high)
        inside = place[None, :] < size[:, None]
        at = np.where(inside & (place > 0), starts[:, None] + place[None, :] - 1, 0)
        matrix = np.where(inside, np.where(place == 0, np.uint8(P.MARK), self.buf[at]), 0).astype(np.uint8)
        up, down = W.powers(high - low + 1)
        total = np.zeros((len(starts), high - low + 1), np.uint64)
        np.cumsum((matrix.astype(np.uint64) + np.uint64(1)) * up[: high - low], axis=1, out=total[:, 1:])
        row, begin = np.nonzero(inside & ((matrix & 0xC0) != 0x80))  # pieces are whole characters
        limit = np.minimum(size - low, high - low)[row]
        found = []
        for n in range(1, self.vocabulary.longest + 1):
            some = (begin + n > after - low) & (begin + n <= limit)
            r, b = row[some], begin[some]
            salt = np.uint64(n * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
            hit, piece = self.vocabulary.find(W.mix((total[r, b + n] - total[r, b]) * down[b] + salt))
            found.append((b[hit] + n, r[hit], b[hit], piece))
        end, row, begin, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.argsort(end, kind="stable")
        return end[by], row[by], begin[by], piece[by]

    def total(self, logp: np.ndarray, rows: int = 2000, cells: int = 1 << 18) -> np.ndarray:
        """[pre-token, language]: log probability, in the order given."""
        out = np.empty((len(self.size), logp.shape[1]))
        for first in range(0, len(self.size), rows):
            many = min(rows, len(self.size) - first)
            step, value = max(64, cells // many), np.zeros((1, many, logp.shape[1]))
            for a in range(0, int(self.size[first]), step):
                live = min(self.alive(a + 1) - first, many)
                low, high = max(0, a - self.vocabulary.longest), min(a + step, int(self.size[first]))
                value = self._advance(logp, first, live, low, a, high, value[-(a - low + 1) :, :live], out)
        return out

    def _advance(self, logp: np.ndarray, first: int, live: int, low: int, a: int, high: int, carried: np.ndarray, out: np.ndarray) -> np.ndarray:
        """[place - low, pre-token, language] for the places low .. high; finished pre-tokens go to ``out``."""
        end, row, begin, piece = self.edges(slice(first, first + live), low, high, a)
        value = np.full((high - low + 1, live, logp.shape[1]), -np.inf)
        value[: a - low + 1] = carried
        cut = np.searchsorted(end, np.arange(high - low + 2))
        for e in range(a + 1, high + 1):
            now, k = value[e - low], min(self.alive(e) - first, live)
            now[:k] = value[e - low - 1, :k] + FLOOR
            some = slice(cut[e - low], cut[e - low + 1])
            if some.stop > some.start:
                np.logaddexp.at(now, row[some], value[begin[some], row[some]] + logp[piece[some]])
            done = max(self.alive(e + 1) - first, 0)
            if done < k:
                out[self.order[first + done : first + k]] = now[done:k]
        return value

    def expected(self, logp: np.ndarray, weight: np.ndarray, cells: int = 1 << 21) -> np.ndarray:
        """As ``Lattice.expected``."""
        count, first, weight = np.zeros(len(logp)), 0, weight[self.order]
        while first < len(self.size):
            width = int(self.size[first])
            live = min(max(1, cells // width), len(self.size) - first)
            size, whole = self.size[first : first + live], np.empty((len(self.size), 1))
            before = self._advance(logp[:, None], first, live, 0, 0, width, np.zeros((1, live, 1)), whole)[:, :, 0]
            end, row, begin, piece = self.edges(slice(first, first + live), 0, width, 0)
            after = np.full((width + 1, live), -np.inf)
            after[size, np.arange(live)] = 0
            by = np.argsort(begin, kind="stable")
            cut = np.searchsorted(begin[by], np.arange(width + 1))
            for s in range(width - 1, -1, -1):
                k = min(self.alive(s + 1) - first, live)
                after[s, :k] = after[s + 1, :k] + FLOOR
                some = by[cut[s] : cut[s + 1]]
                if len(some):
                    np.logaddexp.at(after[s], row[some], after[end[some], row[some]] + logp[piece[some]])
            share = np.exp(before[begin, row] + logp[piece] + after[end, row] - whole[self.order[first + row], 0])
            np.add.at(count, piece, weight[first + row] * share)
            first += live
        return count


def fit(counts: dict[str, dict[bytes, int]], pieces: list[bytes], rounds: int = 4) -> np.ndarray:
    """log P(piece | language), languages in name order, from pre-token counts."""
    vocabulary = P.Vocabulary(pieces)
    columns = []
    for _, of in sorted(counts.items()):
        tokens = sorted(of, key=lambda t: (len(t), t))  # parts of like length make narrow matrices
        weight = np.array([of[t] for t in tokens], np.float64)
        ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        buf = np.frombuffer(b"".join(tokens), np.uint8)
        short = int(np.searchsorted(ends - starts, WIDE, "right"))
        parts: list[tuple[Lattice | Stream, np.ndarray]] = []
        for i in range(0, short, 20_000):
            some = slice(i, min(i + 20_000, short))
            parts.append((Lattice(*P.as_matrix(buf, starts[some], ends[some]), vocabulary), weight[some]))
        if short < len(tokens):
            parts.append((Stream(buf, starts[short:], ends[short:], vocabulary), weight[short:]))
        logp = np.full(len(pieces), -np.log(len(pieces)))
        for _ in range(rounds):
            seen = sum((part.expected(logp, w) for part, w in parts), np.full(len(pieces), SMOOTHING))
            logp = np.log(seen / seen.sum())
        columns.append(logp)
    return np.stack(columns, axis=1) if columns else np.zeros((len(pieces), 0))


def pre_tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, and starts, ends and text number of all pre-tokens."""
    low = W.LOWER[_BLANK[buf]]
    starts, ends, first = W.split(low, off)
    return low, starts, ends, np.repeat(np.arange(len(off) - 1), np.diff(first))


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def learn(
    docs: DataFrame, vocabulary: str = P.VOCABULARY, sample_docs: int = 1000, sample_chars: int = 20_000
) -> tuple[list[str], np.ndarray, np.ndarray, list[bytes]]:
    """Language names, their log shares, log P(piece | language) and the pieces."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.lower(F.col("text").cast("string")).alias("text"))
    known = rows.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    short = F.length("text") <= sample_chars
    rows_of = known.groupBy("lang").agg(F.count(F.lit(1)), F.count(F.when(short, 1))).collect()
    share, eligible = {x: n for x, n, _ in rows_of}, {x: n for x, _, n in rows_of}
    # about four times the sample of each language goes to its window, whatever the language's size
    chance = F.expr("CASE lang " + " ".join(f"WHEN {_quoted(x)} THEN {min(1.0, 4 * sample_docs / max(n, 1))}" for x, n in eligible.items()) + " END") if share else F.lit(1.0)
    drawn = known.filter(short).filter(F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(1 << 31)) < chance * (1 << 31))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = drawn.select("doc_id", "lang").withColumn("place", place).filter(F.col("place") <= sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            buf, s, e, doc = pre_tokens(*text_buffers(batch.column("text")))
            raw = buf.tobytes()
            yield pa.record_batch(
                [batch.column("lang").take(pa.array(doc)), pa.array([raw[a:b] for a, b in zip(s, e, strict=True)], pa.binary())], names=["lang", "token"]
            )

    chosen = known.filter(short).join(F.broadcast(ids.select("doc_id", "lang")), ["doc_id", "lang"]).select("lang", "text")
    count = chosen.mapInArrow(run, "lang string, token binary").groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n"))
    counts: dict[str, dict[bytes, int]] = {}
    for lang, token, n in count.collect():  # of the bounded sample
        counts.setdefault(lang, {})[bytes(token)] = n
    names = sorted(counts)
    total = sum(share[x] for x in names)
    pieces = P.read_pieces(vocabulary)
    return names, np.log([share[x] / total for x in names]), fit(counts, pieces), pieces


def predict(docs: DataFrame, names: list[str], prior: np.ndarray, logp: np.ndarray, pieces: list[bytes]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast((names, prior, logp, P.Vocabulary(pieces)))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prior, logp, vocabulary = model.value
        known, value = np.zeros(0, np.uint64), np.zeros((0, len(names)))
        for batch in slices(batches, "text", 2 << 20):
            buf, s, e, doc = pre_tokens(*text_buffers(batch.column("text")))
            m = batch.num_rows
            h, first, which = np.unique(W.hashes(buf, s, e), return_index=True, return_inverse=True)
            at = np.searchsorted(known, h)
            new = np.ones(len(h), bool) if not len(known) else known[np.minimum(at, len(known) - 1)] != h
            fresh = np.empty((int(new.sum()), len(names)))
            place = first[new]
            size = e[place] - s[place]
            by_size = np.argsort(size, kind="stable")  # rows of like length make narrow matrices
            short = int((size <= WIDE).sum())
            for part in np.array_split(by_size[:short], max(1, short // 20_000)):
                if len(part):
                    fresh[part] = Lattice(*P.as_matrix(buf, s[place[part]], e[place[part]]), vocabulary).total(logp)
            wide = by_size[short:]
            if len(wide):
                fresh[wide] = Stream(buf, s[place[wide]], e[place[wide]], vocabulary).total(logp)
            if len(known) + len(fresh) > CACHE:  # start again with this batch
                keep = np.searchsorted(known, h[~new])
                known, value = known[keep], value[keep]
            order = np.argsort(np.concatenate([known, h[new]]), kind="stable")
            known = np.concatenate([known, h[new]])[order]
            value = np.concatenate([value, fresh])[order]
            of = value[np.searchsorted(known, h)][which]
            total = np.stack([np.bincount(doc, of[:, i], m) + prior[i] for i in range(len(names))], axis=1) if names else np.zeros((m, 1))
            best = total.argmax(axis=1)
            score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            spoken = np.array(batch.column("spoken").to_pylist(), bool) if names else np.zeros(m, bool)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([names[b] if w else "und" for b, w in zip(best, spoken, strict=True)], pa.string()),
                    pa.array(np.where(spoken, score, 0.0)),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    text = F.lower(F.col("text").cast("string"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text.alias("text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("spoken"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")

"""Operator 7: token counts by dynamic programming over a trie of pre-tokens.

A text's tokens are those of its words (runs without white space), each
segmented whole into the pieces of a fixed public vocabulary with
the largest total score.  A piece's unigram score is minus the logarithm of
its rank in the vocabulary plus two; a character outside every piece counts as
one token per byte at a floor below all pieces.  Of segmentations with equal
scores the one with fewer tokens counts.

The distinct words of a batch are sorted, so words with a common prefix stand
together and the columns of the sorted matrix are the levels of their trie.
A node's forward score is computed once, from the scores of its ancestors, for
all words below it; the count at a word's last node is its terminal count.
Words of more than ``WIDE`` bytes are segmented in one stream instead, in
chunks that carry on the scores of the last places a piece can reach back to.
Terminal counts stay in a cache of bounded size for the task's next batches.

Defined results: null and empty texts have no words and no tokens; nothing is
dropped, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.llm import pieces as P
from returnscope.llm import words as W
from returnscope.llm.common import slices, small_batches, text_buffers

CACHE = 1_000_000
WIDE = 64  # bytes of a word that the trie holds


def scores(pieces: list[bytes]) -> tuple[np.ndarray, float]:
    """Score of each piece by its rank, and of a byte outside all pieces."""
    rank = np.arange(len(pieces), dtype=np.float64)
    return -np.log(rank + 2), -2 * float(np.log(len(pieces) + 2))


def trie_counts(matrix: np.ndarray, length: np.ndarray, vocabulary: P.Vocabulary, score: np.ndarray, floor: float) -> np.ndarray:
    """Tokens of each word; rows of ``matrix`` are distinct words with the start mark."""
    order = np.lexsort(matrix.T[::-1])
    matrix, length = matrix[order], length[order]
    n, width = matrix.shape
    hashes = P.Prefixes(matrix, length)
    same = np.zeros(n, np.int64)  # bytes shared with the row above
    if n > 1:
        differ = matrix[1:] != matrix[:-1]
        same[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        same[1:] = np.minimum(same[1:], np.minimum(length[1:], length[:-1]))
    rows = np.arange(n)
    node = [np.zeros(n, np.int64)]  # per level: the row that holds a row's node
    best = [np.zeros(n)]
    count = [np.zeros(n, np.int32)]
    for e in range(1, width + 1):
        new = (same < e) & (length >= e)  # the first row of each prefix of e bytes
        node.append(np.maximum.accumulate(np.where(new, rows, 0)))
        at = np.flatnonzero(new)
        up = node[e - 1][at]
        value, tokens = best[e - 1][up] + floor, count[e - 1][up] + 1
        for s in range(max(0, e - vocabulary.longest), e):
            hit, piece = vocabulary.find(hashes.part(at, s, e))
            if len(hit):
                from_row = node[s][at[hit]]
                v, c = best[s][from_row] + score[piece], count[s][from_row] + 1
                better = (v > value[hit] + 1e-9) | ((v > value[hit] - 1e-9) & (c < tokens[hit]))
                value[hit[better]], tokens[hit[better]] = v[better], c[better]
        level, number = np.full(n, -np.inf), np.zeros(n, np.int32)
        level[at], number[at] = value, tokens
        best.append(level)
        count.append(number)
        if e > vocabulary.longest:  # no piece reaches back so far
            best[e - vocabulary.longest - 1] = np.zeros(0)
    out = np.empty(n, np.int64)
    out[order] = np.array([count[length[i]][node[length[i]][i]] for i in range(n)], np.int64)
    return out


def stream_counts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: P.Vocabulary, score: np.ndarray, floor: float, step: int = 1 << 14) -> np.ndarray:
    """Tokens of each word, of any length: the words one after another, each with its start mark.

    Pieces hold the mark in front only, so none spans two words.
    """
    stream = np.concatenate([x for s, e in zip(starts, ends, strict=True) for x in (np.array([P.MARK], np.uint8), buf[s:e])])
    last = set(np.cumsum(ends - starts + 1).tolist())
    out: list[int] = []
    value, tokens = [0.0], [0]  # of the places low .. a
    for a in range(0, len(stream), step):
        low, high = max(0, a - vocabulary.longest), min(len(stream), a + step)
        value, tokens = [v - value[-1] for v in value[low - a - 1 :]], tokens[low - a - 1 :]
        part = stream[low:high]
        up, down = W.powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=total[1:])
        first = np.flatnonzero((part & 0xC0) != 0x80)  # pieces are whole characters
        found: list[list[tuple[int, float]]] = [[] for _ in range(high - a)]
        for size in range(1, vocabulary.longest + 1):
            s = first[(first + size > a - low) & (first + size <= len(part))]
            salt = np.uint64(size * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
            hit, piece = vocabulary.find(W.mix((total[s + size] - total[s]) * down[s] + salt))
            for x, y in zip(s[hit].tolist(), score[piece].tolist(), strict=True):
                found[x + size - 1 - (a - low)].append((x, y))
        for e, pieces in enumerate(found, a + 1):
            ways = [(value[-1] + floor, tokens[-1] + 1)]
            ways += [(value[s] + x, tokens[s] + 1) for s, x in pieces]
            top = max(ways)[0]
            v, n = min((w for w in ways if w[0] > top - 1e-9), key=lambda w: w[1]) if len(ways) > 1 else ways[0]
            if e in last:
                out.append(n)
                v, n = 0.0, 0
            value.append(v)
            tokens.append(n)
    return np.array(out, np.int64)


def count_tokens(docs: DataFrame, vocabulary: str = P.VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens of every row."""
    small_batches(docs.sparkSession)
    pieces = P.read_pieces(vocabulary)
    model = docs.sparkSession.sparkContext.broadcast((P.Vocabulary(pieces), *scores(pieces)))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, score, floor = model.value
        known, value = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in slices(batches, "text", 2 << 20):
            buf, off = text_buffers(batch.column("text"))
            starts, ends, word = W.split(buf, off)
            s, e = starts, ends
            doc = np.repeat(np.arange(batch.num_rows), np.diff(word))
            h, first, which = np.unique(W.hashes(buf, s, e), return_index=True, return_inverse=True)
            at = np.searchsorted(known, h)
            new = np.ones(len(h), bool) if not len(known) else known[np.minimum(at, len(known) - 1)] != h
            place = first[new]
            fresh = np.empty(len(place), np.int64)
            size = e[place] - s[place]
            for part in map(np.flatnonzero, (size <= 16, (size > 16) & (size <= WIDE))):  # few long words, apart
                if len(part):
                    fresh[part] = trie_counts(*P.as_matrix(buf, s[place[part]], e[place[part]]), pieces, score, floor)
            wide = np.flatnonzero(size > WIDE)
            if len(wide):
                fresh[wide] = stream_counts(buf, s[place[wide]], e[place[wide]], pieces, score, floor)
            if len(known) + len(fresh) > CACHE:
                keep = np.searchsorted(known, h[~new])
                known, value = known[keep], value[keep]
            order = np.argsort(np.concatenate([known, h[new]]), kind="stable")
            known = np.concatenate([known, h[new]])[order]
            value = np.concatenate([value, fresh])[order]
            of = value[np.searchsorted(known, h)][which]
            total = np.bincount(doc, of, batch.num_rows).astype(np.int64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.diff(word), pa.int64()), pa.array(total)], names=["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")

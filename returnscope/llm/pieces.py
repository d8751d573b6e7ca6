"""A fixed public vocabulary of pieces, matched inside pre-tokens with numpy.

A pre-token is a run of bytes; it is read with a start mark in front (the vocabulary's U+2581, here byte 1).  The
vocabulary file belongs to an installed tokenizer library, is read by the
driver from a path that is a parameter, and reaches the tasks as arrays.
"""

from __future__ import annotations

import numpy as np

from returnscope.llm import words as W

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = 1
_SLOTS = 1 << 20


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """Distinct pieces in the order of the vocabulary, start mark as byte 1; controls and byte pieces left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out: dict[bytes, None] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i).encode()
        mark = "▁".encode()
        if mark in piece[1:]:
            continue  # spans words
        out[piece.replace(mark, bytes([MARK]))] = None
    return list(out)


class Vocabulary:
    """Finds the pieces at every place of many pre-tokens."""

    def __init__(self, pieces: list[bytes]):
        self.size = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        buf = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        h = W.hashes(buf, starts, ends) if len(pieces) else np.zeros(0, np.uint64)
        self.order = np.argsort(h)
        self.hash = h[self.order]
        self.some = np.zeros(_SLOTS, bool)
        self.some[(h & np.uint64(_SLOTS - 1)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, and those pieces' numbers."""
        maybe = np.flatnonzero(self.some[(h & np.uint64(_SLOTS - 1)).astype(np.int64)])
        at = np.searchsorted(self.hash, h[maybe])
        at[at == len(self.hash)] = 0
        hit = self.hash[at] == h[maybe] if len(self.hash) else np.zeros(0, bool)
        return maybe[hit], self.order[at[hit]]


class Prefixes:
    """Hashes of all parts of pre-tokens given as rows of a byte matrix."""

    def __init__(self, matrix: np.ndarray, length: np.ndarray):
        self.length = length
        up, self.down = W.powers(matrix.shape[1] + 1)
        value = (matrix.astype(np.uint64) + np.uint64(1)) * up[: matrix.shape[1]]
        self.total = np.zeros((matrix.shape[1] + 1, len(matrix)), np.uint64)
        np.cumsum(value.T, axis=0, out=self.total[1:])

    def part(self, rows: np.ndarray, start: int, end: int) -> np.ndarray:
        """The hash of bytes [start, end) of the rows, equal to words.hashes of them."""
        size = np.uint64((end - start) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
        return W.mix((self.total[end][rows] - self.total[start][rows]) * self.down[start] + size)


def as_matrix(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pre-tokens as rows, start mark first, zero behind; and their lengths with the mark."""
    length = ends - starts
    width = int(length.max(initial=0))
    column = np.arange(width)
    inside = column[None, :] < length[:, None]
    out = np.zeros((len(starts), width + 1), np.uint8)
    out[:, 0] = MARK
    place = np.where(inside, starts[:, None] + column[None, :], 0)
    out[:, 1:] = np.where(inside, buf[place], 0) if len(buf) else 0
    return out, length + 1

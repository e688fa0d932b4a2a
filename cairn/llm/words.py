"""Words of whole texts as 64-bit hashes, without a Python loop over words.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``.  Its hash is a multilinear sum over
its bytes (a random number for the byte times a random odd number for its place), then mixed, so that
two different words share a hash with a probability of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cairn.llm.common import string_offsets

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.Generator(np.random.PCG64(7))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[SPACE] = 0
_FOLD = _BYTE.copy()
_FOLD[65:91] = _BYTE[97:123]
_PLACE = _rng.integers(0, 2**64, 4096, dtype=np.uint64) | np.uint64(1)
_FAR = _rng.integers(0, 2**64, 4096, dtype=np.uint64) | np.uint64(1)
_FAR[0] = 1  # the first 4096 places of a word: its hash does not depend on the words around it
_ODD = _rng.integers(0, 2**64, 8, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes end to end, and where each begins; null is empty."""
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    offs = string_offsets(col)
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


class Words:
    """starts: where each word begins in ``buf``; hashes; first[i]: index of document i's first word (n + 1 of them)."""

    def __init__(self, col: pa.Array, fold: bool = False, step: int = 1 << 19):
        self.buf, self.offs = text_bytes(col)
        buf = self.buf
        self.is_word = ~SPACE[buf]
        begin = self.is_word.copy()
        begin[1:] &= ~self.is_word[:-1]
        edge = self.offs[1:-1]
        edge = edge[edge < len(buf)]
        begin[edge] = self.is_word[edge]
        self.starts = np.flatnonzero(begin)
        n = len(self.starts)
        self.hashes = np.empty(n, dtype=np.uint64)
        table, i = (_FOLD if fold else _BYTE), 0
        while i < n:
            lo = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.starts, lo + step)))
            hi = int(self.starts[j]) if j < n else len(buf)
            s = self.starts[i:j] - lo
            sizes = np.diff(np.append(s, hi - lo))
            place = np.arange(hi - lo)
            place -= np.repeat(s, sizes)
            v = table[buf[lo:hi]]
            v *= _PLACE[place & 4095]
            if sizes.max() > 4096:
                v *= _FAR[(place >> 12) & 4095]
            self.hashes[i:j] = np.add.reduceat(v, s)
            i = j
        mix(self.hashes)
        self.first = np.searchsorted(self.starts, self.offs)

    def lengths(self) -> np.ndarray:
        """Bytes of each word."""
        return np.add.reduceat(self.is_word, self.starts, dtype=np.int64) if len(self.starts) else np.zeros(0, np.int64)

    def counts(self) -> np.ndarray:
        """Words of each document."""
        return np.diff(self.first)

    def whole(self, k: int) -> np.ndarray:
        """Indices of the words at which k words of one document begin."""
        n = len(self.starts)
        end = np.repeat(self.first[1:], self.counts())
        return np.flatnonzero(np.arange(n) + k <= end)


def kgrams(h: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """A hash for each k consecutive entries of h; two lanes are independent."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    a, b = _ODD[2 * lane], _ODD[2 * lane + 1]
    cur = h if lane == 0 else mix(h * _ODD[6])
    out, done, size = None, 0, 1
    while True:
        if k & size:
            part = cur[done : done + n]
            out = part.copy() if out is None else mix(out * a + part)
            done += size
        if size * 2 > k:
            return out
        cur = mix(cur[:-size] * b + cur[size:])
        size *= 2

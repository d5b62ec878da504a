"""Words and word windows of whole Arrow text columns, hashed by numpy without a Python step per word.

A word is a maximal run of bytes other than space and 0x09-0x0D. Its hash is a polynomial over its bytes modulo
2**64 with random coefficients per byte, finished by a bit mixer; hashes of windows are Rabin-Karp polynomials over word
hashes. Both come from one running sum, as the multiplier is odd and so has an inverse modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Everything below 0x80 but letters.
NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])

#: Everything below 0x80 but letters and digits.
NO_TERM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

#: Bytes, and words, hashed at once: what is summed up on the way stays small, whatever the size of a column.
PIECE_BYTES, PIECE_WORDS = 1 << 17, 1 << 16

_coefficients = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_lower = _coefficients.copy()
_lower[ord("A") : ord("Z") + 1] = _coefficients[ord("a") : ord("z") + 1]


class Powers:
    """Powers of an odd base and of its inverse, as far as they were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            have = len(self.up)
            up, down = (np.uint64(pow(b, have, 1 << 64)) for b in (self.base, self.inverse))
            self.up, self.down = np.concatenate([self.up, self.up * up]), np.concatenate([self.down, self.down * down])
        return self.up[:n], self.down[:n]


BYTES = Powers(0x9E3779B97F4A7C15)
WINDOWS = (Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of each value over the whole word (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def running(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """All words of a text column in order: ``hashes``, ``starts`` and ``ends`` (bytes), ``row``, ``counts`` per row.

    ``lower`` folds A-Z in the hashes. With ``letters``, words end at every ASCII character that is no letter; ``apart``
    names any other table of the bytes that end a word. ``beginnings`` asks for hashes of so many first bytes, too.
    """

    def __init__(self, column: pa.Array, lower: bool = False, letters: bool = False, beginnings: tuple[int, ...] = (), apart: np.ndarray = SEPARATOR):
        self.data, self.offsets = buffers(column)
        data, n = self.data, len(column)
        inside = ~(NO_LETTER if letters else apart)[data]
        edge = np.unique(self.offsets)
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[edge[edge < len(data)]] = False
        after[edge[edge > 0] - 1] = False
        self.starts, self.ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(n), self.counts)
        self.hashes, *self.beginnings = self._hash(_lower if lower else _coefficients, beginnings)

    def _hash(self, coefficients: np.ndarray, beginnings: tuple[int, ...]) -> list:
        """Hashes of all words; then, for each size, indices and hashes of the first bytes of the words that have more."""
        out: list = [np.empty(len(self.starts), np.uint64), *([] for _ in beginnings)]
        at, total = 0, len(self.starts)
        while at < total:
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + PIECE_BYTES, "right")))
            up, down = BYTES(self.ends[to - 1] - low)
            sums = running(coefficients[self.data[low : self.ends[to - 1]]] * up)
            starts, ends = self.starts[at:to] - low, self.ends[at:to] - low
            scale = down[starts]
            first = sums[starts]
            out[0][at:to] = mix((sums[ends] - first) * scale + (ends - starts).astype(np.uint64))
            for k, size in enumerate(beginnings, 1):
                longer = np.flatnonzero(ends - starts > size)
                part = (sums[starts[longer] + size] - first[longer]) * scale[longer]
                out[k].append((longer + at, mix(part + np.uint64(size << 32))))
            at = to
        nothing = (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        return [out[0], *(tuple(map(np.concatenate, zip(*parts, strict=True))) if parts else nothing for parts in out[1:])]

    def windows(self, width: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the words at which a window of ``width`` words of one row starts, and the windows' hashes."""
        n = len(self.hashes)
        if n < width:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        starts = np.flatnonzero(self.row[width - 1 :] == self.row[: n - width + 1])
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):  # a hash does not depend on where its piece begins
            low = starts[at]
            to = int(np.searchsorted(starts, low + PIECE_WORDS))
            own = starts[at:to] - low
            up, down = WINDOWS[which](own[-1] + width)
            sums = running(self.hashes[low : low + own[-1] + width] * up)
            out[at:to] = mix((sums[own + width] - sums[own]) * down[own])
            at = to
        return starts, out


def slices(batch: pa.RecordBatch | pa.Table, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch | pa.Table]:
    """Consecutive parts of a batch with at most ``most`` bytes of text each; a longer text is a part of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at, before = 0, 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at, before = to, ends[to - 1]

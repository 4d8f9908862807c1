"""Words of whole columns of texts as flat arrays (vectorised, no per-word Python).

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``; A-Z are lower-cased.  The
bytes of all texts of an Arrow column are handled as one buffer, so the cost
is a few array passes per byte, whatever the number of words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads 64-bit values over the whole range."""
    x = np.array(x, dtype=_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# The low k bytes of an 8-byte block.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=_U)


def utf8_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):      # no chunk at all
        column = pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


@dataclass
class Words:
    """Words of n texts: bounds in ``data`` and the index of the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray        # n + 1 offsets into starts / ends

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def blocks(self, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Each word's bytes as 8-byte numbers (zeros behind its end), and the n + 1 offsets of its numbers."""
        data = np.zeros(len(self.data) + 8, np.uint8)
        data[:len(self.data)] = _LOWER[self.data] if lower else self.data
        at_byte = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        n = (self.ends - self.starts + 7) >> 3
        first = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.starts - 8 * first[:-1], n) + 8 * np.arange(first[-1])
        return at_byte[at] & _KEEP[np.minimum(np.repeat(self.ends, n) - at, 8)], first

    def hashes(self, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of each word, A-Z lower-cased if ``lower``; equal words have equal hashes.

        Every 8-byte block is mixed, then mixed again with its place, before
        the blocks are summed: no two texts cancel by algebra, as they can in
        a polynomial modulo 2^64.
        """
        if not len(self.starts):
            return np.zeros(0, dtype=_U)
        values, first = self.blocks(lower)
        place = np.arange(len(values), dtype=_U) - np.repeat(first[:-1], np.diff(first)).astype(_U)
        sums = np.add.reduceat(mix(mix(values) + (place + _U(1)) * _STEP), first[:-1])
        return mix(sums ^ (self.ends - self.starts).astype(_U))


def split_words(column: pa.Array | pa.ChunkedArray, inside_bytes: np.ndarray = _IS_WORD) -> Words:
    """Words of all texts; ``inside_bytes``: for each byte value, whether it belongs to a word."""
    data, offsets = utf8_buffer(column)
    inside = inside_bytes[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    if len(data):
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[0], edge[-1] = inside[0], inside[-1]
        # Words end where a text ends: a border inside a run closes one word and opens another.
        cuts = np.unique(offsets[1:-1])
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        cuts = cuts[inside[cuts - 1] & inside[cuts]]
        at = np.flatnonzero(edge)
        if len(cuts):
            at = np.sort(np.concatenate([at, cuts, cuts]))
    else:
        at = np.zeros(0, dtype=np.int64)
    starts, ends = at[0::2], at[1::2]
    return Words(data, starts, ends, np.searchsorted(starts, offsets, side="left"))


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each text, and their n + 1 offsets.

    A text with fewer words gives its whole sequence as one; without words, none.
    """
    counts = np.diff(first)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(n)])
    total = len(words)
    rolled = np.zeros(max(total - width + 1, 0), dtype=_U)
    for k in range(width):
        rolled *= _STEP
        rolled += words[k:k + len(rolled)]
    # Of all runs of the flat array keep those that stay within one text.
    keep = np.zeros(total + 1, dtype=np.int64)
    long = np.flatnonzero(counts >= width)
    np.add.at(keep, first[long], 1)
    np.add.at(keep, first[long] + n[long], -1)
    out = np.zeros(out_first[-1], dtype=_U)
    full = np.zeros(out_first[-1], dtype=bool)
    short = np.flatnonzero((counts > 0) & (counts < width))
    full[:] = True
    full[out_first[short]] = False
    out[full] = rolled[np.flatnonzero(np.cumsum(keep[:-1])[:len(rolled)] > 0)]
    for i in short:
        h = int(counts[i])
        for x in words[first[i]:first[i + 1]]:
            h = (h * int(_STEP) + int(x)) & 0xFFFFFFFFFFFFFFFF
        out[out_first[i]] = h ^ 0x5851F42D4C957F2D
    return mix(out), out_first


def shingle_sets(column: pa.Array, width: int):
    """Distinct (hash, text) of a column sorted by hash, and per text the set size and digest."""
    words = split_words(column)
    hashes, first = shingle_hashes(words.hashes(), words.first, width)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.argsort(hashes, kind="stable")
    h, t = hashes[order], owner[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    h, t = h[keep], t[keep]
    sizes = np.bincount(t, minlength=len(first) - 1)
    values = np.zeros(len(hashes), dtype=_U)
    values[order[keep]] = mix(h ^ _U(0xA0761D6478BD642F))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    digests = mix(sums[first[1:]] - sums[first[:-1]] + sizes.astype(_U))
    return h, t, sizes, digests

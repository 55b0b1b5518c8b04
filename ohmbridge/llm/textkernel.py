"""Vectorised numpy kernels over the bytes of an Arrow string column.

A batch's texts lie one after another in one buffer, with offsets. Words are
maximal runs of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. A word's
hash is a polynomial over random 64-bit values of its bytes, modulo 2**64,
finished with a multiply-xor mix, all taken from running sums, so that no Python
code runs per word. Equal words have equal hashes; the chance that two given
different words share one is about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18

_U = np.uint64
_rng = np.random.default_rng(77003)
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_TABLE[65:91] = _TABLE[97:123]
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """The finishing mix of MurmurHash3 (public domain), over uint64."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(BLOCK, 1 << (max(1, n - 1)).bit_length())
    if size not in _powers:
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, byte lengths, word offsets per text)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SEPARATOR[buf]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + BLOCK, "right")))
        stop = ends[j - 1]
        up, down = _power_tables(int(stop - at))
        run = np.empty(stop - at + 1, np.uint64)
        run[0] = 0
        np.cumsum(_TABLE[buf[at:stop]] * up[: stop - at], out=run[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        hashes[i:j] = (run[e] - run[s]) * down[s]
        i = j
    lengths = ends - starts
    return mix(hashes + lengths.astype(np.uint64)), lengths, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, word_offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, shingle offsets per text).

    A text of fewer than ``size`` words has its whole sequence as one shingle; a
    text without words has none.
    """
    counts = np.diff(word_offsets)
    many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate(([0], np.cumsum(many)))
    out = np.empty(out_offsets[-1], np.uint64)
    n = len(hashes)
    if n >= size:
        # the whole run at once, then the windows that lie within one text
        acc = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            acc = mix(acc * _U(0x9FB21C651E98DF25) + hashes[k : n - size + 1 + k])
        text = np.repeat(np.arange(len(counts)), counts)
        ok = text[: n - size + 1] == text[size - 1 :]
        place = np.repeat(counts >= size, many)
        out[place] = acc[ok]
    for t in np.flatnonzero((counts > 0) & (counts < size)):
        acc = np.full(1, int(counts[t]), np.uint64)
        for h in hashes[word_offsets[t] : word_offsets[t + 1]]:
            acc = mix(acc * _U(0x9FB21C651E98DF25) + h)
        out[out_offsets[t]] = acc[0] ^ _U(0x5851F42D4C957F2D)
    return out, out_offsets


def per_text_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values[offsets[i]:offsets[i+1]], zero for empty ranges."""
    run = np.concatenate((np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values, dtype=values.dtype if values.dtype.kind == "f" else np.int64)))
    return run[offsets[1:]] - run[offsets[:-1]]

"""Vectorised word and shingle hashing over Arrow string columns.

Words are maximal runs of bytes that are not separators, after mapping
A-Z to a-z; everything is computed on the UTF-8 buffer with numpy, so
that a batch costs a few passes over its bytes and no Python loop over
words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from commitlens.llm.common import U64, mix64

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII bytes that are neither letters nor digits also end a word here.
NON_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix64(np.arange(256, dtype=U64) + U64(1))
_BASE = 0x2545F4914F6CDD1D
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SLICE = 1 << 20
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, _SLICE), U64(base))
        have[0] = 1
        with np.errstate(over="ignore"):
            have = np.cumprod(have)
        if n <= 4 * _SLICE:
            _powers[base] = have
    return have[:n]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows together and n+1 row offsets; null: empty."""
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def _slices(sep: np.ndarray, brk: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about a megabyte that do not cut a word."""
    a, n = 0, len(sep)
    while a < n:
        b = min(n, a + _SLICE)
        while b < n:
            near = np.flatnonzero(sep[b:b + _SLICE] | brk[b:min(n, b + _SLICE)])
            if len(near):
                b += int(near[0])
                break
            b = min(n, b + _SLICE)
        yield a, b
        a = b


def word_spans(raw: np.ndarray, off: np.ndarray, separators: np.ndarray = BLANKS) -> tuple[np.ndarray, ...]:
    """Start and end byte of every word, and n+1 word offsets of the rows."""
    sep = separators[raw]
    brk = np.zeros(len(raw) + 1, bool)
    brk[off] = True
    inside = ~sep
    first, last = inside.copy(), inside.copy()
    if len(raw):
        first[1:] &= sep[:-1] | brk[1:-1]
        last[:-1] &= sep[1:] | brk[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off), sep, brk


def word_hashes(col: pa.Array, separators: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and n+1 word offsets of the rows."""
    raw, off = text_bytes(col)
    starts, ends, rows, sep, brk = word_spans(raw, off, separators)
    out = np.empty(len(starts), U64)
    with np.errstate(over="ignore"):
        for a, b in _slices(sep, brk):
            i, j = np.searchsorted(starts, (a, b))
            total = np.zeros(b - a + 1, U64)
            np.cumsum(_BYTE[_LOWER[raw[a:b]]] * _power(_BASE, b - a), out=total[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = mix64((total[e] - total[s]) * _power(_BASE_INV, b - a + 1)[s] + (e - s).astype(U64))
    return out, rows


_STEP = [U64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(64)]


def shingle_sets(col: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For every row the sorted distinct hashes of its ``size``-word
    shingles; fewer words: their whole sequence as one; none: empty."""
    words, rows = word_hashes(col)
    with np.errstate(over="ignore"):
        n = max(0, len(words) - size + 1)
        roll = np.zeros(n, U64)
        for k in range(size):
            roll += words[k:k + n] * _STEP[k]
        roll = mix64(roll)
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
            m = b - a
            if m >= size:
                yield np.unique(roll[a:b - size + 1])
            elif m:
                yield mix64(np.array([np.sum(words[a:b] * np.array(_STEP[:m], U64), dtype=U64) + U64(m)]))
            else:
                yield words[:0]

"""Words, hashes and n-grams of whole Arrow batches of text, as numpy arrays.

Texts are UTF-8 bytes in one buffer with offsets. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# ASCII white space.
_SPACES = (9, 10, 11, 12, 13, 32)

SPACE = np.zeros(256, dtype=bool)
SPACE[list(_SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text worked on at a time; a longer text makes a slice of its own.
SLICE_BYTES = 512 << 10

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD1B54A32D192ED03)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in runs of about ``most`` bytes of text."""
    lengths = np.diff(offsets_of(batch.column(column)))
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, done + most, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def offsets_of(texts: pa.Array) -> np.ndarray:
    """Byte offsets into the buffer behind ``texts``."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind, width = (np.int64, 8) if wide else (np.int32, 4)
    if len(texts) == 0:
        return np.zeros(1, dtype=np.int64)
    return np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * width).astype(np.int64)


def packed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of all texts, one after the other."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"")
    offsets = offsets_of(texts)
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE):
    """(starts, ends, first): the words between bytes for which ``apart`` holds; the
    words of text i are ``first[i]`` to ``first[i + 1]``. No word spans two texts."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~apart[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    starts[cuts] = inside[1:-1][cuts]
    ends[cuts - 1] = inside[1:-1][cuts - 1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    made = np.full(n, base, dtype=np.uint64)
    made[:1] = 1
    return np.multiply.accumulate(made)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(base ** i, base ** -i) for i below ``n``, modulo 2 ** 64. Kept for the size of a slice; those
    of a longer text are not."""
    if n > 2 * SLICE_BYTES:
        return _power_table(_BASE, n), _power_table(_BASE_INVERSE, n)
    if len(_powers[0]) < n:
        _powers[:] = [_power_table(base, 2 * SLICE_BYTES) for base in (_BASE, _BASE_INVERSE)]
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of (value + 1) * base ** position before each position."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; it depends on the span's values alone."""
    _, down = powers(len(sums))
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(prefix_sums(data), starts, ends)


def sequences(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): hashes of all runs of ``size`` words per text; a text of fewer
    words, but not none, has the run of all its words."""
    counts = np.diff(first)
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(counts) + 1, dtype=np.int64)
    total = np.zeros(len(hashes), dtype=np.uint64)
    factor = np.uint64(1)
    for j in range(size):
        total[: len(hashes) - j] += hashes[j:] * factor
        factor = factor * _STEP
    runs = mix64(total + np.uint64(size))
    n = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(first[:-1] - offsets[:-1], n) + np.arange(offsets[-1])
    values = runs[at]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        words, short, factor = hashes[first[i] : first[i + 1]], np.uint64(0), np.uint64(1)
        for h in words:
            short = short + h * factor
            factor = factor * _STEP
        values[offsets[i]] = mix64(np.array([short + np.uint64(len(words))]))[0]
    return values, offsets


np.seterr(over="ignore")

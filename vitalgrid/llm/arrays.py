"""NumPy helpers for tasks: words of Arrow text columns as hashes, sets of word shingles, sorted runs."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# an Arrow batch is worked through in slices of about this many bytes of text, which fit a cache
SLICE_BYTES = 1 << 18
SHINGLE = 5

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C55)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; different numbers stay different."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row starts and end within them); NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        end = min(end, len(texts))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the index of each row's first word (one more at the end)."""
    inside = ~_BLANK[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = starts[(starts > 0) & (starts < len(data))]  # a word ends with its row
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, starts)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    if not len(begin):
        return np.empty(0, np.uint64)
    starts = np.zeros(len(data), np.int32)
    starts[begin] = begin
    place = np.arange(len(data), dtype=np.int32) - np.maximum.accumulate(starts)
    lengths = end - begin
    # blanks after a word count as nothing; their place may lie past every word
    factors = powers(_BASE, int(lengths.max()) + 1)
    factors[-1] = 0
    values = factors[np.minimum(place, len(factors) - 1)] * (data.astype(np.uint64) + np.uint64(1))
    values *= ~_BLANK[data]
    return mixed(np.add.reduceat(values, begin) + lengths.astype(np.uint64))


def hashed_words(texts: pa.Array, lower: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of every row."""
    for first, end, data, starts in text_slices(texts):
        data = _LOWER[data] if lower else data
        begin, stop, rows = word_bounds(data, starts)
        hashes = word_hashes(data, begin, stop)
        for i in range(end - first):
            yield first + i, hashes[rows[i] : rows[i + 1]]


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every `width` consecutive words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factors = mixed(np.arange(1, width + 1, dtype=np.uint64) + np.uint64(width << 8)) | np.uint64(1)
    total = hashes[:n] * factors[0]
    for k in range(1, width):
        total += hashes[k : n + k] * factors[k]
    return mixed(total)


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of five words; fewer words are one shingle, no word is none."""
    if 0 < len(hashes) < SHINGLE:
        return window_hashes(hashes, len(hashes))
    return np.unique(window_hashes(hashes, SHINGLE))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int((large[at] == small).sum()) if len(large) else 0


def bytes_of(values: pa.LargeBinaryArray) -> list[bytes]:
    """The values as Python bytes."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1].tolist()
    data = values.buffers()[2].to_pybytes() if values.buffers()[2] is not None else b""
    return [data[a:b] for a, b in zip(offsets, offsets[1:])]


def long_array(values) -> pa.Array:
    """Unsigned hashes as the signed 64-bit numbers that Spark holds."""
    return pa.array(np.asarray(values).view(np.int64) if len(values) else np.empty(0, np.int64), pa.int64())

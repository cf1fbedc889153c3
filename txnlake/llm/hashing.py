"""Word and n-gram hashes of Arrow text columns, vectorised over bytes.

A polynomial hash modulo 2**64 over running sums gives the hash of any byte span
of a chunk in constant time, so a chunk of texts costs a few array passes and no
Python loop over words. Spans are mixed afterwards; two different spans collide
with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
SHINGLE_WORDS = 5
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_BYTES = np.arange(256)
#: Blank bytes are 0x20 and 0x09 to 0x0D; all other bytes belong to words.
IS_BLANK = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        table = np.full(max(n, CHUNK_BYTES), base, np.uint64)
        table[0] = 1
        _powers[key] = np.multiply.accumulate(table)
    return _powers[key][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of texts with about `limit` bytes."""
    data, offsets = text_bytes(column)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Words:
    """Words of a chunk: where they start and end, whose they are, and their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = LOWER):
        blank = IS_BLANK[data]
        inside = ~blank
        first = inside.copy()
        first[1:] &= blank[:-1]
        last = inside.copy()
        last[:-1] &= blank[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        self.data, self.offsets = data, offsets
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: The words of text i are those from bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))
        self.sums = running_hash(data, fold)
        self.hashes = span_hash(self.sums, self.starts, self.ends)


def running_hash(data: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    values = (fold + 1).astype(np.uint64)[data]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * _power(BASE, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of the bytes from each start to its end."""
    raw = (sums[ends] - sums[starts]) * _power(BASE_INVERSE, len(sums))[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def window_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` neighbouring values."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = out * BASE + hashes[i : i + n]
    return mix(out)


def shingles(words: Words, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in text order, and the bounds of each text's own.

    A text of fewer words has its whole word sequence as one; an empty one none.
    """
    count = np.diff(words.bounds)
    own = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(own)])
    out = np.empty(bounds[-1], np.uint64)
    long = window_hash(words.hashes, size)
    row = np.repeat(np.arange(len(own)), own)
    source = words.bounds[row] + np.arange(len(out)) - bounds[row]
    whole = count[row] >= size
    out[whole] = long[source[whole]]
    for n in range(1, size):
        short = np.flatnonzero(count == n)
        if len(short):
            out[bounds[short]] = window_hash(words.hashes, n)[words.bounds[short]]
    return out, bounds


def sets(column: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for first, end, data, offsets in chunks(column):
        values, bounds = shingles(Words(data, offsets), size)
        for i in range(end - first):
            yield first + i, np.unique(values[bounds[i] : bounds[i + 1]])

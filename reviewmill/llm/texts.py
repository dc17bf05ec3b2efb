"""Batches of texts as flat byte arrays: words, word hashes and shingles.

Texts stay in their Arrow buffers. Nothing here makes a Python string per word.
All hashes are 64-bit and depend on the bytes alone, never on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The separators [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RANDOM = np.random.default_rng(20240229)
_BYTE_CODES = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
PLACES = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}

# A slice of a batch holds at most so many bytes, or one text. Work on it takes some fifty
# times as much, which a worker process keeps.
SLICE_BYTES = 1 << 19


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        table = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their boundaries. Null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    bounds = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that no piece but a single long text exceeds ``size`` bytes."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words before each text."""
    inside = ~SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    firsts = bounds[:-1][bounds[:-1] < bounds[1:]]
    before[firsts] = False
    after[firsts[1:] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any byte range follows by one subtraction."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * _power_table(_BASE, len(data)), dtype=np.uint64, out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = _power_table(_BASE_INVERSE, len(sums))
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + lengths * PLACES[0])


def window_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ranges of ``width`` bytes; equal to range_hashes of them."""
    count = max(0, len(sums) - width)
    inverse = _power_table(_BASE_INVERSE, len(sums))[:count]
    return mix((sums[width:] - sums[:count]) * inverse + np.uint64(width) * PLACES[:1])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hashes(prefix_sums(data), starts, ends)


def shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` lower-cased words, and where each text's begin.

    A text with fewer words has one shingle, the whole sequence; a text without
    words has none. Repeats are still there.
    """
    data, bounds = flat(column)
    data = LOWER[data]
    starts, ends, first = spans(data, bounds)
    words = word_hashes(data, starts, ends)
    counts = np.diff(first)
    short = (counts > 0) & (counts < width)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for place in range(width):
        rolled += words[place : place + len(rolled)] * PLACES[place + 1]
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(owner[: len(rolled)] == owner[width - 1 :]) if len(rolled) else []
    text_of = owner[whole]
    values = mix(rolled[whole])
    extra = []
    for i in np.flatnonzero(short):
        part = words[first[i] : first[i + 1]]
        total = part @ PLACES[1 : len(part) + 1] + np.array([len(part)], np.uint64) * PLACES[0]
        extra.append(total[0])
    if extra:
        text_of = np.concatenate([text_of, np.flatnonzero(short)])
        values = np.concatenate([values, mix(np.array(extra, np.uint64))])
        order = np.argsort(text_of, kind="stable")
        text_of, values = text_of[order], values[order]
    return values, np.searchsorted(text_of, np.arange(len(counts) + 1))

"""Words and shingles of a batch of texts as numpy arrays.

A word is a run of bytes outside 0x20 and 0x09-0x0D, so words never depend on a locale. All rows of
a chunk are handled by the same array operations; chunks are cut at rows, and long rows at words, so
that the temporary arrays stay small however long a text is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

CHUNK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
LOWER_BYTES = LOWER.tobytes()

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


#: Rows that go to Python at a time: texts can be long.
BATCH_ROWS = "2000"


def bounded(docs: DataFrame) -> DataFrame:
    """The same frame, whose session hands at most BATCH_ROWS rows at a time to Python."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return docs


def release() -> None:
    """Gives freed memory back to the system, which a reused worker would else hold through later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function of batches, which begins and ends by `release`."""
    def run(batches: Iterator) -> Iterator:
        release()
        try:
            yield from work(batches)
        finally:
            release()
    return run


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWERS = _powers(_BASE, CHUNK), _powers(_INVERSE, CHUNK)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and their offsets; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `size` bytes, one row at least."""
    n, start = len(offsets) - 1, 0
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
        yield start, min(end, n)
        start = min(end, n)


@dataclass
class Words:
    """start and end: bytes within the chunk; row: the chunk's row; hash: of the word's bytes; first: the
    index of each row's first word, with the total at the end."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; a row's end also ends a run."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial hash of each data[start:end], by differences of running sums over pieces of CHUNK bytes."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        a = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, a + CHUNK, "right")))
        piece = data[a:int(end[j - 1])].astype(np.uint64)
        power, inverse = _POWERS
        if len(piece) > CHUNK:
            power, inverse = _powers(_BASE, len(piece)), _powers(_INVERSE, len(piece))
        piece += np.uint64(1)
        piece *= power[:len(piece)]
        total = np.empty(len(piece) + 1, np.uint64)
        total[0] = 0
        np.cumsum(piece, out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (total[e] - total[s]) * inverse[s]
        i = j
    return mix(out)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    inside = ~SPACE[data]
    start, end = runs(data, offsets, inside)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, row, _hashes(LOWER[data] if lower else data, start, end), first)


def segments(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hashes of given byte ranges in ascending order, such as lines."""
    return _hashes(data, start, end)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each `size` consecutive values, whether or not they are of one row."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, size):
        out *= _STEP
        out += hashes[i:i + n]
    return mix(out)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of one text, ascending; a shorter text is one shingle, an empty one has none."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    if len(hashes) < size:
        return windows(hashes, len(hashes)) ^ np.uint64(len(hashes))
    found = np.sort(windows(hashes, size))
    keep = np.empty(len(found), bool)
    keep[0] = True
    np.not_equal(found[1:], found[:-1], out=keep[1:])
    return found[keep]

"""Words and shingles of whole Arrow batches as 64-bit hashes, without a loop per word.

A word is a run of bytes other than space and ``\\x09-\\x0D``, with A-Z in lower case.
Null texts are empty. Batches are cut into slices of at most ``SLICE_BYTES`` (a single
longer text is a slice of its own), so that memory stays bounded by the longest text.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 20
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches near 8 MB: texts may be very long, and workers have little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return freed memory to the system: Spark keeps Python workers for later tasks, which share it."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(ctypes.util.find_library("c"))
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function over a task's batches that leaves its worker small."""

    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, offsets from 0, bytes in lower case)`` of consecutive rows."""
    if isinstance(texts, pa.ChunkedArray):
        before = 0
        for chunk in texts.chunks:
            yield from ((before + first, offsets, data) for first, offsets, data in slices(chunk))
            before += len(chunk)
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, ends[first : last + 1] - ends[first], _LOWER[data[ends[first] : ends[last]]]
        first = last


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the place of each row's first word among them."""
    inside = ~_SPACE[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]  # words end where a row ends
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes and length, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded.tobytes(), strides=(1,))
    length = ends - starts
    hashed = length.astype(np.uint64) * _ODD
    at, done = np.arange(len(starts)), 0
    while at.size:
        left = np.minimum(length[at] - done, 8)
        hashed[at] = mix(hashed[at] * _ODD + (eight[starts[at] + done] & _MASKS[left]))
        done += 8
        at = at[length[at] > done]
    return hashed


def shingles(hashed: np.ndarray) -> np.ndarray:
    """The distinct shingles of one text, ascending; of a shorter text its whole sequence."""
    n = len(hashed)
    width = min(SHINGLE, n)
    if not n:
        return hashed
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total = total * _ODD + hashed[k : n - width + 1 + k]
    return np.unique(mix(total))


def row_shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    """``shingles`` of each row."""
    for _, offsets, data in slices(texts):
        starts, ends, firsts = spans(data, offsets)
        hashed = word_hashes(data, starts, ends)
        for a, b in zip(firsts[:-1], firsts[1:], strict=True):
            yield shingles(hashed[a:b])

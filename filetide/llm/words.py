"""Arrow and numpy helpers on batches of texts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on between tasks, beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between ASCII white space, and the bounds of each text's words (one more than texts)."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, bounds = parts.flatten(), list_bounds(parts)
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)), before[bounds]


def list_bounds(lists: pa.Array) -> np.ndarray:
    bounds = lists.offsets.to_numpy().astype(np.int64)
    return bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefixes:
    """Hashes of any stretches of one byte string, each from two numbers of a running sum.

    A stretch hashes to sum(TABLE[byte] * BASE ** position) modulo 2 ** 64, moved to position 0.
    """

    BASE = np.uint64(0x9E3779B97F4A7C15)
    INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    powers = inverses = np.ones(1, np.uint64)

    def __init__(self, raw: np.ndarray):
        n = len(raw) + 1
        if n > len(Prefixes.powers):
            size = max(n, 1 << 20)
            steps = np.full(size, self.BASE), np.full(size, self.INVERSE)
            steps[0][0] = steps[1][0] = 1
            Prefixes.powers, Prefixes.inverses = np.cumprod(steps[0]), np.cumprod(steps[1])
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(self.TABLE[raw] * self.powers[: n - 1], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverses[starts])


def raw_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings, and the bounds of each. Nulls are empty."""
    if strings.null_count:
        strings = pc.fill_null(strings, "")
    kind = np.int64 if pa.types.is_large_string(strings.type) else np.int32
    bounds = np.frombuffer(strings.buffers()[1], kind)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    if not len(strings) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(strings) + 1, np.int64)
    data = np.frombuffer(strings.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
    return data, bounds - bounds[0]


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words."""
    raw, bounds = raw_bytes(words)
    return Prefixes(raw).hashes(bounds[:-1], bounds[1:]) + mix(np.diff(bounds).astype(np.uint64))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start .. start + length - 1 of every pair, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)

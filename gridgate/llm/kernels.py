"""Array work on many whole texts at once: words, hashes and blocks of bounded size, used inside Spark tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one task works on at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C13
_powers: dict[int, np.ndarray] = {}

#: Bytes of words for decontamination: digits, letters and everything beyond ASCII.
ALNUM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
#: Bytes that separate words for shingles: blanks and the control characters that break lines.
SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
#: A-Z to a-z, all else unchanged.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one array of bytes, and where each begins (one entry more than texts). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[starts[0]:starts[-1]], starts - starts[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """The rows of a task again, in tables that hold about `limit` bytes of text each."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        lengths = pc.fill_null(pc.binary_length(table.column(text)), 0).to_numpy().astype(np.int64)
        ends, row = np.cumsum(lengths), 0
        while row < len(ends):
            room = max(limit - size, 0) + (ends[row - 1] if row else 0)
            cut = max(int(np.searchsorted(ends, room, "right")), row if held else row + 1)
            if cut > row:
                held.append(table.slice(row, cut - row))
                size += int(lengths[row:cut].sum())
                row = cut
            if row < len(ends) or size >= limit:
                yield pa.concat_tables(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.concat_tables(held).combine_chunks()
    held = table = None
    release()


def release() -> None:
    """Give memory that a task no longer needs back to the system: its worker lives on, and so do those of other operators."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        pass


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true entries; none crosses from one text to the next."""
    if not inside.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh = np.zeros(inside.size + 1, bool)
    fresh[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    return (np.flatnonzero(inside & (~before | fresh[:-1])), np.flatnonzero(inside & (~after | fresh[1:])) + 1)


def spread(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and each one's place in its own range."""
    before = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(before, lengths)
    return np.repeat(starts, lengths) + place, place


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of an odd number, modulo 2**64; kept for the next call."""
    if base not in _powers or len(_powers[base]) < n:
        table = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        table[0] = 1
        _powers[base] = np.multiply.accumulate(table)
    return _powers[base][:n]


class RunHashes:
    """64-bit polynomial hashes of any runs of bytes of a block, from sums over the whole block."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.multiply(_BYTE[data], powers(_BASE, len(data)), out=self.sums[1:])
        np.cumsum(self.sums, out=self.sums)
        self.inverse = powers(pow(_BASE, -1, 1 << 64), len(data) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return RunHashes(data)(starts, ends)


def owner(offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which text each place lies in."""
    return np.searchsorted(offsets, places, "right") - 1
